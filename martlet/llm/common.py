"""Shared pieces: table reads, written lineage cuts, connected components."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.session import scratch_path, tune

#: ``[\x20\x09-\x0D]``: what the text contracts call white space.
ASCII_SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder (``spark.checkpoint.dir``) and read
    it back: the lineage is cut and lost executors cost only running tasks."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a written table up to which a join broadcasts it (some tens of MB
#: in memory); a longer table is joined by a shuffle.
BROADCAST_ROWS = 1 << 18


def sized(table: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``table`` (written, so its count reads footers only), marked for
    broadcast when its measured row count allows it."""
    return F.broadcast(table) if table.count() <= rows else table


def shrink(df: DataFrame, rows: int, per_task: int = 1 << 15) -> DataFrame:
    """``df``, which holds at most ``rows`` rows, in no more tasks than these
    need: a round over a small table does not pay for every shuffle partition.
    A large table keeps its partitions."""
    return df.coalesce(max(8, -(-rows // per_task)))


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser (a bijection on 64-bit values)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def connected_components(edges: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` ``edges(a long, b long)`` -> ``(id, component)``, the
    smallest id that each node can reach.  Every round takes the least label
    among a node's neighbours (partial aggregates, so a hub costs one row per
    map task) and then jumps to that label's own label; rounds stop when nothing
    changes.  Nothing is gathered on the driver but one count per round."""
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct()
    e = store(shrink(both, 2 * rows), "cc-edges")
    n = e.count()
    lab = store(shrink(e.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m"))
                       .select("id", F.least("id", "m").alias("component")), n), "cc-labels")
    while True:
        near = (e.join(lab.withColumnRenamed("id", "b"), "b")
                .groupBy(F.col("a").alias("id")).agg(F.min("component").alias("m")))
        hooked = store(shrink(lab.join(near, "id").select(
            "id", F.col("component").alias("was"),
            F.least("component", "m").alias("component")), n), "cc-hooked")
        root = hooked.select(F.col("id").alias("component"), F.col("component").alias("root"))
        jumped = store(shrink(hooked.join(root, "component").select(
            "id", "was", F.col("root").alias("component")), n), "cc-jumped")
        lab = jumped.select("id", "component")
        if jumped.where("component <> was").isEmpty():
            return lab
