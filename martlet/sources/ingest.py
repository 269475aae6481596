"""Sources and sinks: declared-source scans, bronze copies, typed tables,
stamped appends, surrogate-key continuation, materialisation and load audit.

Every write goes below the cluster's shared folder (``spark.checkpoint.dir``,
see :func:`martlet.session.scratch_path`) or to a caller-given path, never to
a machine-local temp folder.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.session import scratch_path


# ----------------------------------------------------------------- reading
def param_source(spark: SparkSession, key: str, default: str) -> str:
    """A source location taken from session config, with a default."""
    return spark.conf.get(key, None) or default


def scan_source(spark: SparkSession, location: str, schema: T.StructType | None = None,
                fmt: str = "parquet") -> DataFrame:
    """Read a declared source; with a schema no inference pass is made."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(location)


# ----------------------------------------------------------------- writing
def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet",
                partition_by=None) -> None:
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def materialize_table(spark: SparkSession, df: DataFrame, name: str,
                      path: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Table materialisation: overwrite-write, then serve the written copy.

    The re-read plan starts at the files, so downstream queries neither
    recompute nor keep the upstream lineage (safe under executor loss)."""
    path = path or scratch_path(spark, name)
    write_table(df, path, "overwrite", fmt)
    return spark.read.format(fmt).load(path)


def materialize_view(df: DataFrame, name: str) -> DataFrame:
    """View materialisation: a named temp view over the lazy plan."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def bronze_copy(spark: SparkSession, raw: DataFrame, name: str,
                path: str | None = None) -> DataFrame:
    """Batch copy of a raw table, unchanged, written as ``name``."""
    return materialize_table(spark, raw, name, path)


def create_typed_table(spark: SparkSession, data, schema: T.StructType,
                       path: str | None = None, name: str = "typed_table") -> DataFrame:
    """Create-or-replace a table with an explicit schema.

    ``data`` is a list of rows (small literal loads) or a DataFrame; a
    DataFrame is cast column by column to ``schema`` (ANSI casts fail on
    overflow instead of wrapping) and must carry every schema column.
    """
    if isinstance(data, DataFrame):
        missing = [f.name for f in schema.fields if f.name not in data.columns]
        if missing:
            raise ValueError(f"columns missing for typed table: {missing}")
        df = data.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name, metadata=f.metadata)
                           for f in schema.fields])
    else:
        df = spark.createDataFrame(data, schema)
    if path is None and name is None:
        return df
    return materialize_table(spark, df, name, path)


def append_batch(batch: DataFrame, path: str, fmt: str = "parquet",
                 stamp_column: str = "_loaded_at") -> None:
    """Append rows stamped with the load time: one ``localtimestamp`` per
    query (the whole batch shares one stamp), TIMESTAMP_NTZ like the raw
    tables' ``_loaded_at``.

    When the table exists, the batch is cast to its schema (by name; a
    missing or extra column fails), so every file of the table carries the
    same physical types — mixed INT32/INT64 files would make later reads fail.
    """
    stamped = batch.withColumn(stamp_column, F.localtimestamp())
    spark = batch.sparkSession
    try:
        target = spark.read.format(fmt).load(path).schema
    except AnalysisException as exc:
        if exc.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        target = None  # no table yet: the batch defines it
    if target is not None:
        have, want = set(stamped.columns), [f.name for f in target.fields]
        if have != set(want):
            raise ValueError(f"batch columns {sorted(have)} do not match table {sorted(want)}")
        stamped = stamped.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name)
                                   for f in target.fields])
    stamped.write.mode("append").format(fmt).save(path)


def next_surrogate_keys(existing: DataFrame, new_rows: DataFrame, key: str,
                        new_key: str | None = None, order_by: str | None = None) -> DataFrame:
    """Give ``new_rows`` integer keys continuing from ``max(existing.key)``, in
    the order of ``order_by`` when given (a range partitioning, no global sort).

    No global sort or single-partition ``row_number``: rows are tagged with
    their partition and in-partition position, the per-partition counts (one
    row per partition) are prefix-summed, and the offsets are broadcast back.
    The tagged rows are checkpointed first so that the counts and the keyed
    rows come from the very same data, even if a task is recomputed.
    """
    new_key = new_key or key
    base = existing.agg(F.coalesce(F.max(key), F.lit(0)).cast("bigint").alias("_base"))
    placed = new_rows
    if order_by:
        placed = new_rows.repartitionByRange(order_by).sortWithinPartitions(order_by)
    tagged = (placed
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id()
                          - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)))
    tagged = tagged.checkpoint(eager=True)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # One row per input partition: the window is bounded by the partition count.
    offsets = (counts.withColumn("_offset", F.coalesce(
        F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)))
        .crossJoin(base)
        .select("_pid", (F.col("_base") + F.col("_offset")).alias("_start")))
    keyed = tagged.join(F.broadcast(offsets), "_pid")
    cols = [c for c in new_rows.columns if c != new_key]
    # keep the key's own type (an INT key stays INT; ANSI raises on overflow)
    key_type = existing.schema[key].dataType
    return keyed.select((F.col("_start") + F.col("_pos") + 1).cast(key_type).alias(new_key), *cols)


def load_audit(tables: dict[str, DataFrame], stamp_column: str = "_loaded_at") -> DataFrame:
    """Per table: row count and newest load stamp, unioned (tbl, rows, last_loaded)."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows"),
                    F.max(stamp_column).alias("last_loaded"))
             .select(F.lit(name).alias("tbl"), "rows", "last_loaded")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)
