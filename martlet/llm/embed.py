"""Embedding near-dedup: an exact metric range join.

Unit vectors at cosine >= t lie within eps = sqrt(2 - 2 t) of each other.
Pivots (a bounded sample) split each label's vectors into cells; a vector is
copied into another pivot's cell when the triangle inequality, or the tighter
distance to the plane between the two pivots, lets a neighbour live there.  Every
cell then finds all neighbours of its own vectors by itself, in pairs of blocks
of at most about ``BLOCK`` rows.  A block pair returns one row per vector: how
many vectors it links to, and the least vector it is connected with there;
links themselves are never listed, so a group of copies stays linear.

Vectors with the same components and label are one node from the start.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, and rows with a null label, link with nothing; vectors of different
length do not link; ``vec_id`` is the key; a null vec_id is its own component;
an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, store

BLOCK, MAX_PIVOTS = 2048, 256


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = []
        for v in batch.column("embedding").to_pylist():
            unit = None
            if v and None not in v:
                x = np.array(v, np.float64)
                top = np.abs(x).max()
                if np.isfinite(top) and top > 0:
                    x = x / top
                    unit = x / math.sqrt(float(x @ x))
            made.append(None if unit is None else unit.tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("grp"), pa.array(made, pa.binary())],
            names=["vec_id", "grp", "unit"])


def _assign(pivots: np.ndarray, eps: float):  # noqa: ANN202
    between = np.sqrt(np.maximum(0, 2 - 2 * pivots @ pivots.T)) if len(pivots) else np.zeros((0, 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [np.frombuffer(u.as_buffer(), np.float64) for u in batch.column("unit")]
            rows, cells, homes = [], [], []
            for i, v in enumerate(x):
                if pivots.shape[1:] != v.shape:  # another length than the pivots': one cell
                    rows.append(i)
                    cells.append(-1)
                    homes.append(True)
                    continue
                d = np.sqrt(np.maximum(0, 2 - 2 * (pivots @ v)))
                home = int(d.argmin())
                near = d - d[home] <= 2 * eps + 1e-9
                plane = d * d - d[home] ** 2 <= 2 * between[home] * eps + 1e-9
                for j in np.flatnonzero(near & plane | (np.arange(len(d)) == home)):
                    rows.append(i)
                    cells.append(int(j))
                    homes.append(int(j) == home)
            part = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ("grp", "rep", "n", "unit")), pa.array(cells, pa.int32()), pa.array(homes)],
                names=["grp", "rep", "n", "unit", "cell", "home"])
    return run


def _join_blocks(threshold: float):  # noqa: ANN202
    schema = pa.schema([("rep", pa.int64()), ("links", pa.int64()), ("anchor", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        side = table["side"].to_numpy()
        rep, n = table["rep"].to_numpy(), table["n"].to_numpy()
        unit = np.frombuffer(b"".join(table["unit"].to_pylist()), np.float64).reshape(table.num_rows, -1)
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(left) or not len(right):
            return schema.empty_table()
        hit = unit[left] @ unit[right].T >= threshold
        hit &= rep[left][:, None] != rep[right][None, :]
        links = hit @ n[right]
        ids, place = np.unique(np.concatenate((rep[left], rep[right])), return_inverse=True)
        i, j = np.nonzero(hit)
        i, j = place[:len(left)][i], place[len(left):][j]
        label = np.arange(len(ids))
        while len(i):  # least place that each vector is connected with in this block pair
            was = label.copy()
            np.minimum.at(label, i, was[j])
            np.minimum.at(label, j, was[i])
            label = label[label]
            if (label == was).all():
                break
        total = np.zeros(len(ids), np.int64)
        total[place[:len(left)]] = links
        keep = (total > 0) | (label != np.arange(len(ids)))
        return pa.table([pa.array(ids[keep]), pa.array(total[keep]), pa.array(ids[label[keep]])], schema=schema)
    return run


def near_vectors(vectors: DataFrame, threshold: float = 0.93, block: int = BLOCK) -> DataFrame:
    """``vectors(vec_id, embedding, label)`` ->
    ``vec_id, n_links, component_id, kept``."""
    eps = math.sqrt(max(0.0, 2 - 2 * threshold))
    src = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                         F.col("label").cast("string").alias("grp"),
                         F.col("embedding").cast("array<double>").alias("embedding"))
    units = store(src.mapInArrow(_units, "vec_id long, grp string, unit binary")
                  .withColumn("k1", F.xxhash64("unit")).withColumn("k2", F.xxhash64(F.lit("second"), "unit")),
                  "vec-units")
    usable = "grp is not null and unit is not null and vec_id is not null"
    nodes = store(units.where(usable).groupBy("grp", "k1", "k2")
                  .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("unit").alias("unit")),
                  "vec-nodes")
    total = nodes.count()
    wanted = min(MAX_PIVOTS, max(1, math.ceil(math.sqrt(total) / 64)))
    sample = nodes.select("unit", F.xxhash64("rep").alias("o")).orderBy("o", "unit").limit(wanted).collect()
    sample = [np.frombuffer(r["unit"], np.float64) for r in sample]
    sample = [v for v in sample if len(v) == len(sample[0])]
    pivots = np.unique(np.array(sample), axis=0) if sample else np.zeros((0, 0))
    cells = store(nodes.select("grp", "rep", "n", "unit").mapInArrow(
        _assign(pivots, eps), "grp string, rep long, n long, unit binary, cell int, home boolean")
        .withColumn("dim", F.octet_length("unit")), "vec-cells")
    key = ["grp", "dim", "cell"]
    sizes = store(cells.groupBy(*key).agg(
        F.ceil(F.sum(F.col("home").cast("int")) / block).cast("int").alias("lefts"),
        F.ceil(F.count(F.lit(1)) / block).cast("int").alias("rights")).where("lefts > 0"), "vec-sizes")
    sized = cells.join(sizes, key)
    mine = F.xxhash64("rep")
    left = (sized.where("home").withColumn("a", F.pmod(mine, F.col("lefts")).cast("int"))
            .withColumn("b", F.explode(F.sequence(F.lit(0), F.col("rights") - 1))).withColumn("side", F.lit(0)))
    right = (sized.withColumn("b", F.pmod(mine, F.col("rights")).cast("int"))
             .withColumn("a", F.explode(F.sequence(F.lit(0), F.col("lefts") - 1))).withColumn("side", F.lit(1)))
    columns = [*key, "a", "b", "side", "rep", "n", "unit"]
    found = store(left.select(columns).union(right.select(columns)).groupBy(*key, "a", "b")
                  .applyInArrow(_join_blocks(threshold), "rep long, links long, anchor long"), "vec-links")
    comp = connected_components(found.where("rep <> anchor").select(F.col("rep").alias("a"), F.col("anchor").alias("b")),
                                found.count())
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = store(nodes.drop("unit").join(links, "rep", "left").join(comp.withColumnRenamed("id", "rep"), "rep", "left")
                    .select("grp", "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                            F.coalesce("component", "rep").alias("component")), "vec-classes")
    out = units.drop("unit").join(classes, ["grp", "k1", "k2"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
