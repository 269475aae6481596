"""Hard-negative mining over anchor-clustered shared lists.

Rows become integer vectors, written once.  Anchors (``vec_id`` divisible by
``anchor_every``) are taken in passes of about ``ANCHORS_PER_PASS`` at most (hash groups); a pass is
clustered (spherical k-means, centroids fitted on at most ``FIT_ROWS`` anchors by
hash order, every anchor assigned) and broadcast, which bounds its size.  Tasks
scan the candidates in blocks.  For each cluster a block's candidates are sorted
once by their angular upper bound

    |candidate| * cos(max(0, angle(candidate, centroid) - widest angle of a member))

and all members walk that one list: a member stops as soon as its own length times
the next bound lies below what it still needs, which certifies that no later row can
enter its result.  What a task has found lets its next blocks stop sooner.  Tasks
return at most ``top`` rows per search; searches are merged by rank, with a partial
limit before the shuffle.

A pass walks twice: for each anchor's first ``positives`` rows of its label, then,
for each positive, for the first ``negatives`` rows of another label inside the band
of scores that the positive's score sets.  Floating point only decides the bounds
(with a margin); scores are exact integers.

Defined cases: rows with a null label or vector, or with a null or non-finite
component, take no part; vectors are compared with those of their own length only;
a component is ``floor(256 * x)``, held to +-(2**31 - 1); scores beyond a long's
range are held to it; ties go to the smaller ``vec_id``, null last, then to the
earlier row; rows that repeat a ``vec_id`` are rows of their own and each other's
candidates; a null ``vec_id`` is no anchor; an anchor without positives, or a
positive of negative score (its band is empty), has no rows; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch_path, store

POSITIVES, NEGATIVES, SCALE = 5, 10, 256
#: Least and greatest score of a negative, in hundredths of its positive's.
BAND = (30, 90)
ANCHORS_PER_PASS, FIT_ROWS, MEMBERS, MAX_CLUSTERS = 16384, 4096, 128, 64
#: Candidates sorted at once, scored between two looks at the bounds, and searches compared at once.
BLOCK, STEP, TOGETHER = 16384, 512, 1024
_LONG = 2**63 - 1


class Searches(NamedTuple):
    """Walks of one cluster: ``vector[anchor]`` against scores in ``[low, high]``."""

    unit: np.ndarray      # centroid
    spread: float         # widest angle between the centroid and a member
    vectors: np.ndarray   # members x dimensions, integers
    norms: np.ndarray
    rows: np.ndarray      # row number of each member
    labels: np.ndarray
    anchor: np.ndarray    # per search: its member, the search's number, its score limits
    number: np.ndarray
    low: np.ndarray
    high: np.ndarray


# --- rows ------------------------------------------------------------------

def _integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = []
        for v in batch.column("embedding").to_pylist():
            ok = v is not None and None not in v
            x = np.array(v if ok else [], np.float64)
            ok = ok and bool(np.isfinite(x).all())
            made.append(np.clip(np.floor(SCALE * x), -(2**31 - 1), 2**31 - 1).astype("<i4").tobytes() if ok else None)
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("row", "vec_id", "label")] + [pa.array(made, pa.binary())],
                                         names=["row", "vec_id", "label", "vector"])


def usable_rows(vectors: DataFrame, shift_every: int, n_labels: int) -> DataFrame:
    label = F.col("label").cast("long")
    if shift_every:
        label = F.when(F.col("vec_id") % shift_every == 0, (label + 1) % n_labels).otherwise(label)
    src = vectors.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
                         F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    src = src.where("label is not null and embedding is not null").withColumn("label", label)
    made = src.mapInArrow(_integers, "row long, vec_id long, label long, vector binary")
    return store(made.where("vector is not null"), "negatives-rows")


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of ``a`` and ``b``, held to a long."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if top < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if top < 2**63:
        return a.astype(np.int64) @ b.astype(np.int64).T
    return np.clip((a.astype(object) @ b.astype(object).T), -_LONG - 1, _LONG).astype(np.int64)


# --- clusters --------------------------------------------------------------

def _units(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    wide = vectors.astype(np.float64)
    norms = np.sqrt((wide * wide).sum(1))
    return wide / np.maximum(norms, 1e-300)[:, None], norms


def centroids(units: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means; the first ``k`` rows (they come in hash order) start it."""
    centres = units[:k].copy()
    for _ in range(rounds):
        at = (units @ centres.T).argmax(1)
        total = np.zeros_like(centres)
        np.add.at(total, at, units)
        size = np.sqrt((total * total).sum(1))
        centres[size > 0] = total[size > 0] / size[size > 0, None]
    return centres


def clusters(rows: np.ndarray, labels: np.ndarray, vectors: np.ndarray, anchor: np.ndarray, low: np.ndarray,
             high: np.ndarray) -> list[Searches]:
    """Anchors of one vector length, by cluster, with the searches of each."""
    units, norms = _units(vectors)
    k = max(1, min(MAX_CLUSTERS, len(rows) // MEMBERS))
    centres = centroids(units[:FIT_ROWS], k)
    home = (units @ centres.T).argmax(1)
    place = np.zeros(len(rows), np.int64)
    out = []
    for c in range(k):
        member = np.flatnonzero(home == c)
        place[member] = np.arange(len(member))
        mine = np.flatnonzero(home[anchor] == c)
        if len(mine):
            spread = float(np.arccos(np.clip(units[member] @ centres[c], -1, 1)).max())
            out.append(Searches(centres[c], spread, vectors[member], norms[member], rows[member], labels[member],
                                place[anchor[mine]], mine, low[mine], high[mine]))
    return out


# --- the walk --------------------------------------------------------------

class _Found:
    """The best ``top`` rows of a cluster's searches so far, and the score each needs."""

    def __init__(self, s: Searches, top: int) -> None:
        self.s, self.top, self.need = s, top, s.low.copy()
        self.table = np.zeros((4, 0), np.int64)  # search of the cluster, score, vec_id, row

    def add(self, parts: list[np.ndarray]) -> None:
        t = np.concatenate([self.table, *parts], axis=1)
        t = t[:, np.lexsort((t[3], t[2], ~t[1], t[0]))]
        first = np.flatnonzero(np.concatenate(([True], t[0, 1:] != t[0, :-1])))
        rank = np.arange(t.shape[1]) - np.repeat(first, np.diff(np.append(first, t.shape[1])))
        self.table = t[:, rank < self.top]
        full = t[:, rank == self.top - 1]
        self.need[full[0]] = np.maximum(self.need[full[0]], full[1])


def walk(found: _Found, units: np.ndarray, norms: np.ndarray, vectors: np.ndarray, labels: np.ndarray,
         ids: np.ndarray, rows: np.ndarray, same_label: bool) -> int:
    """Sends a block down the cluster's list; returns how many candidates were scored
    before every member had stopped."""
    s = found.s
    bound = norms * np.cos(np.maximum(0, np.arccos(np.clip(units @ s.unit, -1, 1)) - s.spread))
    order = np.argsort(-bound, kind="stable")
    for at in range(0, len(order), STEP):
        limit = s.norms * bound[order[at]]
        limit += 1e-9 * np.abs(limit) + 1e-6
        open_ = np.flatnonzero(limit[s.anchor] >= found.need)  # an equal score may still win a tie
        if not len(open_):
            return at
        active, back = np.unique(s.anchor[open_], return_inverse=True)
        part = order[at:at + STEP]
        scores = exact_scores(s.vectors[active], vectors[part])
        right = (labels[part][None, :] == s.labels[active][:, None]) == same_label
        if same_label:
            right &= rows[part][None, :] != s.rows[active][:, None]
        new = []
        for q in range(0, len(open_), TOGETHER):
            search, member = open_[q:q + TOGETHER], back[q:q + TOGETHER]
            mine = scores[member]
            i, j = np.nonzero(right[member] & (mine >= found.need[search, None]) & (mine <= s.high[search, None]))
            new.append(np.stack((search[i], mine[i, j], ids[part[j]], rows[part[j]])))
        if any(x.size for x in new):
            found.add(new)
    return len(order)


_HIT = "search long, score long, vec_id long, row long"
_NULL_ID = _LONG  # sorts last; a null vec_id stays null outside


def _scan(shared, top: int, same_label: bool):  # noqa: ANN001, ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_length = {d: [_Found(s, top) for s in searches] for d, searches in shared.value.items()}
        held, size = [], 0

        def flush() -> None:
            table = pa.Table.from_batches(held)
            width = np.array([len(x.as_buffer()) // 4 for x in table["vector"]])
            for d, lists in by_length.items():
                at = np.flatnonzero(width == d)
                if not len(at):
                    continue
                part = table.take(pa.array(at))
                vectors = np.frombuffer(b"".join(part["vector"].to_pylist()), "<i4").reshape(len(at), d)
                units, norms = _units(vectors)
                ids = part["vec_id"].fill_null(_NULL_ID).to_numpy()
                for found in lists:
                    walk(found, units, norms, vectors, part["label"].to_numpy(), ids, part["row"].to_numpy(), same_label)

        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK):
                held.append(batch.slice(i, BLOCK))
                size += held[-1].num_rows
                if size >= BLOCK:
                    flush()
                    held, size = [], 0
        if held:
            flush()
        for found in (f for lists in by_length.values() for f in lists):
            search, *rest = found.table
            yield pa.RecordBatch.from_arrays([pa.array(found.s.number[search]), *map(pa.array, rest)],
                                             names=["search", "score", "vec_id", "row"])
    return run


def _search(rows: DataFrame, anchors: pa.Table, anchor: np.ndarray, low: np.ndarray, high: np.ndarray, top: int,
            same_label: bool) -> DataFrame:
    """The best ``top`` rows of every search: ``search, score, vec_id, row, rank``."""
    width = np.array([len(x.as_buffer()) // 4 for x in anchors["vector"]], np.int64)
    by_length = {}
    for d in np.unique(width).tolist():
        at = np.flatnonzero(width == d)
        place = np.full(anchors.num_rows, -1)
        place[at] = np.arange(len(at))
        mine = np.flatnonzero(place[anchor] >= 0)
        part = anchors.take(pa.array(at))
        vectors = np.frombuffer(b"".join(part["vector"].to_pylist()), "<i4").reshape(len(at), d)
        by_length[d] = [s._replace(number=mine[s.number]) for s in clusters(
            part["row"].to_numpy(), part["label"].to_numpy(), vectors, place[anchor[mine]], low[mine], high[mine])]
    shared = rows.sparkSession.sparkContext.broadcast(by_length)
    hits = rows.mapInArrow(_scan(shared, top, same_label), _HIT)
    best = Window.partitionBy("search").orderBy(F.col("score").desc(), "vec_id", "row")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)


def mine(vectors: DataFrame, anchor_every: int = 100, shift_every: int = 0, n_labels: int = 10,
         positives: int = POSITIVES, negatives: int = NEGATIVES, band: tuple[int, int] = BAND,
         per_pass: int = ANCHORS_PER_PASS) -> DataFrame:
    """``vectors(vec_id, label, embedding)`` -> ``anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score``.  Where ``vec_id`` is divisible by
    ``shift_every`` the label first becomes ``(label + 1) % n_labels``."""
    spark = vectors.sparkSession
    rows = usable_rows(vectors, shift_every, n_labels)
    queries = rows.where(F.col("vec_id") % anchor_every == 0)
    passes = max(1, -(-queries.count() * 5 // (4 * per_pass)))  # hash groups: room for a quarter more
    path, schema = scratch_path(spark, "negatives"), (
        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    spark.createDataFrame([], schema).write.parquet(f"{path}/none")
    for number in range(passes):
        block = queries.where(F.pmod(F.xxhash64("row"), F.lit(passes)) == number)
        anchors = block.orderBy(F.xxhash64("row", "vec_id"), "row").toArrow()
        n = anchors.num_rows
        if not n:
            continue
        everything = np.full(n, -_LONG - 1), np.full(n, _LONG)
        near = _search(rows, anchors, np.arange(n), *everything, positives, True).toArrow()
        anchor, score = near["search"].to_numpy(), near["score"].to_numpy()
        # 30 * p <= 100 * s <= 90 * p, in integers of any length
        low = np.array([max(-_LONG - 1, -(-band[0] * p // 100)) for p in score.tolist()], np.int64)
        high = np.array([band[1] * p // 100 for p in score.tolist()], np.int64)
        open_ = np.flatnonzero(low <= high)
        if not len(open_):
            continue
        hits = _search(rows, anchors, anchor[open_], low[open_], high[open_], negatives, False)
        table = pa.table({"search": pa.array(np.arange(len(open_))),
                          "anchor_id": anchors["vec_id"].take(pa.array(anchor[open_])),
                          "positive_id": near["vec_id"].take(pa.array(open_)), "positive_score": near["score"].take(pa.array(open_))})
        known = F.broadcast(spark.createDataFrame(table))  # at most per_pass * positives rows
        null_id = F.when(F.col("vec_id") != _NULL_ID, F.col("vec_id"))
        positive = F.when(F.col("positive_id") != _NULL_ID, F.col("positive_id"))
        (hits.join(known, "search")
         .select("anchor_id", positive.alias("positive_id"), F.col("rank").cast("int").alias("rank"), null_id.alias("negative_id"),
                 "positive_score", F.col("score").alias("negative_score"))
         .write.parquet(f"{path}/pass-{number}"))
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)
