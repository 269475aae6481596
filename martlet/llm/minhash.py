"""MinHash near-dedup: one-permutation hashing with optimal densification.

One 64-bit hash per word shingle; the hash's place in its range names the bin,
the least hash of each of ``BANDS * ROWS`` bins is kept, and an empty bin takes
the value of a full one chosen by a shared hash sequence.  Bands of the
signature name buckets.  In every bucket one centre is compared with all others
(star edges), on the full shingle sets.  In the second round every member of a
bucket of up to ``SMALL`` is a centre, which settles it; larger buckets that
still hold more than one component get up to ``CENTRES`` others in each of the
first ``ROUNDS`` rounds.  So a bucket of m members costs at most
max(SMALL, CENTRES) * m pairs a round, never m * m.

A last round settles the larger buckets that are still open, exactly: their
members' shingles are put in one order, rarest first, and sets that reach the
similarity share one of their first (1 - similarity) * size + 1 shingles.  Only
pairs of different components that share such a shingle are compared.  Pairs
whose set sizes, or whose places of the shared shingle, rule the similarity out
are left out.

Documents with one shingle set (copies) are one node from the start.

Defined cases: null, empty or blank text has an empty set and links with
nothing; fewer words than the width make one shingle of the whole sequence;
``doc_id`` is the key: rows that repeat id and text share a verdict; of an id with
different texts each row is judged by its own text, joins the class of copies of that
text under other ids, and is otherwise its own component (such an id stands for no
class); a null doc_id is its own component and is kept; an empty table gives an
empty result; texts of any length are read whole, ``SEGMENT`` bytes at a time; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import connected_components, mix64, shrink, sized, store

BANDS, ROWS = 40, 6
#: Centres per unresolved bucket in the rounds after the first, and the members
#: up to which all are centres in the second.
CENTRES, SMALL = 4, 16
#: Star rounds before the last one, and the slots in which the last one counts
#: shingles (a shingle's rank needs no exact count; 2 MB, whatever the input).
ROUNDS, SLOTS_LOG2 = 3, 18
#: Bytes hashed at once: bounds the numpy arrays of a task (about 60 x this).
SEGMENT = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_U = np.uint64


def _tables():
    rng = np.random.default_rng(20240607)
    letters = rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
    letters[65:91] = letters[97:123]  # A-Z count as a-z
    space = np.zeros(256, bool)
    space[[32, 9, 10, 11, 12, 13]] = True
    powers = np.full(SEGMENT + 1, _BASE, np.uint64)
    powers[0] = 1
    inverse = np.full(SEGMENT + 1, pow(_BASE, -1, 2**64), np.uint64)
    inverse[0] = 1
    return letters, space, np.cumprod(powers), np.cumprod(inverse)


_TABLES: list = []


def _segment_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of one segment."""
    if not _TABLES:
        _TABLES.extend(_tables())
    letters, space, powers, inverse = _TABLES
    gap = np.concatenate(([True], space[data], [True]))
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    start, end = edge[::2], edge[1::2]
    if len(data) > SEGMENT:  # one word longer than a segment, hashed on its own
        from hashlib import blake2b
        full = np.concatenate((data, [])).astype(np.uint8).tobytes().lower()
        return start, np.array([int.from_bytes(blake2b(full[a:b], digest_size=8).digest(), "little")
                                for a, b in zip(start, end)], np.uint64)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(letters[data] * powers[:len(data)])))
    return start, mix64((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start byte and 64-bit hash of every word; works in segments that end at
    white space."""
    space = np.isin(np.arange(256), (32, 9, 10, 11, 12, 13))
    starts, hashes, at = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], 0
    while at < len(data):
        end = min(len(data), at + SEGMENT)
        if end < len(data):
            cut = np.flatnonzero(space[data[at:end]])
            if len(cut):
                end = at + int(cut[-1]) + 1
            else:
                while end < len(data) and not space[data[end]]:
                    far = np.flatnonzero(space[data[end:end + SEGMENT]])
                    end = end + int(far[0]) if len(far) else min(len(data), end + SEGMENT)
        s, h = _segment_words(data[at:end])
        starts.append(s + at)
        hashes.append(h)
        at = end
    return np.concatenate(starts), np.concatenate(hashes)


def shingle_sets(texts: list[str | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and the owner of each."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join(raw), np.uint8)
    begin = np.concatenate(([0], np.cumsum([len(x) + 1 for x in raw])[:-1])) if raw else np.zeros(0)
    start, word = word_hashes(data)
    doc = np.searchsorted(begin, start, side="right") - 1
    n = len(word)
    m = max(0, n - width + 1)
    h = word[:m].copy()
    for j in range(1, width):
        h = mix64(h * _U(0xD1342543DE82EF95) + word[j:j + m])
    h = mix64(h + _U(width))
    whole = doc[:m] == doc[n - m:] if m else np.zeros(0, bool)
    h, own = h[whole], doc[:m][whole]
    counts = np.bincount(doc, minlength=len(texts))
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        first = np.searchsorted(doc, short)
        extra = np.empty(len(short), np.uint64)
        for i, (d, f) in enumerate(zip(short, first)):
            x = word[f:f + 1].copy()
            for j in range(1, counts[d]):
                x = mix64(x * _U(0xD1342543DE82EF95) + word[f + j:f + j + 1])
            extra[i] = mix64(x + _U(int(counts[d])))[0]
        h, own = np.concatenate((h, extra)), np.concatenate((own, short))
    order = np.lexsort((h, own))
    h, own = h[order], own[order]
    if len(h):
        new = np.concatenate(([True], (h[1:] != h[:-1]) | (own[1:] != own[:-1])))
        h, own = h[new], own[new]
    return h, own


def oph_signatures(h: np.ndarray, own: np.ndarray, n: int, k: int) -> np.ndarray:
    """(n, k) signatures; ``h`` is sorted within each owner, and the bin grows
    with the hash, so the first hash of a bin is its least."""
    sig = np.zeros((n, k), np.uint64)
    full = np.zeros((n, k), bool)
    if len(h):
        at = (((h >> _U(32)) * _U(k)) >> _U(32)).astype(np.int64)
        cell = own * k + at
        first = np.concatenate(([True], cell[1:] != cell[:-1]))
        sig.reshape(-1)[cell[first]] = h[first]
        full.reshape(-1)[cell[first]] = True
    row, col = np.nonzero(~full & full.any(axis=1)[:, None])
    step = 0
    while len(row):  # optimal densification: each empty bin asks its own sequence of bins
        if step < 4 * k:
            ask = (mix64(col.astype(np.uint64) * _U(0x9E3779B1) + _U((step + 1) * 0xC2B2AE3D27D4EB4F & 0xFFFFFFFFFFFFFFFF))
                   % _U(k)).astype(np.int64)
        else:
            ask = (col + step) % k
        got = full[row, ask]
        sig[row[got], col[got]] = mix64(sig[row[got], ask[got]] + ask[got].astype(np.uint64))
        row, col, step = row[~got], col[~got], step + 1
    return sig


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    cells = sig.reshape(len(sig), bands, rows)
    key = np.broadcast_to(mix64(np.arange(1, bands + 1, dtype=np.uint64)), cells.shape[:2]).copy()
    for j in range(rows):
        key = mix64(key * _U(0xD1342543DE82EF95) + cells[:, :, j])
    return key.view(np.int64)


def _chunks(batch: pa.RecordBatch, column: str, most: int = SEGMENT) -> Iterator[tuple[int, int, list]]:
    """Row ranges of a batch that hold about ``most`` bytes of text."""
    texts, start, held = batch.column(column).to_pylist(), 0, 0
    for i, t in enumerate(texts):
        held += len(t or "")
        if held >= most or i == len(texts) - 1:
            yield start, i + 1, texts[start:i + 1]
            start, held = i + 1, 0


def _sign(width: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in _chunks(batch, "text"):
                h, own = shingle_sets(texts, width)
                n = np.bincount(own, minlength=b - a)
                key = band_keys(oph_signatures(h, own, b - a, bands * rows), bands, rows)
                sums = []
                for salt in (1, 2):
                    s = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix64(h + _U(salt)))))
                    upto = np.concatenate(([0], np.cumsum(n)))
                    sums.append((s[upto[1:]] - s[upto[:-1]]).view(np.int64))
                none = n == 0
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], np.cumsum(np.where(none, 0, bands)))), pa.int32()),
                    pa.array(key[~none].reshape(-1), pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), batch.column("tag").slice(a, b - a), pa.array(n, pa.int64()),
                     pa.array(sums[0], pa.int64(), mask=none), pa.array(sums[1], pa.int64(), mask=none), lists],
                    names=["doc_id", "tag", "n_shingles", "k1", "k2", "bands"])
    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in _chunks(batch, "text"):
                h, own = shingle_sets(texts, width)
                cut = np.searchsorted(own, np.arange(b - a + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(a, b - a),
                     pa.array([h[cut[i]:cut[i + 1]].tobytes() for i in range(b - a)], pa.binary())],
                    names=["id", "sh"])
    return run


def _slots(h: np.ndarray) -> np.ndarray:
    return (h >> _U(64 - SLOTS_LOG2)).astype(np.int64)


def _count_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << SLOTS_LOG2, np.int64)
    for batch in batches:
        for x in batch.column("sh"):
            total += np.bincount(_slots(np.frombuffer(x.as_buffer(), np.uint64)), minlength=len(total))
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["slot", "c"])


def _prefixes(percent: int, counts):  # noqa: ANN001, ANN202
    """The first shingles of every set, rarest first, and their places."""
    def rows(sets: list[tuple[int, int, int, np.ndarray]]) -> pa.RecordBatch:
        size = [len(t) for *_, t in sets]
        ids, comps, ns = (np.repeat(np.array([x[j] for x in sets], np.int64), size) for j in range(3))
        tokens = np.concatenate([t for *_, t in sets]) if sets else np.zeros(0, np.uint64)
        place = np.concatenate([np.arange(n) for n in size]) if sets else np.zeros(0)
        return pa.RecordBatch.from_arrays(
            [pa.array(tokens.view(np.int64)), pa.array(ids), pa.array(comps), pa.array(ns),
             pa.array(place.astype(np.int64))], names=["token", "id", "component", "n", "place"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for i, c, x in zip(batch.column("id").to_pylist(), batch.column("component").to_pylist(), batch.column("sh")):
                h = np.frombuffer(x.as_buffer(), np.uint64)
                first = len(h) + (-percent * len(h)) // 100 + 1
                held.append((i, c, len(h), h[np.lexsort((h, counts.value[_slots(h)]))[:first]]))
                size += first
                if size > 1 << 18:
                    yield rows(held)
                    held, size = [], 0
            yield rows(held)
    return run


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            hit = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(hit), batch.column("b").filter(hit)],
                                             names=["a", "b"])
    return run


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80,
                    bands: int = BANDS, rows: int = ROWS, tag: Column | None = None) -> DataFrame:
    """``docs(doc_id, text)`` -> ``doc_id, n_shingles, component_id, kept``, and
    ``tag``, a long of each row, if one is given."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tagged = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                         (F.lit(0) if tag is None else tag).cast("long").alias("tag"))
    signed = store(tagged.mapInArrow(_sign(width, bands, rows),
                                     "doc_id long, tag long, n_shingles long, k1 long, k2 long, bands array<long>"), "mh-signed")
    usable = signed.where("k1 is not null and doc_id is not null")
    key = F.struct("k1", "k2")
    repeated = store(usable.groupBy("doc_id").agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
                     .where("lo <> hi").select("doc_id"), "mh-repeated")
    # one node per shingle set
    nodes = store(usable.join(sized(repeated), "doc_id", "left_anti").groupBy("k1", "k2")
                  .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")), "mh-nodes")
    comp = _components(src, nodes, width, percent)
    classes = store(nodes.select("k1", "k2", "rep").join(comp, F.col("rep") == F.col("id"), "left")
                    .select("k1", "k2", F.coalesce("component", "rep").alias("component")), "mh-classes")
    out = signed.drop("bands").join(sized(classes), ["k1", "k2"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"), *([] if tag is None else ["tag"]))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _merge(labels: DataFrame, found: DataFrame) -> DataFrame:
    """``labels(id, component)`` after the new links ``found(a, b)``: only the
    components that they join are walked again, as single nodes."""
    table = sized(labels)
    roots = (found.join(table.select(F.col("id").alias("a"), F.col("component").alias("ca")), "a", "left")
             .join(table.select(F.col("id").alias("b"), F.col("component").alias("cb")), "b", "left")
             .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).where("a <> b"))
    moved = connected_components(roots, found.count())
    to = sized(moved).select(F.col("id").alias("component"), F.col("component").alias("to"))
    old = labels.join(to, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
    return store(old.union(moved.join(table, "id", "left_anti").select("id", "component")), "mh-components")


def _fits(x: Column, y: Column, percent: int) -> Column:
    """Sets of these sizes can reach the similarity."""
    return 100 * F.least(x, y) >= percent * F.greatest(x, y)


def _ordered(x: Column, y: Column) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _small_pairs(known: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components in the buckets of at most ``SMALL``."""
    seen = F.collect_list(F.struct("rep", "n", "component"))
    pairs = F.flatten(F.transform("seen", lambda x: F.transform(
        F.filter("seen", lambda y: (x.rep < y.rep) & (x.component != y.component) & _fits(x.n, y.n, percent)),
        lambda y: F.struct(x.rep.alias("a"), y.rep.alias("b")))))
    return (known.where(F.col("m") <= SMALL).groupBy("bucket").agg(seen.alias("seen"))
            .select(F.explode(pairs).alias("p")).select("p.a", "p.b"))


def _star_pairs(known: DataFrame, done: int, percent: int) -> DataFrame:
    """The next centres of the larger buckets against the members of other
    components: the member with most links, some hashed ones of the largest
    component (the bucket's rest is compared with them), and a hashed one of the
    whole bucket; hashes differ by bucket and round."""
    large = known.where(F.col("m") > SMALL)
    hashed = [F.xxhash64(F.lit(done * CENTRES + i), "bucket", "rep") for i in range(CENTRES - 1)]
    orders = [F.struct("degree"), F.struct(hashed[0]), *(F.struct("size", h) for h in hashed[1:])]
    member = F.struct(F.col("rep").alias("centre"), F.col("component").alias("own"), F.col("n").alias("cn"))
    again = store(shrink(
        large.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                    F.array_distinct(F.array(*[F.max_by(member, o) for o in orders])).alias("cs"))
        .where("lo <> hi").select("bucket", F.explode("cs").alias("c")).select("bucket", "c.*"), known.count()), "mh-again")
    return (large.join(sized(again).withColumnRenamed("bucket", "at"),
                       (F.col("bucket") == F.col("at")) & (F.col("component") != F.col("own"))
                       & _fits(F.col("n"), F.col("cn"), percent))
            .select(*_ordered(F.col("rep"), F.col("centre"))))


def _rest_pairs(src: DataFrame, known: DataFrame, width: int, percent: int) -> DataFrame:
    """Every pair of different components that meets in a larger bucket and can
    reach the similarity, by the shingles that such a pair must share."""
    large = known.where(F.col("m") > SMALL)
    open_ = store(large.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                  .where("lo <> hi").select("bucket"), "mh-open")
    left = store(large.join(sized(open_), "bucket", "left_semi")
                 .select(F.col("rep").alias("id"), "component").distinct(), "mh-left")
    sets = _stored_sets(src, left.select("id"), left.count(), width)
    counts = np.zeros(1 << SLOTS_LOG2, np.int64)
    for r in sets.mapInArrow(_count_slots, "slot long, c long").groupBy("slot").agg(F.sum("c").alias("c")).collect():
        counts[r["slot"]] = r["c"]  # at most 2 ** SLOTS_LOG2 rows
    shared = src.sparkSession.sparkContext.broadcast(counts)
    prefix = store(sets.join(sized(left), "id").mapInArrow(
        _prefixes(percent, shared), "token long, id long, component long, n long, place long"), "mh-prefix")
    mixed = store(prefix.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                  .where("lo <> hi").select("token"), "mh-mixed")
    live = store(prefix.join(sized(mixed), "token", "left_semi"), "mh-live")
    x, y = (live.select("token", *[F.col(c).alias(c + side) for c in live.columns[1:]]) for side in "xy")
    most = F.least(F.col("nx") - F.col("placex"), F.col("ny") - F.col("placey"))
    return (x.join(y, "token").where(
        (F.col("idx") < F.col("idy")) & (F.col("componentx") != F.col("componenty"))
        & _fits(F.col("nx"), F.col("ny"), percent) & ((100 + percent) * most >= percent * (F.col("nx") + F.col("ny"))))
        .select(F.col("idx").alias("a"), F.col("idy").alias("b")))


def _components(src: DataFrame, nodes: DataFrame, width: int, percent: int) -> DataFrame:
    """``(id, component)`` of the nodes that have a link."""
    members = nodes.select("rep", "n", F.explode("bands").alias("bucket"))
    centre = store(members.groupBy("bucket")
                   .agg(F.count(F.lit(1)).alias("m"), F.min(F.struct(F.xxhash64("rep"), "rep", "n")).alias("c"))
                   .where("m > 1").select("bucket", "m", F.col("c.rep").alias("centre"), F.col("c.n").alias("cn")), "mh-centres")
    star = store(members.join(sized(centre), "bucket"), "mh-star")
    todo = (star.where((F.col("rep") != F.col("centre")) & _fits(F.col("n"), F.col("cn"), percent))
            .select(*_ordered(F.col("rep"), F.col("centre"))))
    rows, tested, links, comp, done = star.count(), None, None, None, 0
    last = False
    while True:
        pairs = todo.distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = store(shrink(pairs, rows), "mh-pairs")
        found = store(_confirm(src, pairs, width, percent), "mh-links")
        done += 1
        more = done == 1 or not found.isEmpty()
        if more:
            links = found if links is None else links.union(found)
            comp = connected_components(found, found.count()) if comp is None else _merge(comp, found)
        if last:
            return comp
        last = not more or done == ROUNDS
        tested = pairs if tested is None else tested.union(pairs)
        degree = (links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep")
                  .agg(F.count(F.lit(1)).alias("degree")))
        sizes = comp.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
        label = store(shrink(degree.join(comp.withColumnRenamed("id", "rep"), "rep").join(sizes, "component"),
                             comp.count()), "mh-labels")
        known = store(star.select("bucket", "m", "rep", "n").join(sized(label), "rep", "left").select(
            "bucket", "m", "rep", "n", F.coalesce("component", "rep").alias("component"),
            F.coalesce("degree", F.lit(0)).alias("degree"), F.coalesce("size", F.lit(1)).alias("size")), "mh-known")
        todo = _rest_pairs(src, known, width, percent) if last else _star_pairs(known, done, percent)
        if done == 1:
            todo = todo.union(_small_pairs(known, percent))
            star = star.where(F.col("m") > SMALL)
        rows = known.count() * CENTRES


def _stored_sets(src: DataFrame, ids: DataFrame, n: int, width: int) -> DataFrame:
    """``(id, sh)``: the shingle sets of the ``n`` documents ``ids``."""
    sets = (src.withColumnRenamed("doc_id", "id").join(sized(ids), "id", "left_semi")
            .mapInArrow(_sets(width), "id long, sh binary").dropDuplicates(["id"]))
    return store(shrink(sets, n, 1024), "mh-sets")


def _confirm(src: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets reach the similarity."""
    n = pairs.count()
    ids = store(shrink(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), 2 * n), "mh-ids")
    sets = _stored_sets(src, ids, ids.count(), width)
    return shrink(pairs.join(sets.select(F.col("id").alias("a"), F.col("sh").alias("sa")), "a")
                  .join(sets.select(F.col("id").alias("b"), F.col("sh").alias("sb")), "b")
                  .mapInArrow(_verify(percent), "a long, b long"), n, 2048)
