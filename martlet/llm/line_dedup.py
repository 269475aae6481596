"""Line dedup by a sharded minimal perfect hash.

1. every document's distinct line keys are hashed (128 bits) and counted;
2. the distinct hashes are dealt into shards of about ``KEYS_PER_SHARD``; each
   shard becomes a minimal perfect hash (levels of collision-free bits and
   their ranks) over a fingerprint array and a count array;
3. documents send their line hashes (never the lines) to the shards, which
   look the counts up; hashes of frequent lines come back as one drop set per
   text, and the text is rebuilt without them.

A shard that is probed more often than ``target`` is replicated and its probes
are dealt over the copies row by row, so a line found in a third of all documents,
or in many copies of one text, meets no single task.  Texts meet their drop sets in
one shuffle join at every size (a hot text's partition is split by the adaptive
skew join); a rebuild hashes each line once, however many lines and drops a text has.

Defined cases: null or empty text is one empty line; keys shorter than
``min_chars`` are never dropped; every row counts as a document, also when rows
repeat; a text whose lines all go becomes the empty string; an empty table
gives an empty result; all other columns are carried along untouched (one
named ``line_dedup`` is replaced).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, mix64, store

KEYS_PER_SHARD = 4096
#: Probes per group; hot shards (more probes than this) are at most 2**18.
PROBES_PER_GROUP, MAX_HOT_SHARDS_LOG2 = 16384, 18
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(ASCII_SPACE)), _UPPER, _LOWER)


def _hashes(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("second"), key).alias("h2"))


def _distinct_hashes(text: Column, min_chars: int) -> Column:
    keys = F.array_distinct(F.transform(split_lines(text), line_key))
    keys = F.filter(keys, lambda k: F.char_length(k) >= min_chars)
    return F.transform(keys, _hashes)


# --- the minimal perfect hash (numpy, one shard at a time) -----------------

def mph_build(h1: np.ndarray, h2: np.ndarray, gamma: float = 2.0) -> list[np.ndarray]:
    """Levels of bits for distinct (h1, h2) keys: a key owns the first level at
    which no other remaining key hits its bit."""
    levels = []
    while len(h1):
        size = max(64, int(len(h1) * gamma))
        at = _level_position(h1, h2, len(levels), size)
        single = np.bincount(at, minlength=size) == 1
        levels.append(single)
        rest = ~single[at]
        h1, h2 = h1[rest], h2[rest]
    return levels


def _level_position(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    step = np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    return (mix64(h1 ^ mix64(h2 + step)) % np.uint64(size)).astype(np.int64)


def mph_lookup(levels: list[np.ndarray], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Index of each key among the n keys; -1 for some foreign keys."""
    out = np.full(len(h1), -1, np.int64)
    left, base = np.arange(len(h1)), 0
    for i, bits in enumerate(levels):
        at = _level_position(h1[left], h2[left], i, len(bits))
        hit = bits[at]
        out[left[hit]] = base + (np.cumsum(bits) - 1)[at[hit]]
        base += int(bits.sum())
        left = left[~hit]
    return out


def _fingerprint(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    return (mix64(h1 + mix64(h2)) >> np.uint64(32)).astype("<u4")


_INDEX_SCHEMA = "shard long, probes long, sizes array<int>, bits binary, prints binary, counts binary"


def _build_shard(table: pa.Table) -> pa.Table:
    h1 = table["h1"].to_numpy().view(np.uint64)
    h2 = table["h2"].to_numpy().view(np.uint64)
    n = table["n"].to_numpy()
    levels = mph_build(h1, h2)
    at = mph_lookup(levels, h1, h2)
    prints, counts = np.zeros(len(at), "<u4"), np.zeros(len(at), "<u4")
    prints[at], counts[at] = _fingerprint(h1, h2), np.minimum(n, 2**32 - 1)
    bits = np.packbits(np.concatenate(levels)).tobytes()
    return pa.table({
        "shard": pa.array([table["shard"][0].as_py()], pa.int64()),
        "probes": pa.array([int(n.sum())], pa.int64()),
        "sizes": pa.array([[len(x) for x in levels]], pa.list_(pa.int32())),
        "bits": pa.array([bits], pa.binary()), "prints": pa.array([prints.tobytes()], pa.binary()),
        "counts": pa.array([counts.tobytes()], pa.binary())})


def _prober(min_docs: int):
    out = pa.schema([("t1", pa.int64()), ("t2", pa.int64()), ("h1", pa.int64())])

    def probe(probes: pa.Table, index: pa.Table) -> pa.Table:
        if not probes.num_rows or not index.num_rows:
            return out.empty_table()
        row = index.slice(0, 1).to_pylist()[0]
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8))[:sum(row["sizes"])].astype(bool)
        levels = np.split(bits, np.cumsum(row["sizes"])[:-1])
        h1 = probes["h1"].to_numpy().view(np.uint64)
        h2 = probes["h2"].to_numpy().view(np.uint64)
        at = mph_lookup(levels, h1, h2)
        prints, counts = np.frombuffer(row["prints"], "<u4"), np.frombuffer(row["counts"], "<u4")
        hit = (at >= 0) & (prints[at] == _fingerprint(h1, h2)) & (counts[at] >= min_docs)
        return probes.select(["t1", "t2", "h1"]).filter(pa.array(hit)).cast(out)

    return probe


def line_index(docs: DataFrame, text: str = "text", min_chars: int = 1) -> DataFrame:
    """One row per shard: the perfect hash, fingerprints and document counts of
    the distinct line keys.  Written, since it is read several times."""
    counted = store(
        docs.select(F.explode(_distinct_hashes(F.col(text), min_chars)).alias("h"))
        .groupBy("h.h1", "h.h2").agg(F.count(F.lit(1)).alias("n")), "line-counts")
    shards = max(1, -(-counted.count() // KEYS_PER_SHARD))
    index = (counted.withColumn("shard", F.pmod("h1", F.lit(shards)))
             .groupBy("shard").applyInArrow(_build_shard, _INDEX_SCHEMA)
             .withColumn("shards", F.lit(shards).cast("long")))
    return store(index, "line-index")


def frequent_lines(docs: DataFrame, index: DataFrame, text: str = "text",
                   min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``(t1, t2, drops)``: per text fingerprint, the hashes of its lines that
    the index counts in at least ``min_docs`` documents."""
    size = index.agg(F.sum("probes"), F.max("shards")).first()
    total, shards = size[0] or 0, size[1] or 1
    # total probes / target <= 2**18 shards can be hot: that bounds the broadcast
    target = max(PROBES_PER_GROUP, total >> MAX_HOT_SHARDS_LOG2)
    index = index.withColumn("salts", F.ceil(F.col("probes") / target).cast("int"))
    hot = F.broadcast(index.where("salts > 1").select("shard", "salts"))
    # the text is hashed before its lines are exploded, not once per line
    probes = (docs.select(F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("second"), F.col(text)).alias("t2"),
                          _distinct_hashes(F.col(text), min_chars).alias("hs"))
              .select("t1", "t2", F.explode("hs").alias("h"))
              .select("t1", "t2", "h.h1", "h.h2", F.monotonically_increasing_id().alias("turn"))
              .withColumn("shard", F.pmod("h1", F.lit(shards)))
              .join(hot, "shard", "left")
              .withColumn("salt", F.pmod("turn", F.coalesce("salts", F.lit(1))).cast("int")).drop("salts", "turn"))
    copies = (index.withColumn("salt", F.explode(F.sequence(F.lit(0), F.greatest(F.col("salts"), F.lit(1)) - 1)))
              .select("shard", "salt", "sizes", "bits", "prints", "counts"))
    hits = (probes.groupBy("shard", "salt").cogroup(copies.groupBy("shard", "salt"))
            .applyInArrow(_prober(min_docs), "t1 long, t2 long, h1 long"))
    return store(hits.groupBy("t1", "t2").agg(F.collect_set("h1").alias("drops")), "line-drops")


def _rebuilder(min_chars: int):  # noqa: ANN202
    """Texts without the lines whose key hashes are in the drop set."""
    strip, made = ASCII_SPACE.encode(), pa.struct([("kept", pa.string()), ("n_dropped", pa.int64())])

    def dropped(line: bytes, drops: set[int]) -> bool:
        key = line.strip(strip).lower()  # bytes: A-Z only
        return xxhash.xxh64_intdigest(key, 42) in drops and (min_chars <= 1 or len(key.decode()) >= min_chars)

    @F.arrow_udf("struct<kept: string, n_dropped: long>")
    def rebuild(texts: pa.Array, drops: pa.Array) -> pa.Array:
        out = []
        for text, hashes in zip(texts, drops):
            if not hashes.is_valid:
                out.append(None)
                continue
            found = set(hashes.values.to_numpy().view(np.uint64).tolist())
            lines = (text.as_py() or "").encode().split(b"\n")
            kept = [line for line in lines if not dropped(line, found)]
            out.append({"kept": b"\n".join(kept).decode(), "n_dropped": len(lines) - len(kept)})
        return pa.array(out, made)

    return rebuild


def dedup_lines(docs: DataFrame, text: str = "text", min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``docs`` plus ``line_dedup: struct<n_lines, n_dropped, kept>``."""
    drops = frequent_lines(docs, line_index(docs, text, min_chars), text, min_docs, min_chars)
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "line_dedup"]).alias("row"),
                        F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("second"), F.col(text)).alias("t2"))
    joined = keyed.join(drops.hint("shuffle_hash"), ["t1", "t2"], "left")
    whole, some = F.coalesce(F.col("row")[text], F.lit("")), F.col("drops").isNotNull()
    # texts without drops stay in the JVM
    made = _rebuilder(min_chars)(F.when(some, whole), F.col("drops"))
    out = joined.select("row", whole.alias("whole"), made.alias("made"))
    n_lines = F.char_length("whole") - F.char_length(F.replace("whole", F.lit("\n"), F.lit(""))) + 1
    return out.select("row.*", F.struct(
        n_lines.cast("long").alias("n_lines"), F.coalesce("made.n_dropped", F.lit(0).cast("long")).alias("n_dropped"),
        F.coalesce("made.kept", "whole").alias("kept")).alias("line_dedup"))
