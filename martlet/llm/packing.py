"""Hierarchical multi-length packing.

Map side: documents are tokenised and cut at ``window`` tokens; what is left
of a document (less than a window) is routed to the shortest tier that holds it.
Group side (documents dealt by a hash into groups of bounded size): the longest
tier opens a window per document, fills the gap with whole documents of the
shorter tiers, longest first, and closes it with the head of one more document,
cut to fit; then the next shorter tier does the same.  A sequence of a shorter
tier is exactly as long as its tier (a power of two), so only the last sequence
of a group can need padding.  Sequences of one tier are dealt to step groups of
a constant token budget.

Defined cases: null text is empty (one end token); every row is a document of
its own, also when ids repeat or are null; a text longer than a window fills
whole windows; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW, TIERS = 1024, (1024, 512, 256)
#: Characters of text per packing group, and tokens per training step.
GROUP_CHARS, STEP_TOKENS = 4_000_000, 16 * 1024


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> id, from a file of base64 tokens and ranks."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}


def _tokenise(vocabulary, special, end_id: int, window: int):  # noqa: ANN001, ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(vocabulary.value, special)
        for batch in batches:
            rows, held = [], 0
            ids_in = batch.column("doc_id").to_pylist()
            for doc_id, part, text in zip(ids_in, batch.column("grp").to_pylist(), batch.column("text").to_pylist()):
                ids = np.append(enc.encode_to_numpy(text or "", allowed_special="all"), end_id).astype("<u4")
                full = len(ids) // window * window
                for at in range(0, full, window):
                    rows.append((part, doc_id, at, window, len(ids), zlib.crc32(ids[at:at + window].tobytes()), None))
                if full < len(ids):
                    rest = ids[full:].tobytes()
                    rows.append((part, doc_id, full, len(ids) - full, len(ids), 0, rest))
                    held += len(rest)
                if held > 1 << 23 or len(rows) > 50_000:
                    yield _rows(rows)
                    rows, held = [], 0
            yield _rows(rows)
    return run


_OUT = pa.schema([("grp", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                  ("doc_tokens", pa.int64()), ("crc", pa.int64()), ("ids", pa.binary())])
_MADE = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                   ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
                   ("offset", pa.int64()), ("tier", pa.int64()), ("step_group", pa.int64())])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(_OUT)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _OUT)], schema=_OUT)


_ENCODER: list = [None, None]  # the worker's last (vocabulary, encoder)


def _encoder(vocabulary, special):  # noqa: ANN001, ANN202
    if _ENCODER[0] is not vocabulary:
        import tiktoken

        pattern, ranks = vocabulary
        _ENCODER[:] = vocabulary, tiktoken.Encoding("pack", pat_str=pattern, mergeable_ranks=ranks,
                                                    special_tokens=special)
    return _ENCODER[1]


def pack_group(pieces: list[tuple[int, int]], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """``pieces``: (key, length) with lengths below the longest tier.  Returns
    sequences ``(tier, [(key, from, length), ...])``."""
    sizes = sorted(tiers)
    pools: dict[int, list[tuple[int, int, int]]] = {t: [] for t in sizes}  # (length, key, from), ascending
    for key, n in sorted(pieces, key=lambda p: (p[1], p[0])):
        pools[next(t for t in sizes if n <= t)].append((n, key, 0))
    out = []
    for tier in reversed(sizes):
        shorter = [t for t in reversed(sizes) if t < tier]
        pool = pools[tier]
        while pool:
            n, key, at = pool.pop()
            seq, gap = [(key, at, n)], tier - n
            for t in shorter:  # whole documents first, the longest that fits
                while gap and pools[t]:
                    i = bisect.bisect_right(pools[t], (gap, 1 << 62, 0)) - 1
                    if i < 0:
                        break
                    m, k, a = pools[t].pop(i)
                    seq.append((k, a, m))
                    gap -= m
            while gap:  # then the head of one more, the shortest at hand
                donor = next((pools[t] for t in [*shorter[::-1], tier] if pools[t]), None)
                if donor is None:
                    break
                m, k, a = donor.pop(0)
                take = min(gap, m)
                seq.append((k, a, take))
                gap -= take
                if m > take:
                    bisect.insort(pools[next(t for t in sizes if m - take <= t)], (m - take, k, a + take))
            out.append((sizes[-1] if gap else tier, seq))
    return out


def _packer(tiers: tuple[int, ...], window: int, step_tokens: int):  # noqa: ANN202
    def run(table: pa.Table) -> pa.Table:
        group = table["grp"][0].as_py()
        rows = sorted(table.to_pylist(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["start"], r["doc_tokens"], r["ids"] or b""))
        seqs = [(window, [(i, 0, window)]) for i, r in enumerate(rows) if r["ids"] is None]
        seqs += pack_group([(i, r["length"]) for i, r in enumerate(rows) if r["ids"] is not None], tiers)
        out, steps = [], {}
        for number, (tier, pieces) in enumerate(seqs):
            per = max(1, step_tokens // tier)
            step = steps[tier] = steps.get(tier, -1) + 1
            offset = 0
            for i, a, n in pieces:
                r = rows[i]
                crc = r["crc"] if r["ids"] is None else zlib.crc32(r["ids"][4 * a:4 * (a + n)])
                out.append((r["doc_id"], r["start"] + a, n, crc, r["doc_tokens"], (group << 32) + number, offset,
                            tier, (group << 32) + (sorted(tiers).index(tier) << 28) + step // per))
                offset += n
        columns = list(zip(*out))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _MADE)], schema=_MADE)
    return run


def pack(docs: DataFrame, vocabulary: str, pattern: str, special: dict[str, int], end_id: int = 0, text: str = "text",
         window: int = WINDOW, tiers: tuple[int, ...] = TIERS, group_chars: int = GROUP_CHARS,
         step_tokens: int = STEP_TOKENS) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, tier, step_group``.  ``vocabulary`` is a rank file of
    fixed size (about 1 MB), broadcast with the word ``pattern``; ``special``
    strings in a text count as their ids."""
    ranks = docs.sparkSession.sparkContext.broadcast((pattern, load_ranks(vocabulary)))
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    chars = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-chars // group_chars))
    dealt = src.withColumn("grp", F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(groups)))
    pieces = dealt.mapInArrow(_tokenise(ranks, special, end_id, window), _spark_schema(_OUT))
    return pieces.groupBy("grp").applyInArrow(_packer(tiers, window, step_tokens), _spark_schema(_MADE))


def _spark_schema(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'binary' if pa.types.is_binary(f.type) else 'long'}" for f in schema)
