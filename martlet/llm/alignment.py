"""Cross-tokenizer alignment: corpus-wide counts of token pairs that overlap.

1. every text is encoded by both tokenizers once; the ids are written in chunks of
   about ``CHUNK_CHARS`` characters (a chunk lies in one task, by position);
2. first pass: a chunk is aligned and sends each shard its distinct pairs and, for
   each, its number of documents.  A shard holds the pairs of some ids of the first
   tokenizer, so the highest count of an id is known inside one shard;
3. a shard's distinct pairs (merged in a tree) get a minimal perfect hash; every
   branch of up to ``FAN`` chunks fills a dense count vector indexed by it, and the
   vectors are summed in a tree;
4. the index answers each chunk: position by the hash, checked against the key held
   there, count, and whether the count is the highest of its first id;
5. second pass: the documents of a chunk are aligned again and look their links up
   in the chunk's answers.

Alignment needs no search: with the texts of a chunk laid end to end, every stretch
between neighbouring token ends (of either side) is one link, every shared end
closes a group.  No task holds more than a chunk's documents, ``FAN`` rows of a
shard, or one shard's pairs, which the two vocabularies bound.

Defined cases: null and empty texts, and texts whose token bytes of either side do
not join to the text with a space before it, have no tokens: zeros and ``''``;
every row is a document of its own, also when rows repeat; a very long text is a
chunk of its own; an empty table gives an empty result; all other columns are
carried along (one named ``alignment`` is replaced).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import mix64, scratch_path
from .common import store as written
from .line_dedup import mph_build, mph_lookup
from .packing import load_ranks

CHUNK_CHARS, SHARDS, FAN = 4_000_000, 256, 256
STRUCT = "struct<n_a: long, n_b: long, n_groups: long, n_links: long, n_best: long, count_sum: long, groups_sha256: string>"


class Tokenizers:
    """Both encoders of one worker, and the bytes of each of their tokens."""

    held: list = [None, None]

    def __init__(self, pattern: str, ranks: dict[bytes, int], model: bytes) -> None:
        import sentencepiece
        import tiktoken

        self.first = tiktoken.Encoding("first", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.second = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes_a[i] = token
        piece = self.second.id_to_piece
        self.bytes_b = [bytes([int(piece(i)[3:5], 16)]) if self.second.is_byte(i)
                        else piece(i).replace("▁", " ").encode() for i in range(self.second.get_piece_size())]
        self.lengths_a = np.array([len(b) for b in self.bytes_a], np.int64)
        self.lengths_b = np.array([len(b) for b in self.bytes_b], np.int64)
        self.pairs = len(self.bytes_a) * len(self.bytes_b)
        self.key = np.dtype("<u4" if self.pairs < 2**32 else "<u8")
        self.id = np.dtype("<u2" if max(len(self.bytes_a), len(self.bytes_b)) <= 2**16 else "<u4")
        ids = [[str(i).encode() + end for i in range(len(t)) for end in (b",",)] for t in (self.bytes_a, self.bytes_b)]
        last = [[s[:-1] + end for s in side] for side, end in zip(ids, (b"|", b";"))]
        self.names = np.array([*ids[0], *last[0], *ids[1], *last[1]], object)

    @classmethod
    def of(cls, shared) -> Tokenizers:  # noqa: ANN001
        if cls.held[0] is not shared:
            cls.held[:] = shared, cls(*shared.value)
        return cls.held[1]

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        out = []
        for text, ids in zip(texts, self.second.encode(texts, num_threads=1)):
            raw = b" " + text.encode()
            a = self.first.encode_to_numpy(" " + text, disallowed_special=())
            same = (b"".join(map(self.bytes_b.__getitem__, ids)) == raw
                    and b"".join(map(self.bytes_a.__getitem__, a.tolist())) == raw)
            out.append((a.astype(self.id), np.array(ids, self.id)) if same and text else None)
        return out


class Aligned:
    """Documents laid end to end: links, groups and the documents they are in."""

    def __init__(self, tok: Tokenizers, a: list[np.ndarray], b: list[np.ndarray]) -> None:
        self.tok, self.n_a, self.n_b = tok, np.array([len(x) for x in a]), np.array([len(x) for x in b])
        self.a, self.b = (np.concatenate([np.zeros(0, np.int64), *x]).astype(np.int64) for x in (a, b))
        self.end_a, self.end_b = np.cumsum(tok.lengths_a[self.a]), np.cumsum(tok.lengths_b[self.b])
        self.doc_end = self.end_a[np.cumsum(self.n_a) - 1] if len(a) else np.zeros(0, np.int64)
        self.shared_a, self.shared_b = _found(self.end_a, self.end_b), _found(self.end_b, self.end_a)
        cuts = np.sort(np.concatenate((self.end_a, self.end_b[~self.shared_b])), kind="stable")
        self.doc = np.searchsorted(self.doc_end, cuts)
        self.keys = (self.a[np.searchsorted(self.end_a, cuts)] * len(tok.bytes_b)
                     + self.b[np.searchsorted(self.end_b, cuts)])

    def pair_documents(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys, ascending, and how many documents hold each."""
        distinct = np.unique(self.doc * self.tok.pairs + self.keys) % self.tok.pairs
        return np.unique(distinct, return_counts=True)

    def group_digests(self) -> list[str]:
        ends = self.end_a[self.shared_a]
        order = np.argsort(np.concatenate((2 * np.searchsorted(ends, self.end_a), 2 * np.searchsorted(ends, self.end_b) + 1)),
                           kind="stable")
        na, nb = len(self.tok.bytes_a), len(self.tok.bytes_b)
        name = np.concatenate((self.a + na * self.shared_a, 2 * na + self.b + nb * self.shared_b))[order]
        parts = self.tok.names[name].tolist()
        at = np.concatenate(([0], np.cumsum(self.n_a + self.n_b))).tolist()
        return [hashlib.sha256(b"".join(parts[i:j])[:-1]).hexdigest() for i, j in pairwise(at)]


def _found(x: np.ndarray, among: np.ndarray) -> np.ndarray:
    at = np.searchsorted(among, x)
    return (at < len(among)) & (among[np.minimum(at, len(among) - 1)] == x) if len(among) else np.zeros(len(x), bool)


def _ids(column: pa.ChunkedArray | pa.Array, width: np.dtype) -> list[np.ndarray | None]:
    return [np.frombuffer(x.as_buffer(), width) if x.is_valid else None for x in column]


# --- tasks -----------------------------------------------------------------

def _tokenise(shared, chunk_chars: int):  # noqa: ANN001, ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, task = Tokenizers.of(shared), TaskContext.get().partitionId() << 32
        chunk, chars = 0, 0
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts = batch.column("text").to_pylist()
                made = tok.encode([t or "" for t in texts])
                chunks = []
                for t in texts:
                    if chars and chars + len(t or "") > chunk_chars:
                        chunk, chars = chunk + 1, 0
                    chars += len(t or "") + 64
                    chunks.append(task | chunk)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(chunks, pa.int64()), batch.column("row"),
                     pa.array([m and m[0].tobytes() for m in made], pa.binary()),
                     pa.array([m and m[1].tobytes() for m in made], pa.binary())], names=["chunk", "row", "a", "b"])
    return run


def _first_pass(shared, shards: int):  # noqa: ANN001, ANN202
    def rows(tok: Tokenizers, chunk: int, held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        keys, docs = Aligned(tok, *zip(*held)).pair_documents()
        shard = keys // len(tok.bytes_b) % shards
        order = np.argsort(shard, kind="stable")
        at = np.searchsorted(shard[order], np.arange(shards + 1))
        out = [(s, chunk, keys[order[i:j]].astype(tok.key).tobytes(), docs[order[i:j]].astype("<u4").tobytes())
               for s, (i, j) in enumerate(pairwise(at.tolist())) if i < j]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["shard", "chunk", "keys", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, held, now, size = Tokenizers.of(shared), [], None, 0
        for batch in batches:
            for chunk, a, b in zip(batch.column("chunk").to_pylist(), _ids(batch.column("a"), tok.id),
                                   _ids(batch.column("b"), tok.id)):
                if held and (chunk != now or size > 1 << 22):
                    yield rows(tok, now, held)
                    held, size = [], 0
                now = chunk
                if a is not None:
                    held.append((a, b))
                    size += len(a) + len(b)
        if held:
            yield rows(tok, now, held)
    return run


def _keys(column: pa.ChunkedArray, key: np.dtype) -> np.ndarray:
    return np.concatenate([np.zeros(0, key), *(np.frombuffer(x.as_buffer(), key) for x in column)])


def _union(key: np.dtype):  # noqa: ANN202
    def run(table: pa.Table) -> pa.Table:
        return pa.table({"shard": table["shard"].slice(0, 1), "branch": table["branch"].slice(0, 1),
                         "keys": pa.array([np.unique(_keys(table["keys"], key)).tobytes()], pa.binary())})
    return run


def _hash(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    wide = keys.astype(np.uint64)
    return mix64(wide + np.uint64(0x9E3779B97F4A7C15)), wide


def _build(key: np.dtype):  # noqa: ANN202
    def run(table: pa.Table) -> pa.Table:
        keys = _keys(table["keys"], key)
        levels = mph_build(*_hash(keys))
        held = np.zeros(len(keys), key)
        held[mph_lookup(levels, *_hash(keys))] = keys
        return pa.table({"shard": table["shard"].slice(0, 1), "sizes": pa.array([[len(x) for x in levels]], pa.list_(pa.int32())),
                         "bits": pa.array([np.packbits(np.concatenate(levels)).tobytes()], pa.binary()),
                         "keys": pa.array([held.tobytes()], pa.binary())})
    return run


class _Index:
    """One shard's perfect hash with its verified keys."""

    def __init__(self, row: dict, key: np.dtype) -> None:
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8))[:sum(row["sizes"])].astype(bool)
        self.levels = np.split(bits, np.cumsum(row["sizes"])[:-1])
        self.keys = np.frombuffer(row["keys"], key)

    def places(self, keys: np.ndarray) -> np.ndarray:
        at = mph_lookup(self.levels, *_hash(keys))
        if (at < 0).any() or (self.keys[at] != keys).any():
            raise ValueError("a pair is missing from the index of its shard")
        return at


def _dense(key: np.dtype):  # noqa: ANN202
    out = pa.schema([("shard", pa.int64()), ("branch", pa.int64()), ("counts", pa.binary())])

    def run(requests: pa.Table, index: pa.Table) -> pa.Table:
        if not requests.num_rows:
            return out.empty_table()
        held = _Index(index.slice(0, 1).to_pylist()[0], key)
        total = np.zeros(len(held.keys), "<i8")
        for keys, docs in zip(requests["keys"], requests["docs"]):  # keys of one row are distinct
            total[held.places(np.frombuffer(keys.as_buffer(), key))] += np.frombuffer(docs.as_buffer(), "<u4")
        return pa.table([requests["shard"].slice(0, 1), requests["branch"].slice(0, 1), pa.array([total.tobytes()], pa.binary())],
                        schema=out)
    return run


def _add(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_buffer(), "<i8") for x in table["counts"])
    return pa.table({"shard": table["shard"].slice(0, 1), "branch": table["branch"].slice(0, 1),
                     "counts": pa.array([total.tobytes()], pa.binary())})


def _answer(key: np.dtype, n_second: int):  # noqa: ANN202
    out = pa.schema([("chunk", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()), ("best", pa.binary())])

    def run(requests: pa.Table, index: pa.Table) -> pa.Table:
        if not requests.num_rows:
            return out.empty_table()
        row = index.slice(0, 1).to_pylist()[0]
        held, counts = _Index(row, key), np.frombuffer(row["counts"], "<i8")
        first, place = np.unique(held.keys // n_second, return_inverse=True)
        highest = np.zeros(len(first), np.int64)
        np.maximum.at(highest, place, counts)
        best = counts == highest[place]
        at = [held.places(np.frombuffer(keys.as_buffer(), key)) for keys in requests["keys"]]
        return pa.table([requests["chunk"], requests["keys"], pa.array([counts[i].tobytes() for i in at], pa.binary()),
                         pa.array([best[i].tobytes() for i in at], pa.binary())], schema=out)
    return run


def _second_pass(shared):  # noqa: ANN001, ANN202
    made = pa.struct([("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
                      ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string())])

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        schema = pa.schema([("row", docs.schema.field("row").type), ("alignment", made)])
        if not docs.num_rows:
            return schema.empty_table()
        tok = Tokenizers.of(shared)
        a, b = _ids(docs["a"], tok.id), _ids(docs["b"], tok.id)
        have = [i for i, x in enumerate(a) if x is not None]
        out = {f.name: np.zeros(docs.num_rows, np.int64) for f in made if f.type == pa.int64()}
        digest = [""] * docs.num_rows
        if have:
            texts = Aligned(tok, [a[i] for i in have], [b[i] for i in have])
            keys, first = np.unique(_keys(answers["keys"], tok.key), return_index=True)
            counts = np.concatenate([np.frombuffer(x.as_buffer(), "<i8") for x in answers["counts"]])[first]
            best = np.concatenate([np.frombuffer(x.as_buffer(), bool) for x in answers["best"]])[first]
            at = np.searchsorted(keys, texts.keys.astype(tok.key))
            n = len(have)
            out["n_a"][have], out["n_b"][have] = texts.n_a, texts.n_b
            out["n_links"][have] = links = np.bincount(texts.doc, minlength=n)
            out["n_groups"][have] = texts.n_a + texts.n_b - links
            out["n_best"][have] = np.bincount(texts.doc[best[at]], minlength=n)
            upto = np.concatenate(([0], np.cumsum(counts[at])))
            ends = np.cumsum(links)
            out["count_sum"][have] = upto[ends] - upto[ends - links]
            for i, d in zip(have, texts.group_digests()):
                digest[i] = d
        struct = pa.StructArray.from_arrays([*(pa.array(x) for x in out.values()), pa.array(digest, pa.string())], fields=list(made))
        return pa.Table.from_arrays([docs["row"], pa.chunked_array([struct])], schema=schema)
    return run


# --- the operator ----------------------------------------------------------

def pair_index(requests: DataFrame, branches: int, key: np.dtype) -> DataFrame:
    """``requests(shard, branch, keys, docs)`` -> one row per shard: perfect hash,
    keys in hash order and, for each, its number of documents."""
    def tree(rows: DataFrame, width: int, merge, schema: str) -> DataFrame:  # noqa: ANN001
        while width > 1:
            width = -(-width // FAN)
            rows = (rows.withColumn("branch", F.pmod("branch", F.lit(width)).cast("long"))
                    .groupBy("shard", "branch").applyInArrow(merge, schema))
        return rows

    keys = "shard long, branch long, keys binary"
    merged = requests.select("shard", "branch", "keys").groupBy("shard", "branch").applyInArrow(_union(key), keys)
    merged = tree(merged, branches, _union(key), keys)
    hashes = written(merged.groupBy("shard").applyInArrow(_build(key), "shard long, sizes array<int>, bits binary, keys binary"),
                     "pair-hash")
    vectors = (requests.groupBy("shard", "branch").cogroup(_copies(hashes, branches).groupBy("shard", "branch"))
               .applyInArrow(_dense(key), "shard long, branch long, counts binary"))
    vectors = tree(vectors, branches, _add, "shard long, branch long, counts binary")
    return written(hashes.join(vectors.drop("branch"), "shard"), "pair-index")


def _copies(index: DataFrame, branches: int) -> DataFrame:
    """The index rows once for every branch of requests that reads them."""
    return index.withColumn("branch", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(branches - 1).cast("long"))))


def align(docs: DataFrame, ranks_file: str, pattern: str, model_file: str, text: str = "text", keep_text: bool = True,
          chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """``docs`` (without the text unless ``keep_text``) plus ``alignment: struct<n_a,
    n_b, n_groups, n_links, n_best, count_sum, groups_sha256>``.  ``ranks_file`` holds
    the byte-level vocabulary A, ``model_file`` the piece model B; both have a fixed
    size and are broadcast."""
    with open(model_file, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast((pattern, load_ranks(ranks_file), f.read()))
    tok = Tokenizers(*shared.value)
    kept = [c for c in docs.columns if c != "alignment" and (keep_text or c != text)]
    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    row_type = _nullable(src.schema["row"].dataType)
    ids = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("row", row_type),
                        T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])
    path = scratch_path(docs.sparkSession, "align-ids")
    src.mapInArrow(_tokenise(shared, chunk_chars), ids).write.option("compression", "zstd").parquet(path)
    tokens = docs.sparkSession.read.schema(ids).parquet(path)
    chunks = tokens.select("chunk").distinct().count()
    branches = max(1, -(-chunks // FAN))
    requests = written(
        tokens.select("chunk", "a", "b").mapInArrow(_first_pass(shared, SHARDS), "shard long, chunk long, keys binary, docs binary")
        .withColumn("branch", F.pmod(F.xxhash64("chunk"), F.lit(branches))), "pair-requests")
    index = pair_index(requests, branches, tok.key)
    answers = (requests.select("shard", "branch", "chunk", "keys").groupBy("shard", "branch")
               .cogroup(_copies(index, branches).groupBy("shard", "branch"))
               .applyInArrow(_answer(tok.key, len(tok.bytes_b)), "chunk long, keys binary, counts binary, best binary"))
    out = T.StructType([T.StructField("row", row_type), T.StructField("alignment", T._parse_datatype_string(STRUCT))])
    return (tokens.groupBy("chunk").cogroup(answers.groupBy("chunk"))
            .applyInArrow(_second_pass(shared), out).select("row.*", "alignment"))


def _nullable(kind: T.DataType) -> T.DataType:
    """``kind`` as files and Arrow return it: every field may be null."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType), True, f.metadata) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType), True)
    if isinstance(kind, T.MapType):
        return T.MapType(_nullable(kind.keyType), _nullable(kind.valueType), True)
    return kind
