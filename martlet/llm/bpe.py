"""BPE encoding and decoding with a contiguous rank array.

A word is held as its part ids and, next to them, the merge rank of every
adjacent pair.  The least rank is searched for, its boundary deleted and the
two neighbouring ranks refreshed, until no pair can merge.  Words longer than
``SHORT`` parts use the same rules with a heap, so a very long word stays
n log n.  Encoded words are remembered per worker, up to ``MEMORY`` entries.

Words are cut with the character tables that the library has: its letters and numbers
are those of Unicode 16, its lower case is newer and its normal form older.

The vocabulary is read on the driver from a tokenizer file whose path is a
parameter, and broadcast (a file of about 2 MB).

Defined cases: null text is empty; empty text has no ids and decodes to the
empty string; the special tokens of the file count as such in any text; other
columns are carried along; rows that repeat give equal results; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from array import array
from dataclasses import dataclass, field
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHORT, MEMORY = 64, 400_000
_NONE = 1 << 60


# Capitals newer than Python's tables and their small letters, which the
# library's lower case knows.
NEWER_LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB,
               0xA7DC: 0x19B, **{c: c + 32 for c in range(0x10D50, 0x10D66)}, **{c: c + 27 for c in range(0x16EA0, 0x16EB9)}}


# Letters and numbers that Unicode 16 added, which the library's word
# pattern knows; later ones it does not.
UNICODE_16 = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D40, 0x10D49), (0x10D4A, 0x10D65),
    (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
    (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x116D0, 0x116E3), (0x11BC0, 0x11BE0), (0x11BF0, 0x11BF9),
    (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16130, 0x16139), (0x16D40, 0x16D6C), (0x16D70, 0x16D79), (0x18CFF, 0x18CFF),
    (0x1CCF0, 0x1CCF9), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0), (0x1E5F1, 0x1E5FA))


# Marks that Python puts in canonical order and the library, whose normal
# form is older, takes for letters of their own; and the one composition newer than it.
LATER_MARKS = (
    (0x7FD, 0x7FD), (0x898, 0x89F), (0x8CA, 0x8D3), (0x9FE, 0x9FE), (0xC3C, 0xC3C), (0xD3B, 0xD3C), (0xEBA, 0xEBA),
    (0x1715, 0x1715), (0x1ABF, 0x1ACE), (0x1DF6, 0x1DFA), (0xA82C, 0xA82C), (0x10D24, 0x10D27), (0x10EAB, 0x10EAC),
    (0x10EFD, 0x10EFF), (0x10F46, 0x10F50), (0x10F82, 0x10F85), (0x11070, 0x11070), (0x1133B, 0x1133B), (0x1145E, 0x1145E),
    (0x11839, 0x1183A), (0x11930, 0x11930), (0x1193D, 0x1193E), (0x11943, 0x11943), (0x119E0, 0x119E0), (0x11A34, 0x11A34),
    (0x11A47, 0x11A47), (0x11A99, 0x11A99), (0x11D42, 0x11D42), (0x11D44, 0x11D45), (0x11D97, 0x11D97), (0x11F41, 0x11F42),
    (0x16FF0, 0x16FF1), (0x1E08F, 0x1E08F), (0x1E130, 0x1E136), (0x1E2AE, 0x1E2AE), (0x1E2EC, 0x1E2EF), (0x1E4EC, 0x1E4EF))
_LATER = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in LATER_MARKS)


#: No character below this one is treated differently by the library.
FIRST_DIFFERENT = "\u0558"


def normal_form(text: str) -> str:
    """NFC as the library has it."""
    import regex

    if max(text) < FIRST_DIFFERENT or not regex.search(f"[{_LATER}]", text):
        return unicodedata.normalize("NFC", text)
    return "".join(unicodedata.normalize("NFC", part) for part in regex.split(f"([{_LATER}])", text))


@cache
def newer_letters():  # noqa: ANN201
    """What the ``regex`` package calls a letter, a number or a space and the library does
    not know yet (nothing that Python's own tables or Unicode 16 hold), as the ranges of a
    class; and a compiled class of these and of the capitals above."""
    import regex

    known = {c for a, b in UNICODE_16 for c in range(a, b + 1)}
    letter = regex.compile(r"[\p{L}\p{N}\s]")
    ranges: list[list[int]] = []
    for c in range(0x110000):
        x = chr(c)
        if unicodedata.category(x) == "Cn" and c not in known and letter.match(x):
            if ranges and c == ranges[-1][1] + 1:
                ranges[-1][1] = c
            else:
                ranges.append([c, c])
    newer = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges) or "\\U0010ffff"
    return regex.compile(f"[{newer}{''.join(map(chr, NEWER_LOWER))}]"), newer


@dataclass
class WordBPE:
    """The rules of one file: word-end marks, lower case, white space dropped."""

    ranks: dict[int, int]            # left id << 20 | right id -> rank
    merged: list[int]                # rank -> id of the merged part
    start: list[tuple[int, int]]     # byte -> (id inside a word, id at its end)
    tokens: list[str]                # id -> token
    special: dict[str, int]
    pattern: str
    memory: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "memory": {}}

    @classmethod
    def load(cls, path: str) -> WordBPE:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, vocab = spec["model"], spec["model"]["vocab"]
        end = model["end_of_word_suffix"]
        steps = spec["pre_tokenizer"]["pretokenizers"]
        if [s["type"] for s in steps] != ["Split", "ByteLevel"] or spec["decoder"] is not None:
            raise ValueError("not a word-level BPE file of the known form")
        ranks, merged = {}, []
        for rank, (a, b) in enumerate(model["merges"]):
            ranks.setdefault(vocab[a] << 20 | vocab[b], rank)
            merged.append(vocab[a + b])
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = [""] * (max([*vocab.values(), *special.values()]) + 1)
        for t, i in [*vocab.items(), *special.items()]:
            tokens[i] = t
        letters = byte_letters()
        return cls(ranks, merged, [(vocab[c], vocab[c + end]) for c in letters], tokens, special,
                   steps[0]["pattern"]["Regex"])

    def words(self, text: str) -> list[str]:
        import regex

        pattern = self.pattern
        if not text.isascii():
            text = normal_form(text)
            if max(text) >= FIRST_DIFFERENT and newer_letters()[0].search(text):
                text, pattern = text.translate(NEWER_LOWER), self.careful
        # lower case letter by letter: no special form for a final sigma
        return regex.findall(pattern, text.replace("Σ", "σ").lower())

    @property
    def careful(self) -> str:
        """The word pattern with the letters, numbers and spaces of the library's older
        character tables only."""
        _, newer = newer_letters()
        return (self.pattern.replace("[\\p{L}]+", f"(?:(?![{newer}])\\p{{L}})+").replace("[\\p{N}]", f"(?:(?![{newer}])\\p{{N}})")
                .replace("[^\\s\\p{L}\\p{N}]+", f"(?:[{newer}]|[^\\s\\p{{L}}\\p{{N}}])+"))

    def merge(self, word: str) -> tuple[int, ...]:
        raw = word.encode("utf-8", "surrogatepass")
        start = self.start
        parts = [start[b][0] for b in raw]
        parts[-1] = start[raw[-1]][1]
        if len(parts) > SHORT:
            return tuple(self._merge_long(parts))
        get, merged = self.ranks.get, self.merged
        ranks = [get(a << 20 | b, _NONE) for a, b in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == _NONE:
                break
            i = ranks.index(least)
            parts[i] = merged[least]
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = get(parts[i] << 20 | parts[i + 1], _NONE)
            if i:
                ranks[i - 1] = get(parts[i - 1] << 20 | parts[i], _NONE)
        return tuple(parts)

    def _merge_long(self, parts: list[int]) -> list[int]:
        n, get, merged = len(parts), self.ranks.get, self.merged
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := get(parts[i] << 20 | parts[i + 1])) is not None]
        heapq.heapify(heap)
        gone = bytearray(n)
        while heap:
            rank, i = heapq.heappop(heap)
            if gone[i] or (j := after[i]) >= n or get(parts[i] << 20 | parts[j]) != rank:
                continue
            parts[i], gone[j], after[i] = merged[rank], 1, after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := get(parts[i] << 20 | parts[after[i]])) is not None:
                    heapq.heappush(heap, (r, i))
            if (k := before[i]) >= 0 and (r := get(parts[k] << 20 | parts[i])) is not None:
                heapq.heappush(heap, (r, k))
        return [p for p, dead in zip(parts, gone) if not dead]

    def encode(self, text: str) -> list[int]:
        import regex

        if not any(s in text for s in self.special):
            return self._encode_plain(text)
        out: list[int] = []
        for piece in regex.split("(" + "|".join(map(regex.escape, self.special)) + ")", text):
            if piece in self.special:
                out.append(self.special[piece])
            elif piece:
                out += self._encode_plain(piece)
        return out

    def _encode_plain(self, text: str) -> list[int]:
        memory, out = self.memory, []
        for w in self.words(text):
            got = memory.get(w)
            if got is None:
                got = self.merge(w)
                if len(w) <= SHORT:
                    if len(memory) >= MEMORY:
                        memory.clear()
                    memory[w] = got
            out += got
        return out

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by one space: the file names no decoder."""
        return " ".join(map(self.tokens.__getitem__, ids))


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level files:
    printable Latin-1 bytes stand for themselves, the rest, in order, for the
    code points from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    extra = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(extra)) for b in range(256)]


_WORKER: dict[int, WordBPE] = {}


def encode_decode(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """``docs`` plus ``bpe: struct<ids, decoded>`` (ids as little-endian
    unsigned 32-bit integers)."""
    return _apply(docs, vocabulary, text, "ids binary, decoded string", lambda ids, s: (ids, s))


def encode_digest(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """``docs`` plus ``bpe: struct<n_tokens, ids_sha256, decoded_sha256>``; the
    ids and the decoded text do not leave the Python worker."""
    sha = hashlib.sha256
    return _apply(docs, vocabulary, text, "n_tokens long, ids_sha256 string, decoded_sha256 string",
                  lambda ids, s: (len(ids) // 4, sha(ids).hexdigest(),
                                  sha(s.encode("utf-8", "surrogatepass")).hexdigest()))


def _apply(docs: DataFrame, vocabulary: str, text: str, schema: str, row) -> DataFrame:  # noqa: ANN001
    rules = docs.sparkSession.sparkContext.broadcast(WordBPE.load(vocabulary))
    names = [f.split()[0] for f in schema.split(", ")]

    @F.pandas_udf(schema)
    def run(column):  # noqa: ANN001, ANN202
        import pandas as pd

        bpe, out = rules.value, []
        for t in column:
            ids = bpe.encode(t or "")
            out.append(row(array("I", ids).tobytes(), bpe.decode(ids)))
        return pd.DataFrame(out, columns=names)

    return docs.withColumn("bpe", run(F.col(f"`{text}`")))
