"""Secret scans: patterns and sliding-window entropy.

Patterns give the spans of three kinds (assign, access, hex).  Every long
token-like string, without the spans in it, is a candidate: its character class is read off
(hex, letters of one case, upper case and digits, lower case and digits, mixed), a window of
``WINDOW`` characters slides over it, the counts per character are updated by
the one that enters and the one that leaves, and so is the sum of c * log2(c)
from which the Shannon entropy of the window follows.  A candidate is a secret
when a window reaches its class's threshold.

Allow-list: UUIDs and dates, then numbers and words between its signs are left out
first, so each part of a path counts by itself.  A word has a word's shape (one case,
capitalised or camel case, a few digits behind it); one of ``WINDOW`` characters or
more must also be made of common letter pairs, as random letters are not.

DataFrame functions only.  Offsets are code points, end exclusive.  Defined
cases: null text is empty and has no spans; every row is scanned on its own; a very
long text is scanned whole, in time that grows with it (spans are placed by running
sums, base spans are looked for around each candidate only); other columns stay; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # a run is taken whole, so 20 characters or more
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-"
#: Character class, its shape, and the least entropy (bits) of a window.
CLASSES = (
    ("hex", r"^(?:[0-9a-f]+|[0-9A-F]+)$", 2.95),
    ("letters", r"^(?:[a-z]+|[A-Z]+)$", 3.3),
    ("upper", r"^[0-9A-Z]+$", 3.4),
    ("lower", r"^[0-9a-z]+$", 3.5),
    ("mixed", r"^.*$", 3.65),
)
_SIGNS = "+/_=-"
#: Known shapes that hold signs themselves: UUIDs, dates with a time.
KNOWN = (
    r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
    r"[0-9]{4}-?[0-9]{2}-?[0-9]{2}[T_-][0-9]{2}-?[0-9]{2}(?:-?[0-9]{2}(?:-?[0-9]{1,9})?)?(?:Z|UTC|GMT)?",
)
_BEFORE, _AFTER = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
#: A part between signs, or a sign; a part that is a number or has a word's shape: lower
#: case, upper case, capitalised or camel case with acronyms, up to four digits after it.
PART = r"[0-9A-Za-z]+|[+/_=-]"
#: (A word reads one way only; the possessive forms spare very long ones the way back.)
WORD = (r"^(?:[0-9]++|(?:[A-Z]++|[a-z]*+(?:[A-Z][a-z]++|[A-Z]{2,5}[a-z]{3,}+)*+[A-Z]{0,5}+)[0-9]{0,4}+)$")
# The most common letter pairs of European languages, and the least
# share of them (per cent) among the pairs of a word of ``WINDOW`` characters or more.
PAIRS = (
    "th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve co me de hi ri ro ic ne ea"
    " ra ce li ch ll be ma si om ur ca el ta la ns di fo ho pe ec pr no ct us ac ot il tr ly nc et ut ss so rs un lo wa ge ie"
    " wh ee wi em ad ol rt po we na ul ni ts mo ow pa im mi ai sh ir su id os iv ia am fi ci vi pl ig tu ev ld").split()
WORD_PAIRS = 40
#: Shorter words stay with the text around them: random text has such parts too.
LONG_WORD = 3
_CHUNK = 256


def _starts(lengths: Column) -> Column:
    """Running sums before each element, in chunks so that a text with very
    many matches stays far from quadratic."""
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _CHUNK).cast("int")),
                         lambda c: F.slice(lengths, c * _CHUNK + 1, F.lit(_CHUNK)))

    def run(values: Column, base: Column) -> Column:
        state = F.struct(base.cast("int").alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(values, state, lambda s, x: F.struct(
            (s.at + x).alias("at"), F.concat(s.out, F.array(s.at)).alias("out")))

    def step(s: Column, chunk: Column) -> Column:
        part = run(chunk, s.at)
        return F.struct(part["at"].alias("at"), F.concat(s.out, F.array(part["out"])).alias("out"))

    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<int>>").alias("out"))
    return F.flatten(F.aggregate(chunks, state, step)["out"])


def _spans(text: Column, pattern: str, kind: str, keep=None) -> Column:  # noqa: ANN001
    """``array<struct<s, k, e, v>>`` of the matches that ``keep`` lets stand."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(1)) if "([" in pattern else found
    # text between and within matches, in turn: gap 0, match 0, gap 1, match 1, ...
    lengths = F.zip_with(F.split(text, pattern, -1), found,
                         lambda gap, hit: F.struct(F.char_length(gap).alias("g"),
                                                   F.coalesce(F.char_length(hit), F.lit(0)).alias("h")))
    rows = _let(lengths, lambda known: F.zip_with(
        F.arrays_zip(_let(F.transform(known, lambda x: x.g + x.h), _starts).alias("a"), known.alias("l")),
        F.arrays_zip(found.alias("f"), value.alias("v")), lambda x, y: F.struct(
            (x["a"] + x["l"]["g"]).alias("s"), F.lit(KINDS.index(kind)).alias("k"),
            (x["a"] + x["l"]["g"] + x["l"]["h"]).alias("e"), y["v"].alias("v"))))
    rows = F.filter(rows, lambda r: r.v.isNotNull())
    return F.filter(rows, keep) if keep else rows


def window_entropy(value: Column) -> Column:
    """The highest Shannon entropy (bits) of any window of ``WINDOW``
    characters; 0 for shorter strings."""
    place = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    # places are 0 outside the alphabet, which is a symbol of its own
    pairs = F.zip_with(place, F.concat(F.array_repeat(F.lit(-1), WINDOW), place),
                       lambda new, old: F.struct(new.alias("new"), old.alias("old")))
    pairs = F.slice(pairs, F.lit(1), F.size(place))

    def weigh(c: Column) -> Column:
        return F.when(c > 0, c * F.log2(c)).otherwise(F.lit(0.0))

    def step(s: Column, x: Column) -> Column:
        before_in = F.element_at(s.counts, x.new + 1).cast("double")
        s1 = s["sum"] + weigh(before_in + 1) - weigh(before_in)
        before_out = (F.element_at(s.counts, x.old + 1) + F.when(x.old == x.new, 1).otherwise(0)).cast("double")
        s2 = F.when(x.old < 0, s1).otherwise(s1 - weigh(before_out) + weigh(before_out - 1))
        counts = F.transform(s.counts, lambda v, i: v + F.when(i == x.new, 1).otherwise(0)
                             - F.when(i == x.old, 1).otherwise(0))
        entropy = F.lit(WINDOW).cast("double")
        entropy = F.log2(entropy) - s2 / entropy
        return F.struct(counts.alias("counts"), s2.alias("sum"), (s.n + 1).alias("n"),
                        F.when(s.n + 1 >= WINDOW, F.greatest(s.best, entropy)).otherwise(s.best).alias("best"))

    state = F.struct(F.array_repeat(F.lit(0), len(ALPHABET) + 1).alias("counts"), F.lit(0.0).alias("sum"),
                     F.lit(0).alias("n"), F.lit(0.0).alias("best"))
    return F.aggregate(pairs, state, step)["best"]


def _let(value: Column, use) -> Column:  # noqa: ANN001
    """``use(value)`` with ``value`` evaluated once, wherever ``use`` puts it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _is_word(part: Column) -> Column:
    """A part between signs is a number or a word."""
    letters = F.lower(F.regexp_replace(part, "[0-9]+$", ""))
    n = F.char_length(letters) - 1
    common = F.size(F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substring(letters, i, F.lit(2)).isin(PAIRS)))
    return part.rlike(WORD) & F.when(F.char_length(part) >= WINDOW, 100 * common >= WORD_PAIRS * n).otherwise(F.lit(True))


def _is_secret(value: Column) -> Column:
    """Words and known shapes between the signs are left out; what stands
    between them, or all of it when words are less than half, is a secret
    when a window reaches the threshold of its class."""
    plain = value
    for shape in KNOWN:
        plain = F.regexp_replace(plain, _BEFORE + shape + _AFTER, "0")

    def parts(v: Column) -> Column:
        return F.regexp_extract_all(v, F.lit(PART), F.lit(0))

    def is_sign(x: Column) -> Column:
        return x.isin(list(_SIGNS))

    def letters(v: Column) -> Column:
        return F.aggregate(v, F.lit(0), lambda n, x: n + F.when(is_sign(x), 0).otherwise(F.char_length(x)))

    def odd(v: Column) -> Column:
        return F.filter(v, lambda x: ~is_sign(x) & ~_is_word(x))

    def secret(v: Column) -> Column:
        least = F.lit(CLASSES[-1][2])
        for _, shape, bits in reversed(CLASSES):
            least = F.when(v.rlike(shape), F.lit(bits)).otherwise(least)
        return (F.size(odd(parts(v))) > 0) & (F.round(window_entropy(v), 9) >= least)

    def judged(v: Column) -> Column:
        rest = F.concat_ws("", F.transform(parts(v), lambda x: F.when(
            ~is_sign(x) & (F.char_length(x) >= LONG_WORD) & _is_word(x), F.lit(" ")).otherwise(x)))
        pieces = F.transform(F.split(rest, " "), lambda x: F.btrim(x, F.lit(_SIGNS)))
        whole = 2 * letters(odd(parts(v))) > letters(parts(v))
        return F.exists(F.when(whole, F.array(v)).otherwise(pieces),
                        lambda x: F.when(F.char_length(x) >= WINDOW, secret(x)).otherwise(F.lit(False)))

    return _let(plain, judged)


def _outside(r: Column, base: Column) -> Column:
    """The parts of a candidate outside the base spans that hold a window."""
    inside = F.filter(base, lambda b: (b.s < r.e) & (r.s < b.e))
    state = F.struct(r.s.alias("at"), F.array().cast("array<struct<s:int,e:int>>").alias("out"))

    def step(x: Column, b: Column) -> Column:
        gap = F.array(F.struct(x.at.alias("s"), b.s.alias("e")))
        return F.struct(F.greatest(x.at, b.e).alias("at"), F.concat(x.out, gap).alias("out"))

    parts = F.aggregate(inside, state, step, lambda x: F.concat(
        x.out, F.array(F.struct(x.at.alias("s"), r.e.alias("e")))))
    return F.transform(F.filter(parts, lambda x: x.e - x.s >= WINDOW), lambda x: F.struct(
        x.s.alias("s"), r.k.alias("k"), x.e.alias("e"), F.substring(r.v, x.s - r.s + 1, x.e - x.s).alias("v")))


_ARRAY = "array<struct<s:int,k:int,e:int,v:string>>"


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs``), ``base`` and ``added``: arrays of
    ``struct<s, k, e, v>`` (start, kind number, end, value), each by start."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    none = F.array().cast(_ARRAY)
    small = F.lower(t)
    named = F.lit(False)
    for word in ("password", "passwd", "secret", "token", "apikey", "api_key"):
        named = named | small.contains(word)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    got = docs.select(
        row.alias("row"), t.alias("t"), named.alias("named"), t.contains("AKIA").alias("keyed"),
        t.rlike(CANDIDATE).alias("long"))
    got = got.select(
        "row", "t", "long",
        F.when(F.col("named"), _spans(F.col("t"), ASSIGN, "assign", lambda r: F.char_length(r.v) >= 6))
        .otherwise(none).cast(_ARRAY).alias("assign"),
        F.when(F.col("keyed"), _spans(F.col("t"), ACCESS, "access")).otherwise(none).cast(_ARRAY).alias("access"),
        F.when(F.col("long"), _spans(F.col("t"), HEX, "hex")).otherwise(none).cast(_ARRAY).alias("hex"))
    got = got.select("row", "t", "long", F.sort_array(F.concat("assign", "access", "hex")).alias("base"))
    # both arrays are bound once: the base spans are not looked for anew at every candidate
    found = F.struct(F.col("base").alias("base"), _spans(F.col("t"), CANDIDATE, "entropy").alias("long"))
    added = _let(found, lambda x: F.filter(
        F.flatten(F.transform(x["long"], lambda r: _outside(r, x["base"]))), lambda r: _is_secret(r.v)))
    return got.select("row", "base", F.when(F.col("long"), added).otherwise(none).cast(_ARRAY).alias("added"))


def render(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda r: F.concat_ws(
        ":", F.element_at(names, r.k + 1), r.s.cast("string"), r.e.cast("string"))))


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with every span replaced; overlapping spans become one mark."""
    t = F.coalesce(text, F.lit(""))
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(s: Column, r: Column) -> Column:
        fresh = F.array(F.substring(t, s.at + 1, r.s - s.at), F.lit(mark))
        return F.struct(F.greatest(s.at, r.e).alias("at"),
                        F.when(r.s >= s.at, F.concat(s.out, fresh)).otherwise(s.out).alias("out"))

    done = F.aggregate(spans, state, step)
    return F.concat(F.concat_ws("", done["out"]), F.substring(t, done["at"] + 1, F.lit(1 << 30)))
