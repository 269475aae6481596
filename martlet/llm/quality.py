"""Quality rules as a ledger of rule bits.

Every rule is evaluated once per document; its failure sets one bit and the
measurements are kept beside the bits.  A policy is a named, versioned set of
rules: applying it is ``failed_bits & mask = 0``, and what each rule of a
policy does alone or on top of the others comes from an aggregate over the
distinct bit patterns, without the texts.

DataFrame functions only.  Defined cases: null text has no words; every row is
judged on its own (repeats alike); other columns stay; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, WORD

SYMBOLS = "#*$%&|<>"

#: Rule -> condition under which a document fails.  The position is the bit;
#: append only.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 50"),
    ("repetition", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "100 * n_symbols > 20 * n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 40 * n_text_lines"),
    ("word_length", "word_chars < 2 * n_words or word_chars > 10 * n_words"),
    ("capitals", "100 * n_upper > 50 * word_chars"),
)
#: Policy version -> its rules.
POLICIES: dict[str, tuple[str, ...]] = {
    "base-1": ("few_words", "repetition"),
    "standard-1": tuple(name for name, _ in RULES),
}
_BASE = ("few_words", "repetition")


def mask(rules: tuple[str, ...]) -> int:
    bits = {name: 1 << i for i, (name, _) in enumerate(RULES)}
    return sum(bits[r] for r in set(rules))


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def _repeat_words(hashes: Column) -> Column:
    """Words that lie in a 3-word window which the text holds twice or more."""
    everything = F.lit(1 << 30)
    pairs = F.zip_with(hashes, F.slice(hashes, F.lit(2), everything), lambda a, b: F.xxhash64(a, b))
    windows = F.zip_with(pairs, F.slice(hashes, F.lit(3), everything), lambda a, b: F.xxhash64(a, b))
    return F.slice(windows, F.lit(1), F.greatest(F.size(hashes) - 2, F.lit(0)))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus the measurements that the rules use."""
    everything = F.lit(1 << 30)
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.btrim(x, F.lit(ASCII_SPACE)) != "")
    bare = _without(t, ASCII_SPACE)
    m = docs.select(
        row.alias("row"),
        F.transform(F.regexp_extract_all(t, F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w)).alias("words"),
        F.char_length(bare).cast("long").alias("word_chars"),
        (F.char_length(t) - F.char_length(_without(t, SYMBOLS))).cast("long").alias("n_symbols"),
        (F.char_length(bare) - F.char_length(_without(bare, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))).cast("long").alias("n_upper"),
        lines.alias("lines"))
    m = m.select("row", "word_chars", "n_symbols", "n_upper", "words",
                 F.size("words").cast("long").alias("n_words"),
                 F.size("lines").cast("long").alias("n_text_lines"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"))
    m = m.withColumn("windows", _repeat_words(F.col("words"))).drop("words")
    # sorted (hash, place): equal neighbours are the repeated windows
    m = m.withColumn("sorted", F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("p"))))))
    twice = F.zip_with("sorted", F.slice("sorted", F.lit(2), everything),
                       lambda a, b: F.when(a.h == b.h, F.array(a.p, b.p)))
    m = m.withColumn("places", F.sort_array(F.array_distinct(F.flatten(F.filter(twice, lambda x: x.isNotNull())))))
    cover = F.zip_with("places", F.slice("places", F.lit(2), everything),
                       lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
    repeat = F.aggregate(cover, F.lit(0).cast("long"), lambda s, x: s + x.cast("long"))
    return m.select("row", "n_words", "word_chars", "n_symbols", "n_upper", "n_text_lines", "n_dup_lines",
                    F.coalesce(repeat, F.lit(0).cast("long")).alias("n_repeat_words"))


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs``), the measurements and ``failed_bits``."""
    bits = F.lit(0).cast("long")
    for i, (_, fails) in enumerate(RULES):
        bits = bits + F.when(F.expr(fails), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long"))
    return measure(docs, text).withColumn("failed_bits", bits)


def passes(policy: str) -> Column:
    return F.col("failed_bits").bitwiseAND(F.lit(mask(POLICIES[policy])).cast("long")) == 0


def ablate(entries: DataFrame, policy: str) -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail it alone (they
    would be kept without it), and the bits seen together with it."""
    whole = mask(POLICIES[policy])
    patterns = (entries.select(F.col("failed_bits").bitwiseAND(F.lit(whole).cast("long")).alias("bits"))
                .groupBy("bits").agg(F.count(F.lit(1)).alias("n")))
    rules = [F.struct(F.lit(name).alias("rule"), F.lit(mask((name,))).cast("long").alias("bit"))
             for name in POLICIES[policy]]
    return (patterns.withColumn("r", F.explode(F.array(*rules)))
            .withColumn("hit", F.col("bits").bitwiseAND(F.col("r.bit")) != 0)
            .groupBy(F.col("r.rule").alias("rule"))
            .agg(F.sum(F.when(F.col("hit"), F.col("n")).otherwise(0)).alias("n_failed"),
                 F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_failed_alone"),
                 F.coalesce(F.bit_or(F.when(F.col("hit"), F.col("bits"))), F.lit(0)).alias("seen_with"),
                 F.sum("n").alias("n_docs")))
