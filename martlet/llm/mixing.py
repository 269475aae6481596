"""Mixing sources to target weights by Pareto order sampling (DataFrame functions
only).

1. A document's size is its number of words.  Sources, in code point order with
   null last, weigh ``weights`` in turn and share the corpus's words; a source's
   target stops at ``cap`` times its size and the excess is shared anew by weight
   (water filling, solved at once from prefix sums over the sources).
2. Inside a source a document's expected copies grow with the fourth root of its
   size class (octaves) up to ``cap``; their factor solves ``sum(size * copies) =
   target``.  Whole copies are taken for certain; the fraction left is the
   document's inclusion probability ``p``.
3. The documents of a source are ranked by ``(u / (1 - u)) / (p / (1 - p))``: random
   odds by inclusion odds.  The sample's size is fixed in words: the ranking is
   taken as far as it fits, and one last place goes to the document behind that end
   whose size is nearest to the words still missing (to none, if that is nearer).

A ranking is never sorted as a whole.  Its positions are 48-bit integers; words are
summed in 4,096 ranges a source, then in 4,096 ranges of the range that holds the
end, and only what is left there is put in order: two map-side combined aggregates,
whatever share of all rows one source holds.

Defined cases: null text has size 0; a document of size 0 is never taken; a null
source is one source, the last; the draw ``u`` depends on ``seed``, id and text, so
runs agree, and rows that repeat both are taken together; documents at one
48-bit position are taken together; an empty table gives an empty result; very
long texts are measured whole; all other columns are carried along (one named
``mix`` is replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, WORD, store

WEIGHTS, CAP = (5, 2, 1), 3
#: Bits of a position in the ranking, and of one of its ranges.
POSITION_BITS, RANGE_BITS = 48, 12
#: Copies of each row of a table too long to broadcast: a hot key's rows are dealt over them.
SALTS = 64


def document_size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def size_class(size: Column) -> Column:
    """0 for 0, else the number of binary digits: octaves."""
    return F.when(size > 0, F.length(F.bin(size))).otherwise(0)


def draw(doc_id: Column, text: Column, seed: str) -> Column:
    """Uniform in (0, 1) with 52 bits, from seed, id and text."""
    key = F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit(""))))
    return (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def measure(docs: DataFrame, text: str, source: str, doc_id: str, seed: str, keep_text: bool) -> DataFrame:
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "mix" and (keep_text or c != text)])
    t = F.col(f"`{text}`")
    return docs.select(row.alias("row"), F.col(f"`{source}`").cast("string").alias("src"), document_size(t).alias("size"),
                       draw(F.col(f"`{doc_id}`"), t, seed).alias("u")).withColumn("cls", size_class(F.col("size")))


def _lookup(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``rows`` with the columns of ``table``, one row per null-safe key and
    written before: broadcast up to ``BROADCAST_ROWS``, else copied ``SALTS`` times."""
    named = table.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in table.columns if c not in keys])
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    if table.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(named), on, how).drop(*[f"_{k}" for k in keys])
    salted = named.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    mine = rows.withColumn("_mine", F.pmod(F.xxhash64("u"), F.lit(SALTS)).cast("int"))
    return (mine.join(salted, [*on, F.col("_mine") == F.col("_salt")], how)
            .drop("_mine", "_salt", *[f"_{k}" for k in keys]))


def source_targets(strata: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``strata(src, words)`` -> ``src, source_size, target``, one row per source.
    Only this table, one row per source, is put in order in one task."""
    wide = "decimal(38,0)"
    sizes = strata.groupBy("src").agg(F.sum("words").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("src").asc_nulls_last())) - 1
    weighed = (sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(place, F.lit(len(weights))) + 1))
               .withColumn("total", F.sum("source_size").over(Window.partitionBy())))
    by_room = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("src").asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    shared = (weighed
              .withColumn("left", F.col("total") - F.coalesce(F.sum(F.col("source_size") * cap).over(before), F.lit(0)))
              .withColumn("heavy", F.sum("weight").over(by_room.rowsBetween(0, Window.unboundedFollowing)))
              .withColumn("full", (F.col("left") * F.col("weight")).cast(wide)
                          >= F.col("source_size").cast(wide) * cap * F.col("heavy")))
    # the first source with room sets the share of every source with room
    first = shared.agg(F.min(F.when(~F.col("full"), F.struct(
        (F.col("source_size") / F.col("weight")).alias("room"), "left", "heavy"))).alias("f"))
    target = F.when(F.col("full"), (F.col("source_size") * cap).cast("double")).otherwise(
        (F.col("f")["left"] * F.col("weight")).cast("double") / F.col("f")["heavy"])
    return shared.crossJoin(F.broadcast(first)).select("src", "source_size", target.alias("target"))


def inclusion(strata: DataFrame, targets: DataFrame, cap: int = CAP) -> DataFrame:
    """Per source and size class: certain copies ``whole``, inclusion probability
    ``p``, and the source's words ``rest`` left for the sample."""
    down = Window.partitionBy("src").orderBy(F.col("cls").desc())
    before = down.rowsBetween(Window.unboundedPreceding, -1)
    tilt = F.sqrt(F.sqrt(F.pow(F.lit(2.0), F.col("cls"))))  # the fourth root of the size, by octaves
    solved = (strata.join(targets.withColumnRenamed("src", "_src"), F.col("src").eqNullSafe(F.col("_src"))).drop("_src")
              .withColumn("tilt", F.when(F.col("words") > 0, tilt).otherwise(0.0))
              .withColumn("factor", F.try_divide(
                  F.col("target") - cap * F.coalesce(F.sum("words").over(before), F.lit(0)),
                  F.sum(F.col("tilt") * F.col("words")).over(down.rowsBetween(0, Window.unboundedFollowing))))
              .withColumn("full", (F.col("target") >= cap * F.col("source_size")) | (F.col("factor") * F.col("tilt") >= cap)))
    source = Window.partitionBy("src")
    best = F.max(F.when(~F.col("full") & (F.col("tilt") > 0), F.struct("cls", "factor"))).over(source)
    copies = F.when(F.col("full"), F.lit(float(cap))).otherwise(
        F.least(F.lit(float(cap)), F.col("best")["factor"] * F.col("tilt")))
    return (solved.withColumn("best", best)
            .withColumn("copies", F.when(F.col("words") > 0, F.coalesce(copies, F.lit(0.0))).otherwise(0.0))
            .withColumn("whole", F.floor("copies"))
            .withColumn("p", F.col("copies") - F.col("whole"))
            .withColumn("rest", F.col("target") - F.sum(F.col("whole") * F.col("words")).over(source))
            .select("src", "cls", "source_size", "target", "whole", "p", "rest"))


def position(u: Column, p: Column) -> Column:
    """Place in a source's ranking, below ``2**POSITION_BITS``: ``q / (1 + q)`` of
    the quotient of odds, which rises with it."""
    quotient = (u / (1 - u)) * ((1 - p) / p)
    return F.least(F.floor(quotient / (1 + quotient) * F.lit(float(1 << POSITION_BITS))),
                   F.lit((1 << POSITION_BITS) - 1)).cast("long")


def _end_range(ranked: DataFrame, shift: int) -> DataFrame:
    """The range of ``2**shift`` positions of each source in which its words reach
    ``rest``: ``src, range, rest`` with the words still to take inside it."""
    upto = Window.partitionBy("src").orderBy("range")
    sums = (ranked.withColumn("range", F.shiftright("at", shift)).groupBy("src", "range")
            .agg(F.sum("size").alias("words"), F.max("rest").alias("rest"))
            .withColumn("upto", F.sum("words").over(upto)).where("upto >= rest"))
    first = F.min(F.struct("range", (F.col("rest") - F.col("upto") + F.col("words")).alias("rest")))
    return sums.groupBy("src").agg(first.alias("f")).select("src", "f.range", "f.rest")


def sample_ends(ranked: DataFrame) -> DataFrame:
    """``ranked(src, at, size, rest)`` -> ``src, end, gap``: documents at positions up
    to ``end`` are in the sample, which then lacks ``gap`` words.  A source missing
    here is taken whole."""
    for shift in range(POSITION_BITS - RANGE_BITS, POSITION_BITS - 3 * RANGE_BITS, -RANGE_BITS):
        inside = store(_end_range(ranked, shift), "mix-range")
        ranked = _lookup(ranked.drop("rest"), inside, ["src"]).where(F.shiftright("at", shift) == F.col("range")).drop("range")
    upto = Window.partitionBy("src").orderBy("at")
    groups = (ranked.groupBy("src", "at").agg(F.sum("size").alias("words"), F.max("rest").alias("rest"))
              .withColumn("upto", F.sum("words").over(upto)).where("upto >= rest"))
    edge = F.min(F.struct((F.col("at") - 1).alias("end"), (F.col("rest") - F.col("upto") + F.col("words")).alias("gap")))
    return groups.groupBy("src").agg(edge.alias("e")).select("src", "e.*")


def last_places(ranked: DataFrame, ends: DataFrame) -> DataFrame:
    """``src, end, last``: the position behind ``end`` whose document comes nearest
    to the words missing; null if leaving them out is nearer."""
    behind = _lookup(ranked, ends, ["src"]).where("at > end").withColumn("off", F.abs(F.col("size") - F.col("gap")))
    best = F.min(F.when(F.col("off") < F.col("gap"), F.struct("off", "at")))
    return behind.groupBy("src").agg(F.max("end").alias("end"), best.alias("b")).select("src", "end", F.col("b.at").alias("last"))


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id",
        weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: str = "mix", keep_text: bool = True) -> DataFrame:
    """``docs`` (without the text unless ``keep_text``) plus ``mix: struct<size,
    source_size, target, copies, taken, p>``."""
    small = store(measure(docs, text, source, doc_id, seed, False), "mix-sizes")
    strata = store(small.groupBy("src", "cls").agg(F.sum("size").alias("words")), "mix-strata")
    plan = store(inclusion(strata, source_targets(strata, weights, cap), cap), "mix-plan")

    def placed(rows: DataFrame) -> DataFrame:
        return _lookup(rows, plan, ["src", "cls"]).withColumn("at", F.when((F.col("p") > 0) & (F.col("size") > 0), position(F.col("u"), F.col("p"))))

    ranked = placed(small.select("src", "cls", "size", "u")).where("at is not null").select("src", "at", "size", "rest", "u")
    ends = store(last_places(ranked, store(sample_ends(ranked), "mix-gaps")), "mix-ends")
    rows = measure(docs, text, source, doc_id, seed, True) if keep_text else small
    out = _lookup(placed(rows), ends, ["src"], "left")
    drawn = F.col("at").isNotNull() & (
        (F.col("at") <= F.coalesce("end", F.lit(1 << POSITION_BITS))) | F.col("at").eqNullSafe(F.col("last")))
    copies = F.when(F.col("size") > 0, F.col("whole") + drawn.cast("long")).otherwise(0).cast("long")
    return out.withColumn("copies", copies).select("row.*", F.struct(
        "size", F.col("source_size").cast("long").alias("source_size"), "target", "copies",
        (F.col("size") * F.col("copies")).alias("taken"), "p").alias("mix"))
