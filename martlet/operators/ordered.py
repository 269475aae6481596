"""Order-dependent operators that stay distributed when one group is huge.

* ``lag_by_group`` cuts the groups that a sketch finds to be large into slices of their
  own order range; the slice borders are literals of the plan, so the rows and the
  small table that carries values over the borders share one deterministic
  partitioning, and the fact is shuffled once.
* ``exact_quantiles`` brackets every cut by a mergeable sketch; a second pass counts
  what lies below a bracket and keeps only the values inside.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.operators.skew import HotKeys, hot_keys

#: Relative rank error of the sketch is 1 / ACCURACY; a bracket spans MARGIN of it each way.
ACCURACY, MARGIN = 10_000, 4


def exact_quantiles(df: DataFrame, column: str, probs, prefix: str | None = None) -> DataFrame:
    """Exact discrete percentiles (``percentile_disc``) of one column as ONE row."""
    return exact_quantiles_multi(df, [column], probs, [prefix or column])


def exact_quantiles_multi(df: DataFrame, columns: list[str], probs,
                          prefixes: list[str] | None = None) -> DataFrame:
    """Exact ``percentile_disc`` of several columns in ONE pass, as one row
    ``<prefix>_q1 .. _qK`` per column.

    For each ``p`` the result is the smallest value whose cumulative count
    reaches ``ceil(p * N)`` (NULLs ignored), with exact rational thresholds
    (``0.6 * 5`` is 3, not 3.0000000000000004).  Pass 1: a Greenwald-Khanna sketch
    brackets every cut (one row).  Pass 2: values are counted below each bracket, and
    by value inside it, in one map-side combined aggregate; a cut's running count
    goes over the values of its bracket only, about ``2 * MARGIN / ACCURACY`` of
    all rows at most.  A hot value is one row per task.  Values are compared with
    the brackets as doubles (monotone) and with each other exactly.
    """
    prefixes = prefixes or list(columns)
    types = [df.schema[c].dataType for c in columns]
    # one comparable type for the unpivoted values: exact decimal when every
    # column is integral/decimal, else double
    if all(isinstance(t, (T.IntegralType, T.DecimalType)) for t in types):
        scale = max([t.scale for t in types if isinstance(t, T.DecimalType)] or [0])
        value_type = f"decimal(38,{scale})"
    else:
        value_type = "double"
    margin = MARGIN / ACCURACY
    aggs = []
    for i, c in enumerate(columns):
        v = F.col(c).cast("double")
        for j, p in enumerate(probs):
            low, high = (F.percentile_approx(v, float(q), ACCURACY) for q in (max(p - margin, 0.0), min(p + margin, 1.0)))
            aggs += [(F.min(v) if p <= margin else low).alias(f"_lo_{i}_{j}"), (F.max(v) if p >= 1 - margin else high).alias(f"_hi_{i}_{j}")]
    aggs += [F.count(c).alias(f"_n_{i}") for i, c in enumerate(columns)]
    brackets = df.agg(*aggs)
    cuts = []
    for i, c in enumerate(columns):
        for j, p in enumerate(probs):
            frac = Fraction(p).limit_denominator(10**6)
            # ceil(num * N / den) in integers, at least 1
            rank = F.greatest(F.floor((F.col(f"_n_{i}") * frac.numerator + (frac.denominator - 1)) / F.lit(frac.denominator)), F.lit(1))
            cuts.append(F.struct(F.lit(i).alias("m"), F.lit(j).alias("q"), F.col(c).cast(value_type).alias("v"),
                                 F.col(f"_lo_{i}_{j}").alias("lo"), F.col(f"_hi_{i}_{j}").alias("hi"), rank.cast("long").alias("rank")))
    near = (df.select(*dict.fromkeys(columns)).crossJoin(F.broadcast(brackets)).select(F.explode(F.array(*cuts)).alias("x"))
            .select("x.*").where(F.col("v").cast("double") <= F.col("hi")))
    held = (near.groupBy("m", "q", F.when(F.col("v").cast("double") >= F.col("lo"), F.col("v")).alias("v"))
            .agg(F.count(F.lit(1)).alias("n"), F.max("rank").alias("rank")))
    # what lies below the bracket is the null value, first in order
    upto = held.withColumn("upto", F.sum("n").over(Window.partitionBy("m", "q").orderBy("v")))
    hit = F.col("upto") >= F.col("rank")
    missed = F.lit("a sketch's bracket missed its quantile")
    return upto.agg(*[
        F.min(F.when((F.col("m") == i) & (F.col("q") == j) & hit, F.when(
            F.col("v").isNull(), F.raise_error(missed).cast(value_type)).otherwise(F.col("v")))).cast(dtype).alias(f"{prefix}_q{j + 1}")
        for i, (prefix, dtype) in enumerate(zip(prefixes, types)) for j in range(len(probs))])


def approx_quantiles(df: DataFrame, column: str, probs, relative_error: float = 0.05,
                     prefix: str | None = None) -> DataFrame:
    """Greenwald-Khanna sketch percentiles (``approxQuantile`` semantics) as a
    lazy one-row DataFrame — no driver round trip."""
    prefix = prefix or column
    accuracy = max(1, int(round(1.0 / relative_error))) if relative_error > 0 else 1_000_000_000
    q = F.percentile_approx(F.col(column), list(probs), accuracy)
    return df.agg(q.alias("_q")).select(
        *[F.col("_q")[i].alias(f"{prefix}_q{i + 1}") for i in range(len(probs))])


def lag_by_group(df: DataFrame, group: str, order: list[str], value: str,
                 out: str = "prev_value", hot: HotKeys | None = None) -> DataFrame:
    """``lag(value) over (partition by group order by order...)`` without
    putting a large group into one task.

    Groups that hold more rows than an average partition (``hot``, found by a sketch of
    ``df`` unless given) are cut into slices at quantiles of the first order column,
    which must be a number, a date or a timestamp; rows that share its value share a
    slice.  A window runs inside (group, slice); the first row of a slice takes the last
    value of the nearest earlier slice from a table of one row per slice of a hot group.
    The order columns must make the order total (add a key as tie-break).
    """
    hot = hot_keys(df, group) if hot is None else hot
    if not hot:
        return df.withColumn(out, F.lag(value).over(Window.partitionBy(group).orderBy(*order)))
    sliced = df.withColumn("_slice", _slice_of(df, group, order[0], hot))
    w = Window.partitionBy(group, "_slice").orderBy(*order)
    local = sliced.withColumn(out, F.lag(value).over(w)).withColumn("_first", F.row_number().over(w) == 1)
    last = (sliced.where(hot.holds(F.col(group))).groupBy(group, "_slice")
            .agg(F.max(F.struct(*order, F.col(value).alias("_val"))).alias("_last")))
    border = last.select(F.col(group).alias("_g"), F.col("_slice").alias("_s"),
                         F.lag("_last").over(Window.partitionBy(group).orderBy("_slice"))["_val"].alias("_prev"))
    # at most hot.parts rows per hot group, and fewer hot groups than partitions
    joined = local.join(F.broadcast(border), F.col(group).eqNullSafe(F.col("_g")) & (F.col("_slice") == F.col("_s")), "left")
    return (joined.withColumn(out, F.when(F.col("_first"), F.col("_prev")).otherwise(F.col(out)))
            .drop("_slice", "_first", "_g", "_s", "_prev"))


def _slice_of(df: DataFrame, group: str, order: str, hot: HotKeys) -> Column:
    """Slice number of a row: how many of its group's borders lie before it."""
    probs = [i / hot.parts for i in range(1, hot.parts)]
    rows = (df.where(hot.holds(F.col(group))).groupBy(group)
            .agg(F.percentile_approx(order, probs, 100 * hot.parts).alias("at")).collect())
    slices = F.lit(0)
    for r in rows:  # one per hot group
        borders = sorted({x for x in r["at"] or [] if x is not None})
        if borders:
            before = F.size(F.filter(F.array(*map(F.lit, borders)), lambda b: b < F.col(order)))
            slices = F.when(F.col(group).eqNullSafe(F.lit(r[group])), before).otherwise(slices)
    return slices


def bounded_cuts(values: Column, cuts: list[Column], ascending_scores=True) -> Column:
    """Score 1..len(cuts)+1 by the first cut ``value <= cut`` (a ``<=`` ladder)."""
    n = len(cuts)
    expr = None
    for i, cut in enumerate(cuts):
        score = (i + 1) if ascending_scores else (n + 1 - i)
        expr = F.when(values <= cut, F.lit(score)) if expr is None else expr.when(values <= cut, F.lit(score))
    return expr.otherwise(F.lit(n + 1 if ascending_scores else 1))
