"""Metric kinds over time: running totals, conversions, re-aggregable distinct counts.

* ``cumulative_metric``: a metric's running (or trailing) total on every day of its
  range and for every combination of dimensions;
* ``conversions`` / ``conversion_rate``: base events that a goal event of the same
  entity follows within a horizon;
* ``distinct_partials`` / ``distinct_rollup``: distinct keys per day as bitmaps, from
  which any coarser slice is counted without the fact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.functions import exact_ratio
from martlet.operators.skew import HotKeys
from martlet.plans.metrics import METRICS, metric_query
from martlet.sources.ingest import materialize_table

#: A key has one row, so one day, in its model: its distinct count adds up over days.
MODEL_KEY = {"fct_orders": "order_id", "dim_customers": "customer_id"}


def _same(left: str, right: str, columns: list[str]) -> list[Column]:
    return [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]


def cumulative_metric(models: dict[str, DataFrame], metric: str, dims: list[str] | None = None,
                      trailing_days: int | None = None, hot: dict[str, HotKeys] | None = None) -> DataFrame:
    """``date_day, *dims, <metric>``: the running total of ``metric`` up to each day, or
    over the last ``trailing_days`` days, with every day of the data present.

    The fact is aggregated to days once (written: days x dimensions).  Days are summed
    inside their month, months are prefix-summed, and a day adds its month's offset: a
    window never holds more than a month of days or one row per month of a dimension
    value.  Rows without a day belong to no total."""
    m, dims = METRICS[metric], list(dims or [])
    adds_up = m.agg in ("sum", "count") or (m.agg == "count_distinct" and m.expr == MODEL_KEY.get(m.model))
    if m.kind != "simple" or not adds_up:
        raise ValueError(f"{metric} does not add up over days")
    daily = metric_query(models, [metric], dims=dims, grain="day", hot=hot).where("metric_time is not null")
    daily = materialize_table(daily.sparkSession, daily.withColumnRenamed("metric_time", "date_day"), f"daily-{metric}")
    bounds = F.broadcast(daily.agg(F.min("date_day").alias("_from"), F.max("date_day").alias("_to")))  # one row
    days = F.explode(F.sequence("_from", "_to", F.expr("INTERVAL 1 DAY"))).alias("date_day")
    spine = (daily.select(*dims).distinct().crossJoin(bounds) if dims else bounds.where("_from is not null")).select(*dims, days)
    filled = (spine.alias("s").join(daily.alias("d"), _same("s", "d", [*dims, "date_day"]), "left")
              .select("s.*", F.coalesce(F.col(f"d.{metric}"), F.lit(0)).alias("_v"), F.trunc("s.date_day", "month").alias("_month")))
    inside = F.sum("_v").over(Window.partitionBy(*dims, "_month").orderBy("date_day"))
    months = filled.groupBy(*dims, "_month").agg(F.sum("_v").alias("_total"))
    before = Window.partitionBy(*(dims or [F.lit(0)])).orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)
    offsets = months.select(*dims, "_month", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    kind = daily.schema[metric].dataType
    total = (filled.withColumn("_v", inside).alias("f").join(offsets.alias("o"), _same("f", "o", [*dims, "_month"]))
             .select("f.date_day", *[f"f.{c}" for c in dims], (F.col("f._v") + F.col("o._offset")).alias(metric)))
    if trailing_days:
        was = total.withColumn("date_day", F.date_add("date_day", trailing_days))
        total = (total.alias("t").join(was.alias("w"), _same("t", "w", [*dims, "date_day"]), "left")
                 .select("t.date_day", *[f"t.{c}" for c in dims],
                         (F.col(f"t.{metric}") - F.coalesce(F.col(f"w.{metric}"), F.lit(0))).alias(metric)))
    return total.withColumn(metric, F.col(metric).cast("decimal(28,2)" if kind.typeName() == "decimal" else kind))


def conversions(base: DataFrame, goals: DataFrame, entity: str, time: str, tie: str, horizon: int) -> DataFrame:
    """``base`` plus ``converted_at``: the ``time`` of the first goal of the same entity
    after the base event and at most ``horizon`` later, else null.

    ``time`` is a whole number in both frames and ``horizon`` is in its unit; a goal
    comes after a base event of the same time if its ``tie`` is larger.  Events are put
    into buckets of one horizon: the goal lies in the event's own bucket, found by one
    window per (entity, bucket), or is the first one of the next bucket, taken from one
    row per (entity, bucket).  So events of one entity are dealt over its buckets and are
    never paired with each other.  Base events without entity or time stay unconverted."""
    bucket = F.floor(F.col("_t") / horizon)
    known = F.col(entity).isNotNull() & F.col(time).isNotNull()
    row = F.struct(*[F.col(f"`{c}`") for c in base.columns])
    starts = base.where(known).select(F.col(entity).alias("_e"), F.col(time).cast("bigint").alias("_t"), F.col(tie).alias("_i"), row.alias("_row"))
    ends = goals.where(known).select(F.col(entity).alias("_e"), F.col(time).cast("bigint").alias("_t"), F.col(tie).alias("_i"),
                                     F.lit(None).cast(starts.schema["_row"].dataType).alias("_row"))
    events = starts.unionByName(ends).withColumn("_b", bucket)
    # backwards, so that the nearest later goal is the last one seen (linear)
    later = (Window.partitionBy("_e", "_b").orderBy(F.col("_t").desc(), F.col("_i").desc(), F.col("_row").isNull().asc())
             .rowsBetween(Window.unboundedPreceding, -1))
    goal_time = F.when(F.col("_row").isNull(), F.col("_t"))
    inside = events.withColumn("_next", F.last(goal_time, ignorenulls=True).over(later)).where("_row is not null")
    first = ends.withColumn("_b", bucket).groupBy("_e", (F.col("_b") - 1).alias("_b")).agg(F.min("_t").alias("_first"))
    found = inside.join(first, ["_e", "_b"], "left").select(
        "_row.*", F.coalesce("_next", F.when(F.col("_first") - F.col("_t") <= horizon, F.col("_first"))).alias("converted_at"))
    rest = base.where(~F.coalesce(known, F.lit(False))).withColumn("converted_at", F.lit(None).cast("bigint"))
    return found.unionByName(rest)


def conversion_rate(converted: DataFrame, period: Column, *dims: str) -> DataFrame:
    """``period, *dims, base_events, conversions, conversion_rate`` (4 places)."""
    return (converted.groupBy(period.alias("period"), *dims)
            .agg(F.count(F.lit(1)).alias("base_events"), F.count("converted_at").alias("conversions"))
            .withColumn("conversion_rate", exact_ratio("conversions", "base_events", 4, "decimal(20,0)")))


def repeat_order_conversion(orders: DataFrame, horizon_days: int = 90) -> DataFrame:
    """First order of each customer -> completed later order, by month of the first."""
    keyed = orders.select("customer_id", "order_date", "order_id", "status").withColumn("day", F.unix_date("order_date"))
    first = keyed.groupBy("customer_id").agg(F.min(F.struct("order_date", "order_id", "day")).alias("f")).select("customer_id", "f.*")
    made = conversions(first, keyed.where("status = 'completed'"), "customer_id", "day", "order_id", horizon_days)
    return conversion_rate(made, F.trunc("order_date", "month"))


def event_conversion(events: DataFrame, start: str, goal: str, horizon_seconds: int = 86_400) -> DataFrame:
    """Events of type ``start`` -> event of type ``goal`` by the same user, by day."""
    timed = events.withColumn("at", F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', CAST(ts AS TIMESTAMP_NTZ))"))
    made = conversions(timed.where(F.col("event_type") == start), timed.where(F.col("event_type") == goal),
                       "user_id", "at", "event_id", horizon_seconds * 1_000_000)
    return conversion_rate(made, F.col("ts").cast("date"))


# ------------------------------------------------------------- distinct counts
GRAINS = {"day": lambda d: d, "month": lambda d: F.trunc(d, "month"), "year": lambda d: F.trunc(d, "year"),
          "total": lambda d: F.lit(None).cast("date")}


def distinct_partials(df: DataFrame, day: str, keys: dict[str, str], dims: list[str] | None = None) -> DataFrame:
    """One row per day, dimension values, counted key and block of 32,768 key values: a
    bitmap of the integer keys seen.  ``keys`` names the counted columns; their rows
    share one pass and one map-side combined exchange.  Written; batches of new days
    can be appended, and a key may be seen on any number of days."""
    tagged = df.select(F.col(day).alias("day"), *(dims or []), F.explode(F.array(*[
        F.struct(F.lit(name).alias("counted"), F.col(c).cast("bigint").alias("key")) for name, c in keys.items()])).alias("x"))
    return (tagged.select("day", *(dims or []), "x.*").where("key is not null")
            .groupBy("day", *(dims or []), "counted", F.bitmap_bucket_number("key").alias("block"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("key")).alias("bits")))


def distinct_rollup(partials: DataFrame, keys: list[str], grains=("month", "year", "total"), dims: list[str] | None = None) -> DataFrame:
    """``grain, period, *dims`` and one distinct count per key, from bitmaps alone."""
    dims = list(dims or [])
    parts = []
    for grain in grains:
        merged = (partials.groupBy(GRAINS[grain](F.col("day")).alias("period"), *dims, "counted", "block")
                  .agg(F.bitmap_or_agg("bits").alias("bits")))
        counts = [F.coalesce(F.sum(F.when(F.col("counted") == k, F.bitmap_count("bits"))), F.lit(0)).alias(k) for k in keys]
        parts.append(merged.groupBy("period", *dims).agg(*counts).select(F.lit(grain).alias("grain"), "period", *dims, *keys))
    return reduce(DataFrame.unionByName, parts)
