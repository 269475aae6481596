"""Running totals, conversions and bitmap distinct counts against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from martlet.plans import metrics_time as MT
from martlet.plans.catalog import _Models
from martlet.plans.platform import Platform


def orders_frame(spark, n=900, seed=4):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        day = dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 200))
        rows.append((i, 0 if i % 3 == 0 else None if i % 50 == 1 else rnd.randint(1, 40), None if i % 77 == 5 else day,
                     rnd.choice(["completed", "placed"])))
    rows += [(5000, 90, dt.date(2024, 2, 1), "completed"), (5001, 91, dt.date(2024, 2, 1), "placed"),
             (5002, 91, dt.date(2024, 2, 1), "completed"), (5003, 92, dt.date(2024, 1, 1), "placed"),
             (5004, 92, dt.date(2024, 1, 31), "completed"), (5005, 93, dt.date(2024, 1, 1), "placed"),
             (5006, 93, dt.date(2024, 2, 1), "completed"), (5007, 94, dt.date(2024, 1, 5), "placed"),
             (5007, 94, dt.date(2024, 1, 5), "placed")]
    return rows, spark.createDataFrame(rows, "order_id long, customer_id long, order_date date, status string")


@pytest.mark.parametrize("horizon", [1, 30, 400])
def test_conversions_equal_brute_force(spark, horizon):
    """Every order as base event: ties by id, a hot customer, null customers and days,
    a repeated row, goals exactly at the horizon."""
    rows, df = orders_frame(spark)
    base = df.withColumn("day", F.unix_date("order_date"))
    got = {}
    for r in MT.conversions(base, base.where("status = 'completed'"), "customer_id", "day", "order_id", horizon).collect():
        got.setdefault((r.order_id, r.customer_id, r.order_date), []).append(r.converted_at)
    epoch = dt.date(1970, 1, 1)
    want = {}
    for i, c, d, _ in rows:
        after = [x for k, cc, x, s in rows if s == "completed" and None not in (c, d, x) and cc == c and (x, k) > (d, i) and (x - d).days <= horizon]
        want.setdefault((i, c, d), []).append((min(after) - epoch).days if after else None)
    assert got == want
    assert len(got[(5007, 94, dt.date(2024, 1, 5))]) == 2


def test_conversion_pairs_no_events(spark):
    _, df = orders_frame(spark)
    base = df.withColumn("day", F.unix_date("order_date"))
    plan = MT.conversions(base, base, "customer_id", "day", "order_id", 30)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert len(joins) == 1 and "_b#" in joins[0]  # one row per (entity, bucket) on its right
    assert MT.conversions(base.limit(0), base, "customer_id", "day", "order_id", 30).count() == 0
    assert MT.conversions(base, base.limit(0), "customer_id", "day", "order_id", 30).where("converted_at is not null").count() == 0


def test_cumulative_totals(spark, smoke_dir):
    models = _Models(Platform.from_driver(spark, smoke_dir))
    fct = models["fct_orders"].where("status = 'completed'").groupBy("order_date").agg(F.sum("amount_paid").alias("v")).collect()
    by_day = {r.order_date: r.v for r in fct}
    out = {r.date_day: r.total_recognised_revenue for r in MT.cumulative_metric(models, "total_recognised_revenue").collect()}
    last = {r.date_day: r.total_recognised_revenue
            for r in MT.cumulative_metric(models, "total_recognised_revenue", trailing_days=7).collect()}
    first, end = min(out), max(out)
    assert set(out) == {first + dt.timedelta(days=i) for i in range((end - first).days + 1)} == set(last)
    running = 0
    for day in sorted(out):
        running += by_day.get(day, 0)
        assert out[day] == running
        assert last[day] == sum(by_day.get(day - dt.timedelta(days=i), 0) for i in range(7))
    with pytest.raises(ValueError, match="does not add up"):
        MT.cumulative_metric(models, "avg_order_value")


def test_cumulative_windows_hold_a_month_at_most(spark, smoke_dir):
    df = MT.cumulative_metric(_Models(Platform.from_driver(spark, smoke_dir)), "total_orders", ["payment_method"])
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if line.strip(" +-:").startswith("Window")]
    assert windows and all("payment_method" in w for w in windows)
    assert any("_month" in w and "date_day" in w for w in windows)


def test_distinct_counts_from_stored_days(spark, tmp_path):
    """Two batches of days, appended; a key on several days counts once per period."""
    _, df = orders_frame(spark)
    keys = {"customers": "customer_id", "orders": "order_id"}
    path = str(tmp_path / "days")
    cut = F.col("order_date") < F.lit("2024-03-15")
    for part in (df.where(cut), df.where(~cut)):
        MT.distinct_partials(part, "order_date", keys, ["status"]).write.mode("append").parquet(path)
    stored = spark.read.parquet(path)
    known = df.where("order_date is not null")
    for dims in ([], ["status"]):
        got = MT.distinct_rollup(stored, list(keys), ("day", "month", "year", "total"), dims)
        for grain, period in MT.GRAINS.items():
            want = known.groupBy(period(F.col("order_date")).alias("period"), *dims).agg(
                F.count_distinct("customer_id").alias("customers"), F.count_distinct("order_id").alias("orders"))
            part = got.where(F.col("grain") == grain).drop("grain")
            assert part.exceptAll(want.select(part.columns)).isEmpty() and want.select(part.columns).exceptAll(part).isEmpty()
