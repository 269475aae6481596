"""Distributed order operators against brute force, with a hot key holding
a third of all rows."""

import random

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from martlet.operators.ordered import exact_quantiles, lag_by_group
from martlet.sources.ingest import next_surrogate_keys


def skewed(spark, n=30000):
    # group 0 holds a third of the rows; order key ties broken by id
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97 + 1).alias("g"),
        (F.col("id") * 7919 % 1000).alias("t"), F.col("id").alias("k"))


def test_lag_by_group_matches_window(spark):
    df = skewed(spark)
    got = lag_by_group(df, "g", ["t", "k"], "t", out="prev")
    want = df.withColumn("prev", F.lag("t").over(Window.partitionBy("g").orderBy("t", "k")))
    diff = got.select("g", "t", "k", "prev").exceptAll(want.select("g", "t", "k", "prev"))
    assert diff.count() == 0
    assert got.count() == df.count()


def test_hot_group_is_split_across_partitions(spark):
    df = skewed(spark)
    parts = (df.repartitionByRange(8, "g", "t", "k").filter("g = 0")
             .select(F.spark_partition_id().alias("p")).distinct().count())
    assert parts > 1


def test_exact_quantiles_match_percentile_disc(spark):
    rnd = random.Random(7)
    vals = [rnd.choice([None, rnd.randint(0, 50), rnd.randint(0, 5)]) for _ in range(5000)]
    df = spark.createDataFrame([(v,) for v in vals], "v int")
    probs = [0.2, 0.4, 0.6, 0.8, 0.5, 1.0]
    got = exact_quantiles(df, "v", probs).collect()[0]
    xs = np.sort(np.array([v for v in vals if v is not None]))
    n = len(xs)
    from fractions import Fraction
    for i, p in enumerate(probs, 1):
        fr = Fraction(p).limit_denominator(10**6)
        t = max(1, -(-fr.numerator * n // fr.denominator))
        assert got[f"v_q{i}"] == xs[t - 1]
    sql = spark.createDataFrame([(v,) for v in vals], "v int").selectExpr(
        "percentile_disc(0.4) WITHIN GROUP (ORDER BY v) AS p").collect()[0].p
    assert got["v_q2"] == sql


def test_next_surrogate_keys(spark):
    existing = spark.createDataFrame([(5,), (42,)], "id int")
    new = spark.range(1000).repartition(7).select(F.lit(None).cast("int").alias("id"), "id")
    new = spark.range(1000).repartition(7).withColumnRenamed("id", "payload")
    keyed = next_surrogate_keys(existing, new, "id")
    ids = sorted(r.id for r in keyed.collect())
    assert ids == list(range(43, 1043))


def test_order_gaps_with_a_hot_customer(spark, smoke_dir):
    """One customer owns a third of all orders: the range-split lag must equal
    the naive per-customer window, and churn counts must equal count(DISTINCT)."""
    from martlet.operators import features
    from martlet.plans.platform import Platform

    fct = Platform.from_driver(spark, smoke_dir).fct_orders
    hot = fct.withColumn("customer_id", F.when(F.col("order_id") % 3 == 0, F.lit(-1))
                         .otherwise(F.col("customer_id")))
    got = features.order_gaps(hot)
    w = Window.partitionBy("customer_id").orderBy("order_date", "order_id")
    gaps = (hot.withColumn("gap", F.datediff("order_date", F.lag("order_date").over(w)))
            .filter("gap IS NOT NULL"))
    want = gaps.groupBy("customer_id").agg(
        F.round(F.sum("gap").cast("decimal(22,0)") / F.count("gap").cast("decimal(20,0)"), 4)
        .alias("avg_days_between_orders"),
        F.round(F.stddev_samp(F.col("gap").cast("double")), 4).alias("stddev_days_between_orders"),
        F.max("gap").cast("bigint").alias("max_gap_days"))
    cols = ["customer_id", "avg_days_between_orders", "stddev_days_between_orders", "max_gap_days"]
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0
    assert want.select(cols).exceptAll(got.select(cols)).count() == 0
    hot_row = got.filter("customer_id = -1").collect()[0]
    assert hot_row.max_gap_days is not None


def test_gaps_from_days_equal_gaps_from_orders(spark):
    """Same-day orders, a null day, a null customer, one order, a hot customer."""
    from martlet.operators import features

    rng = random.Random(3)
    rows = [(0 if i % 3 == 0 else None if i % 17 == 0 else i % 40 + 1, i,
             None if i % 23 == 0 else f"2024-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}") for i in range(1200)]
    rows += [(99, 5000, "2024-01-01"), (98, 5001, None), (97, 5002, "2024-02-02"), (97, 5003, "2024-02-02")]
    df = spark.createDataFrame(rows, "customer_id long, order_id long, day string").select(
        "customer_id", "order_id", F.col("day").cast("date").alias("order_date"))
    got, want = features.order_day_gaps(df), features.order_gaps(df)
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_lag_by_group_null_keys_and_values(spark):
    rows = [(None if i % 5 == 0 else i % 4, None if i % 7 == 0 else i % 30, i,
             None if i % 11 == 0 else i * 2) for i in range(3000)]
    df = spark.createDataFrame(rows, "g int, t int, k int, v int")
    got = lag_by_group(df, "g", ["t", "k"], "v", out="prev")
    want = df.withColumn("prev", F.lag("v").over(Window.partitionBy("g").orderBy("t", "k")))
    cols = ["g", "t", "k", "v", "prev"]
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0
    assert want.select(cols).exceptAll(got.select(cols)).count() == 0
