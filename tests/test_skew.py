"""Hot keys: found by a sketch, dealt over tasks, with the plain join's rows."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from martlet.operators import features
from martlet.operators.ordered import exact_quantiles_multi
from martlet.operators.skew import HotKeys, hot_keys, split_join
from martlet.plans import metrics as M
from martlet.plans import questions as Q
from martlet.plans.catalog import _Models
from martlet.plans.platform import Platform
from martlet.sources import adapter


def hot_fact(spark, n=30_000):
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 11 == 0, F.lit(None).cast("long"))
        .otherwise(F.col("id") % 500).cast("long").alias("k"), F.col("id").alias("order_id"), (F.col("id") % 13).alias("v"))


def test_sketch_finds_the_hot_keys_only(spark):
    hot = hot_keys(hot_fact(spark), "k", over=0.4)
    assert hot.keys == (7,) and hot.null and hot.parts >= 5
    assert not hot_keys(spark.range(5000).withColumnRenamed("id", "k"), "k")
    assert not hot_keys(spark.range(0).withColumnRenamed("id", "k"), "k")
    assert hot_keys(spark.range(100).select(F.lit("x").alias("k")), "k").keys == ("x",)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_split_join_equals_the_join(spark, how):
    fact = hot_fact(spark)
    dim = spark.range(0, 600, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("d"))
    dim = dim.unionByName(spark.sql("select 7L as k, 1L as d union all select 7L, 2L union all select null, 3L"))
    want = fact.join(dim, "k", how)
    for hot in (hot_keys(fact, "k", over=0.4), HotKeys((7, 8, 10_000), True, 3), HotKeys()):
        got = split_join(fact, dim, "k", how, hot)
        assert got.columns == want.columns
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    with pytest.raises(ValueError, match="inner and left"):
        split_join(fact, dim, "k", "full")


def test_no_task_of_the_join_holds_twice_the_median(spark):
    """Rows per task of the shuffled join, without adaptive help."""
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        fact = spark.range(160_000).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 20_000).alias("k"), F.col("id").alias("order_id"))
        dim = spark.range(20_000).select(F.col("id").alias("k"), F.col("id").alias("d"))

        def sizes(df):
            return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]

        plain = sizes(fact.join(dim, "k", "left"))
        split = sizes(split_join(fact, dim, "k", "left", hot_keys(fact, "k")))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(plain) == sum(split) == 160_000
    assert max(plain) > 4 * statistics.median(plain)
    assert max(split) <= 2 * statistics.median(split)


class Skewed:
    """The driver's platform with a third of all orders at one customer."""

    def __init__(self, spark, smoke_dir):
        raw = adapter.load_raw(spark, smoke_dir)
        one = raw.customers.agg(F.min("customer_id")).first()[0]
        orders = raw.orders.withColumn("customer_id", F.when(F.col("order_id") % 3 == 0, F.lit(one)).otherwise(F.col("customer_id")))
        self.p = Platform(adapter.RawTables(raw.customers, raw.products, orders, raw.order_items, raw.payments, raw.reviews),
                          as_of="2001-08-01", high=2_000_000, mid=1_000_000)
        self.customer = one


def test_customer_joins_with_a_hot_customer(spark, smoke_dir):
    s = Skewed(spark, smoke_dir)
    p, hot = s.p, s.p.hot_customers
    assert hot.keys == (s.customer,)

    def same(make):
        got, want = make(hot), make(None)
        assert got.columns == want.columns
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()

    same(lambda h: features.customer_order_history(p.dim_customers, p.fct_orders, "2001-08-01", h))
    same(lambda h: Q.breakdown("return_rate", "segment", p.dim_customers, p.fct_orders, h))
    same(lambda h: Q.return_rate_by_category_segment(p.stg_order_items, p.dim_products, p.fct_orders, p.dim_customers, h))
    for names, dims in ((["total_recognised_revenue", "total_orders"], ["customer_segment"]), (["revenue_per_customer"], ["country"])):
        same(lambda h: M.metric_query(_Models(p), names, dims=dims, hot=h and {"customer_id": h}))


def test_quantiles_of_hot_and_wide_values(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice([0, 0, 0, 7, None]), rnd.gauss(0, 1e6), str(rnd.randint(-10**9, 10**9))) for _ in range(20_000)]
    df = spark.createDataFrame(rows, "a int, b double, c string").select(
        "a", F.col("b"), F.col("c").cast("decimal(18,2)").alias("c"), F.lit(None).cast("int").alias("none"))
    probs = [0.0001, 0.2, 0.5, 0.9999, 1.0]
    got = exact_quantiles_multi(df.select("a", F.col("b").cast("decimal(20,4)").alias("b"), "c", "none"), ["a", "b", "c", "none"], probs).first()
    want = df.selectExpr(*[f"percentile_disc({p}) WITHIN GROUP (ORDER BY {e}) AS {c}_q{i}" for c, e in (
        ("a", "a"), ("b", "cast(b as decimal(20,4))"), ("c", "c")) for i, p in enumerate(probs, 1)]).first()
    for c in "abc":
        for i in range(1, 6):
            assert float(got[f"{c}_q{i}"]) == float(want[f"{c}_q{i}"])
    assert got["none_q1"] is None
    plan = exact_quantiles_multi(df, ["a", "c"], probs)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and plan.count("percentile_approx") > 0
