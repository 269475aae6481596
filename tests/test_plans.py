"""Plan shape: pruning and pushdown reach the scan, no Cartesian products,
no Expand on the order fact where distinct counts were rewritten."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from martlet.plans import catalog


def plan_of(spark, smoke_dir, name):
    df = entry.queries()[name](spark, smoke_dir)
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_pruning_and_pushdown(spark, smoke_dir):
    df = entry.queries()["fct_orders"](spark, smoke_dir)
    text = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    li = [line for line in text.splitlines() if "ReadSchema" in line and "l_orderkey" in line]
    assert li and all("l_shipdate" not in x and "l_tax" not in x and "l_discount" not in x for x in li)
    silver = entry.queries()["silver_orders"](spark, smoke_dir)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PushedFilters: [IsNotNull(o_orderkey)]" in silver


@pytest.mark.parametrize("key", ["stg_orders", "stg_payments", "product_ratings", "fct_orders", "load_audit"])
def test_no_source_row_is_dropped(spark, smoke_dir, key):
    """No modulus or line-number filter on the driver tables."""
    plan = entry.queries()[key](spark, smoke_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"% (13|97)|l_linenumber#\d+L? = 1", plan)


@pytest.mark.parametrize("name", ["kpi_summary", "all_metrics", "side_by_side_kpis",
                                  "churn_order_features", "fct_revenue_by_product",
                                  "revenue_by_product_lines", "metric_return_rate", "metric_ratio",
                                  "return_rate_breakdown_total", "return_rate_breakdown_segment",
                                  "return_rate_by_category_segment", "mart_country_performance"])
def test_no_expand(spark, smoke_dir, name):
    assert "Expand" not in plan_of(spark, smoke_dir, name)


def test_no_cartesian_products(spark, smoke_dir):
    for name in ["fct_revenue_by_product", "medallion_revenue_by_product", "top_products",
                 "payment_method_affinity_pairs", "all_metrics", "rfm_customer_features"]:
        assert "CartesianProduct" not in plan_of(spark, smoke_dir, name)


def test_gaps_shuffle_the_orders_once(spark, smoke_dir):
    """No pinned copy, no join while no customer is hot; a hot customer is cut into
    slices that the window goes over."""
    from martlet.operators import features
    from martlet.plans.platform import Platform

    plan = plan_of(spark, smoke_dir, "order_gaps")
    assert "Scan ExistingRDD" not in plan and "Join" not in plan
    assert plan.count("Exchange hashpartitioning(customer_id") == 1
    orders = Platform.from_driver(spark, smoke_dir).stg_orders
    hot = orders.withColumn("customer_id", F.when(F.col("order_id") % 3 == 0, F.lit(-1)).otherwise(F.col("customer_id")))
    plan = features.order_gaps(hot)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and "lag(order_date" in line]
    assert windows and all("_slice" in w for w in windows)
    assert "Scan ExistingRDD" not in plan


def test_co_bucketed_marts_need_no_shuffle(spark, smoke_dir, tmp_path):
    from martlet.operators import consumers
    from martlet.plans import build
    from martlet.plans.platform import Platform

    build.build_marts(spark, Platform.from_driver(spark, smoke_dir), base=str(tmp_path / "b"),
                      customer_buckets=4, run_tests=False)
    tables = {t.name.rsplit("_", 2)[-2] + "_" + t.name.rsplit("_", 2)[-1]: t.name
              for t in spark.catalog.listTables() if t.name.startswith("martlet_")}
    fct, dim = spark.table(tables["fct_orders"]), spark.table(tables["dim_customers"])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = consumers.mart_customer_segments(dim, fct, "2001-08-01")
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
    assert df.count() == dim.count()


def test_order_layout_needs_no_exchange_of_the_items(spark, smoke_dir, tmp_path):
    """Joins and aggregates on the order key read the bucket layout; the items are only
    shuffled as partial sums per product."""
    from martlet.operators import consumers
    from martlet.plans import build
    from martlet.plans.platform import Platform

    plain = Platform.from_driver(spark, smoke_dir)
    p = build.build_order_layout(spark, plain, base=str(tmp_path / "layout"), buckets=4)
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def final_plan(df):
            df.write.format("noop").mode("overwrite").save()
            return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]

        assert "Exchange" not in final_plan(p.fct_orders)
        lines = consumers.revenue_by_product_lines(p.stg_order_items, p.stg_orders, plain.dim_products)
        plan = final_plan(lines)
        assert "Exchange hashpartitioning(order_id" not in plan
        assert plan.count("Exchange hashpartitioning(product_id") == 2  # the partial sums, and the products
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    want = consumers.revenue_by_product_lines(plain.stg_order_items, plain.stg_orders, plain.dim_products)
    assert lines.exceptAll(want).isEmpty() and want.exceptAll(lines).isEmpty()
    assert p.fct_orders.exceptAll(plain.fct_orders).isEmpty() and plain.fct_orders.exceptAll(p.fct_orders).isEmpty()


def test_order_layout_has_more_buckets_for_more_rows(spark, smoke_dir, tmp_path, monkeypatch):
    """A task reads a whole bucket: its rows must not grow with the tables."""
    from martlet.operators import consumers, skew
    from martlet.plans import build
    from martlet.plans.platform import Platform

    plain = Platform.from_driver(spark, smoke_dir)
    items = plain.stg_order_items.count()
    monkeypatch.setattr(skew, "ROWS_PER_TASK", items // 10)
    p = build.build_order_layout(spark, plain, base=str(tmp_path / "layout"), buckets=4)
    for name in build.ORDER_TABLES:
        held = [r["count"] for r in getattr(p, name).groupBy(F.input_file_name()).count().collect()]
        assert len(held) >= 10 and max(held) <= items // 5
    lines = consumers.revenue_by_product_lines(p.stg_order_items, p.stg_orders, plain.dim_products)
    want = consumers.revenue_by_product_lines(plain.stg_order_items, plain.stg_orders, plain.dim_products)
    assert lines.exceptAll(want).isEmpty() and want.exceptAll(lines).isEmpty()


def test_line_revenue_is_dealt_over_more_tasks_for_more_rows(spark, smoke_dir, monkeypatch):
    from martlet.operators import skew
    from martlet.plans.platform import Platform

    want = catalog.queries()["revenue_by_product_lines"](spark, smoke_dir)
    items = Platform.from_driver(spark, smoke_dir).stg_order_items.count()
    monkeypatch.setattr(skew, "ROWS_PER_TASK", items // 20)
    got = catalog.queries()["revenue_by_product_lines"](spark, smoke_dir)
    plan = got._jdf.queryExecution().executedPlan().toString()
    dealt = [int(n) for n in re.findall(r"hashpartitioning\(order_id#\d+L, (\d+)\), REPARTITION_BY_NUM", plan)]
    assert len(dealt) == 2 and set(dealt) in ({20}, {21})
    assert "Exchange hashpartitioning(product_id" in plan
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


SIDE_EFFECT_KEYS = {"bronze_stream", "silver_stream", "silver_stream_events", "gold_refresh",
                    "append_batch", "append_batch_once", "scan_source", "bronze_copy", "create_typed_table",
                    "materialize_table"}


def test_no_registered_plan_has_expand_or_cartesian(spark, smoke_dir):
    bad = {}
    for name, fn in catalog.queries().items():
        if name in SIDE_EFFECT_KEYS:
            continue
        plan = fn(spark, smoke_dir)._jdf.queryExecution().executedPlan().toString()
        found = [op for op in ("Expand", "CartesianProduct") if op in plan]
        if found:
            bad[name] = found
    assert bad == {}
