"""Seed-shaped fixtures with hand-computed expected marts (as_of 2026-03-31)."""

from decimal import Decimal as D

import pytest

from martlet.operators import consumers, features, marts
from martlet.plans import metrics as M
from martlet.plans import questions as Q
from martlet.plans.platform import Platform
from tests.fixtures import seed_raw

AS_OF = "2026-03-31"


@pytest.fixture(scope="module")
def p(spark):
    return Platform(seed_raw(spark), as_of=AS_OF)


def by_key(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_fct_orders(p):
    f = by_key(p.fct_orders, "order_id")
    assert len(f) == 6
    assert f[100]["number_of_items"] == 2 and f[100]["items_total"] == D("225.50")
    assert f[100]["amount_paid"] == D("250.00")          # failed retry not counted
    assert f[100]["payment_method"] == "credit_card"      # lower-cased
    assert f[101]["amount_paid"] == D("300.00")          # 'SUCCESS' is lower-cased first
    assert f[102]["status"] == "returned"
    assert f[103]["amount_paid"] == D("0.00")            # pending only
    assert f[104]["number_of_items"] == 0 and f[104]["amount_paid"] == D("0.00")
    assert f[105]["items_total"] == D("0.00") and f[105]["amount_paid"] == D("120.00")


def test_dim_customers(p):
    d = by_key(p.dim_customers, "customer_id")
    assert d[1]["number_of_orders"] == 3 and d[1]["total_lifetime_value"] == D("670.00")
    assert d[1]["customer_segment"] == "high_value"
    assert d[1]["email"] == "ann@x.com" and d[1]["country"] == "US"
    assert d[2]["total_lifetime_value"] == D("80.00") and d[2]["customer_segment"] == "low_value"
    assert d[3]["total_lifetime_value"] == D("0.00") and d[3]["customer_segment"] == "low_value"
    assert d[4]["number_of_orders"] == 0 and d[4]["first_order_date"] is None


def test_segments_thresholds_are_arguments(spark):
    p2 = Platform(seed_raw(spark), as_of=AS_OF, high=50, mid=10)
    d = by_key(p2.dim_customers, "customer_id")
    assert d[2]["customer_segment"] == "high_value"


def test_mart_customer_segments(p):
    s = by_key(consumers.mart_customer_segments(p.dim_customers, p.fct_orders, AS_OF), "customer_id")
    assert s[1]["marketing_segment"] == "champion" and s[1]["days_since_last_order"] == 6
    assert s[2]["marketing_segment"] == "at_risk"
    assert s[3]["marketing_segment"] == "lapsed"
    assert s[4]["marketing_segment"] == "never_purchased"
    assert s[1]["completed_orders"] == 3


def test_country_performance_order_weighted_ltv(p):
    c = by_key(consumers.mart_country_performance(p.dim_customers, p.fct_orders), "country")
    us = c["US"]
    assert us["total_customers"] == 2 and us["high_value_customers"] == 1
    assert us["total_orders"] == 3 and us["recognised_revenue"] == D("670.00")
    assert us["avg_ltv"] == D("502.5000")                 # (670*3 + 0*1) / 4 (trap T4)
    assert us["revenue_per_customer"] == D("335.0000")
    assert c["KR"]["recognised_revenue"] == D("0.00")


def test_revenue_by_product_spine_and_lines(p):
    allp = by_key(consumers.fct_revenue_by_product(p.fct_orders, p.dim_products), "product_id")
    assert {r["total_orders"] for r in allp.values()} == {6}
    assert {r["recognised_revenue"] for r in allp.values()} == {D("670.00")}
    lines = by_key(consumers.revenue_by_product_lines(p.stg_order_items, p.fct_orders,
                                                      p.dim_products), "product_id")
    assert lines[10]["recognised_revenue"] == D("500.00") and lines[10]["total_orders"] == 2
    assert lines[11]["recognised_revenue"] == D("25.50")
    assert lines[12]["return_count"] == 1 and lines[12]["recognised_revenue"] == D("0.00")


def test_revenue_by_product_no_orders_is_zero(spark, p):
    empty = p.fct_orders.limit(0)
    rows = consumers.fct_revenue_by_product(empty, p.dim_products).collect()
    assert len(rows) == 3
    assert all(r["recognised_revenue"] == 0 and r["total_orders"] == 0 for r in rows)


def test_affinity_pairs(p):
    rows = features.payment_method_affinity_pairs(p.fct_orders).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.method_a, r.method_b, r.shared_customers) == ("credit_card", "paypal", 1)
    assert r.avg_spend_method_a == D("185.00") and r.avg_spend_method_b == D("300.00")


def test_order_gaps_and_churn(p):
    g = by_key(features.order_gaps(p.fct_orders), "customer_id")
    assert g[1]["avg_days_between_orders"] == D("37.0000") and g[1]["max_gap_days"] == 69
    assert abs(g[1]["stddev_days_between_orders"] - 45.2548) < 1e-4
    assert g[2]["stddev_days_between_orders"] is None
    ch = by_key(features.customer_churn_features(p.dim_customers, p.fct_orders, AS_OF), "customer_id")
    assert ch[3]["is_churned"] is True and ch[1]["is_churned"] is False
    assert ch[4]["total_orders"] == 0 and ch[4]["is_churned"] is False     # trap T7
    assert ch[2]["return_rate"] == D("0.5000")


def test_rfm_exact_quintiles(p):
    base = features.rfm_base(p.dim_customers, p.fct_orders, AS_OF)
    cuts = features.rfm_quintiles(base, "exact").collect()[0]
    assert [cuts[f"recency_days_q{i}"] for i in range(1, 5)] == [0, 6, 44, 303]
    scores = by_key(features.rfm_customer_features(base, features.rfm_quintiles(base)), "customer_id")
    assert {k: v["rfm_score"] for k, v in scores.items()} == {1: 12, 2: 5, 3: 4, 4: 7}
    assert scores[4]["r_score"] == 5                                    # trap T7


def test_metric_layer(p):
    models = {"fct_orders": p.fct_orders, "dim_customers": p.dim_customers}
    one = M.metric_query(models, ["total_revenue", "total_recognised_revenue", "total_orders",
                                  "return_rate", "revenue_per_customer"]).collect()[0]
    assert one.total_revenue == D("750.00") and one.total_recognised_revenue == D("670.00")
    assert one.total_orders == 6
    assert one.return_rate == D("0.166667")
    assert one.revenue_per_customer == D("167.5000")                     # 670 / 4 customers
    seg = by_key(M.metric_query(models, ["total_recognised_revenue"], dims=["customer_segment"]),
                 "customer_segment")
    assert seg["high_value"]["total_recognised_revenue"] == D("670.00")
    kpi = Q.kpi_summary(p.fct_orders).collect()[0]
    assert kpi.return_rate == D("16.6667") and kpi.completed_orders == 3


def test_time_spine(spark):
    spine = marts.time_spine_daily("2026-03-31", spark=spark)
    days = [r.date_day for r in spine.collect()]
    assert min(days).isoformat() == "2024-01-01" and max(days).isoformat() == "2026-04-29"


def test_metric_filter_on_joined_dimension(p):
    models = {"fct_orders": p.fct_orders, "dim_customers": p.dim_customers}
    r = M.metric_query(models, ["total_recognised_revenue", "total_orders"],
                       where="customer_segment = 'high_value'").collect()[0]
    assert r.total_recognised_revenue == D("670.00") and r.total_orders == 3


def test_medallion_variants_trap_t14(spark):
    from martlet.operators import staging

    raw = seed_raw(spark)
    s = {e: staging.silver(e, getattr(raw, e)) for e in ("customers", "orders", "order_items", "payments")}
    fct = marts.gold_fct_orders(s["orders"], s["order_items"], s["payments"])
    dim = marts.gold_dim_customers(s["customers"], s["orders"], s["payments"])
    sql_form = by_key(consumers.medallion_customer_segments(dim, fct, AS_OF), "customer_id")
    py_form = by_key(consumers.medallion_customer_segments(dim, fct, AS_OF, null_recency=9999),
                     "customer_id")
    assert sql_form[4]["marketing_segment"] == "never_purchased"
    assert py_form[4]["marketing_segment"] == "lapsed"            # 9999 > 90 fires first
    assert sql_form[1]["marketing_segment"] == "champion" == py_form[1]["marketing_segment"]
    sql_c = by_key(consumers.medallion_country_performance(fct, dim, "sql"), "country")
    py_c = by_key(consumers.medallion_country_performance(fct, dim, "python"), "country")
    assert sql_c["US"]["active_customers"] == 1 and py_c["US"]["active_customers"] == 3
    assert sql_c["US"]["revenue_per_customer"] == D("670.00")
    assert py_c["US"]["revenue_per_customer"] == D("223.33")


def test_sql_over_registered_views(spark, p):
    p.register_views(prefix="seed_")
    row = spark.sql("""
        SELECT SUM(CASE WHEN status = 'completed' THEN amount_paid ELSE 0 END) AS total_revenue,
               COUNT(DISTINCT order_id) AS total_orders,
               COUNT(DISTINCT CASE WHEN status = 'completed' THEN order_id END) AS completed_orders
        FROM seed_fct_orders""").collect()[0]
    kpi = Q.kpi_summary(p.fct_orders).collect()[0]
    assert (row.total_revenue, row.total_orders, row.completed_orders) == \
        (kpi.total_revenue, kpi.total_orders, kpi.completed_orders)
    seg = {r.customer_segment: r.revenue for r in spark.sql("""
        SELECT c.customer_segment,
               SUM(CASE WHEN o.status = 'completed' THEN o.amount_paid ELSE 0 END) AS revenue
        FROM seed_dim_customers c LEFT JOIN seed_fct_orders o ON c.customer_id = o.customer_id
        GROUP BY c.customer_segment""").collect()}
    ours = {r.customer_segment: r.revenue for r in Q.revenue_by_segment(p.dim_customers, p.fct_orders).collect()}
    assert seg == ours
