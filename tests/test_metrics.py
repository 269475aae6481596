"""Formulas and filters of the metric layer on a hand-made order fact."""

from decimal import Decimal as D

import pytest

from martlet.plans import metrics as M


@pytest.fixture
def models(spark):
    fct = spark.createDataFrame(
        [(1, 10, "completed", D("10.00"), 1), (2, 10, "returned", D("4.00"), 2), (3, 11, "completed", D("6.00"), 1)],
        "order_id int, customer_id int, status string, amount_paid decimal(18,2), number_of_items bigint")
    dim = spark.createDataFrame([(10, "x", "high_value"), (11, "y", "low_value"), (12, "y", "low_value")],
                                "customer_id int, country string, customer_segment string")
    return {"fct_orders": fct, "dim_customers": dim}


def derived(monkeypatch, formula, *inputs):
    monkeypatch.setitem(M.METRICS, "m", M.Metric("m", kind="derived", inputs=inputs, formula=formula))


def test_difference_and_three_inputs(models, monkeypatch):
    row = M.metric_query(models, ["unrecognised_revenue"]).first()
    assert row.unrecognised_revenue == D("4.00")
    derived(monkeypatch, "(total_revenue - total_recognised_revenue) / total_customers",
            "total_revenue", "total_recognised_revenue", "total_customers")
    assert M.metric_query(models, ["m"]).first().m == D("1.3333")


def test_ratio_as_an_input(models, monkeypatch):
    derived(monkeypatch, "return_rate * 100", "return_rate")
    assert round(M.metric_query(models, ["m"]).first().m, 4) == D("33.3333")


def test_filter_goes_to_its_owner(models):
    row = M.metric_query(models, ["revenue_per_customer"], where="status = 'completed'").first()
    assert row.revenue_per_customer == D("5.3333")
    assert M.metric_query(models, ["total_orders"], where="status <> 'no country here'").first()[0] == 3
    with pytest.raises(ValueError, match="owns"):
        M.metric_query(models, ["total_customers"], where="status = 'completed'")


def test_distinct_counts_share_one_key(models):
    df = M.metric_query(models, ["total_orders", "completed_orders", "return_rate"])
    assert tuple(df.first())[:2] == (3, 2)
    assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()
