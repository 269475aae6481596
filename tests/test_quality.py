"""Quality operators on hand-made bad rows."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.operators import contracts, quality, staging
from martlet.sources.schemas import fct_orders_contract, raw_schema

T0 = dt.datetime(2026, 3, 31, 12, 0, 0)


@pytest.fixture(scope="module")
def bad_orders(spark):
    rows = [
        (1, 10, dt.date(2026, 1, 1), "completed", D("10.00"), "paypal", T0),
        (None, 10, dt.date(2026, 1, 2), "placed", D("5.00"), "paypal", T0),       # null key
        (2, 99, dt.date(2026, 1, 3), "unknown", D("7.00"), "paypal", T0),         # bad status, orphan
        (2, 10, dt.date(2026, 1, 3), "shipped", None, "paypal", T0),              # dup key, null amount
        (3, 10, dt.date(2026, 1, 4), "Completed", D("0.00"), "paypal", T0),
    ]
    return spark.createDataFrame(rows, raw_schema("raw_orders"))


def test_column_tests(spark, bad_orders):
    stg = staging.stg_orders(bad_orders)
    assert quality.test_not_null(stg, "order_id").count() == 1
    dup = quality.test_unique(stg, "order_id").collect()
    assert [(r.order_id, r.n_records) for r in dup] == [(2, 2)]
    bad = quality.test_accepted_values(stg, "status", ["placed", "shipped", "completed", "returned"])
    assert [(r.status, r.n_records) for r in bad.collect()] == [("unknown", 1)]
    customers = spark.createDataFrame([(10,)], "customer_id int")
    orphans = quality.test_relationships(stg, "customer_id", customers, "customer_id")
    assert [r.customer_id for r in orphans.collect()] == [99]


def test_positive_revenue(spark):
    fct = spark.createDataFrame(
        [(1, "completed", D("0.00")), (2, "completed", D("5.00")), (3, "placed", D("0.00"))],
        "order_id int, status string, amount_paid decimal(18,2)")
    assert [r.order_id for r in quality.test_positive_revenue(fct).collect()] == [1]


def test_expectations_drop_warn_fail(spark, bad_orders):
    obs = Observation("silver_orders")
    silver = staging.silver_orders(bad_orders, observation=obs)
    assert silver.count() == 4                             # null key dropped
    metrics = obs.get
    # "Completed" is lower-cased before the status rule runs
    assert metrics["rows"] == 5 and metrics["valid_order_id"] == 1 and metrics["valid_status"] == 1
    rep = {r.expectation: r for r in quality.expectation_report(
        staging.silver_orders_rows(bad_orders), staging.SILVER_RULES["orders"]).collect()}
    assert rep["valid_order_id"].failed_records == 1 and rep["valid_order_id"].kept_records == 4
    # quantity 0 and -1 violate the warn rule but stay
    items = spark.createDataFrame(
        [(1, 1, 1, 0, D("1.00"), T0), (2, 1, 1, -1, D("1.00"), T0), (3, 1, 1, 2, D("1.00"), T0)],
        raw_schema("raw_order_items"))
    rep = quality.expectation_report(staging.silver_order_items_rows(items),
                                     staging.SILVER_RULES["order_items"]).collect()
    assert {r.expectation: r.failed_records for r in rep} == {"positive_quantity": 2, "valid_item": 0}
    ok = quality.expect_or_fail(staging.stg_orders(bad_orders), "has_customer", "customer_id IS NOT NULL")
    assert ok.count() == 5
    with pytest.raises(Exception):
        quality.expect_or_fail(staging.stg_orders(bad_orders), "valid_order_id",
                               "order_id IS NOT NULL").collect()


def test_null_email_warn(spark):
    rows = [(1, "a", "b", None, dt.date(2024, 1, 1), "us", T0),
            (None, "a", "b", "x@y", dt.date(2024, 1, 1), "us", T0)]
    df = spark.createDataFrame(rows, raw_schema("raw_customers"))
    out = staging.silver_customers(df).collect()
    assert len(out) == 1 and out[0].email is None


def test_quality_report(spark, bad_orders):
    stg = staging.stg_orders(bad_orders)
    customers = spark.createDataFrame([(10, "a@b", dt.date(2024, 1, 1))],
                                      "customer_id int, email string, created_date date")
    rep = {(r.test, r.column_name): r for r in quality.quality_report(
        {"stg_orders": stg, "stg_customers": customers},
        {"stg_orders": quality.MODEL_TESTS["stg_orders"]}).collect()}
    assert rep[("not_null", "order_id")].failures == 1
    assert rep[("unique", "order_id")].failures == 1
    assert rep[("accepted_values", "status")].failures == 1
    assert rep[("relationships", "customer_id")].failures == 1
    assert rep[("not_null", "amount")].failures == 1
    assert rep[("not_null", "customer_id")].status == "pass"
    assert rep[("not_null", "amount")].status == "fail"
    with pytest.raises(ValueError, match="stg_order_items"):
        quality.quality_report({"stg_orders": stg, "stg_customers": customers})
    with pytest.raises(ValueError, match="stg_customers"):
        quality.quality_report({"stg_orders": stg}, {"stg_orders": quality.MODEL_TESTS["stg_orders"]})


def test_contract_rejects_a_second_row_of_a_key(spark):
    schema = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("v", T.StringType())])
    once = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    assert contracts.contract_cast(once, schema, primary_key=["id"]).count() == 2
    with pytest.raises(Exception, match="is not unique"):
        contracts.contract_cast(once.union(once), schema, primary_key=["id"]).collect()


def test_source_freshness(spark):
    as_of = dt.datetime(2026, 3, 31, 12, 0, 0)

    def stamped(minutes):
        return spark.createDataFrame([(as_of - dt.timedelta(minutes=minutes),)],
                                     T.StructType([T.StructField("_loaded_at", T.TimestampNTZType())]))

    srcs = {"raw_customers": stamped(30), "raw_orders": stamped(180), "raw_order_items": stamped(420),
            "raw_payments": stamped(60 * 30)}
    rep = {r.source: r for r in quality.source_freshness(srcs, as_of=as_of).collect()}
    assert rep["raw_customers"].status == "pass"
    assert rep["raw_orders"].status == "warn"
    assert rep["raw_order_items"].status == "error"
    assert rep["raw_payments"].status == "warn" and rep["raw_payments"].age_hours == 30.0


def test_contracts(spark):
    contract = fct_orders_contract()
    good = spark.createDataFrame(
        [(1, 2, dt.date(2026, 1, 1), "placed", "paypal", 1, D("1.00"), D("1.00"))],
        "order_id bigint, customer_id bigint, order_date date, status string, payment_method string, "
        "number_of_items bigint, items_total decimal(22,2), amount_paid decimal(31,2)")
    out = contracts.contract_cast(good, contract)
    assert out.schema["order_id"].dataType == T.IntegerType()
    assert out.schema["amount_paid"].dataType == T.DecimalType(18, 2)
    assert out.schema["amount_paid"].metadata["comment"].startswith("successful payments")
    assert out.count() == 1
    with pytest.raises(contracts.ContractError):
        contracts.contract_cast(good.drop("status"), contract)
    with pytest.raises(contracts.ContractError):
        contracts.contract_cast(good.withColumn("extra", F.lit(1)), contract)
    null_key = good.withColumn("order_id", F.lit(None).cast("bigint"))
    with pytest.raises(Exception):
        contracts.contract_cast(null_key, contract).collect()
    retyped = contract.add("x", T.StringType())
    diff = {r.column_name: r.change for r in contracts.contract_diff(spark, retyped, out.schema).collect()}
    assert diff == {"x": "removed"}
    new = T.StructType([f if f.name != "status" else T.StructField("status", T.IntegerType())
                        for f in contract.fields if f.name != "payment_method"])
    diff = {r.column_name: (r.change, r.breaking) for r in
            contracts.contract_diff(spark, contract, new).collect()}
    assert diff == {"status": ("type_changed", True), "payment_method": ("removed", True)}
    docs = {r.column_name: r.comment for r in contracts.column_comments(spark, contract).collect()}
    assert docs["order_id"].startswith("order key")


def test_between(spark):
    df = spark.createDataFrame([(1, 0), (2, 3), (3, 6), (4, None)], "id int, rating int")
    assert sorted(r.id for r in quality.test_between(df, "rating", 1, 5).collect()) == [1, 3]


def test_column_docs_persist_through_a_written_table(spark, tmp_path):
    from martlet.sources.ingest import materialize_table

    contract = fct_orders_contract(T.LongType())
    df = spark.createDataFrame(
        [(1, 2, dt.date(2026, 1, 1), "placed", "paypal", 1, D("1.00"), D("1.00"))],
        "order_id bigint, customer_id bigint, order_date date, status string, payment_method string, "
        "number_of_items bigint, items_total decimal(22,2), amount_paid decimal(31,2)")
    back = materialize_table(spark, contracts.contract_cast(df, contract), "fct", str(tmp_path / "fct"))
    docs = {r.column_name: r.comment for r in contracts.column_comments(spark, back.schema).collect()}
    assert docs["amount_paid"].startswith("successful payments")


def test_contract_overflow_raises(spark):
    """Trap T11: a decimal(22,2) sum that does not fit decimal(18,2) fails."""
    contract = fct_orders_contract(T.LongType())
    big = spark.createDataFrame(
        [(1, 2, dt.date(2026, 1, 1), "placed", "paypal", 1, D("1.00"), D("12345678901234567890.00"))],
        "order_id bigint, customer_id bigint, order_date date, status string, payment_method string, "
        "number_of_items bigint, items_total decimal(22,2), amount_paid decimal(22,2)")
    if spark.conf.get("spark.sql.ansi.enabled") != "true":
        pytest.skip("ANSI mode off")
    with pytest.raises(Exception):
        contracts.contract_cast(big, contract).collect()


def test_quality_report_reads_every_model_once(spark):
    """All key tests of three models in one exchange per grouping, with the counts that
    the single tests give."""
    from martlet.operators.quality import ColumnTest as T

    child = spark.createDataFrame([(1, "a", 5), (1, "b", 6), (None, "a", 9), (3, None, 9), (4, "z", None)], "id int, s string, fk int")
    parent = spark.createDataFrame([(5,), (5,), (None,)], "pk long")
    other = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "k string")
    tests = {"child": [T("not_null", "id"), T("unique", "id"), T("accepted_values", "s", ("a",)),
                       T("relationships", "fk", parent="parent", field="pk"),
                       T("expression", "fk", predicate="fk < 9", severity="warn", name="small_fk")],
             "parent": [T("unique", "pk")], "other": [T("unique", "k"), T("not_null", "k")]}
    report = quality.quality_report({"child": child, "parent": parent, "other": other}, tests)
    got = {(r.model, r.test): (r.failures, r.status) for r in report.collect()}
    assert got == {("child", "not_null"): (1, "fail"), ("child", "unique"): (1, "fail"), ("child", "accepted_values"): (2, "fail"),
                   ("child", "relationships"): (3, "fail"), ("child", "small_fk"): (3, "warn"), ("parent", "unique"): (1, "fail"),
                   ("other", "unique"): (1, "fail"), ("other", "not_null"): (1, "fail")}
    plan = report._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning(test") == 2 and "SortMergeJoin" not in plan
    empty = quality.quality_report({m: d.limit(0) for m, d in (("child", child), ("parent", parent), ("other", other))}, tests)
    assert {r.status for r in empty.collect()} == {"pass"} and empty.count() == 8
