"""Data-quality operators: column tests, row expectations, the per-table
quality report and source freshness.  Every result is a DataFrame.

Scale notes: column tests that only need a row predicate (not_null,
accepted_values, custom expressions) are evaluated together in one
aggregate pass per table; ``unique`` is one partially-aggregated
``groupBy``; ``relationships`` is a ``left_anti`` join (AQE broadcasts a small
parent or splits a skewed child key).  Nothing is collected.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.functions import as_of_timestamp


# ---------------------------------------------------------------- expectations
@dataclass(frozen=True)
class Expectation:
    """A row rule: ``action`` is ``warn`` (keep, count), ``drop`` (remove
    violating rows) or ``fail`` (stop the query on the first violation).
    A predicate that is NULL counts as a violation."""

    name: str
    predicate: str
    action: str = "warn"

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def violation_metrics(rules: list[Expectation]) -> list[Column]:
    return ([F.count(F.lit(1)).alias("rows")]
            + [F.sum(F.when(r.holds(), 0).otherwise(1)).alias(r.name) for r in rules])


def apply_expectations(df: DataFrame, rules: list[Expectation], observation=None) -> DataFrame:
    """Apply warn/drop/fail rules in one pass.

    ``observation`` (a ``pyspark.sql.Observation`` or, for streams, a metric
    name) receives the per-rule violation counts of the incoming rows.
    """
    if observation is not None and rules:
        df = df.observe(observation, *violation_metrics(rules))
    for r in rules:
        if r.action == "drop":
            df = df.filter(r.holds())
        elif r.action == "fail":
            msg = f"expectation {r.name} failed: {r.predicate}"
            df = df.filter(F.when(r.holds(), F.lit(True)).otherwise(F.raise_error(F.lit(msg))))
        elif r.action != "warn":
            raise ValueError(f"unknown expectation action {r.action!r}")
    return df


def expect_warn(df: DataFrame, name: str, predicate: str, observation=None) -> DataFrame:
    return apply_expectations(df, [Expectation(name, predicate, "warn")], observation)


def expect_or_drop(df: DataFrame, name: str, predicate: str, observation=None) -> DataFrame:
    return apply_expectations(df, [Expectation(name, predicate, "drop")], observation)


def expect_or_fail(df: DataFrame, name: str, predicate: str) -> DataFrame:
    return apply_expectations(df, [Expectation(name, predicate, "fail")])


def expectation_report(df: DataFrame, rules: list[Expectation]) -> DataFrame:
    """One aggregate pass: (expectation, action, failed_records, total_records,
    kept_records) for every rule over the *incoming* rows."""
    if not rules:
        raise ValueError("no expectations given")
    dropping = reduce(lambda a, b: a & b, [r.holds() for r in rules if r.action == "drop"],
                      F.lit(True))
    agg = df.agg(F.count(F.lit(1)).alias("total_records"),
                 F.sum(F.when(dropping, 1).otherwise(0)).alias("kept_records"),
                 *[F.sum(F.when(r.holds(), 0).otherwise(1)).alias(f"_v{i}")
                   for i, r in enumerate(rules)])
    pairs = ", ".join(f"'{r.name}', '{r.action}', _v{i}" for i, r in enumerate(rules))
    return agg.select(
        F.expr(f"stack({len(rules)}, {pairs}) AS (expectation, action, failed_records)"),
        "total_records", "kept_records",
    ).select("expectation", "action",
             F.coalesce(F.col("failed_records"), F.lit(0)).cast("bigint").alias("failed_records"),
             F.col("total_records").cast("bigint").alias("total_records"),
             F.coalesce(F.col("kept_records"), F.lit(0)).cast("bigint").alias("kept_records"))


# ---------------------------------------------------------------- column tests
def test_not_null(df: DataFrame, column: str) -> DataFrame:
    """Failing rows: ``column`` is NULL."""
    return df.filter(F.col(column).isNull())


def test_unique(df: DataFrame, column: str) -> DataFrame:
    """Failing keys: non-null values of ``column`` seen more than once,
    with their multiplicity (map-side combined count, skew-safe)."""
    return (df.select(column).filter(F.col(column).isNotNull())
            .groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1))


def test_accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Failing values outside ``values`` (NULL ignored), with row counts."""
    return (df.select(column)
            .filter(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))
            .groupBy(column).agg(F.count(F.lit(1)).alias("n_records")))


def test_relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Failing child rows: non-null ``column`` with no ``parent.field``."""
    keys = parent.select(F.col(field).alias("_parent_key")).filter(F.col("_parent_key").isNotNull())
    return (child.filter(F.col(column).isNotNull())
            .join(keys, F.col(column) == F.col("_parent_key"), "left_anti"))


def test_between(df: DataFrame, column: str, low, high) -> DataFrame:
    """Failing rows: non-null ``column`` outside ``[low, high]`` (the
    dashboard's ``expect_between`` check)."""
    c = F.col(column)
    return df.filter(c.isNotNull() & ~c.between(low, high))


def test_positive_revenue(fct_orders: DataFrame) -> DataFrame:
    """Custom test (severity warn): completed orders with nothing paid."""
    return (fct_orders.filter((F.col("status") == "completed") & (F.col("amount_paid") <= 0))
            .select("order_id", "status", "amount_paid"))


# --------------------------------------------------------------- quality report
@dataclass(frozen=True)
class ColumnTest:
    kind: str                       # not_null | unique | accepted_values | relationships | expression
    column: str
    values: tuple = ()
    parent: str | None = None       # relationships: parent model name
    field: str | None = None        # relationships: parent column
    predicate: str | None = None    # expression: rows failing when NOT predicate
    severity: str = "error"
    name: str | None = None

    @property
    def label(self) -> str:
        return self.name or self.kind


def _nn(c):
    return ColumnTest("not_null", c)


def _uq(c):
    return ColumnTest("unique", c)


# Declared tests of the governed models (50 column tests + 1 custom).
MODEL_TESTS: dict[str, list[ColumnTest]] = {
    "stg_customers": [_nn("customer_id"), _uq("customer_id"), _nn("email"), _nn("created_date")],
    "stg_orders": [_nn("order_id"), _uq("order_id"), _nn("customer_id"),
                   ColumnTest("relationships", "customer_id", parent="stg_customers",
                              field="customer_id"),
                   ColumnTest("accepted_values", "status",
                              ("placed", "shipped", "completed", "returned")),
                   _nn("amount")],
    "stg_order_items": [_nn("order_item_id"), _uq("order_item_id"), _nn("order_id"),
                        _nn("quantity")],
    "stg_products": [_nn("product_id"), _uq("product_id"), _nn("unit_price")],
    "stg_payments": [_nn("payment_id"), _uq("payment_id"), _nn("order_id"),
                     ColumnTest("accepted_values", "payment_status",
                                ("success", "failed", "pending"))],
    "dim_customers": [_nn("customer_id"), _uq("customer_id"), _nn("email"),
                      ColumnTest("accepted_values", "customer_segment",
                                 ("high_value", "mid_value", "low_value"))],
    "dim_products": [_nn("product_id"), _uq("product_id")],
    "fct_orders": [_nn("order_id"), _uq("order_id"), _nn("customer_id"),
                   ColumnTest("relationships", "customer_id", parent="dim_customers",
                              field="customer_id"),
                   _nn("order_date"),
                   ColumnTest("accepted_values", "status",
                              ("placed", "shipped", "completed", "returned")),
                   _nn("amount_paid"),
                   ColumnTest("expression", "amount_paid", severity="warn",
                              name="assert_positive_revenue",
                              predicate="NOT (status = 'completed' AND amount_paid <= 0)")],
    "mart_customer_segments": [_nn("customer_id"), _uq("customer_id"),
                               ColumnTest("accepted_values", "marketing_segment",
                                          ("champion", "loyal", "at_risk", "lapsed",
                                           "never_purchased", "other"))],
    "mart_country_performance": [_nn("country"), _uq("country")],
    "fct_revenue": [_nn("order_id"), _uq("order_id"), _nn("recognised_revenue")],
    "fct_revenue_by_product": [_nn("product_id"), _uq("product_id")],
    "rfm_customer_features": [_nn("customer_id"), _uq("customer_id")],
    "customer_churn_features": [_nn("customer_id"), _uq("customer_id")],
    "payment_method_affinity_pairs": [_nn("method_a"), _nn("method_b")],
}

REPORT_COLUMNS = ["model", "test", "column_name", "severity", "failures", "status"]


def _key(c: Column, kind: T.DataType) -> list[Column]:
    """A key in two longs: an integer as it is, anything else as 128 bits of hash."""
    if isinstance(kind, T.IntegralType):
        return [c.cast("bigint").alias("k1"), F.lit(0).cast("bigint").alias("k2")]
    return [F.xxhash64(c).alias("k1"), F.xxhash64(F.lit("second"), c).alias("k2")]


def _tag(test: int, key: list[Column] | None, when: Column, parent: bool = False) -> Column:
    """One tagged row where ``when`` holds: the test, the key it is about, and whether
    the row counts on the child's or the parent's side."""
    key = key or [F.lit(0).cast("bigint").alias("k1"), F.lit(0).cast("bigint").alias("k2")]
    return F.when(when, F.struct(F.lit(test).alias("test"), *key, F.lit(0 if parent else 1).cast("bigint").alias("child"),
                                 F.lit(1 if parent else 0).cast("bigint").alias("parent")))


def _tags(number: int, t: ColumnTest, df: DataFrame) -> Column:
    c = F.col(t.column)
    if t.kind == "not_null":
        return _tag(number, None, c.isNull())
    if t.kind == "expression":
        return _tag(number, None, ~F.coalesce(F.expr(t.predicate), F.lit(False)))
    key = _key(c, df.schema[t.column].dataType)
    if t.kind == "accepted_values":
        return _tag(number, key, c.isNotNull() & ~c.isin(list(t.values)))
    if t.kind in ("unique", "relationships"):
        return _tag(number, key, c.isNotNull())
    raise ValueError(f"unknown test kind {t.kind!r}")


def key_audit(models: dict[str, DataFrame], flat: list[tuple[str, ColumnTest]]) -> DataFrame:
    """``(test, failures)`` of numbered tests that have any row to count.

    Every model is read once: a row becomes one tagged row (test, key) per key test
    and per failed row test, a parent's row one for each relationship that points
    at it.  All of them go through one exchange with a combined count per (test,
    key): a hot key, or a test that fails on every row, is one row per map task."""
    emits: dict[str, list[Column]] = {}
    for i, (model, t) in enumerate(flat):
        emits.setdefault(model, []).append(_tags(i, t, models[model]))
        if t.kind == "relationships":
            field = F.col(t.field)
            key = _key(field, models[t.parent].schema[t.field].dataType)
            emits.setdefault(t.parent, []).append(_tag(i, key, field.isNotNull(), parent=True))
    rows = reduce(DataFrame.union, [
        models[model].select(F.explode(F.array(*tags)).alias("x")).where("x is not null").select("x.*")
        for model, tags in emits.items()])
    held = rows.groupBy("test", "k1", "k2").agg(F.sum("child").alias("child"), F.sum("parent").alias("parent"))

    def is_kind(kind: str) -> Column:
        return F.col("test").isin([i for i, (_, t) in enumerate(flat) if t.kind == kind])

    failed = (F.when(is_kind("unique"), (F.col("child") > 1).cast("bigint"))
              .when(is_kind("accepted_values"), F.lit(1).cast("bigint"))
              .when(is_kind("relationships"), F.when(F.col("parent") == 0, F.col("child")).otherwise(0))
              .otherwise(F.col("child")))
    return held.groupBy("test").agg(F.sum(failed).alias("failures"))


def quality_report(models: dict[str, DataFrame],
                   tests: dict[str, list[ColumnTest]] | None = None) -> DataFrame:
    """Run the declared tests; a model or parent that is missing is an error
    (pass a shorter ``tests`` for fewer models).

    Returns (model, test, column_name, severity, failures, status) where
    status is ``pass``, ``warn`` or ``fail`` by the test's severity.  Failures are
    null rows (``not_null``), rows against a predicate (``expression``), distinct
    values outside a list (``accepted_values``), keys seen more than once
    (``unique``) and child rows without a parent (``relationships``).
    """
    tests = MODEL_TESTS if tests is None else tests
    flat = [(model, t) for model, model_tests in tests.items() for t in model_tests]
    for model, t in flat:
        if model not in models:
            raise ValueError(f"the tests name a model that was not given: {model}")
        if t.kind == "relationships" and t.parent not in models:
            raise ValueError(f"{model}.{t.column} refers to a model that was not given: {t.parent}")
    if not flat:
        raise ValueError("no model of the test suite was given")
    spark = models[flat[0][0]].sparkSession
    declared = spark.range(1).select(F.inline(F.array(*[F.struct(
        F.lit(i).alias("test_no"), F.lit(model).alias("model"), F.lit(t.label).alias("test"), F.lit(t.column).alias("column_name"),
        F.lit(t.severity).alias("severity")) for i, (model, t) in enumerate(flat)])))
    counted = key_audit(models, flat).select(F.col("test").alias("test_no"), F.col("failures").alias("n"))
    # one row per declared test on either side
    report = (declared.join(F.broadcast(counted), "test_no", "left")
              .withColumn("failures", F.coalesce("n", F.lit(0)).cast("bigint")))
    status = (F.when(F.col("failures") == 0, F.lit("pass"))
              .when(F.col("severity") == "warn", F.lit("warn")).otherwise(F.lit("fail")))
    return report.withColumn("status", status).select(*REPORT_COLUMNS)


# ------------------------------------------------------------------- freshness
@dataclass(frozen=True)
class Freshness:
    warn_after_hours: float
    error_after_hours: float
    loaded_at_field: str = "_loaded_at"


# Declared freshness thresholds per raw source (warn / error).
SOURCE_FRESHNESS = {
    "raw_customers": Freshness(1, 6),
    "raw_orders": Freshness(1, 6),
    "raw_order_items": Freshness(1, 6),
    "raw_products": Freshness(3 * 24, 7 * 24),
    "raw_payments": Freshness(24, 2 * 24),
}


def source_freshness(sources: dict[str, DataFrame], rules: dict[str, Freshness] | None = None,
                     as_of=None) -> DataFrame:
    """Per source: max loaded_at, its age in hours at ``as_of``, and
    pass/warn/error.  One global max per table (partial aggregation),
    then a union of one-row frames."""
    rules = SOURCE_FRESHNESS if rules is None else rules
    now = as_of_timestamp(as_of)
    parts = []
    for name, rule in rules.items():
        if name not in sources:
            continue
        parts.append(sources[name].agg(F.max(rule.loaded_at_field).cast("timestamp_ntz")
                                       .alias("max_loaded_at"))
                     .select(F.lit(name).alias("source"), "max_loaded_at",
                             F.lit(float(rule.warn_after_hours)).alias("warn_after_hours"),
                             F.lit(float(rule.error_after_hours)).alias("error_after_hours")))
    if not parts:
        raise ValueError("no declared source was given")
    df = reduce(DataFrame.unionByName, parts)
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), now) / F.lit(3600.0)
    df = df.withColumn("age_hours", age)
    status = (F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
              .when(F.col("age_hours") > F.col("error_after_hours"), F.lit("error"))
              .when(F.col("age_hours") > F.col("warn_after_hours"), F.lit("warn"))
              .otherwise(F.lit("pass")))
    return df.withColumn("status", status).select(
        "source", "max_loaded_at", "age_hours", "warn_after_hours", "error_after_hours", "status")
