"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator, each reading the driver tables through the adapter, with the
driver data's fixed as-of day and segment thresholds.  Results leave through
:func:`martlet.functions.to_edge` (money as DOUBLE, integers as BIGINT).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from martlet.functions import to_edge
from martlet.operators import consumers, contracts, features, marts, quality, staging
from martlet.operators.skew import partitions, parts_for
from martlet.plans import build
from martlet.plans import metrics as M
from martlet.plans import metrics_time as MT
from martlet.plans import questions as Q
from martlet.plans.platform import Medallion, Platform
from martlet.session import scratch_path, tune
from martlet.sources import adapter, ingest, ledger, schemas
from martlet.streaming import incremental, medallion

AS_OF = adapter.DRIVER_AS_OF
HIGH = adapter.DRIVER_HIGH
MID = adapter.DRIVER_MID

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            tune(spark)
            return to_edge(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        run.__wrapped__ = fn
        REGISTRY[name] = run
        return fn
    return deco


def P(spark, sf_dir) -> Platform:
    return Platform.from_driver(spark, sf_dir)


def _no_stamp(df: DataFrame) -> DataFrame:
    return df.drop("_loaded_at")


# ---------------------------------------------------------- sources and sinks
@register("scan_source")
def _scan_source(spark, sf_dir):
    """Declared raw source read from its files with the typed schema."""
    raw = adapter.raw_orders(spark, sf_dir)
    path = scratch_path(spark, "raw_orders")
    ingest.write_table(raw, path)
    return _no_stamp(ingest.scan_source(spark, path, schemas.raw_schema("raw_orders", LongType())))


@register("param_source")
def _param_source(spark, sf_dir):
    """Source location from session config (``martlet.source_dir``) or default."""
    location = ingest.param_source(spark, "martlet.source_dir", sf_dir)
    return _no_stamp(adapter.raw_products(spark, location))


@register("bronze_copy")
def _bronze_copy(spark, sf_dir):
    return _no_stamp(ingest.bronze_copy(spark, adapter.raw_customers(spark, sf_dir), "bronze_customers"))


for _entity in ("orders", "order_items", "products", "payments"):
    register(f"bronze_copy_{_entity}")(
        lambda spark, sf_dir, _e=_entity: _no_stamp(ingest.bronze_copy(
            spark, adapter.load_raw(spark, sf_dir).as_dict()[f"raw_{_e}"], f"bronze_{_e}")))


@register("create_typed_table")
def _create_typed_table(spark, sf_dir):
    return _no_stamp(ingest.create_typed_table(spark, adapter.raw_payments(spark, sf_dir),
                                               schemas.raw_schema("raw_payments", LongType()),
                                               name="raw_payments"))


@register("next_surrogate_keys")
def _next_surrogate_keys(spark, sf_dir):
    """Keys continuing after max(customer_id) for a re-load of every customer."""
    raw = adapter.raw_customers(spark, sf_dir)
    return ingest.next_surrogate_keys(raw, raw.select("customer_id", "email"), "customer_id",
                                      new_key="new_customer_id", order_by="customer_id")


@register("append_batch")
def _append_batch(spark, sf_dir):
    """Typed table + a stamped appended batch with continued keys, read back."""
    raw = adapter.raw_customers(spark, sf_dir)
    path = scratch_path(spark, "raw_customers_appended")
    ingest.write_table(raw, path)
    batch = ingest.next_surrogate_keys(raw, _no_stamp(raw).withColumn("_old", F.col("customer_id")),
                                       "customer_id", order_by="_old")
    ingest.append_batch(batch.select(*[c for c in raw.columns if c != "_loaded_at"]), path)
    return spark.read.parquet(path).withColumn("_loaded_at", F.col("_loaded_at").isNotNull()) \
        .withColumnRenamed("_loaded_at", "is_stamped")


@register("append_batch_once")
def _append_batch_once(spark, sf_dir):
    """As ``append_batch``, through the batch ledger: the batch is written half
    (staged, never committed), written, and retried twice; it counts once."""
    raw = adapter.raw_customers(spark, sf_dir)
    rest = [c for c in raw.columns if c != "_loaded_at"]
    book = ledger.Ledger(spark, scratch_path(spark, "raw_customers_ledger"))
    book.append("initial", {"raw_customers": raw})
    keyed = ingest.next_surrogate_keys(raw, _no_stamp(raw).withColumn("_old", F.col("customer_id")),
                                       "customer_id", order_by="_old").select(*rest)
    book.stage("batch-1", "raw_customers", keyed.withColumn("_loaded_at", F.localtimestamp()))
    for _ in range(3):
        ledger.append_batch_once(book, "raw_customers", keyed, "batch-1")
    return book.read("raw_customers").withColumn("_loaded_at", F.col("_loaded_at").isNotNull()) \
        .withColumnRenamed("_loaded_at", "is_stamped")


@register("materialize_table")
def _materialize_table(spark, sf_dir):
    return ingest.materialize_table(spark, P(spark, sf_dir).fct_orders, "fct_orders")


@register("materialize_view")
def _materialize_view(spark, sf_dir):
    return ingest.materialize_view(P(spark, sf_dir).dim_products, "dim_products_view")


@register("load_audit")
def _load_audit(spark, sf_dir):
    raw = adapter.load_raw(spark, sf_dir)
    return ingest.load_audit(raw.as_dict())


# ------------------------------------------------------------------- staging
for _name in ("stg_customers", "stg_orders", "stg_order_items", "stg_products", "stg_payments"):
    register(_name)(lambda spark, sf_dir, _n=_name: getattr(P(spark, sf_dir), _n))

for _entity in ("customers", "orders", "order_items", "products", "payments"):
    register(f"silver_{_entity}")(
        lambda spark, sf_dir, _e=_entity: getattr(Medallion.from_driver(spark, sf_dir), _e))


# ---------------------------------------------------------------------- marts
for _name in ("int_order_payments", "int_customer_orders", "int_order_items_enriched",
              "dim_customers", "dim_products", "fct_orders"):
    register(_name)(lambda spark, sf_dir, _n=_name: getattr(P(spark, sf_dir), _n))


def _data_spine(fct: DataFrame, as_of=AS_OF) -> DataFrame:
    bounds = fct.agg(F.min("order_date").alias("start"),
                     F.date_add(F.max("order_date"), 1).alias("end"))
    return marts.time_spine_daily(as_of, bounds=bounds, lookback_months=None, lookahead_days=None)


@register("time_spine_daily")
def _time_spine(spark, sf_dir):
    """Daily spine over the whole order-date range of the data."""
    return _data_spine(P(spark, sf_dir).fct_orders)


@register("gold_dim_customers")
def _gold_dim(spark, sf_dir):
    return Medallion.from_driver(spark, sf_dir).gold_dim_customers


@register("gold_fct_orders")
def _gold_fct(spark, sf_dir):
    return Medallion.from_driver(spark, sf_dir).gold_fct_orders


@register("gold_fct_revenue")
def _gold_rev(spark, sf_dir):
    return marts.gold_fct_revenue(Medallion.from_driver(spark, sf_dir).gold_fct_orders)


# ------------------------------------------------------------------ consumers
@register("mart_customer_segments")
def _mcs(spark, sf_dir):
    p = P(spark, sf_dir)
    return consumers.mart_customer_segments(p.dim_customers, p.fct_orders, AS_OF)


@register("mart_country_performance")
def _mcp(spark, sf_dir):
    p = P(spark, sf_dir)
    return consumers.mart_country_performance(p.dim_customers, p.fct_orders)


@register("medallion_customer_segments")
def _pcs(spark, sf_dir):
    s = Medallion.from_driver(spark, sf_dir)
    return consumers.medallion_customer_segments(s.gold_dim_customers, s.gold_fct_orders, AS_OF,
                                                 HIGH, MID)


@register("medallion_customer_segments_py")
def _pcs_py(spark, sf_dir):
    s = Medallion.from_driver(spark, sf_dir)
    return consumers.medallion_customer_segments(s.gold_dim_customers, s.gold_fct_orders, AS_OF,
                                                 HIGH, MID, null_recency=9999)


@register("medallion_country_performance")
def _pcp(spark, sf_dir):
    s = Medallion.from_driver(spark, sf_dir)
    return consumers.medallion_country_performance(s.gold_fct_orders, s.gold_dim_customers, "sql")


@register("medallion_country_performance_py")
def _pcp_py(spark, sf_dir):
    s = Medallion.from_driver(spark, sf_dir)
    return consumers.medallion_country_performance(s.gold_fct_orders, s.gold_dim_customers, "python")


@register("fct_revenue")
def _fct_revenue(spark, sf_dir):
    return consumers.fct_revenue(P(spark, sf_dir).fct_orders)


@register("fct_revenue_by_product")
def _frbp(spark, sf_dir):
    p = P(spark, sf_dir)
    return consumers.fct_revenue_by_product(p.fct_orders, p.dim_products)


@register("revenue_by_product_lines")
def _rbpl(spark, sf_dir):
    p = P(spark, sf_dir)
    parts = parts_for(p.stg_order_items, min(partitions(p.stg_order_items), 32))
    return consumers.revenue_by_product_lines(p.stg_order_items, p.fct_orders, p.dim_products, parts)


@register("medallion_fct_revenue")
def _pfr(spark, sf_dir):
    return consumers.medallion_fct_revenue(Medallion.from_driver(spark, sf_dir).gold_fct_orders)


@register("medallion_fct_revenue_py")
def _pfr_py(spark, sf_dir):
    return consumers.medallion_fct_revenue(Medallion.from_driver(spark, sf_dir).gold_fct_orders, "python")


@register("medallion_revenue_by_product")
def _prbp(spark, sf_dir):
    s = Medallion.from_driver(spark, sf_dir)
    return consumers.medallion_revenue_by_product(s.gold_fct_orders, s.products)


# --------------------------------------------------------- order-key layout
def _order_layout(spark, sf_dir) -> Platform:
    return build.build_order_layout(spark, P(spark, sf_dir), buckets=16)


@register("fct_orders_bucketed")
def _fob(spark, sf_dir):
    """``fct_orders`` from items and payments co-bucketed with the orders."""
    return _order_layout(spark, sf_dir).fct_orders


@register("revenue_by_product_lines_bucketed")
def _rbplb(spark, sf_dir):
    p = _order_layout(spark, sf_dir)
    return consumers.revenue_by_product_lines(p.stg_order_items, p.stg_orders, p.dim_products)


@register("top3_products_bucketed")
def _t3b(spark, sf_dir):
    p = _order_layout(spark, sf_dir)
    return Q.top3_products(p.stg_order_items, p.fct_orders, p.dim_products)


# ------------------------------------------------------------------- features
@register("customer_order_history")
def _coh(spark, sf_dir):
    p = P(spark, sf_dir)
    return features.customer_order_history(p.dim_customers, p.fct_orders, AS_OF, p.hot_customers)


def _rfm(spark, sf_dir):
    p = P(spark, sf_dir)
    return features.rfm_base(p.dim_customers, p.fct_orders, AS_OF)


@register("rfm_base")
def _rfm_base(spark, sf_dir):
    return _rfm(spark, sf_dir)


@register("rfm_quintiles")
def _rfm_q(spark, sf_dir):
    return features.rfm_quintiles(_rfm(spark, sf_dir), "exact")


@register("rfm_customer_features")
def _rfm_f(spark, sf_dir):
    p = P(spark, sf_dir)
    return features.rfm_scores(p.dim_customers, p.fct_orders, AS_OF, "exact")


@register("rfm_customer_features_approx")
def _rfm_fa(spark, sf_dir):
    """The reference's sketch cut points (relative error 0.05)."""
    p = P(spark, sf_dir)
    return features.rfm_scores(p.dim_customers, p.fct_orders, AS_OF, "approx")


@register("churn_order_features")
def _cof(spark, sf_dir):
    return features.churn_order_features(P(spark, sf_dir).fct_orders)


@register("order_gaps")
def _og(spark, sf_dir):
    p = P(spark, sf_dir)
    return features.order_gaps(p.stg_orders, p.hot_customers)


@register("customer_churn_features")
def _ccf(spark, sf_dir):
    p = P(spark, sf_dir)
    return features.customer_churn_features(p.dim_customers, p.fct_orders, AS_OF)


@register("payment_method_affinity_pairs")
def _pmap(spark, sf_dir):
    return features.payment_method_affinity_pairs(P(spark, sf_dir).fct_orders)


# -------------------------------------------------------------------- metrics
class _Models(Mapping):
    """The metric layer's model map, building a mart only when it is used."""

    names = ("fct_orders", "dim_customers", "dim_products", "stg_order_items")

    def __init__(self, platform: Platform):
        self._p = platform

    def __getitem__(self, name):
        if name not in self.names:
            raise KeyError(name)
        return getattr(self._p, name)

    def __iter__(self):
        return iter(self.names)

    def __len__(self):
        return len(self.names)


def _models(spark, sf_dir):
    return _Models(P(spark, sf_dir))


def _split_query(spark, sf_dir, metrics, dims):
    """A metric query whose customer join deals the orders of hot customers."""
    p = P(spark, sf_dir)
    return M.metric_query(_Models(p), metrics, dims=dims, hot={"customer_id": p.hot_customers})


for _metric in M.METRICS:
    register(f"metric_{_metric}")(
        lambda spark, sf_dir, _m=_metric: M.metric_query(_models(spark, sf_dir), [_m]))


@register("metric_by_dimension")
def _mbd(spark, sf_dir):
    return M.metric_query(_models(spark, sf_dir),
                          ["total_revenue", "total_orders", "avg_order_value", "total_items_sold"],
                          dims=["status", "payment_method"])


@register("metric_by_month")
def _mbm(spark, sf_dir):
    return M.metric_query(_models(spark, sf_dir), ["total_recognised_revenue", "total_orders"],
                          grain="month")


@register("metric_cross_model")
def _mcm(spark, sf_dir):
    return _split_query(spark, sf_dir, ["total_recognised_revenue", "total_orders"], ["customer_segment"])


@register("metric_filtered")
def _mf(spark, sf_dir):
    return M.metric_query(_models(spark, sf_dir), ["total_recognised_revenue", "completed_orders"],
                          dims=["payment_method"], where="order_date >= DATE '1998-01-01'")


@register("metric_ratio")
def _mr(spark, sf_dir):
    return M.metric_query(_models(spark, sf_dir), ["return_rate"], dims=["payment_method"])


@register("metric_derived")
def _md(spark, sf_dir):
    return _split_query(spark, sf_dir, ["revenue_per_customer"], ["country"])


@register("metric_return_rate_by_category_segment")
def _mrc(spark, sf_dir):
    return _split_query(spark, sf_dir, ["return_rate", "total_orders"], ["category", "customer_segment"])


@register("metric_time_spine")
def _mts(spark, sf_dir):
    models = _models(spark, sf_dir)
    return M.metric_time_spine(models, "total_recognised_revenue", _data_spine(models["fct_orders"]))


@register("metric_cumulative")
def _mcu(spark, sf_dir):
    """Running recognised revenue per segment on every day of the data."""
    p = P(spark, sf_dir)
    return MT.cumulative_metric(_Models(p), "total_recognised_revenue", ["customer_segment"], hot={"customer_id": p.hot_customers})


@register("metric_trailing")
def _mtr(spark, sf_dir):
    """Orders of the last 30 days, on every day and payment method."""
    return MT.cumulative_metric(_models(spark, sf_dir), "total_orders", ["payment_method"], trailing_days=30)


@register("metric_conversion")
def _mcv(spark, sf_dir):
    """First order -> completed repeat order within 90 days, by first month."""
    return MT.repeat_order_conversion(P(spark, sf_dir).stg_orders)


@register("metric_conversion_events")
def _mce(spark, sf_dir):
    """Sign-up -> purchase within a day, by day."""
    return MT.event_conversion(adapter.read_table(spark, sf_dir, "events"), "signup", "purchase")


@register("metric_distinct_rollup")
def _mdr(spark, sf_dir):
    """Active customers and orders per month, year and in all, from stored day bitmaps."""
    keys = {"active_customers": "customer_id", "total_orders": "order_id"}
    days = ingest.materialize_table(spark, MT.distinct_partials(P(spark, sf_dir).stg_orders, "order_date", keys), "day-bitmaps")
    return MT.distinct_rollup(days, list(keys))


@register("orders_metric_view")
def _omv(spark, sf_dir):
    return M.query_metric_view(M.ORDERS_VIEW, P(spark, sf_dir).fct_orders)


@register("customers_metric_view")
def _cmv(spark, sf_dir):
    return M.query_metric_view(M.CUSTOMERS_VIEW, P(spark, sf_dir).dim_customers)


@register("all_metrics")
def _am(spark, sf_dir):
    p = P(spark, sf_dir)
    return Q.all_metrics(p.dim_customers, p.fct_orders)


@register("kpi_summary")
def _kpi(spark, sf_dir):
    return Q.kpi_summary(P(spark, sf_dir).fct_orders)


@register("revenue_by_segment")
def _rbs(spark, sf_dir):
    p = P(spark, sf_dir)
    return Q.revenue_by_segment(p.dim_customers, p.fct_orders)


@register("revenue_by_country")
def _rbc(spark, sf_dir):
    p = P(spark, sf_dir)
    return Q.revenue_by_country(p.dim_customers, p.fct_orders)


@register("customers_by_segment")
def _cbs(spark, sf_dir):
    return Q.customers_by_segment(P(spark, sf_dir).dim_customers)


@register("top_products")
def _tp(spark, sf_dir):
    p = P(spark, sf_dir)
    return Q.top_products(p.dim_products, p.fct_orders)


BREAKDOWNS = {
    "revenue": ["total", "month", "segment", "payment_method"],
    "aov": ["total", "month", "segment", "payment_method"],
    "return_rate": ["total", "month", "segment", "payment_method"],
    "customers": ["total", "month", "segment", "country"],
    "ltv": ["total", "month", "segment", "country"],
}

def _breakdown(metric: str, by: str):
    def run(spark, sf_dir):
        p = P(spark, sf_dir)
        # customer metrics' fourth breakdown is by country (same explorer slot)
        hot = p.hot_customers if (metric, by) == ("return_rate", "segment") else None
        return Q.breakdown(metric, "payment_method" if by == "country" else by,
                           p.dim_customers, p.fct_orders, hot)
    return run


for _metric, _bys in BREAKDOWNS.items():
    for _by in _bys:
        register(f"{_metric}_breakdown_{_by}")(_breakdown(_metric, _by))


@register("side_by_side_kpis")
def _sbs(spark, sf_dir):
    p = P(spark, sf_dir)
    return Q.side_by_side_kpis(p.dim_customers, p.fct_orders)


@register("revenue_last_month")
def _rlm(spark, sf_dir):
    return Q.revenue_last_month(P(spark, sf_dir).fct_orders, AS_OF)


@register("mom_growth")
def _mom(spark, sf_dir):
    return Q.mom_growth(P(spark, sf_dir).fct_orders)


@register("top3_products")
def _t3(spark, sf_dir):
    p = P(spark, sf_dir)
    return Q.top3_products(p.stg_order_items, p.fct_orders, p.dim_products)


@register("high_value_share")
def _hvs(spark, sf_dir):
    p = P(spark, sf_dir)
    return Q.high_value_share(p.dim_customers, p.fct_orders)


@register("at_risk_customers")
def _arc(spark, sf_dir):
    return Q.at_risk_customers(P(spark, sf_dir).dim_customers, AS_OF)


@register("churned_customers")
def _chc(spark, sf_dir):
    return Q.churned_customers(P(spark, sf_dir).dim_customers, AS_OF)


@register("returning_customers")
def _rc(spark, sf_dir):
    return Q.returning_customers(P(spark, sf_dir).dim_customers)


@register("high_value_customers")
def _hvc(spark, sf_dir):
    return Q.high_value_customers(P(spark, sf_dir).dim_customers, HIGH)


@register("return_rate_by_category_segment")
def _rrcs(spark, sf_dir):
    p = P(spark, sf_dir)
    return Q.return_rate_by_category_segment(p.stg_order_items, p.dim_products, p.fct_orders,
                                             p.dim_customers, p.hot_customers)


@register("revenue_quarter_country")
def _rqc(spark, sf_dir):
    p = P(spark, sf_dir)
    return Q.revenue_quarter_country(p.dim_customers, p.fct_orders, AS_OF)


@register("product_ratings")
def _pr(spark, sf_dir):
    p = P(spark, sf_dir)
    return Q.product_ratings(p.raw.reviews, p.dim_products)


# -------------------------------------------------------------------- quality
# Rows added to the full tables so that the quality keys see
# failures.  A customer without orders, one whose completed order was never
# paid, an orphan payment, and one row against every silver rule.
EDGE_ROWS: dict[str, list[dict]] = {
    "customers": [{"customer_id": -1, "email": "NONE@Example.com", "country": "x"},
                  {"customer_id": -2, "email": "UNPAID@Example.com", "country": "x"}],
    "orders": [{"order_id": -1, "customer_id": -2, "status": "completed", "amount": "10.00"}],
    "payments": [{"payment_id": -1, "order_id": -9, "status": "success", "amount": "5.00"}],
}
BAD_ROWS: dict[str, list[dict]] = {
    "customers": [{"customer_id": None, "email": "a@Example.com"}, {"customer_id": -3, "email": None}],
    "orders": [{"order_id": None, "status": "placed"}, {"order_id": -2, "status": "lost"}],
    "order_items": [{"order_item_id": None, "quantity": 1}, {"order_item_id": -1, "quantity": 0}],
    "products": [{"product_id": None}, {"product_id": None}],
    "payments": [{"payment_id": None, "amount": "1.00"}, {"payment_id": -2, "amount": "0.00"}],
}


def _plus_rows(spark, df: DataFrame, rows: list[dict]) -> DataFrame:
    """``df`` and a few literal rows; columns not given are NULL."""
    for row in rows:
        one = spark.range(1).select(*[F.lit(row.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema])
        df = df.unionByName(one)
    return df


def _edge_platform(spark, sf_dir) -> Platform:
    raw = adapter.load_raw(spark, sf_dir)
    tables = {e: _plus_rows(spark, getattr(raw, e), EDGE_ROWS.get(e, []))
              for e in ("customers", "products", "orders", "order_items", "payments", "reviews")}
    return Platform(adapter.RawTables(**tables), as_of=AS_OF, high=HIGH, mid=MID)


@register("test_not_null")
def _tnn(spark, sf_dir):
    """Customers without any order have no most_recent_order_date."""
    return quality.test_not_null(_edge_platform(spark, sf_dir).dim_customers, "most_recent_order_date")


@register("test_unique")
def _tu(spark, sf_dir):
    return quality.test_unique(P(spark, sf_dir).stg_order_items, "order_item_id")


@register("test_accepted_values")
def _tav(spark, sf_dir):
    """Raw (not yet lower-cased) order statuses outside the domain."""
    return quality.test_accepted_values(adapter.raw_orders(spark, sf_dir), "status",
                                        schemas.ORDER_STATUSES)


@register("test_relationships")
def _tr(spark, sf_dir):
    p = _edge_platform(spark, sf_dir)
    return quality.test_relationships(p.stg_payments, "order_id", p.stg_orders, "order_id") \
        .select("payment_id", "order_id")


@register("test_between")
def _tb(spark, sf_dir):
    """Review ratings outside 1..5 and line quantities outside 1..50."""
    raw = adapter.load_raw(spark, sf_dir)
    bad_ratings = quality.test_between(raw.reviews, "rating", 1, 5).select(
        F.lit("raw_reviews").alias("table_name"), F.col("review_id").alias("row_id"),
        F.col("rating").cast("double").alias("value"))
    bad_qty = quality.test_between(raw.order_items, "quantity", 1, 50).select(
        F.lit("raw_order_items").alias("table_name"), F.col("order_item_id").alias("row_id"),
        F.col("quantity").cast("double").alias("value"))
    return bad_ratings.unionByName(bad_qty)


@register("test_positive_revenue")
def _tpr(spark, sf_dir):
    return quality.test_positive_revenue(_edge_platform(spark, sf_dir).fct_orders)


def _silver_report(spark, sf_dir, action):
    raw = adapter.load_raw(spark, sf_dir)
    bronze = {"customers": raw.customers, "orders": raw.orders, "order_items": raw.order_items,
              "products": raw.products, "payments": raw.payments}
    parts = []
    for entity, rules in staging.SILVER_RULES.items():
        chosen = [r for r in rules if r.action == action]
        if chosen:
            rows = staging.SILVER_PROJECTIONS[entity](_plus_rows(spark, bronze[entity], BAD_ROWS[entity]))
            # what the operator itself lets through, beside the counts of the rules
            kept = rows
            for r in chosen:
                operator = quality.expect_or_drop if action == "drop" else quality.expect_warn
                kept = operator(kept, r.name, r.predicate)
            report = quality.expectation_report(rows, chosen).drop("kept_records")
            parts.append(report.crossJoin(F.broadcast(kept.agg(F.count(F.lit(1)).alias("kept_records"))))
                         .select(F.lit(f"silver_{entity}").alias("table_name"), "*"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@register("expect_warn")
def _ew(spark, sf_dir):
    return _silver_report(spark, sf_dir, "warn")


@register("expect_or_drop")
def _ed(spark, sf_dir):
    return _silver_report(spark, sf_dir, "drop")


@register("expect_or_fail")
def _ef(spark, sf_dir):
    return quality.expect_or_fail(P(spark, sf_dir).stg_orders, "valid_order_id", "order_id IS NOT NULL")


@register("quality_report")
def _qr(spark, sf_dir):
    """All 51 declared tests of the 15 governed models; the two marts that the others
    are built from are written once."""
    p = P(spark, sf_dir).materialize(spark, ("fct_orders", "dim_customers"))
    dim, fct, prod = p.dim_customers, p.fct_orders, p.dim_products
    return quality.quality_report({
        **p.models(),
        "mart_customer_segments": consumers.mart_customer_segments(dim, fct, AS_OF),
        "mart_country_performance": consumers.mart_country_performance(dim, fct),
        "fct_revenue": consumers.fct_revenue(fct),
        "fct_revenue_by_product": consumers.fct_revenue_by_product(fct, prod),
        "rfm_customer_features": features.rfm_scores(dim, fct, AS_OF),
        "customer_churn_features": features.customer_churn_features(dim, fct, AS_OF),
        "payment_method_affinity_pairs": features.payment_method_affinity_pairs(fct)})


@register("contract_cast")
def _cc(spark, sf_dir):
    make, key = schemas.CONTRACTS["fct_orders"]
    return contracts.contract_cast(P(spark, sf_dir).fct_orders, make(LongType()), primary_key=key)


@register("source_freshness")
def _sf(spark, sf_dir):
    raw = adapter.load_raw(spark, sf_dir)
    return quality.source_freshness(raw.as_dict(), as_of=AS_OF)


# ------------------------------------------------------------------ streaming
def _landing(spark, df, name):
    path = scratch_path(spark, f"landing-{name}")
    ingest.write_table(df, path)
    return path


def _bronze(spark, sf_dir, table="raw_orders"):
    """Bronze stream over the source's own files."""
    paths = medallion.stream_paths(spark, f"bronze-{table}", sf_dir)
    medallion.await_streams([medallion.start_stream(adapter.stream_raw(spark, sf_dir)[table], paths, f"bronze_{table}")])
    return paths.sink


@register("bronze_stream")
def _bs(spark, sf_dir):
    return _no_stamp(medallion.read_sink(spark, _bronze(spark, sf_dir)))


def _silver_sink(spark, sf_dir, entity):
    table = f"raw_{entity}"
    bronze = _bronze(spark, sf_dir, table)
    paths = medallion.stream_paths(spark, f"silver-{entity}", bronze)
    medallion.silver_stream(spark, entity, schemas.raw_schema(table, LongType()), paths)
    return paths.sink


# The stream fixture's rules (FIXTURES §5).
EVENT_RULES = [quality.Expectation("no_error_events", "event_type <> 'error'", "drop"),
               quality.Expectation("value_cap", "value <= 200", "warn")]


@register("silver_stream_events")
def _sse(spark, sf_dir):
    """``events`` as an append-only source: the silver stream operator with a
    drop rule and a warn rule, drained with availableNow and read back."""
    events = adapter.read_table(spark, sf_dir, "events")
    source = _landing(spark, events, "events")
    paths = medallion.stream_paths(spark, "silver-events", source)
    stream = spark.readStream.schema(events.schema).format("parquet").load(source)
    kept = quality.apply_expectations(stream, EVENT_RULES, observation="events_expectations")
    medallion.await_streams([medallion.start_stream(kept, paths, "silver_events")])
    return medallion.read_sink(spark, paths.sink)


@register("silver_stream")
def _ss(spark, sf_dir):
    return medallion.read_sink(spark, _silver_sink(spark, sf_dir, "orders"))


for _entity in ("customers", "order_items", "products", "payments"):
    register(f"bronze_stream_{_entity}")(
        lambda spark, sf_dir, _e=_entity: _no_stamp(medallion.read_sink(spark, _bronze(spark, sf_dir, f"raw_{_e}"))))
    register(f"silver_stream_{_entity}")(
        lambda spark, sf_dir, _e=_entity: medallion.read_sink(spark, _silver_sink(spark, sf_dir, _e)))


def _gold(spark, sf_dir):
    """Bronze streams of four sources run together, then their silver streams
    together, then the gold batch over the drained silver folders."""
    entities = ("customers", "orders", "order_items", "payments")
    raw = adapter.stream_raw(spark, sf_dir)
    bronze_paths = {e: medallion.stream_paths(spark, f"bronze-raw_{e}", sf_dir) for e in entities}
    medallion.await_streams([medallion.start_stream(raw[f"raw_{e}"], bronze_paths[e], f"bronze_raw_{e}") for e in entities])
    silver_paths, queries = {}, []
    for e in entities:
        paths = medallion.stream_paths(spark, f"silver-{e}", bronze_paths[e].sink)
        queries.append(medallion.silver_query(spark, e, schemas.raw_schema(f"raw_{e}", LongType()),
                                              paths))
        silver_paths[e] = paths.sink
    medallion.await_streams(queries)
    return medallion.gold_refresh(spark, silver_paths, HIGH, MID)


@register("gold_refresh")
def _gr(spark, sf_dir):
    return _gold(spark, sf_dir)["gold_fct_orders"]


@register("gold_refresh_dim_customers")
def _grc(spark, sf_dir):
    return _gold(spark, sf_dir)["gold_dim_customers"]


@register("gold_refresh_fct_revenue")
def _grr(spark, sf_dir):
    return _gold(spark, sf_dir)["gold_fct_revenue"]


#: Days that cut the sources into batches: orders and items by load day, payments by
#: payment day, so that some payments arrive before and some after their order.
ORDER_CUTS, PAYMENT_CUTS = ("1996-01-01", "1998-06-01"), ("1995-01-01", "1998-06-15")


def _incremental_gold(spark, sf_dir) -> tuple[incremental.GoldStore, DataFrame]:
    """Three batches of silver rows, the second one sent twice, and a snapshot."""
    raw = adapter.load_raw(spark, sf_dir).as_dict()
    store = incremental.GoldStore(spark, scratch_path(spark, "gold-incremental"), block_rows=50_000)

    def between(e, column, cuts, n):
        rows = raw[f"raw_{e}"]
        day = F.col(column).cast("date")
        if n > 0:
            rows = rows.where(day.isNull() | (day >= F.lit(cuts[n - 1]))) if n == len(cuts) else rows.where(day >= F.lit(cuts[n - 1]))
        if n < len(cuts):
            rows = rows.where(day < F.lit(cuts[n]))
        return staging.silver(e, rows)

    for n in range(3):
        changes = incremental.order_changes(between("orders", "_loaded_at", ORDER_CUTS, n),
                                            between("order_items", "_loaded_at", ORDER_CUTS, n),
                                            between("payments", "payment_date", PAYMENT_CUTS, n))
        store.refresh(f"batch-{n}", changes)
        if n == 1:
            store.refresh(f"batch-{n}", changes)
            store.compact()
    return store, staging.silver("customers", raw["raw_customers"])


@register("gold_refresh_incremental")
def _gri(spark, sf_dir):
    return _incremental_gold(spark, sf_dir)[0].gold_fct_orders()


@register("gold_refresh_incremental_dim_customers")
def _gric(spark, sf_dir):
    store, customers = _incremental_gold(spark, sf_dir)
    return store.gold_dim_customers(customers, HIGH, MID)


@register("gold_refresh_incremental_fct_revenue")
def _grir(spark, sf_dir):
    return _incremental_gold(spark, sf_dir)[0].gold_fct_revenue()


def queries() -> dict[str, Query]:
    return dict(REGISTRY)
