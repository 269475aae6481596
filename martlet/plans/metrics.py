"""Metric layer: named metrics answered by dimension, time grain and filter.

A request (metrics x dimensions x grain x where) becomes one conditional
aggregate per model: every simple metric is ``agg(CASE WHEN filter THEN expr
END)``, so several metrics with different filters cost one scan and one
(partially aggregated) shuffle.  Dimensions of another model are reached by a
join on the entity key *before* grouping (the fact stays at its grain);
derived metrics spanning two models join the two aggregates on the shared
dimensions.  Nothing is collected; the result is a DataFrame.
"""

from __future__ import annotations

import ast
import re
from dataclasses import dataclass, field
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.functions import exact_ratio
from martlet.operators.skew import HotKeys, split_join


@dataclass(frozen=True)
class Metric:
    name: str
    kind: str = "simple"                 # simple | ratio | derived
    model: str | None = None
    agg: str | None = None               # sum | count_distinct | average | count
    expr: str | None = None
    filter: str | None = None
    numerator: str | None = None         # ratio: metric name
    numerator_filter: str | None = None
    denominator: str | None = None
    inputs: tuple = ()                   # derived: metric names
    formula: str | None = None           # derived: expression over inputs
    hidden: bool = False
    label: str = ""


# The governed metric definitions.
METRICS: dict[str, Metric] = {m.name: m for m in [
    Metric("total_customers", model="dim_customers", agg="count_distinct", expr="customer_id",
           label="Total Customers"),
    Metric("avg_customer_lifetime_value", model="dim_customers", agg="average",
           expr="total_lifetime_value", label="Average Customer Lifetime Value (USD)"),
    Metric("total_lifetime_value", model="dim_customers", agg="sum", expr="total_lifetime_value",
           hidden=True),
    Metric("total_orders_per_customer", model="dim_customers", agg="sum", expr="number_of_orders",
           hidden=True),
    Metric("total_revenue", model="fct_orders", agg="sum", expr="amount_paid",
           label="Total Revenue (USD)"),
    Metric("total_recognised_revenue", model="fct_orders", agg="sum", expr="amount_paid",
           filter="status = 'completed'", label="Total Recognised Revenue (USD)"),
    Metric("avg_order_value", model="fct_orders", agg="average", expr="amount_paid",
           label="Average Order Value (USD)"),
    Metric("total_orders", model="fct_orders", agg="count_distinct", expr="order_id",
           label="Total Orders"),
    Metric("completed_orders", model="fct_orders", agg="count_distinct",
           expr="order_id", filter="status = 'completed'", label="Completed Orders"),
    Metric("total_items_sold", model="fct_orders", agg="sum", expr="number_of_items",
           label="Total Items Sold"),
    Metric("return_flag", model="fct_orders", agg="sum",
           expr="CASE WHEN status = 'returned' THEN 1 ELSE 0 END", hidden=True),
    Metric("return_rate", kind="ratio", numerator="total_orders",
           numerator_filter="status = 'returned'", denominator="total_orders",
           label="Order Return Rate"),
    Metric("revenue_per_customer", kind="derived",
           inputs=("total_recognised_revenue", "total_customers"),
           formula="total_recognised_revenue / total_customers",
           label="Revenue per Customer (USD)"),
    Metric("unrecognised_revenue", kind="derived", inputs=("total_revenue", "total_recognised_revenue"),
           formula="total_revenue - total_recognised_revenue", label="Unrecognised Revenue (USD)"),
]}

# Time dimension each model aggregates on, and entity keys for joins.
AGG_TIME = {"fct_orders": "order_date", "dim_customers": "created_date"}
ENTITY_JOINS = {("fct_orders", "dim_customers"): "customer_id"}
MODEL_DIMENSIONS = {
    "fct_orders": {"order_date", "status", "payment_method", "customer_id"},
    "dim_customers": {"country", "customer_segment", "created_date", "customer_id"},
    "dim_products": {"category", "is_active"},
}

AVG_SCALE = 4


def _agg_column(m: Metric, extra_filter: str | None = None) -> Column:
    cond = " AND ".join(f"({f})" for f in (m.filter, extra_filter) if f)
    value = F.expr(m.expr)
    if cond:
        value = F.when(F.expr(cond), value)
    if m.agg == "sum":
        return F.sum(value)
    if m.agg == "count_distinct":
        return F.count_distinct(value)
    if m.agg == "count":
        return F.count(value)
    if m.agg == "average":
        # exact decimal average, rounded HALF_UP (engine-independent)
        return exact_ratio(F.sum(value), F.count(value), AVG_SCALE)
    raise ValueError(f"unknown aggregation {m.agg!r}")


def _cond(m: Metric, extra: str | None) -> str:
    return " AND ".join(f"({f})" for f in (m.filter, extra) if f)


def _aggregate(df: DataFrame, group_cols: list[str], parts) -> DataFrame:
    """Conditional aggregates of one model.  When two or more are
    ``count_distinct`` of the same expression under different filters (a
    ratio such as return rate), the rows are first reduced to one per
    (group, distinct value) with the filters as 0/1 flags — exact, and one
    shuffle instead of an Expand that copies every row per distinct
    aggregate.  Sums, counts and averages are re-aggregated from partials."""
    distinct = [(a, m, e) for a, m, e in parts if m.agg == "count_distinct"]
    exprs = {m.expr for _, m, _ in distinct}
    if len(distinct) < 2 or len(exprs) != 1:
        aggs = [_agg_column(simple, extra).alias(alias) for alias, simple, extra in parts]
        return df.groupBy(*group_cols).agg(*aggs) if group_cols else df.agg(*aggs)
    key = F.expr(next(iter(exprs))).alias("_dk")
    level1, level2 = [], []
    for i, (alias, m, extra) in enumerate(parts):
        cond = _cond(m, extra)
        if m.agg == "count_distinct":
            if cond:
                level1.append(F.max(F.coalesce(F.expr(cond), F.lit(False)).cast("int")).alias(f"_f{i}"))
                level2.append(F.coalesce(F.sum(F.when(F.col("_dk").isNotNull(), F.col(f"_f{i}"))),
                                         F.lit(0)).cast("bigint").alias(alias))
            else:
                level2.append(F.count("_dk").alias(alias))
            continue
        value = F.expr(m.expr)
        if cond:
            value = F.when(F.expr(cond), value)
        if m.agg == "sum":
            level1.append(F.sum(value).alias(f"_s{i}"))
            level2.append(F.sum(f"_s{i}").alias(alias))
        elif m.agg == "count":
            level1.append(F.count(value).alias(f"_c{i}"))
            level2.append(F.sum(f"_c{i}").alias(alias))
        elif m.agg == "average":
            level1 += [F.sum(value).alias(f"_s{i}"), F.count(value).alias(f"_c{i}")]
            level2.append(exact_ratio(F.sum(f"_s{i}"), F.sum(f"_c{i}"), AVG_SCALE).alias(alias))
        else:
            raise ValueError(m.agg)
    if not level1:
        level1 = [F.count(F.lit(1)).alias("_rows")]
    grain = df.groupBy(*group_cols, key).agg(*level1)
    return grain.groupBy(*group_cols).agg(*level2) if group_cols else grain.agg(*level2)


def _formula(text: str) -> Column:
    """A derived metric's formula over the finished input metrics: names,
    numbers, + - * / and parentheses; a quotient is exact, rounded to 4 places,
    and NULL for a zero denominator."""
    def build(node: ast.AST) -> Column:
        if isinstance(node, ast.Name):
            return F.col(node.id)
        if isinstance(node, ast.Constant) and isinstance(node.value, (int, float)):
            return F.lit(Decimal(str(node.value)))
        if isinstance(node, ast.UnaryOp) and isinstance(node.op, ast.USub):
            return -build(node.operand)
        if isinstance(node, ast.BinOp):
            left, right = build(node.left), build(node.right)
            if isinstance(node.op, ast.Add):
                return left + right
            if isinstance(node.op, ast.Sub):
                return left - right
            if isinstance(node.op, ast.Mult):
                return left * right
            if isinstance(node.op, ast.Div):
                counts = isinstance(node.right, ast.Name) and METRICS[node.right.id].agg in ("count", "count_distinct")
                if counts:
                    return exact_ratio(left, right, 4)
                return F.round(left.cast("decimal(28,6)") / F.nullif(right.cast("decimal(28,6)"), F.lit(0)), 4)
        raise ValueError(f"not a metric formula: {text!r}")

    return build(ast.parse(text, mode="eval").body)


def _named(where: str) -> set[str]:
    """Words of a predicate outside quoted strings."""
    return set(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", re.sub(r"'(?:[^']|'')*'", " ", where)))


def _product_bridge(models: dict[str, DataFrame], dims: list[str]) -> DataFrame:
    """Order -> product dimensions, each combination of an order once: an order
    with several lines of a category counts once in it."""
    return (models["stg_order_items"].select("order_id", "product_id")
            .join(models["dim_products"].select("product_id", *dims), "product_id")
            .select("order_id", *dims).distinct())


def _model_frame(models: dict[str, DataFrame], model: str, dims: list[str],
                 where: str | None = None, hot: dict[str, HotKeys] | None = None) -> DataFrame:
    """The model, joined to another model's dimensions through its entity key
    when a requested dimension (or a column named in ``where``) lives there."""
    df = models[model]
    by_product = [d for d in dims if d in MODEL_DIMENSIONS["dim_products"]]
    if model == "fct_orders" and by_product and "stg_order_items" in models:
        df = df.join(_product_bridge(models, by_product), "order_id")
    own = MODEL_DIMENSIONS.get(model, set()) | set(df.columns)
    foreign = [d for d in dims if d not in own and d not in ("metric_time",)]
    for (fact, dim_model), key in ENTITY_JOINS.items():
        if fact != model or dim_model not in models:
            continue
        if where:
            named = _named(where)
            foreign += [c for c in models[dim_model].columns
                        if c in named and c not in own and c not in foreign]
        if foreign and all(d in models[dim_model].columns for d in foreign):
            return split_join(df, models[dim_model].select(key, *foreign), key, "left", (hot or {}).get(key))
    if foreign:
        raise ValueError(f"dimensions {foreign} not reachable from {model}")
    return df


def _simple_parts(metric: Metric) -> list[tuple[str, Metric, str | None]]:
    """(output alias, simple metric, extra filter) needed to compute ``metric``."""
    if metric.kind == "simple":
        return [(metric.name, metric, None)]
    if metric.kind == "ratio":
        return [(f"_{metric.name}_num", METRICS[metric.numerator], metric.numerator_filter),
                (f"_{metric.name}_den", METRICS[metric.denominator], None)]
    if metric.kind == "derived":
        return [p for name in metric.inputs for p in _simple_parts(METRICS[name])]
    raise ValueError(metric.kind)


def metric_query(models: dict[str, DataFrame], metrics: list[str], dims: list[str] | None = None,
                 grain: str | None = None, where: str | None = None, hot: dict[str, HotKeys] | None = None) -> DataFrame:
    """Answer ``metrics`` grouped by ``dims`` (+ ``metric_time`` at ``grain``).

    ``where`` is a SQL predicate over the model's (and joined) columns.
    It filters the models that reach all of its columns, and is an error when
    none does.  Ratio metrics are num/den of two conditional aggregates; derived
    metrics evaluate their formula over the finished input metrics after
    joining the per-model aggregates on the requested dimensions.  ``hot`` names, per
    entity key, the keys whose fact rows are dealt over several tasks of a join.
    """
    dims = list(dims or [])
    wanted = [METRICS[m] for m in metrics]
    by_model: dict[str, list[tuple[str, Metric, str | None]]] = {}
    for m in wanted:
        for alias, simple, extra in _simple_parts(m):
            parts = by_model.setdefault(simple.model, [])
            if alias not in [a for a, _, _ in parts]:
                parts.append((alias, simple, extra))
    group_cols = dims + (["metric_time"] if grain else [])
    frames, filtered = [], False
    columns = {c for m in models for c in models[m].columns} if where else set()
    for model, parts in by_model.items():
        df = _model_frame(models, model, dims, where, hot)
        # the predicate goes to the models that reach all of its columns
        if where and (_named(where) & columns) <= set(df.columns):
            df, filtered = df.filter(F.expr(where)), True
        if grain:
            df = df.withColumn("metric_time", F.date_trunc(grain, F.col(AGG_TIME[model])).cast("date"))
        frames.append(_aggregate(df, group_cols, parts))
    if where and not filtered:
        raise ValueError(f"no requested model owns the columns of {where!r}")
    if len(frames) == 1:
        out = frames[0]
    elif group_cols:
        out = reduce(lambda a, b: a.join(b, group_cols, "full_outer"), frames)
    else:
        # one-row aggregates: the product of single rows is a single row
        out = reduce(lambda a, b: a.crossJoin(b), frames)
    finished = {name for m in wanted if m.kind == "derived" for name in m.inputs if METRICS[name].kind == "ratio"}
    for name in sorted(finished):
        out = out.withColumn(name, exact_ratio(f"_{name}_num", f"_{name}_den", 6, "decimal(20,0)"))
    selects = list(group_cols)
    for m in wanted:
        if m.kind == "simple":
            selects.append(F.col(m.name))
        elif m.kind == "ratio":
            selects.append(exact_ratio(f"_{m.name}_num", f"_{m.name}_den", 6, "decimal(20,0)")
                           .alias(m.name))
        else:
            selects.append(_formula(m.formula).alias(m.name))
    return out.select(*selects)


def metric_time_spine(models: dict[str, DataFrame], metric: str, spine: DataFrame) -> DataFrame:
    """Daily metric with every spine day present (missing days -> 0)."""
    daily = metric_query(models, [metric], grain="day").withColumnRenamed("metric_time", "date_day")
    return (spine.join(daily, "date_day", "left")
            .select("date_day", F.coalesce(F.col(metric), F.lit(0)).alias(metric)))


# ----------------------------------------------------------------- metric views
@dataclass(frozen=True)
class MetricView:
    """A metric view: dimensions and measures as SQL expressions (what the
    view publishes).  ``grain_measures`` restates the same measures in a
    decomposable form over ``distinct_key`` so that a query needing several
    distinct counts runs from the distinct-key grain (no Expand):
    ``("sum", expr)``, ``("avg", expr)``, ``("count_distinct", filter|None)``
    and ``("pct_of_distinct", filter)`` = distinct[filter] / distinct * 100."""

    source: str
    dimensions: dict[str, str]
    measures: dict[str, str]
    metadata: dict = field(default_factory=dict)
    distinct_key: str | None = None
    grain_measures: dict[str, tuple] = field(default_factory=dict)


# The two metric views (dimension and measure expressions).
ORDERS_VIEW = MetricView(
    source="fct_orders",
    dimensions={"order_date": "order_date", "status": "status", "payment_method": "payment_method"},
    measures={
        "total_revenue": "SUM(CASE WHEN status = 'completed' THEN amount_paid ELSE 0 END)",
        "avg_order_value": "ROUND(SUM(CASE WHEN status = 'completed' THEN amount_paid END)"
                           " / CAST(NULLIF(COUNT(CASE WHEN status = 'completed' THEN amount_paid END), 0)"
                           " AS DECIMAL(20,0)), 4)",
        "total_orders": "COUNT(DISTINCT order_id)",
        "return_rate": "COUNT(DISTINCT CASE WHEN status = 'returned' THEN order_id END)"
                       " / CAST(COUNT(DISTINCT order_id) AS DOUBLE) * 100",
    },
    distinct_key="order_id",
    grain_measures={
        "total_revenue": ("sum", "CASE WHEN status = 'completed' THEN amount_paid ELSE 0 END"),
        "avg_order_value": ("avg", "CASE WHEN status = 'completed' THEN amount_paid END"),
        "total_orders": ("count_distinct", None),
        "return_rate": ("pct_of_distinct", "status = 'returned'"),
    },
    metadata={"display_names": {"order_date": "Order Date", "status": "Order Status",
                                "payment_method": "Payment Method", "total_revenue": "Total Revenue",
                                "avg_order_value": "Average Order Value",
                                "total_orders": "Total Orders", "return_rate": "Return Rate (%)"}},
)
CUSTOMERS_VIEW = MetricView(
    source="dim_customers",
    dimensions={"country": "country", "customer_segment": "customer_segment",
                "created_date": "created_date"},
    measures={
        "customer_count": "COUNT(DISTINCT customer_id)",
        "avg_lifetime_value": "ROUND(SUM(total_lifetime_value)"
                              " / CAST(NULLIF(COUNT(total_lifetime_value), 0) AS DECIMAL(20,0)), 4)",
        "high_value_customers":
            "COUNT(DISTINCT CASE WHEN customer_segment = 'high_value' THEN customer_id END)",
    },
    distinct_key="customer_id",
    grain_measures={
        "customer_count": ("count_distinct", None),
        "avg_lifetime_value": ("avg", "total_lifetime_value"),
        "high_value_customers": ("count_distinct", "customer_segment = 'high_value'"),
    },
    metadata={"display_names": {"country": "Country", "customer_segment": "Customer Segment",
                                "created_date": "Customer Since", "customer_count": "Total Customers",
                                "avg_lifetime_value": "Average Lifetime Value",
                                "high_value_customers": "High Value Customers"}},
)


def query_metric_view(view: MetricView, source: DataFrame, dimensions: list[str] | None = None,
                      measures: list[str] | None = None) -> DataFrame:
    """``SELECT dims, MEASURE(m) ... GROUP BY dims`` for a metric view."""
    dims = list(view.dimensions) if dimensions is None else list(dimensions)
    meas = list(view.measures) if measures is None else list(measures)
    keyed = source.select(*[F.expr(view.dimensions[d]).alias(d) for d in dims],
                          *[F.col(c) for c in source.columns if c not in dims])
    if view.distinct_key and all(m in view.grain_measures for m in meas):
        return _view_from_grain(view, keyed, dims, meas)
    aggs = [F.expr(view.measures[m]).alias(m) for m in meas]
    return keyed.groupBy(*dims).agg(*aggs) if dims else keyed.agg(*aggs)


def _view_from_grain(view: MetricView, keyed: DataFrame, dims: list[str],
                     meas: list[str]) -> DataFrame:
    key = view.distinct_key
    level1, level2 = [], []
    for i, name in enumerate(meas):
        kind, arg = view.grain_measures[name]
        if kind == "sum":
            level1.append(F.sum(F.expr(arg)).alias(f"_s{i}"))
            level2.append(F.sum(f"_s{i}").alias(name))
        elif kind == "avg":
            level1 += [F.sum(F.expr(arg)).alias(f"_s{i}"), F.count(F.expr(arg)).alias(f"_c{i}")]
            level2.append(exact_ratio(F.sum(f"_s{i}"), F.sum(f"_c{i}"), AVG_SCALE).alias(name))
        elif kind in ("count_distinct", "pct_of_distinct"):
            if arg is None:
                numerator = F.count(key)
            else:
                level1.append(F.max(F.coalesce(F.expr(arg), F.lit(False)).cast("int")).alias(f"_f{i}"))
                numerator = F.coalesce(F.sum(F.when(F.col(key).isNotNull(), F.col(f"_f{i}"))),
                                       F.lit(0)).cast("bigint")
            if kind == "count_distinct":
                level2.append(numerator.alias(name))
            else:
                level2.append((F.try_divide(numerator, F.count(key).cast("double")) * 100).alias(name))
        else:
            raise ValueError(kind)
    if not level1:
        level1 = [F.count(F.lit(1)).alias("_rows")]
    grain = keyed.groupBy(*dims, key).agg(*level1)
    return grain.groupBy(*dims).agg(*level2) if dims else grain.agg(*level2)
