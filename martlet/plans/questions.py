"""Business questions and dashboard queries over the marts.

Each is a small DataFrame program over ``fct_orders`` / ``dim_customers`` /
``dim_products`` (+ order items and reviews where the question needs line
grain).  Facts are aggregated to customer grain before they meet the
customer dimension; top-k questions keep their ``limit`` (it is the feature)
with a deterministic tie-break.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlet.functions import as_of_date, exact_ratio, is_completed, is_returned, money_zero
from martlet.operators.grain import n_distinct, n_distinct_where, order_grain
from martlet.operators.skew import HotKeys, split_join


def _div(num, den, scale, num_type="decimal(22,2)"):
    return exact_ratio(num, den, scale, num_type)


def _pct_returned(returned, total):
    """returned / total * 100, exact decimal, 4 places (app: DECIMAL(10,4) cast)."""
    return exact_ratio(returned.cast("decimal(20,0)") * 100, total, 4, "decimal(23,0)")


def _customer_revenue(fct: DataFrame) -> DataFrame:
    """Completed revenue per customer (the fact pre-aggregated to customer grain)."""
    return (fct.groupBy("customer_id")
            .agg(F.sum(F.when(is_completed(), F.col("amount_paid")).otherwise(money_zero()))
                 .alias("_rev")))


# ----------------------------------------------------------------- executive tab
def _order_kpis(fct: DataFrame, aov: str) -> DataFrame:
    """One row: completed revenue, distinct / completed / returned orders and
    an average order value (``aov='completed'`` or ``'all'``), exact, from the
    order grain (no Expand)."""
    amount = F.col("amount_paid")
    avg_src = F.when(is_completed(), amount) if aov == "completed" else amount
    g = order_grain(fct, flags={"_c": is_completed(), "_r": is_returned()},
                    aggs=[F.sum(F.when(is_completed(), amount).otherwise(money_zero())).alias("_rev"),
                          F.sum(avg_src).alias("_s"), F.count(avg_src).alias("_n")])
    return g.agg(F.sum("_rev").alias("total_revenue"), n_distinct().alias("total_orders"),
                 n_distinct_where("_c").alias("completed_orders"),
                 n_distinct_where("_r").alias("_ret"),
                 _div(F.sum("_s"), F.sum("_n"), 4).alias("avg_order_value"))


def kpi_summary(fct: DataFrame) -> DataFrame:
    return _order_kpis(fct, "completed").select(
        "total_revenue", "total_orders", "completed_orders",
        _pct_returned(F.col("_ret"), F.col("total_orders")).alias("return_rate"))


def revenue_by(dim: DataFrame, fct: DataFrame, column: str) -> DataFrame:
    """Completed revenue per dimension value; customers without orders add 0."""
    j = dim.select("customer_id", column).join(_customer_revenue(fct), "customer_id", "left")
    return (j.groupBy(column)
            .agg(F.coalesce(F.sum("_rev"), money_zero()).alias("revenue"))
            .orderBy(F.col("revenue").desc()))


def revenue_by_segment(dim: DataFrame, fct: DataFrame) -> DataFrame:
    return revenue_by(dim, fct, "customer_segment")


def revenue_by_country(dim: DataFrame, fct: DataFrame) -> DataFrame:
    return revenue_by(dim, fct, "country")


def customers_by_segment(dim: DataFrame) -> DataFrame:
    return (dim.groupBy("customer_segment")
            .agg(F.count(F.lit(1)).alias("customers"),
                 _div(F.sum("total_lifetime_value"), F.count("total_lifetime_value"), 2).alias("avg_ltv"))
            .orderBy(F.col("customers").desc()))


def top_products(dim_products: DataFrame, fct: DataFrame, k: int = 10) -> DataFrame:
    """Dashboard "top products": products x all orders (``ON 1 = 1``), so
    every product carries the same totals; top ``k`` with name, category and
    price as the tie-break.  The orders are aggregated to one broadcast row."""
    summary = fct.agg(F.count_distinct("order_id").alias("order_count"),
                      F.coalesce(F.sum(F.when(is_completed(), F.col("amount_paid")).otherwise(money_zero())),
                                 money_zero()).alias("_rev"))
    groups = (dim_products.groupBy("product_name", "category", "unit_price")
              .agg(F.count(F.lit(1)).alias("_k")))
    return (groups.crossJoin(F.broadcast(summary))
            .select("product_name", "category", "unit_price", "order_count",
                    (F.col("_rev") * F.col("_k")).alias("revenue"))
            .orderBy(F.col("order_count").desc(), "product_name", "category", "unit_price")
            .limit(k))


# --------------------------------------------------------------- metric explorer
def _completed(fct):
    return fct.filter(is_completed())


def _month(c):
    return F.trunc(c, "month")


def breakdown(metric: str, by: str, dim: DataFrame, fct: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """The explorer's five metrics x {total, month, segment, payment method
    (country for customer metrics)}.  Output (metric_name, value) for
    ``total`` and (period, value) otherwise."""
    if metric in ("revenue", "aov"):
        base = _completed(fct)
        if metric == "revenue":
            value = F.sum("amount_paid")
        else:
            value = _div(F.sum("amount_paid"), F.count("amount_paid"), 4)
        name = "total_recognised_revenue" if metric == "revenue" else "avg_order_value"
        time_col = "order_date"
    elif metric == "return_rate":
        return _return_rate_breakdown(by, dim, fct, hot)
    elif metric == "customers":
        base = dim
        value = F.count_distinct("customer_id")
        name, time_col = "total_customers", "created_date"
    elif metric == "ltv":
        base = dim
        value = _div(F.sum("total_lifetime_value"), F.count("total_lifetime_value"), 4)
        name, time_col = "avg_lifetime_value", "created_date"
    else:
        raise ValueError(metric)
    if by == "total":
        return base.agg(value.alias("value")).select(F.lit(name).alias("metric_name"), "value")
    if by == "month":
        return base.groupBy(_month(time_col).alias("period")).agg(value.alias("value"))
    if by == "segment":
        if metric in ("customers", "ltv"):
            return base.groupBy(F.col("customer_segment").alias("period")).agg(value.alias("value"))
        # one row per customer meets the dimension, so a hot customer's orders never do
        per = base.groupBy("customer_id").agg(F.sum("amount_paid").alias("_s"), F.count("amount_paid").alias("_n"))
        j = per.join(dim.select("customer_id", "customer_segment"), "customer_id")
        value = F.sum("_s") if metric == "revenue" else _div(F.sum("_s"), F.sum("_n"), 4)
        return j.groupBy(F.col("customer_segment").alias("period")).agg(value.alias("value"))
    if by == "payment_method":
        col = "country" if metric in ("customers", "ltv") else "payment_method"
        return base.groupBy(F.col(col).alias("period")).agg(value.alias("value"))
    raise ValueError(by)


def _return_rate_breakdown(by: str, dim: DataFrame, fct: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Returned share of distinct orders, via the order grain (no Expand)."""
    if by == "total":
        base, keys = fct, []
    elif by == "month":
        base, keys = fct.withColumn("period", _month("order_date")), ["period"]
    elif by == "segment":
        base = split_join(fct.select("customer_id", "order_id", "status"),
                          dim.select("customer_id", F.col("customer_segment").alias("period")), "customer_id", hot=hot)
        keys = ["period"]
    elif by == "payment_method":
        base, keys = fct.withColumn("period", F.col("payment_method")), ["period"]
    else:
        raise ValueError(by)
    g = order_grain(base, keys, flags={"_r": is_returned()})
    value = _pct_returned(n_distinct_where("_r"), n_distinct()).alias("value")
    if not keys:
        return g.agg(value).select(F.lit("return_rate").alias("metric_name"), "value")
    return g.groupBy(*keys).agg(value)


# ------------------------------------------------------------- comparison tab
def _customer_kpis(dim: DataFrame) -> DataFrame:
    return dim.agg(F.count_distinct("customer_id").alias("customer_count"),
                   _div(F.sum("total_lifetime_value"), F.count("total_lifetime_value"), 4)
                   .alias("avg_lifetime_value"))


def all_metrics(dim: DataFrame, fct: DataFrame) -> DataFrame:
    """One row: revenue (completed), orders, return rate %, customers, avg LTV,
    AOV (completed) — two one-row aggregates side by side."""
    return _order_kpis(fct, "completed").crossJoin(_customer_kpis(dim)).select(
        "total_revenue", "total_orders",
        _pct_returned(F.col("_ret"), F.col("total_orders")).alias("return_rate_pct"),
        "customer_count", "avg_lifetime_value", "avg_order_value")


def side_by_side_kpis(dim: DataFrame, fct: DataFrame) -> DataFrame:
    """The model-side figures of the comparison tab (AOV here unfiltered)."""
    return _order_kpis(fct, "all").crossJoin(_customer_kpis(dim)).select(
        "total_revenue", "total_orders",
        _pct_returned(F.col("_ret"), F.col("total_orders")).alias("return_rate_pct"),
        "avg_order_value", "customer_count", "avg_lifetime_value")


# ---------------------------------------------------------- analyst questions
def revenue_last_month(fct: DataFrame, as_of=None) -> DataFrame:
    """Completed revenue in the calendar month before ``as_of``."""
    day = as_of_date(as_of)
    start = F.trunc(F.add_months(day, -1), "month")
    end = F.trunc(day, "month")
    return (_completed(fct).filter((F.col("order_date") >= start) & (F.col("order_date") < end))
            .agg(F.coalesce(F.sum("amount_paid"), money_zero()).alias("revenue"),
                 F.count("order_id").alias("orders"))
            .select(start.alias("month"), "revenue", "orders"))


def mom_growth(fct: DataFrame) -> DataFrame:
    """Monthly completed revenue with month-over-month growth in percent.
    The window runs over the monthly aggregate (one row per month)."""
    monthly = (_completed(fct).groupBy(_month("order_date").alias("month"))
               .agg(F.sum("amount_paid").alias("revenue")))
    prev = F.lag("revenue").over(Window.orderBy("month"))
    return (monthly.withColumn("prev_revenue", prev)
            .withColumn("growth_pct",
                        F.round((F.col("revenue") - F.col("prev_revenue")).cast("decimal(20,2)")
                                / F.nullif(F.col("prev_revenue"), money_zero()).cast("decimal(20,2)")
                                * 100, 4)))


def product_line_revenue(order_items: DataFrame, fct: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Completed line revenue per product (items of completed orders)."""
    lines = (order_items.select("order_id", "product_id", "line_total")
             .join(_completed(fct).select("order_id"), "order_id"))
    per_product = lines.groupBy("product_id").agg(F.sum("line_total").alias("revenue"))
    return per_product.join(dim_products.select("product_id", "product_name", "category"),
                            "product_id", "left")


def top3_products(order_items: DataFrame, fct: DataFrame, dim_products: DataFrame,
                  k: int = 3) -> DataFrame:
    return (product_line_revenue(order_items, fct, dim_products)
            .select("product_id", "product_name", "category", "revenue")
            .orderBy(F.col("revenue").desc(), "product_id").limit(k))


def high_value_share(dim: DataFrame, fct: DataFrame) -> DataFrame:
    """Share (%) of completed revenue from high-value customers."""
    j = _customer_revenue(fct).join(dim.select("customer_id", "customer_segment"), "customer_id", "left")
    return (j.agg(F.sum(F.when(F.col("customer_segment") == "high_value", F.col("_rev"))
                        .otherwise(money_zero())).alias("high_value_revenue"),
                  F.sum("_rev").alias("total_revenue"))
            .select("high_value_revenue", "total_revenue",
                    F.round(F.col("high_value_revenue").cast("decimal(20,2)")
                            / F.nullif(F.col("total_revenue"), money_zero()).cast("decimal(20,2)")
                            * 100, 4)
                    .alias("high_value_share_pct")))


def inactive_customers(dim: DataFrame, as_of=None, days: int = 90) -> DataFrame:
    day = as_of_date(as_of)
    d = F.datediff(day, F.col("most_recent_order_date"))
    return (dim.filter(d > days)
            .select("customer_id", "email", "customer_segment", "most_recent_order_date",
                    d.alias("days_since_last_order")))


def at_risk_customers(dim: DataFrame, as_of=None) -> DataFrame:
    return inactive_customers(dim, as_of, 90)


def churned_customers(dim: DataFrame, as_of=None) -> DataFrame:
    return inactive_customers(dim, as_of, 180)


def returning_customers(dim: DataFrame) -> DataFrame:
    return (dim.filter(F.col("number_of_orders") > 1)
            .select("customer_id", "email", "number_of_orders", "total_lifetime_value"))


def high_value_customers(dim: DataFrame, high=500) -> DataFrame:
    return (dim.filter(F.col("total_lifetime_value") >= high)
            .select("customer_id", "email", "country", "total_lifetime_value"))


def return_rate_by_category_segment(order_items: DataFrame, dim_products: DataFrame,
                                    fct: DataFrame, dim: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Per (customer segment, product category): distinct orders holding an
    item of the category, how many were returned, and the rate (%)."""
    order_cats = (order_items.select("order_id", "product_id")
                  .join(dim_products.select("product_id", "category"), "product_id")
                  .select("order_id", "category").distinct())
    o = fct.select("order_id", "customer_id", "status")
    j = split_join(order_cats.join(o, "order_id"), dim.select("customer_id", "customer_segment"), "customer_id", "left", hot)
    g = (order_grain(j, ["customer_segment", "category"], flags={"_r": is_returned()})
         .groupBy("customer_segment", "category")
         .agg(n_distinct().alias("orders"), n_distinct_where("_r").alias("returned_orders")))
    return g.withColumn("return_rate_pct", _pct_returned(F.col("returned_orders"), F.col("orders")))


def quarter_bounds(as_of=None):
    """First day of the calendar quarter before ``as_of``'s quarter, and of
    ``as_of``'s own quarter."""
    day = as_of_date(as_of)
    this_q = F.trunc(day, "quarter")
    return F.add_months(this_q, -3), this_q


def revenue_quarter_country(dim: DataFrame, fct: DataFrame, as_of=None) -> DataFrame:
    """Recognised revenue by country in the last full quarter before as_of."""
    start, end = quarter_bounds(as_of)
    q = _completed(fct).filter((F.col("order_date") >= start) & (F.col("order_date") < end))
    per_customer = q.groupBy("customer_id").agg(F.sum("amount_paid").alias("_rev"),
                                                F.count("order_id").alias("_n"))
    j = per_customer.join(dim.select("customer_id", "country"), "customer_id")
    return (j.groupBy("country").agg(F.sum("_rev").alias("recognised_revenue"),
                                     F.sum("_n").alias("orders"))
            .select(start.alias("quarter_start"), "country", "recognised_revenue", "orders"))


def product_ratings(reviews: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Reviews per product category: count and mean rating (4 places)."""
    j = reviews.select("product_id", "rating").join(
        dim_products.select("product_id", "category"), "product_id", "left")
    return j.groupBy("category").agg(
        F.count("rating").alias("reviews"),
        exact_ratio(F.sum("rating"), F.count("rating"), 4, "decimal(22,0)").alias("avg_rating"))
