"""Consumer marts of the marketing and finance teams, in both the governed
(model) form and the medallion-team form, whose rules differ on purpose.

Rewrites (same results, cheaper plans):

* every fact table is aggregated to customer grain *before* it meets the
  customer dimension (order-weighted averages are kept exact, trap T4);
* product marts whose join is "every product x all orders" aggregate the
  orders to ONE row and broadcast that row (its size is fixed), instead of a
  nested-loop join whose output is products x orders (trap T5).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.functions import as_of_date, exact_ratio, is_completed, is_returned, money_zero
from martlet.operators.grain import n_distinct, n_distinct_where, order_grain
from martlet.operators.marts import DEFAULT_HIGH, DEFAULT_MID


def _completed_amount():
    return F.when(is_completed(), F.col("amount_paid")).otherwise(money_zero())


# ----------------------------------------------------------------- marketing
def mart_customer_segments(dim_customers: DataFrame, fct_orders: DataFrame,
                           as_of=None) -> DataFrame:
    """Recency x value segment (ordered CASE); NULL recency -> never_purchased."""
    day = as_of_date(as_of)
    recency = (fct_orders.groupBy("customer_id")
               .agg(F.max("order_date").alias("last_order_date"),
                    F.count_distinct(F.when(is_completed(), F.col("order_id"))).alias("completed_orders"))
               .withColumn("days_since_last_order", F.datediff(day, F.col("last_order_date"))))
    d = F.col("days_since_last_order")
    seg = F.col("customer_segment")
    marketing = (F.when((d <= 30) & (seg == "high_value"), F.lit("champion"))
                 .when((d <= 90) & seg.isin("high_value", "mid_value"), F.lit("loyal"))
                 .when(d <= 180, F.lit("at_risk"))
                 .when(d > 180, F.lit("lapsed"))
                 .when(F.col("last_order_date").isNull(), F.lit("never_purchased"))
                 .otherwise(F.lit("other")))
    return (dim_customers.join(recency, "customer_id", "left")
            .select("customer_id", "first_name", "last_name", "email", "country",
                    "customer_segment", "total_lifetime_value", "number_of_orders",
                    "last_order_date", "completed_orders", "days_since_last_order",
                    marketing.alias("marketing_segment")))


def mart_country_performance(dim_customers: DataFrame, fct_orders: DataFrame) -> DataFrame:
    """Per country: customers, high-value customers, orders, recognised
    revenue, order-weighted average LTV and revenue per customer.

    The reference joins customers to orders and averages LTV over the joined
    rows, so a customer weighs max(1, #orders); that weighting is reproduced
    from a per-customer pre-aggregate (one row per customer reaches the
    country grouping instead of one per order).
    """
    per_customer = (fct_orders.groupBy("customer_id")
                    .agg(F.count(F.lit(1)).alias("_rows"),
                         F.count_distinct("order_id").alias("_orders"),
                         F.sum(_completed_amount()).alias("_revenue")))
    c = dim_customers.select("customer_id", "country", "customer_segment", "total_lifetime_value")
    j = c.join(per_customer, "customer_id", "left")
    weight = F.greatest(F.coalesce(F.col("_rows"), F.lit(0)), F.lit(1))
    # (country, customer) grain first: the two distinct customer counts become
    # a count and a flag sum (no Expand).
    cg = order_grain(j, ["country"], key="customer_id",
                     flags={"_hv": F.col("customer_segment") == "high_value"},
                     aggs=[F.sum(F.coalesce(F.col("_orders"), F.lit(0))).alias("_o"),
                           F.sum("_revenue").alias("_r"),
                           F.sum(F.col("total_lifetime_value") * weight).alias("_lw"),
                           F.sum(F.when(F.col("total_lifetime_value").isNotNull(), weight)).alias("_ww")])
    g = cg.groupBy("country").agg(
        n_distinct("customer_id").alias("total_customers"),
        n_distinct_where("_hv", "customer_id").alias("high_value_customers"),
        F.sum("_o").alias("total_orders"),
        F.coalesce(F.sum("_r"), money_zero()).alias("recognised_revenue"),
        F.sum("_lw").alias("_ltv_w"), F.sum("_ww").alias("_w"),
    )
    return g.select(
        "country", "total_customers", "high_value_customers", "total_orders",
        "recognised_revenue",
        exact_ratio("_ltv_w", "_w", 4).alias("avg_ltv"),
        exact_ratio("recognised_revenue", "total_customers", 4).alias("revenue_per_customer"),
    )


def medallion_customer_segments(gold_dim_customers: DataFrame, gold_fct_orders: DataFrame,
                                as_of=None, high=DEFAULT_HIGH, mid=DEFAULT_MID,
                                null_recency=None) -> DataFrame:
    """The marketing team's own rule set over the gold tables.

    ``null_recency=None`` is the SQL form (no order -> NULL days);
    ``null_recency=9999`` is the Python form's sentinel (trap T14).
    """
    day = as_of_date(as_of)
    recency = (gold_fct_orders.groupBy("customer_id")
               .agg(F.max("order_date").alias("last_order_date"),
                    F.count("order_id").alias("order_count")))
    days = F.datediff(day, F.col("last_order_date"))
    if null_recency is not None:
        days = F.coalesce(days, F.lit(int(null_recency)))
    j = (gold_dim_customers.join(recency, "customer_id", "left")
         .withColumn("days_since_last_order", days))
    d = F.col("days_since_last_order")
    ltv = F.col("total_lifetime_value")
    n = F.col("number_of_orders")
    seg = (F.when((ltv >= high) & (d <= 30), F.lit("champion"))
           .when(n >= 3, F.lit("loyal"))
           .when((ltv >= mid) & (d > 60), F.lit("at_risk"))
           .when(d > 90, F.lit("lapsed"))
           .when(n == 0, F.lit("never_purchased"))
           .otherwise(F.lit("other")))
    return j.select("customer_id", "first_name", "last_name", "email", "country",
                    "customer_segment", "total_lifetime_value", "number_of_orders",
                    "last_order_date", "days_since_last_order", seg.alias("marketing_segment"))


def medallion_country_performance(gold_fct_orders: DataFrame, gold_dim_customers: DataFrame,
                                  variant: str = "sql") -> DataFrame:
    """Completed orders by country.  ``variant='sql'`` counts distinct
    customers/orders; ``'python'`` counts joined rows (trap T14)."""
    completed = gold_fct_orders.filter(is_completed()).select("order_id", "customer_id", "amount_paid")
    # Per customer first: one row per customer reaches the country grouping.
    per_customer = completed.groupBy("customer_id").agg(
        (F.count_distinct("order_id") if variant == "sql" else F.count("order_id")).alias("_orders"),
        F.count(F.lit(1)).alias("_rows"),
        F.sum("amount_paid").alias("_s"), F.count("amount_paid").alias("_c"))
    j = per_customer.join(gold_dim_customers.select("customer_id", "country"), "customer_id")
    if variant == "sql":
        g = j.groupBy("country").agg(F.sum("_orders").alias("total_orders"),
                                     F.sum("_s").alias("_s"), F.sum("_c").alias("_c"),
                                     F.count_distinct("customer_id").alias("active_customers"))
        rpc = exact_ratio("_s", "active_customers", 2)
    else:
        g = j.groupBy("country").agg(F.sum("_orders").alias("total_orders"),
                                     F.sum("_s").alias("_s"), F.sum("_c").alias("_c"),
                                     F.sum("_rows").alias("active_customers"))
        rpc = exact_ratio(F.round(F.col("_s"), 2), "active_customers", 2)
    return (g.select("country", "total_orders",
                     F.round(F.col("_s"), 2).alias("total_revenue"),
                     exact_ratio("_s", "_c", 2).alias("avg_order_value"),
                     "active_customers", rpc.alias("revenue_per_customer"))
            .orderBy(F.col("total_revenue").desc()))


# ------------------------------------------------------------------- finance
def fct_revenue(fct_orders: DataFrame) -> DataFrame:
    """Order grain + month/year and recognised / returned amounts."""
    return fct_orders.select(
        "order_id", "customer_id", "order_date",
        F.trunc("order_date", "month").alias("order_month"),
        F.trunc("order_date", "year").alias("order_year"),
        "status", "payment_method", "number_of_items", "items_total", "amount_paid",
        F.when(is_completed(), F.col("amount_paid")).otherwise(money_zero()).alias("recognised_revenue"),
        F.when(is_returned(), F.col("amount_paid")).otherwise(money_zero()).alias("returned_amount"),
    )


def _all_orders_summary(fct_orders: DataFrame) -> DataFrame:
    """The one-row aggregate every product receives under ``ON 1 = 1``
    (distinct counts from the order grain: one shuffle, no Expand)."""
    g = order_grain(fct_orders, flags={"_r": is_returned()},
                    aggs=[F.sum(_completed_amount()).alias("_rev"),
                          F.min("order_date").alias("_first"), F.max("order_date").alias("_last")])
    return g.agg(n_distinct().alias("total_orders"), F.sum("_rev").alias("recognised_revenue"),
                 n_distinct_where("_r").alias("return_count"),
                 F.min("_first").alias("first_order_date"),
                 F.max("_last").alias("most_recent_order_date"))


def fct_revenue_by_product(fct_orders: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Every product with the totals of all orders (the reference's demo
    attribution).  With no orders at all the sum is 0, not NULL."""
    summary = _all_orders_summary(fct_orders)
    p = (dim_products.groupBy("product_id", "product_name", "category", "unit_price", "is_active")
         .agg(F.count(F.lit(1)).alias("_dup")))
    return (p.crossJoin(F.broadcast(summary))
            .select("product_id", "product_name", "category", "unit_price", "is_active",
                    "total_orders",
                    # a duplicated product row would meet every order twice
                    (F.coalesce(F.col("recognised_revenue"), money_zero()) * F.col("_dup"))
                    .alias("recognised_revenue"),
                    "return_count", "first_order_date", "most_recent_order_date"))


def revenue_by_product_lines(order_items: DataFrame, fct_orders: DataFrame,
                             dim_products: DataFrame, parts: int | None = None) -> DataFrame:
    """Line-level attribution (what the product mart asks for in production):
    each product gets the line totals of its own completed orders.

    A task sorts its part of both sides and holds its (product, order) groups, so its
    memory follows the rows of a part: give ``parts`` from the items' rows
    (:func:`~martlet.operators.skew.parts_for`), or inputs bucketed by the order."""
    o = fct_orders.select("order_id", "status", "order_date")
    lines = order_items.select("order_id", "product_id", "line_total")
    if parts:
        lines, o = lines.repartition(parts, "order_id"), o.repartition(parts, "order_id")
    lines = lines.join(o, "order_id")
    g = order_grain(lines, ["product_id"], flags={"_r": is_returned()},
                    aggs=[F.sum(F.when(is_completed(), F.col("line_total")).otherwise(money_zero()))
                          .alias("_rev"),
                          F.min("order_date").alias("_first"), F.max("order_date").alias("_last")])
    per_product = g.groupBy("product_id").agg(
        n_distinct().alias("total_orders"), F.sum("_rev").alias("recognised_revenue"),
        n_distinct_where("_r").alias("return_count"),
        F.min("_first").alias("first_order_date"), F.max("_last").alias("most_recent_order_date"))
    return (dim_products.select("product_id", "product_name", "category", "unit_price", "is_active")
            .join(per_product, "product_id", "left")
            .select("product_id", "product_name", "category", "unit_price", "is_active",
                    F.coalesce("total_orders", F.lit(0).cast("bigint")).alias("total_orders"),
                    F.coalesce(F.col("recognised_revenue"), money_zero()).alias("recognised_revenue"),
                    F.coalesce("return_count", F.lit(0).cast("bigint")).alias("return_count"),
                    "first_order_date", "most_recent_order_date"))


def medallion_fct_revenue(gold_fct_orders: DataFrame, variant: str = "sql") -> DataFrame:
    """Finance team's order-grain revenue with the payment-vs-items delta.

    The SQL form adds ``revenue_month`` (first day of the month, as DATE)."""
    cols = [
        "order_id", "order_date", "customer_id", "status", "amount_paid",
        F.when(is_completed(), F.col("amount_paid")).otherwise(money_zero()).alias("recognised_revenue"),
        F.round(F.col("amount_paid") - F.coalesce(F.col("items_total"), money_zero()), 2)
        .alias("payment_vs_items_delta"),
    ]
    if variant == "sql":
        cols.append(F.trunc("order_date", "month").alias("revenue_month"))
    return gold_fct_orders.select(*cols)


def medallion_revenue_by_product(gold_fct_orders: DataFrame, products: DataFrame) -> DataFrame:
    """Completed orders x products grouped by (category, product_name).

    Each group's rows are (#completed orders) x (#products sharing that
    category and name), so counts and sums scale by that multiplicity while
    the average is unchanged; no products x orders product is built."""
    completed = gold_fct_orders.filter(is_completed())
    summary = completed.agg(F.count("order_id").alias("_n"), F.sum("amount_paid").alias("_s"),
                            F.count("amount_paid").alias("_c"))
    groups = products.groupBy("category", "product_name").agg(F.count(F.lit(1)).alias("_k"))
    return (groups.crossJoin(F.broadcast(summary))
            .filter(F.col("_n") > 0)
            .select("category", "product_name",
                    (F.col("_n") * F.col("_k")).alias("total_orders"),
                    F.round(F.col("_s") * F.col("_k"), 2).alias("total_revenue"),
                    exact_ratio("_s", "_c", 2).alias("avg_order_value"))
            .orderBy(F.col("total_revenue").desc()))
