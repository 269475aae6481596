"""Intermediate models, platform marts and the gold layer.

Plan shape (checked with ``explain``): every child table is aggregated to the
parent's key *before* the join (map-side partial aggregation, so a hot key
costs one row per task, not one row per record), and the join then reuses
the aggregate's hash partitioning — each input is shuffled exactly once.
AQE turns a join into a broadcast only when the runtime size of a side is
under ``spark.sql.adaptive.autoBroadcastJoinThreshold``; no side whose size
grows with the data is broadcast by hint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.functions import as_of_date, exact_ratio, money_zero

DEFAULT_HIGH = 500
DEFAULT_MID = 100


def _success_amount():
    return F.when(F.col("payment_status") == "success", F.col("amount")).otherwise(F.lit(0))


# ------------------------------------------------------------------ intermediate
def int_order_payments(stg_payments: DataFrame) -> DataFrame:
    """Per order: successful amount and latest payment day (all payments)."""
    return (stg_payments.groupBy("order_id")
            .agg(F.sum(_success_amount()).alias("amount_paid"),
                 F.max("payment_date").alias("latest_payment_date")))


def int_customer_orders(stg_orders: DataFrame, order_payments: DataFrame) -> DataFrame:
    """Per customer: order count, lifetime value, first and last order day."""
    o = stg_orders.select("order_id", "customer_id", "order_date")
    op = order_payments.select("order_id", "amount_paid")
    return (o.join(op, "order_id", "left")
            .groupBy("customer_id")
            .agg(F.count("order_id").alias("number_of_orders"),
                 F.sum("amount_paid").alias("total_lifetime_value"),
                 F.min("order_date").alias("first_order_date"),
                 F.max("order_date").alias("most_recent_order_date")))


def int_order_items_enriched(stg_order_items: DataFrame, stg_products: DataFrame) -> DataFrame:
    p = stg_products.select("product_id", "product_name", "category")
    return (stg_order_items.join(p, "product_id", "left")
            .select("order_item_id", "order_id", "product_id", "product_name", "category",
                    "quantity", "unit_price", "line_total"))


# ------------------------------------------------------------------------ marts
def segment_of(ltv, high=DEFAULT_HIGH, mid=DEFAULT_MID):
    ltv = F.col(ltv) if isinstance(ltv, str) else ltv
    return (F.when(ltv >= high, F.lit("high_value"))
            .when(ltv >= mid, F.lit("mid_value"))
            .otherwise(F.lit("low_value")))


def dim_customers(stg_customers: DataFrame, customer_orders: DataFrame,
                  high=DEFAULT_HIGH, mid=DEFAULT_MID) -> DataFrame:
    """One row per customer; customers without orders get 0 / NULL dates."""
    co = customer_orders
    return (stg_customers.join(co, "customer_id", "left")
            .select("customer_id", "first_name", "last_name", "email", "created_date", "country",
                    F.coalesce("number_of_orders", F.lit(0).cast("bigint")).alias("number_of_orders"),
                    F.coalesce(F.col("total_lifetime_value"), money_zero())
                    .alias("total_lifetime_value"),
                    "first_order_date", "most_recent_order_date",
                    segment_of("total_lifetime_value", high, mid).alias("customer_segment")))


def dim_products(stg_products: DataFrame) -> DataFrame:
    return stg_products.select("product_id", "product_name", "category", "unit_price", "is_active")


def order_item_totals(order_items: DataFrame) -> DataFrame:
    """Per order: item count and items total (aggregate-before-join).

    The reference builds this from items left-joined to products; that join
    adds no rows because ``product_id`` is the products' primary key (a
    declared, tested constraint), so the lookup is dropped here — it would
    shuffle the largest table once more for nothing.
    """
    return (order_items.groupBy("order_id")
            .agg(F.count("order_item_id").alias("number_of_items"),
                 F.sum("line_total").alias("items_total")))


def order_paid_totals(stg_payments: DataFrame) -> DataFrame:
    return stg_payments.groupBy("order_id").agg(F.sum(_success_amount()).alias("amount_paid"))


def fct_orders(stg_orders: DataFrame, stg_order_items: DataFrame,
               stg_payments: DataFrame) -> DataFrame:
    """One row per order with item count, items total and amount paid."""
    return (stg_orders
            .join(order_item_totals(stg_order_items), "order_id", "left")
            .join(order_paid_totals(stg_payments), "order_id", "left")
            .select("order_id", "customer_id", "order_date", "status", "payment_method",
                    F.coalesce("number_of_items", F.lit(0).cast("bigint")).alias("number_of_items"),
                    F.coalesce(F.col("items_total"), money_zero()).alias("items_total"),
                    F.coalesce(F.col("amount_paid"), money_zero()).alias("amount_paid")))


def time_spine_daily(as_of=None, start="2024-01-01", end="2027-01-01",
                     bounds: DataFrame | None = None, spark=None,
                     lookback_months: int | None = 60, lookahead_days: int | None = 30) -> DataFrame:
    """Daily spine ``[start, end)`` kept where ``as_of - lookback_months < day <
    as_of + lookahead_days``; ``None`` leaves that side untrimmed.

    ``bounds`` may be a one-row DataFrame with ``start``/``end`` date columns
    derived from the data (e.g. min/max order day); the spine is then exploded
    from that row (its size is the number of days, not the number of rows).
    """
    if bounds is None:
        if spark is None:
            raise ValueError("pass a SparkSession or a bounds DataFrame")
        bounds = spark.range(1).select(F.lit(str(start)).cast("date").alias("start"),
                                       F.lit(str(end)).cast("date").alias("end"))
    day = as_of_date(as_of)
    spine = bounds.select(F.explode(F.sequence(F.col("start"), F.date_sub(F.col("end"), 1),
                                               F.expr("INTERVAL 1 DAY"))).alias("date_day"))
    if lookback_months is not None:
        spine = spine.filter(F.col("date_day") > F.add_months(day, -lookback_months))
    if lookahead_days is not None:
        spine = spine.filter(F.col("date_day") < F.date_add(day, lookahead_days))
    return spine


# ------------------------------------------------------------------------- gold
def gold_dim_customers(silver_customers: DataFrame, silver_orders: DataFrame,
                       silver_payments: DataFrame, high=DEFAULT_HIGH, mid=DEFAULT_MID) -> DataFrame:
    """Pipeline variant: LTV through payments INNER JOIN orders, rounded."""
    om = (silver_orders.groupBy("customer_id")
          .agg(F.count("order_id").alias("number_of_orders"),
               F.min("order_date").alias("first_order_date"),
               F.max("order_date").alias("most_recent_order_date")))
    # Successful payments are pre-summed per order before meeting the orders,
    # so the join sees one row per paid order instead of one per payment.
    paid = (silver_payments.filter(F.col("payment_status") == "success")
            .groupBy("order_id").agg(F.sum("amount").alias("paid")))
    pt = (paid.join(silver_orders.select("order_id", "customer_id"), "order_id")
          .groupBy("customer_id").agg(F.round(F.sum("paid"), 2).alias("total_lifetime_value")))
    ltv = F.coalesce(F.col("total_lifetime_value"), money_zero())
    return (silver_customers.join(om, "customer_id", "left").join(pt, "customer_id", "left")
            .select("customer_id", "first_name", "last_name", "email", "country", "created_date",
                    F.coalesce("number_of_orders", F.lit(0).cast("bigint")).alias("number_of_orders"),
                    "first_order_date", "most_recent_order_date",
                    ltv.alias("total_lifetime_value"),
                    segment_of(ltv, high, mid).alias("customer_segment")))


def gold_fct_orders(silver_orders: DataFrame, silver_order_items: DataFrame,
                    silver_payments: DataFrame) -> DataFrame:
    """Pipeline variant: success filtered before grouping; keeps ``amount``."""
    im = order_item_totals(silver_order_items)
    pm = (silver_payments.filter(F.col("payment_status") == "success")
          .groupBy("order_id").agg(F.sum("amount").alias("amount_paid")))
    return (silver_orders.join(im, "order_id", "left").join(pm, "order_id", "left")
            .select("order_id", "customer_id", "status", "order_date", "amount",
                    F.coalesce("number_of_items", F.lit(0).cast("bigint")).alias("number_of_items"),
                    F.coalesce(F.col("items_total"), money_zero()).alias("items_total"),
                    F.coalesce(F.col("amount_paid"), money_zero()).alias("amount_paid")))


def gold_fct_revenue(fct: DataFrame) -> DataFrame:
    """Daily completed-order revenue; ``revenue_month`` as ``yyyy-MM``."""
    return (fct.filter(F.col("status") == "completed")
            .groupBy("order_date")
            .agg(F.sum("amount_paid").alias("daily_revenue"),
                 F.count("order_id").alias("number_of_orders"),
                 exact_ratio(F.sum("amount_paid"), F.count("amount_paid"), 2)
                 .alias("avg_order_value"))
            .withColumn("revenue_month", F.date_format("order_date", "yyyy-MM"))
            .select("order_date", "revenue_month", "daily_revenue", "number_of_orders",
                    "avg_order_value"))
