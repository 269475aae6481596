"""Staging (view models) and the silver layer of the medallion pipeline.

Each function is a pure projection over one raw table: Catalyst fuses it into
the scan's codegen stage and prunes every column the caller does not use.
Silver tables add row expectations (see :mod:`martlet.operators.quality`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.operators.quality import Expectation, apply_expectations


def stg_customers(raw_customers: DataFrame) -> DataFrame:
    return raw_customers.select(
        "customer_id", "first_name", "last_name",
        F.lower("email").alias("email"),
        F.col("created_at").cast("date").alias("created_date"),
        F.upper("country").alias("country"),
    )


def stg_orders(raw_orders: DataFrame) -> DataFrame:
    return raw_orders.select(
        "order_id", "customer_id",
        F.col("order_date").cast("date").alias("order_date"),
        F.lower("status").alias("status"),
        "amount",
        F.lower("payment_method").alias("payment_method"),
    )


def stg_order_items(raw_order_items: DataFrame) -> DataFrame:
    return raw_order_items.select(
        "order_item_id", "order_id", "product_id", "quantity", "unit_price",
        (F.col("quantity") * F.col("unit_price")).alias("line_total"),
    )


def stg_products(raw_products: DataFrame) -> DataFrame:
    return raw_products.select(
        "product_id", "product_name",
        F.lower("category").alias("category"),
        "unit_price",
        F.col("is_active").cast("boolean").alias("is_active"),
    )


def stg_payments(raw_payments: DataFrame) -> DataFrame:
    return raw_payments.select(
        "payment_id", "order_id",
        F.lower("payment_method").alias("payment_method"),
        "amount",
        F.lower("status").alias("payment_status"),
        F.col("payment_date").cast("date").alias("payment_date"),
    )


# Silver expectations (name, predicate, action) as declared.
SILVER_RULES = {
    "customers": [Expectation("valid_email", "email IS NOT NULL", "warn"),
                  Expectation("valid_customer_id", "customer_id IS NOT NULL", "drop")],
    "orders": [Expectation("valid_order_id", "order_id IS NOT NULL", "drop"),
               Expectation("valid_status",
                           "status IN ('placed', 'shipped', 'completed', 'returned')",
                           "warn")],
    "order_items": [Expectation("positive_quantity", "quantity > 0", "warn"),
                    Expectation("valid_item", "order_item_id IS NOT NULL", "drop")],
    "products": [Expectation("valid_product_id", "product_id IS NOT NULL", "drop")],
    "payments": [Expectation("valid_payment_id", "payment_id IS NOT NULL", "drop"),
                 Expectation("positive_amount", "amount > 0", "warn")],
}


def silver_customers_rows(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "customer_id", "first_name", "last_name",
        F.lower("email").alias("email"),
        F.to_date("created_at").alias("created_date"),
        F.upper("country").alias("country"),
    )


def silver_orders_rows(bronze: DataFrame) -> DataFrame:
    # The silver order table carries no payment_method (unlike stg_orders).
    return bronze.select(
        "order_id", "customer_id",
        F.lower("status").alias("status"),
        F.to_date("order_date").alias("order_date"),
        "amount",
    )


def silver_order_items_rows(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "order_item_id", "order_id", "product_id", "quantity", "unit_price",
        (F.col("quantity") * F.col("unit_price")).alias("line_total"),
    )


def silver_products_rows(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "product_id", "product_name",
        F.lower("category").alias("category"),
        "unit_price", "is_active",
    )


def silver_payments_rows(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "payment_id", "order_id",
        F.lower("payment_method").alias("payment_method"),
        "amount",
        F.to_date("payment_date").alias("payment_date"),
        F.lower("status").alias("payment_status"),
    )


SILVER_PROJECTIONS = {
    "customers": silver_customers_rows,
    "orders": silver_orders_rows,
    "order_items": silver_order_items_rows,
    "products": silver_products_rows,
    "payments": silver_payments_rows,
}


def silver(entity: str, bronze: DataFrame, observation=None) -> DataFrame:
    """Silver table for ``entity``: projection, then its expectations.

    Works on batch and streaming inputs alike; pass a
    ``pyspark.sql.Observation`` (batch) or a name (stream) to collect the
    per-rule violation counts without a second pass.
    """
    return apply_expectations(SILVER_PROJECTIONS[entity](bronze), SILVER_RULES[entity],
                              observation=observation)


def silver_customers(bronze: DataFrame, observation=None) -> DataFrame:
    return silver("customers", bronze, observation)


def silver_orders(bronze: DataFrame, observation=None) -> DataFrame:
    return silver("orders", bronze, observation)


def silver_order_items(bronze: DataFrame, observation=None) -> DataFrame:
    return silver("order_items", bronze, observation)


def silver_products(bronze: DataFrame, observation=None) -> DataFrame:
    return silver("products", bronze, observation)


def silver_payments(bronze: DataFrame, observation=None) -> DataFrame:
    return silver("payments", bronze, observation)
