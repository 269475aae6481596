"""Typed schemas: the six raw tables and the three contracted marts.

Identifier columns are INT in the published contracts; the driver tables use
64-bit keys, so every builder takes an ``id_type`` (default INT, the adapter
passes LONG).  Column documentation travels as ``StructField`` metadata
(``{"comment": ...}``) and is what :func:`martlet.operators.contracts.column_comments`
reports.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY_RAW = T.DecimalType(10, 2)
MONEY_MART = T.DecimalType(18, 2)

# Accepted domains of the governed columns.
ORDER_STATUSES = ["placed", "shipped", "completed", "returned"]
PAYMENT_STATUSES = ["success", "failed", "pending"]
CUSTOMER_SEGMENTS = ["high_value", "mid_value", "low_value"]
MARKETING_SEGMENTS = ["champion", "loyal", "at_risk", "lapsed", "never_purchased", "other"]
PRODUCT_CATEGORIES = ["apparel", "electronics", "fitness", "footwear", "nutrition"]
PAYMENT_METHODS = ["credit_card", "paypal", "bank_transfer"]

RAW_TABLES = ["raw_customers", "raw_products", "raw_orders", "raw_order_items",
              "raw_payments", "raw_reviews"]


def _f(name, dtype, nullable=True, comment=None):
    meta = {"comment": comment} if comment else {}
    return T.StructField(name, dtype, nullable, meta)


def raw_schema(table: str, id_type: T.DataType = T.IntegerType()) -> T.StructType:
    """Schema of one raw table, including the ``_loaded_at`` stamp."""
    i = id_type
    cols = {
        "raw_customers": [
            _f("customer_id", i), _f("first_name", T.StringType()),
            _f("last_name", T.StringType()), _f("email", T.StringType()),
            _f("created_at", T.DateType()), _f("country", T.StringType()),
        ],
        "raw_products": [
            _f("product_id", i), _f("product_name", T.StringType()),
            _f("category", T.StringType()), _f("unit_price", MONEY_RAW),
            _f("is_active", T.BooleanType()),
        ],
        "raw_orders": [
            _f("order_id", i), _f("customer_id", i), _f("order_date", T.DateType()),
            _f("status", T.StringType()), _f("amount", MONEY_RAW),
            _f("payment_method", T.StringType()),
        ],
        "raw_order_items": [
            _f("order_item_id", i), _f("order_id", i), _f("product_id", i),
            _f("quantity", T.IntegerType()), _f("unit_price", MONEY_RAW),
        ],
        "raw_payments": [
            _f("payment_id", i), _f("order_id", i), _f("payment_method", T.StringType()),
            _f("amount", MONEY_RAW), _f("status", T.StringType()),
            _f("payment_date", T.DateType()),
        ],
        "raw_reviews": [
            _f("review_id", i), _f("order_id", i), _f("product_id", i),
            _f("customer_id", i), _f("rating", T.IntegerType()),
            _f("review_date", T.DateType()),
        ],
    }[table]
    return T.StructType(cols + [_f("_loaded_at", T.TimestampNTZType(),
                                   comment="time the row was loaded")])


def dim_customers_contract(id_type: T.DataType = T.IntegerType()) -> T.StructType:
    return T.StructType([
        _f("customer_id", id_type, False, "customer key, one row per customer"),
        _f("first_name", T.StringType()),
        _f("last_name", T.StringType()),
        _f("email", T.StringType(), False, "lower-cased e-mail address"),
        _f("created_date", T.DateType(), comment="account creation day"),
        _f("country", T.StringType(), comment="upper-cased country"),
        _f("number_of_orders", T.LongType(), comment="orders placed, 0 if none"),
        _f("total_lifetime_value", MONEY_MART,
           comment="sum of successful payments over all orders"),
        _f("first_order_date", T.DateType()),
        _f("most_recent_order_date", T.DateType()),
        _f("customer_segment", T.StringType(),
           comment="value tier from total_lifetime_value"),
    ])


def dim_products_contract(id_type: T.DataType = T.IntegerType()) -> T.StructType:
    return T.StructType([
        _f("product_id", id_type, False, "product key"),
        _f("product_name", T.StringType(), False),
        _f("category", T.StringType(), comment="lower-cased category"),
        _f("unit_price", MONEY_MART),
        _f("is_active", T.BooleanType()),
    ])


def fct_orders_contract(id_type: T.DataType = T.IntegerType()) -> T.StructType:
    return T.StructType([
        _f("order_id", id_type, False, "order key, one row per order"),
        _f("customer_id", id_type, False, "foreign key to dim_customers"),
        _f("order_date", T.DateType(), False),
        _f("status", T.StringType(), comment="placed, shipped, completed or returned"),
        _f("payment_method", T.StringType()),
        _f("number_of_items", T.LongType(), comment="line items of the order"),
        _f("items_total", MONEY_MART, comment="sum of line totals"),
        _f("amount_paid", MONEY_MART,
           comment="successful payments only; not the order amount"),
    ])


CONTRACTS = {
    "dim_customers": (dim_customers_contract, ["customer_id"]),
    "dim_products": (dim_products_contract, ["product_id"]),
    "fct_orders": (fct_orders_contract, ["order_id"]),
}
