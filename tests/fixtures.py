"""Small hand-made raw tables (seed-shaped) with the edge rows the models
must handle: a success + failed payment, pending-only payments, an order
without payment, orders without items, a customer without orders, and item
totals that differ from the order amount."""

import datetime as dt
from decimal import Decimal as D

from martlet.sources.adapter import RawTables
from martlet.sources.schemas import raw_schema

T0 = dt.datetime(2026, 3, 31, 0, 0, 0)


def d(s):
    return dt.date.fromisoformat(s)


CUSTOMERS = [
    (1, "Ann", "Lee", "ANN@X.COM", d("2024-01-05"), "us", T0),
    (2, "Bo", "Kim", "bo@x.com", d("2024-02-01"), "kr", T0),
    (3, "Cy", "Ode", "cy@x.com", d("2024-03-01"), "de", T0),
    (4, "Di", "Ng", "di@x.com", d("2024-04-01"), "us", T0),   # no orders
]
PRODUCTS = [
    (10, "Shoe", "Footwear", D("100.00"), True, T0),
    (11, "Band", "FITNESS", D("25.50"), True, T0),
    (12, "Bar", "nutrition", D("3.00"), False, T0),
]
ORDERS = [
    (100, 1, d("2026-03-20"), "completed", D("250.00"), "CREDIT_CARD", T0),  # success + failed
    (101, 1, d("2026-01-10"), "completed", D("300.00"), "paypal", T0),
    (102, 2, d("2025-12-01"), "Returned", D("80.00"), "paypal", T0),
    (103, 2, d("2026-02-15"), "placed", D("40.00"), "bank_transfer", T0),     # pending only
    (104, 3, d("2025-06-01"), "shipped", D("60.00"), "credit_card", T0),      # no payment, no items
    (105, 1, d("2026-03-25"), "completed", D("120.00"), "credit_card", T0),   # no items
]
ORDER_ITEMS = [
    (1000, 100, 10, 2, D("100.00"), T0),
    (1001, 100, 11, 1, D("25.50"), T0),
    (1002, 101, 10, 3, D("100.00"), T0),
    (1003, 102, 12, 4, D("20.00"), T0),
    (1004, 103, 11, 1, D("40.00"), T0),
]
PAYMENTS = [
    (5000, 100, "credit_card", D("250.00"), "success", d("2026-03-20"), T0),
    (5001, 100, "credit_card", D("250.00"), "failed", d("2026-03-19"), T0),
    (5002, 101, "paypal", D("300.00"), "SUCCESS", d("2026-01-10"), T0),
    (5003, 102, "paypal", D("80.00"), "success", d("2025-12-01"), T0),
    (5004, 103, "bank_transfer", D("40.00"), "pending", d("2026-02-15"), T0),
    (5005, 105, "credit_card", D("120.00"), "success", d("2026-03-25"), T0),
]
REVIEWS = [
    (1, 100, 10, 1, 5, d("2026-03-22"), T0),
    (2, 101, 10, 1, 4, d("2026-01-12"), T0),
    (3, 102, 12, 2, 2, d("2025-12-05"), T0),
]


def seed_raw(spark) -> RawTables:
    def mk(rows, table):
        return spark.createDataFrame(rows, raw_schema(table))

    return RawTables(mk(CUSTOMERS, "raw_customers"), mk(PRODUCTS, "raw_products"),
                     mk(ORDERS, "raw_orders"), mk(ORDER_ITEMS, "raw_order_items"),
                     mk(PAYMENTS, "raw_payments"), mk(REVIEWS, "raw_reviews"))
