"""The platform model graph: raw tables -> staging -> intermediate -> marts.

``Platform`` wires the operator functions together lazily (each attribute is a
DataFrame built on first use), so a caller asking for one mart gets one
Catalyst plan from the parquet scans to that mart, and nothing else runs.
``materialize`` writes chosen marts to the shared folder and re-reads them,
cutting lineage for a multi-query session (the table-model materialisation).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from martlet.operators import marts, staging
from martlet.operators.skew import HotKeys, hot_keys
from martlet.sources.adapter import DRIVER_AS_OF, DRIVER_HIGH, DRIVER_MID, load_raw
from martlet.sources.ingest import materialize_table


class Platform:
    def __init__(self, raw, as_of=None, high=marts.DEFAULT_HIGH,
                 mid=marts.DEFAULT_MID):
        self.raw = raw
        self.as_of = as_of
        self.high = high
        self.mid = mid

    @classmethod
    def from_driver(cls, spark: SparkSession, sf_dir: str) -> "Platform":
        """The driver tables with their fixed as-of day and thresholds."""
        return cls(load_raw(spark, sf_dir), as_of=DRIVER_AS_OF, high=DRIVER_HIGH, mid=DRIVER_MID)

    # staging
    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.raw.customers)

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.raw.orders)

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return staging.stg_order_items(self.raw.order_items)

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.raw.products)

    @cached_property
    def stg_payments(self) -> DataFrame:
        return staging.stg_payments(self.raw.payments)

    # intermediate
    @cached_property
    def int_order_payments(self) -> DataFrame:
        return marts.int_order_payments(self.stg_payments)

    @cached_property
    def int_customer_orders(self) -> DataFrame:
        return marts.int_customer_orders(self.stg_orders, self.int_order_payments)

    @cached_property
    def int_order_items_enriched(self) -> DataFrame:
        return marts.int_order_items_enriched(self.stg_order_items, self.stg_products)

    # marts
    @cached_property
    def fct_orders(self) -> DataFrame:
        return marts.fct_orders(self.stg_orders, self.stg_order_items, self.stg_payments)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return marts.dim_customers(self.stg_customers, self.int_customer_orders,
                                   self.high, self.mid)

    @cached_property
    def dim_products(self) -> DataFrame:
        return marts.dim_products(self.stg_products)

    @cached_property
    def hot_customers(self) -> HotKeys:
        """Customers with more orders than an average partition (one sketch over
        the orders' customer column)."""
        return hot_keys(self.stg_orders, "customer_id")

    def models(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in (
            "stg_customers", "stg_orders", "stg_order_items", "stg_products", "stg_payments",
            "dim_customers", "dim_products", "fct_orders")}

    def register_views(self, prefix: str = "") -> list[str]:
        """Expose the models as temp views (``<prefix>fct_orders`` ...) so
        SQL written against the marts (dashboards, ad-hoc questions) runs
        through ``spark.sql`` on the same lazy plans."""
        names = []
        for name, df in self.models().items():
            df.createOrReplaceTempView(prefix + name)
            names.append(prefix + name)
        return names

    def materialize(self, spark: SparkSession, names=("fct_orders", "dim_customers",
                                                       "dim_products")) -> "Platform":
        """Write the named marts once (shared folder) and serve them from
        the written copy; later queries start from the parquet, not from the
        raw scans, and survive executor loss without recomputation."""
        plans = [getattr(self, name) for name in names]
        with ThreadPoolExecutor(max(1, len(plans))) as pool:  # independent writes run as concurrent jobs
            written = list(pool.map(lambda x: materialize_table(spark, *x), zip(plans, names)))
        self.__dict__.update(zip(names, written))
        return self


class Medallion:
    """Batch silver and gold tables over raw tables (the medallion graph):
    silver = projection + expectations, gold = the pipeline's own marts.
    The streaming form is :mod:`martlet.streaming.medallion`."""

    def __init__(self, raw, high=marts.DEFAULT_HIGH, mid=marts.DEFAULT_MID):
        self.raw = raw
        self.high = high
        self.mid = mid

    @classmethod
    def from_driver(cls, spark: SparkSession, sf_dir: str) -> "Medallion":
        return cls(load_raw(spark, sf_dir), high=DRIVER_HIGH, mid=DRIVER_MID)

    @cached_property
    def customers(self) -> DataFrame:
        return staging.silver_customers(self.raw.customers)

    @cached_property
    def orders(self) -> DataFrame:
        return staging.silver_orders(self.raw.orders)

    @cached_property
    def order_items(self) -> DataFrame:
        return staging.silver_order_items(self.raw.order_items)

    @cached_property
    def products(self) -> DataFrame:
        return staging.silver_products(self.raw.products)

    @cached_property
    def payments(self) -> DataFrame:
        return staging.silver_payments(self.raw.payments)

    @cached_property
    def gold_fct_orders(self) -> DataFrame:
        return marts.gold_fct_orders(self.orders, self.order_items, self.payments)

    @cached_property
    def gold_dim_customers(self) -> DataFrame:
        return marts.gold_dim_customers(self.customers, self.orders, self.payments,
                                        self.high, self.mid)

    @cached_property
    def gold_fct_revenue(self) -> DataFrame:
        return marts.gold_fct_revenue(self.gold_fct_orders)
