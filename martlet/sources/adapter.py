"""Map the driver's TPC-H-style tables onto the six raw commerce tables.

Every mapping is a projection/filter over one scan (plus the tiny ``nation``
lookup and one order-key join for review authors), so Catalyst prunes the
parquet columns.  No source row is dropped and nothing is collected.

The mapping (fixed values chosen for the test data, stated together here):

* customers: ``first_name = 'Customer'``, ``last_name = substr(c_name, 10)``,
  ``email = c_name || '@Example.com'``, ``country = n_name``,
  ``created_at = 1994-01-01 + c_custkey % 365 days``.
* products: ``category = p_type``, ``is_active = p_partkey % 20 <> 0``.
* orders: status ``RETURNED`` when ``o_orderkey % 7 = 3``, else F -> ``Completed``,
  O -> ``placed``, P -> ``shipped`` (mixed case on purpose); priority
  1-URGENT/2-HIGH -> ``credit_card``, 3-MEDIUM -> ``paypal``, else
  ``bank_transfer``.
* order items: ``order_item_id = l_orderkey * 10 + l_linenumber`` (not unique).
* payments: one per order; ``pending`` for a placed order, else ``Success``; a
  ``failed`` retry (id ``2k+1``) is added when ``o_orderkey % 11 = 0``.
* reviews: one per order line, ``rating = 1 + l_partkey % 5``.
* ``_loaded_at``: the row's business date as a timestamp.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values for the driver data set (see FIXTURES: as-of day and the
# segment thresholds scaled to its order amounts).
DRIVER_AS_OF = "2001-08-01"
DRIVER_HIGH = 2_000_000
DRIVER_MID = 1_000_000


@dataclass(frozen=True)
class RawTables:
    customers: DataFrame
    products: DataFrame
    orders: DataFrame
    order_items: DataFrame
    payments: DataFrame
    reviews: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {
            "raw_customers": self.customers, "raw_products": self.products,
            "raw_orders": self.orders, "raw_order_items": self.order_items,
            "raw_payments": self.payments, "raw_reviews": self.reviews,
        }


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _reader(spark: SparkSession, sf_dir: str):
    return lambda name: read_table(spark, sf_dir, name)


def _money(c: Column) -> Column:
    return c.cast("decimal(10,2)")


def _order_status(o: DataFrame) -> Column:
    return (F.when(o.o_orderkey % 7 == 3, F.lit("RETURNED"))
            .when(o.o_orderstatus == "F", F.lit("Completed"))
            .when(o.o_orderstatus == "O", F.lit("placed"))
            .when(o.o_orderstatus == "P", F.lit("shipped")))


def _payment_method(o: DataFrame) -> Column:
    return (F.when(o.o_orderpriority.isin("1-URGENT", "2-HIGH"), F.lit("credit_card"))
            .when(o.o_orderpriority == "3-MEDIUM", F.lit("paypal"))
            .otherwise(F.lit("bank_transfer")))


def raw_customers(spark: SparkSession, sf_dir: str, read=None) -> DataFrame:
    read = read or _reader(spark, sf_dir)
    c = read("customer").select("c_custkey", "c_name", "c_nationkey")
    n = read("nation").select("n_nationkey", "n_name")
    created = F.date_add(F.lit("1994-01-01").cast("date"), (F.col("c_custkey") % 365).cast("int"))
    return (c.join(n, c.c_nationkey == n.n_nationkey, "inner")
            .select(F.col("c_custkey").alias("customer_id"),
                    F.lit("Customer").alias("first_name"),
                    F.substring("c_name", 10, 1 << 30).alias("last_name"),
                    F.concat("c_name", F.lit("@Example.com")).alias("email"),
                    created.alias("created_at"),
                    F.col("n_name").alias("country"),
                    created.cast("timestamp_ntz").alias("_loaded_at")))


def raw_products(spark: SparkSession, sf_dir: str, read=None) -> DataFrame:
    read = read or _reader(spark, sf_dir)
    p = read("part")
    stamp = F.date_add(F.lit("1994-01-01").cast("date"), (p.p_partkey % 365).cast("int"))
    return p.select(p.p_partkey.alias("product_id"), p.p_name.alias("product_name"),
                    p.p_type.alias("category"), _money(p.p_retailprice).alias("unit_price"),
                    (p.p_partkey % 20 != 0).alias("is_active"),
                    stamp.cast("timestamp_ntz").alias("_loaded_at"))


def raw_orders(spark: SparkSession, sf_dir: str, read=None) -> DataFrame:
    read = read or _reader(spark, sf_dir)
    o = read("orders")
    day = o.o_orderdate.cast("date")
    return (o
            .select(o.o_orderkey.alias("order_id"), o.o_custkey.alias("customer_id"),
                    day.alias("order_date"), _order_status(o).alias("status"),
                    _money(o.o_totalprice).alias("amount"),
                    _payment_method(o).alias("payment_method"),
                    day.cast("timestamp_ntz").alias("_loaded_at")))


def raw_order_items(spark: SparkSession, sf_dir: str, read=None) -> DataFrame:
    read = read or _reader(spark, sf_dir)
    li = read("lineitem")
    return li.select((li.l_orderkey * 10 + li.l_linenumber).alias("order_item_id"),
                     li.l_orderkey.alias("order_id"), li.l_partkey.alias("product_id"),
                     li.l_quantity.cast("int").alias("quantity"),
                     _money(li.l_extendedprice).alias("unit_price"),
                     li.l_shipdate.cast("date").cast("timestamp_ntz").alias("_loaded_at"))


def raw_payments(spark: SparkSession, sf_dir: str, read=None) -> DataFrame:
    read = read or _reader(spark, sf_dir)
    o = read("orders")
    day = o.o_orderdate.cast("date")
    status = F.when(_order_status(o) == "placed", F.lit("pending")).otherwise(F.lit("Success"))
    base = [o.o_orderkey.alias("order_id"), _payment_method(o).alias("payment_method"),
            _money(o.o_totalprice).alias("amount")]
    first = o.select((o.o_orderkey * 2).alias("payment_id"), *base, status.alias("status"),
                     day.alias("payment_date"), day.cast("timestamp_ntz").alias("_loaded_at"))
    retry = (o.filter(o.o_orderkey % 11 == 0)
             .select((o.o_orderkey * 2 + 1).alias("payment_id"), *base,
                     F.lit("failed").alias("status"), day.alias("payment_date"),
                     day.cast("timestamp_ntz").alias("_loaded_at")))
    return first.unionByName(retry)


def raw_reviews(spark: SparkSession, sf_dir: str, read=None) -> DataFrame:
    read = read or _reader(spark, sf_dir)
    li = read("lineitem")
    o = read("orders").select("o_orderkey", "o_custkey")
    return (li.join(o, li.l_orderkey == o.o_orderkey, "left")
            .select((li.l_orderkey * 10 + li.l_linenumber).alias("review_id"), li.l_orderkey.alias("order_id"),
                    li.l_partkey.alias("product_id"), o.o_custkey.alias("customer_id"),
                    (1 + li.l_partkey % 5).cast("int").alias("rating"),
                    li.l_shipdate.cast("date").alias("review_date"),
                    li.l_shipdate.cast("date").cast("timestamp_ntz").alias("_loaded_at")))


class DriverRawTables:
    """The six raw tables over the driver parquet, each built on first use
    (a query that needs only orders lists and reads only ``orders``)."""

    _BUILDERS = {"customers": raw_customers, "products": raw_products, "orders": raw_orders,
                 "order_items": raw_order_items, "payments": raw_payments,
                 "reviews": raw_reviews}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir, self._built, self._scans = spark, sf_dir, {}, {}

    def _read(self, name: str) -> DataFrame:
        """One DataFrame (one file listing) per driver table for this object."""
        if name not in self._scans:
            self._scans[name] = read_table(self._spark, self._dir, name)
        return self._scans[name]

    def __getattr__(self, name):
        builders = type(self)._BUILDERS
        if name not in builders:
            raise AttributeError(name)
        if name not in self._built:
            self._built[name] = builders[name](self._spark, self._dir, read=self._read)
        return self._built[name]

    def as_dict(self) -> dict[str, DataFrame]:
        return {f"raw_{name}": getattr(self, name) for name in self._BUILDERS}


def load_raw(spark: SparkSession, sf_dir: str) -> DriverRawTables:
    """All six raw tables as lazy DataFrames over the driver parquet."""
    return DriverRawTables(spark, sf_dir)


def stream_raw(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> dict[str, DataFrame]:
    """The raw tables but reviews as streams over the driver's own files: each new
    file of a source folder is read once per checkpoint, nothing is copied first.
    ``nation`` is a lookup and stays a batch table."""
    def read(name: str) -> DataFrame:
        table = read_table(spark, sf_dir, name)
        if name == "nation":
            return table
        reader = spark.readStream.schema(table.schema)
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        # a glob: a stream source takes one file by a pattern only, a folder either way
        return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parque[t]")

    builders = DriverRawTables._BUILDERS
    return {f"raw_{e}": builders[e](spark, sf_dir, read=read) for e in builders if e != "reviews"}


# The same mapping as DuckDB SQL, for the oracle (CTE text, no trailing comma).
ADAPTER_SQL = """
raw_customers AS (
  SELECT c.c_custkey AS customer_id, 'Customer' AS first_name,
         substr(c.c_name, 10) AS last_name, concat(c.c_name, '@Example.com') AS email,
         DATE '1994-01-01' + CAST(c.c_custkey % 365 AS INTEGER) AS created_at,
         n.n_name AS country,
         CAST(DATE '1994-01-01' + CAST(c.c_custkey % 365 AS INTEGER) AS TIMESTAMP) AS _loaded_at
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
),
raw_products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
         CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price, p_partkey % 20 <> 0 AS is_active,
         CAST(DATE '1994-01-01' + CAST(p_partkey % 365 AS INTEGER) AS TIMESTAMP) AS _loaded_at
  FROM part
),
mapped_orders AS (
  SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day,
         CASE WHEN o_orderkey % 7 = 3 THEN 'RETURNED'
              WHEN o_orderstatus = 'F' THEN 'Completed'
              WHEN o_orderstatus = 'O' THEN 'placed'
              WHEN o_orderstatus = 'P' THEN 'shipped' END AS status,
         CAST(o_totalprice AS DECIMAL(10,2)) AS amount,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'credit_card'
              WHEN o_orderpriority = '3-MEDIUM' THEN 'paypal'
              ELSE 'bank_transfer' END AS payment_method
  FROM orders
),
raw_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, day AS order_date, status,
         amount, payment_method, CAST(day AS TIMESTAMP) AS _loaded_at
  FROM mapped_orders
),
raw_order_items AS (
  SELECT l_orderkey * 10 + l_linenumber AS order_item_id, l_orderkey AS order_id,
         l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
         CAST(l_extendedprice AS DECIMAL(10,2)) AS unit_price,
         CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS _loaded_at
  FROM lineitem
),
raw_payments AS (
  SELECT o_orderkey * 2 AS payment_id, o_orderkey AS order_id, payment_method, amount,
         CASE WHEN status = 'placed' THEN 'pending' ELSE 'Success' END AS status,
         day AS payment_date, CAST(day AS TIMESTAMP) AS _loaded_at
  FROM mapped_orders
  UNION ALL
  SELECT o_orderkey * 2 + 1, o_orderkey, payment_method, amount, 'failed', day,
         CAST(day AS TIMESTAMP)
  FROM mapped_orders WHERE o_orderkey % 11 = 0
),
raw_reviews AS (
  SELECT l.l_orderkey * 10 + l.l_linenumber AS review_id, l.l_orderkey AS order_id, l.l_partkey AS product_id,
         o.o_custkey AS customer_id, CAST(1 + l.l_partkey % 5 AS INTEGER) AS rating,
         CAST(l.l_shipdate AS DATE) AS review_date,
         CAST(CAST(l.l_shipdate AS DATE) AS TIMESTAMP) AS _loaded_at
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""
