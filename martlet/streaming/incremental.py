"""Gold tables maintained from changes instead of recomputed.

The state is three tables of decomposable partial rows, kept by a
:class:`~martlet.sources.ledger.Ledger` that commits all three at once:

* ``orders``: per order id, its columns and the sums of its items and successful
  payments, partitioned by ``block`` (order id by ``block_rows``; surrogate keys grow,
  so new and recently changed orders share few blocks);
* ``customers``: per customer, order count, lifetime value, first and last day;
* ``days``: per day, completed orders and revenue.

A batch of silver rows is reduced to one row per touched order (one shuffle, combined
on the map side).  Only the touched blocks of ``orders`` are read, and only the touched
orders in them, to see what each order was before; the difference to what it is now
goes to the customer and day partials as signed sums.  A batch appends one row per
touched order, customer and day and rewrites nothing, so it reads and writes in
proportion to the change.  Items and payments may arrive before or after their order.
``compact`` merges the partial rows into a snapshot.

A retried batch id does nothing; a crash before the commit leaves state that no reader
sees, and the retry starts from the committed state.

Defined cases: an order id names one order (declared unique); rows without an order id
belong to no order; items and payments of an order that has not arrived count once it
arrives; statuses, days and customers may be null and form groups of their own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.functions import exact_ratio, money_zero
from martlet.operators import marts, staging
from martlet.sources.ingest import materialize_table
from martlet.sources.ledger import Ledger

MONEY = "decimal(28,2)"
CHANGES = (f"order_id long, customer_id long, status string, order_date date, amount decimal(10,2), here int, "
           f"number_of_items long, items_total {MONEY}, amount_paid {MONEY}")
ORDERS = f"{CHANGES}, block long"
CUSTOMERS = f"customer_id long, number_of_orders long, ltv {MONEY}, first_order_date date, most_recent_order_date date"
DAYS = f"order_date date, number_of_orders long, daily_revenue {MONEY}"


def order_changes(orders: DataFrame | None = None, order_items: DataFrame | None = None,
                  payments: DataFrame | None = None) -> DataFrame:
    """Silver rows of any of the three tables as rows of one shape; works on streams."""
    parts = []
    if orders is not None:
        parts.append(orders.select(
            F.col("order_id").cast("long").alias("order_id"), F.col("customer_id").cast("long").alias("customer_id"), "status",
            "order_date", F.col("amount").cast("decimal(10,2)").alias("amount"), F.lit(1).alias("here"), *_sums()))
    if order_items is not None:
        parts.append(order_items.select(
            F.col("order_id").cast("long").alias("order_id"), *_no_order(),
            *_sums(F.col("order_item_id").isNotNull().cast("long"), F.col("line_total"))))
    if payments is not None:
        paid = F.when(F.col("payment_status") == "success", F.col("amount"))
        parts.append(payments.select(F.col("order_id").cast("long").alias("order_id"), *_no_order(), *_sums(paid=paid)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.where("order_id is not null")


def _no_order() -> list:
    return [F.lit(None).cast(t).alias(c) for c, t in (("customer_id", "long"), ("status", "string"), ("order_date", "date"),
                                                      ("amount", "decimal(10,2)"))] + [F.lit(0).alias("here")]


def _sums(items=None, total=None, paid=None) -> list:
    def made(c, kind):
        return F.coalesce((F.lit(0) if c is None else c).cast(kind), F.lit(0).cast(kind))

    return [made(items, "long").alias("number_of_items"), made(total, MONEY).alias("items_total"), made(paid, MONEY).alias("amount_paid")]


def merged_orders(partials: DataFrame, *more: str) -> DataFrame:
    """One row per order id from any number of partial rows."""
    return partials.groupBy("order_id", *more).agg(
        *[F.max(c).alias(c) for c in ("customer_id", "status", "order_date", "amount", "here")],
        F.sum("number_of_items").alias("number_of_items"),
        *[F.sum(c).cast(MONEY).alias(c) for c in ("items_total", "amount_paid")])


def merged_customers(partials: DataFrame) -> DataFrame:
    return partials.groupBy("customer_id").agg(
        F.sum("number_of_orders").alias("number_of_orders"), F.sum("ltv").cast(MONEY).alias("ltv"),
        F.min("first_order_date").alias("first_order_date"), F.max("most_recent_order_date").alias("most_recent_order_date"))


def merged_days(partials: DataFrame) -> DataFrame:
    return partials.groupBy("order_date").agg(F.sum("number_of_orders").alias("number_of_orders"),
                                              F.sum("daily_revenue").cast(MONEY).alias("daily_revenue"))


@dataclass(frozen=True)
class Refresh:
    """What one batch touched: blocks read, and the folders it appended."""

    blocks: tuple[int, ...]
    folders: dict[str, str]


class GoldStore:
    """Incrementally maintained gold tables below ``path``."""

    def __init__(self, spark: SparkSession, path: str, block_rows: int = 1_000_000, compact_after: int | None = None):
        self._spark, self.ledger = spark, Ledger(spark, path)
        self._block_rows, self._compact_after = block_rows, compact_after

    # -------------------------------------------------------------- refresh
    def refresh(self, batch_id: str, changes: DataFrame) -> Refresh | None:
        """Take in ``changes`` (:func:`order_changes`); ``None`` if the batch was
        committed before."""
        if self.ledger.has(batch_id):
            return None
        touched = (merged_orders(changes)
                   .withColumn("block", F.floor(F.col("order_id") / self._block_rows).cast("long")))
        folders = {"orders": self.ledger.stage(batch_id, "orders", touched.repartition("block"), "block")}
        now = self.ledger.staged(folders["orders"], ORDERS)
        blocks = sorted(r.block for r in now.select("block").distinct().collect())
        # read by both aggregates, computed once
        moved = materialize_table(self._spark, self._differences(now, blocks), "gold-moved")
        customers = merged_customers(moved.select(
            "customer_id", F.col("arrived").alias("number_of_orders"), F.col("paid").alias("ltv"),
            F.when(F.col("arrived") > 0, F.col("order_date")).alias("first_order_date"),
            F.when(F.col("arrived") > 0, F.col("order_date")).alias("most_recent_order_date")))
        days = merged_days(moved.where("status = 'completed'").select(
            "order_date", F.col("arrived").alias("number_of_orders"), F.col("paid").alias("daily_revenue")))
        folders["customers"] = self.ledger.stage(batch_id, "customers", customers.select(*_names(CUSTOMERS)))
        folders["days"] = self.ledger.stage(batch_id, "days", days.select(*_names(DAYS)))
        self.ledger.commit(batch_id, folders)
        if self._compact_after and len(self.ledger.live()) > self._compact_after:
            self.compact()
        return Refresh(tuple(blocks), folders)

    def known(self, blocks) -> DataFrame:
        """Committed partial rows of these order blocks (partition pruning)."""
        return self.ledger.read("orders", ORDERS).where(F.col("block").isin(list(blocks)))

    def _differences(self, now: DataFrame, blocks) -> DataFrame:
        """Per touched order that is here after the batch: ``arrived`` (1 if it came
        with it) and the change of its paid sum as the gold tables see it."""
        # a block follows from its order ids, so the order id alone partitions both joins and the merge
        before = merged_orders(self.known(blocks).join(now.select("order_id"), "order_id", "left_semi"))
        was = before.select("order_id", *[F.col(c).alias(f"was_{c}") for c in ("customer_id", "status", "order_date", "here", "amount_paid")])
        both = now.join(was, "order_id", "left")
        here = F.coalesce("was_here", F.lit(0))
        paid = F.coalesce("was_amount_paid", F.lit(0).cast(MONEY))
        return both.where((here == 1) | (F.col("here") == 1)).select(
            *[F.when(here == 1, F.col(f"was_{c}")).otherwise(F.col(c)).alias(c) for c in ("customer_id", "status", "order_date")],
            (1 - here).cast("long").alias("arrived"),
            F.when(here == 1, F.col("amount_paid")).otherwise(F.col("amount_paid") + paid).cast(MONEY).alias("paid"))

    def compact(self) -> None:
        """Replace all live partial rows by one snapshot, a batch like any other."""
        live = self.ledger.live()
        included = sorted({b for e in live for b in (e.batch_id, *e.included)})
        batch_id = f"snapshot-{len(included)}"
        if self.ledger.has(batch_id):
            return
        # dealt by block before the merge: one shuffle serves the merge and the write
        orders = merged_orders(self.ledger.read("orders", ORDERS).repartition("block"), "block")
        self.ledger.commit(batch_id, {
            "orders": self.ledger.stage(batch_id, "orders", orders, "block"),
            "customers": self.ledger.stage(batch_id, "customers", merged_customers(self.ledger.read("customers", CUSTOMERS))
                                           .select(*_names(CUSTOMERS))),
            "days": self.ledger.stage(batch_id, "days", merged_days(self.ledger.read("days", DAYS)).select(*_names(DAYS)))}, included)

    # ----------------------------------------------------------- gold tables
    def gold_fct_orders(self) -> DataFrame:
        return (merged_orders(self.ledger.read("orders", ORDERS)).where("here = 1")
                .select("order_id", "customer_id", "status", "order_date", "amount", "number_of_items",
                        F.col("items_total").cast("decimal(18,2)").alias("items_total"),
                        F.col("amount_paid").cast("decimal(18,2)").alias("amount_paid")))

    def gold_dim_customers(self, silver_customers: DataFrame, high=marts.DEFAULT_HIGH, mid=marts.DEFAULT_MID) -> DataFrame:
        totals = merged_customers(self.ledger.read("customers", CUSTOMERS))
        ltv = F.coalesce(F.col("ltv").cast("decimal(18,2)"), money_zero())
        return (silver_customers.join(totals, "customer_id", "left")
                .select("customer_id", "first_name", "last_name", "email", "country", "created_date",
                        F.coalesce("number_of_orders", F.lit(0).cast("long")).alias("number_of_orders"),
                        "first_order_date", "most_recent_order_date", ltv.alias("total_lifetime_value"),
                        marts.segment_of(ltv, high, mid).alias("customer_segment")))

    def gold_fct_revenue(self) -> DataFrame:
        return (merged_days(self.ledger.read("days", DAYS)).where("number_of_orders > 0")
                .select("order_date", F.date_format("order_date", "yyyy-MM").alias("revenue_month"), "daily_revenue",
                        "number_of_orders", exact_ratio("daily_revenue", "number_of_orders", 2).alias("avg_order_value")))


def _names(ddl: str) -> list[str]:
    return [c.split()[0] for c in ddl.replace("(28,2)", "").replace("(10,2)", "").split(", ")]


def gold_stream(store: GoldStore, raw: dict[str, DataFrame], checkpoint: str, name: str = "gold", trigger: dict | None = None):
    """Start (do not wait for) one streaming query over the raw streams of orders,
    order items and payments: silver rules, then a refresh per micro-batch.  The
    micro-batch id is the batch id, so a batch that is run again after a failure is
    taken once.  Reads the source folders themselves; nothing is landed in between."""
    silver = {e: staging.silver(e, raw[f"raw_{e}"]) for e in ("orders", "order_items", "payments")}
    changes = order_changes(silver["orders"], silver["order_items"], silver["payments"])
    return (changes.writeStream.queryName(name).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .foreachBatch(lambda rows, epoch: store.refresh(f"{name}-{epoch}", rows) and None).start())
