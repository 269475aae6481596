"""The batch ledger and the incrementally maintained gold tables."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from martlet.operators import marts, staging
from martlet.sources import adapter
from martlet.sources.ledger import Ledger, append_batch_once
from martlet.streaming import incremental, medallion


@pytest.fixture
def base():
    return tempfile.mkdtemp(prefix="martlet-ledger-")


def rows_of(df, *columns):
    return sorted(map(str, df.select(*(columns or df.columns)).collect()))


# ------------------------------------------------------------------ ledger
def test_retry_and_crashed_write_change_nothing(spark, base):
    book = Ledger(spark, base)
    first = spark.range(10).withColumn("v", F.lit("a"))
    assert append_batch_once(book, "t", first, "b0")
    broken = spark.range(100, 200, numPartitions=4).withColumn(
        "v", F.when(F.col("id") == 190, F.raise_error(F.lit("lost"))).otherwise("b"))
    with pytest.raises(Exception, match="lost"):
        append_batch_once(book, "t", broken, "b1")            # some files were written
    book.stage("b1", "t", first.withColumn("_loaded_at", F.localtimestamp()))  # written, never committed
    assert book.read("t").count() == 10 and not book.has("b1")
    good = spark.range(100, 200).withColumn("v", F.lit("b"))
    assert append_batch_once(book, "t", good, "b1")
    stamps = book.read("t").select("_loaded_at").distinct().collect()
    for _ in range(2):
        assert not append_batch_once(Ledger(spark, base), "t", good, "b1")
    out = book.read("t")
    assert out.count() == 110 and out.columns == ["id", "v", "_loaded_at"]
    assert sorted(out.select("_loaded_at").distinct().collect()) == sorted(stamps)  # the first commit's stamp stays


def test_racing_commits_of_one_batch_count_once(spark, base):
    book = Ledger(spark, base)
    folders = [book.stage("b", "t", spark.range(5).withColumn("writer", F.lit(w))) for w in (1, 2)]
    for folder in folders:
        book.commit("b", {"t": folder})
    assert {r.writer for r in book.read("t").collect()} == {1} and book.read("t").count() == 5


def test_batches_take_the_table_schema(spark, base):
    book = Ledger(spark, base)
    append_batch_once(book, "t", spark.range(3), "b0")
    append_batch_once(book, "t", spark.range(3).select(F.col("id").cast("int").alias("id")), "b1")
    assert book.read("t").schema["id"].dataType.typeName() == "long"
    with pytest.raises(ValueError, match="do not match"):
        append_batch_once(book, "t", spark.range(3).withColumn("extra", F.lit(1)), "b2")
    assert book.read("none", "a long").count() == 0


# ------------------------------------------------------------------ gold
def silver_of(spark, smoke_dir):
    raw = adapter.load_raw(spark, smoke_dir).as_dict()
    return {e: staging.silver(e, raw[f"raw_{e}"]) for e in ("customers", "orders", "order_items", "payments")}


def assert_gold(store, silver):
    fct = marts.gold_fct_orders(silver["orders"], silver["order_items"], silver["payments"])
    dim = marts.gold_dim_customers(silver["customers"], silver["orders"], silver["payments"])
    money = {"items_total", "amount_paid", "total_lifetime_value", "daily_revenue", "avg_order_value"}

    def plain(df):
        return df.select(*[F.col(c).cast("decimal(18,2)").alias(c) if c in money else c for c in sorted(df.columns)])

    for got, want in ((store.gold_fct_orders(), fct), (store.gold_dim_customers(silver["customers"]), dim),
                      (store.gold_fct_revenue(), marts.gold_fct_revenue(fct))):
        assert rows_of(plain(got)) == rows_of(plain(want))


def test_late_and_early_rows_equal_a_full_recompute(spark, smoke_dir, base):
    silver = silver_of(spark, smoke_dir)
    store = incremental.GoldStore(spark, base, block_rows=1000, compact_after=3)
    for n in range(4):  # every table is cut by another hash: all orders of arrival occur
        part = {e: silver[e].where(F.pmod(F.xxhash64(F.lit(e), f"{e.rstrip('s')}_id"), F.lit(4)) == n)
                for e in ("orders", "order_items", "payments")}
        changes = incremental.order_changes(part["orders"], part["order_items"], part["payments"])
        assert store.refresh(f"b{n}", changes) is not None
        assert store.refresh(f"b{n}", changes) is None
    assert len(store.ledger.live()) < 4  # a snapshot was taken on the way
    assert_gold(store, silver)


def test_work_is_in_proportion_to_the_change(spark, smoke_dir, base):
    silver = silver_of(spark, smoke_dir)
    top = silver["orders"].agg(F.max("order_id")).first()[0]
    cut = top - top // 100  # the newest 1% of order ids
    old, new = (incremental.order_changes(*[silver[e].where(cond) for e in ("orders", "order_items", "payments")])
                for cond in (F.col("order_id") <= cut, F.col("order_id") > cut))
    store = incremental.GoldStore(spark, base, block_rows=max(1, top // 200))
    first = store.refresh("old", old)
    second = store.refresh("new", new)
    total = store.ledger.read("orders", incremental.ORDERS).count()
    touched = silver["orders"].where(F.col("order_id") > cut).count()
    assert len(first.blocks) >= 190 and len(second.blocks) <= 4
    assert store.known(second.blocks).count() <= 0.03 * total  # rows read (partitions pruned)
    assert "PartitionFilters: [block" in store.known(second.blocks)._jdf.queryExecution().toString()
    for table, schema in (("orders", incremental.ORDERS), ("customers", incremental.CUSTOMERS), ("days", incremental.DAYS)):
        assert store.ledger.staged(second.folders[table], schema).count() <= touched  # rows written
    assert_gold(store, silver)


def test_a_refresh_joins_once_and_shuffles_by_order_only(spark, base, monkeypatch):
    def changes(ids):
        day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 5).cast("int"))
        orders = spark.createDataFrame([(i,) for i in ids], "id long").select(
            F.col("id").alias("order_id"), (F.col("id") % 3).alias("customer_id"), F.lit("completed").alias("status"),
            day.alias("order_date"), F.lit(1).cast("decimal(10,2)").alias("amount"))
        paid = orders.select("order_id", F.lit("success").alias("payment_status"), "amount")
        return incremental.order_changes(orders, None, paid)

    plans = {}
    store = incremental.GoldStore(spark, base, block_rows=10)
    store.refresh("b0", changes(range(60)))
    real = store.ledger.stage

    def stage(batch_id, table, rows, *more):
        plans[batch_id, table] = rows._jdf.queryExecution().executedPlan().toString()
        return real(batch_id, table, rows, *more)

    monkeypatch.setattr(store.ledger, "stage", stage)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        second = store.refresh("b1", changes([*range(30, 90), 30]))
        store.compact()
        now = store.ledger.staged(second.folders["orders"], incremental.ORDERS)
        joined = store._differences(now, second.blocks)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Join" not in plans["b1", "customers"] and "Join" not in plans["b1", "days"]
    assert joined.count("Exchange hashpartitioning(order_id") == 3 == joined.count("Exchange")  # known, and the batch for each join
    assert plans["snapshot-2", "orders"].count("Exchange") == 1
    days = store.gold_fct_revenue().orderBy("order_date").collect()
    assert [(r.number_of_orders, int(r.daily_revenue)) for r in days] == [(18, 25), *[(18, 24)] * 4]
    assert store.gold_fct_orders().count() == 90


def test_crash_before_the_commit_is_retried_whole(spark, smoke_dir, base, monkeypatch):
    silver = silver_of(spark, smoke_dir)
    changes = incremental.order_changes(silver["orders"], silver["order_items"], silver["payments"])
    store = incremental.GoldStore(spark, base)
    real = store.ledger.commit
    monkeypatch.setattr(store.ledger, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost driver")))
    with pytest.raises(RuntimeError, match="lost driver"):
        store.refresh("b0", changes)
    monkeypatch.setattr(store.ledger, "commit", real)
    assert store.gold_fct_orders().count() == 0
    store.refresh("b0", changes)
    assert_gold(store, silver)


def test_gold_stream_takes_each_micro_batch_once(spark, smoke_dir, base):
    source = f"{base}/source"
    os.makedirs(source)
    tables = {n: spark.read.parquet(f"{smoke_dir}/{n}.parquet") for n in ("orders", "lineitem", "customer", "nation", "part")}
    for n in ("customer", "nation", "part"):
        tables[n].write.parquet(f"{source}/{n}.parquet")
    early = F.col("o_orderkey") % 3 != 0
    tables["orders"].where(early).write.parquet(f"{source}/orders.parquet")
    tables["lineitem"].where("l_orderkey % 2 = 0").write.parquet(f"{source}/lineitem.parquet")
    store = incremental.GoldStore(spark, f"{base}/gold", block_rows=500)

    def run():
        query = incremental.gold_stream(store, adapter.stream_raw(spark, source), f"{base}/checkpoint")
        medallion.await_streams([query])

    run()
    tables["orders"].where(~early).write.mode("append").parquet(f"{source}/orders.parquet")
    tables["lineitem"].where("l_orderkey % 2 <> 0").write.mode("append").parquet(f"{source}/lineitem.parquet")
    run()
    run()  # nothing new
    assert len(store.ledger.committed()) == 2
    again = spark.range(0).select(F.lit(1).cast("long").alias("order_id"))
    assert store.refresh("gold-0", again) is None  # a micro-batch run again is known
    assert_gold(store, silver_of(spark, smoke_dir))
