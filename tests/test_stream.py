"""Streaming: restart with one checkpoint never duplicates; silver stream
applies drop/warn rules and publishes the counts."""

import os
import tempfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.operators.quality import Expectation, apply_expectations
from martlet.sources.adapter import raw_orders
from martlet.sources.schemas import raw_schema
from martlet.streaming import medallion


def test_bronze_restart_no_duplicates(spark, smoke_dir):
    base = tempfile.mkdtemp(prefix="martlet-stream-")
    source = os.path.join(base, "landing")
    paths = medallion.StreamPaths(source, os.path.join(base, "bronze"), os.path.join(base, "ckpt"))
    orders = raw_orders(spark, smoke_dir)
    first = orders.filter("order_date < DATE '1998-01-01'")
    second = orders.filter("order_date >= DATE '1998-01-01'")
    first.coalesce(1).write.mode("append").parquet(source)
    schema = raw_schema("raw_orders", T.LongType())
    medallion.bronze_stream(spark, schema, paths, name="restart_a")
    n1 = spark.read.parquet(paths.sink).count()
    assert n1 == first.count()
    second.coalesce(1).write.mode("append").parquet(source)
    medallion.bronze_stream(spark, schema, paths, name="restart_b")      # same checkpoint
    medallion.bronze_stream(spark, schema, paths, name="restart_c")      # nothing new
    sink = spark.read.parquet(paths.sink)
    assert sink.count() == orders.count()
    assert sink.groupBy("order_id").count().filter("count > 1").count() == 0


def test_silver_stream_orders(spark, smoke_dir):
    base = tempfile.mkdtemp(prefix="martlet-silver-")
    source = os.path.join(base, "bronze")
    raw_orders(spark, smoke_dir).write.parquet(source)
    paths = medallion.StreamPaths(source, os.path.join(base, "silver"), os.path.join(base, "ckpt"))
    q = medallion.silver_stream(spark, "orders", raw_schema("raw_orders", T.LongType()), paths)
    out = spark.read.parquet(paths.sink)
    assert out.count() == raw_orders(spark, smoke_dir).count()
    assert set(out.columns) == {"order_id", "customer_id", "status", "order_date", "amount"}
    observed = q.lastProgress["observedMetrics"]["silver_orders_expectations"]
    assert observed["rows"] == out.count() and observed["valid_order_id"] == 0


def test_events_stream_expectations(spark, smoke_dir):
    base = tempfile.mkdtemp(prefix="martlet-events-")
    events = spark.read.parquet(f"{smoke_dir}/events.parquet")
    rules = [Expectation("no_errors", "event_type <> 'error'", "drop"),
             Expectation("value_cap", "value <= 200", "warn")]
    events.write.parquet(f"{base}/landing")          # a file source reads a folder
    stream = spark.readStream.schema(events.schema).parquet(f"{base}/landing")
    kept = apply_expectations(stream, rules, observation="events_rules")
    q = (kept.writeStream.format("parquet").option("checkpointLocation", f"{base}/ckpt")
         .trigger(availableNow=True).start(f"{base}/out"))
    q.awaitTermination(300)
    out = spark.read.parquet(f"{base}/out")
    expected = events.filter(F.coalesce(F.col("event_type") != "error", F.lit(False))).count()
    assert out.count() == expected
    assert out.filter("event_type = 'error'").count() == 0


def test_build_medallion_and_marts(spark, smoke_dir):
    from martlet.plans import build
    from martlet.plans.platform import Platform
    from martlet.sources.adapter import load_raw

    base = tempfile.mkdtemp(prefix="martlet-build-")
    out = build.build_medallion(spark, load_raw(spark, smoke_dir), base=f"{base}/m",
                                high=2_000_000, mid=1_000_000)
    tables = [k for k in out if k != "expectations"]
    assert len(tables) == 13
    assert out["expectations"]["orders"]["rows"] == raw_orders(spark, smoke_dir).count()
    marts_out = build.build_marts(spark, Platform.from_driver(spark, smoke_dir), base=f"{base}/k")
    assert spark.read.parquet(marts_out["fct_orders"]).count() == raw_orders(spark, smoke_dir).count()
    fct_schema = spark.read.parquet(marts_out["fct_orders"]).schema
    assert fct_schema["amount_paid"].dataType == T.DecimalType(18, 2)
    report = spark.read.parquet(marts_out["quality_report"])
    models = {r.model for r in report.select("model").distinct().collect()}
    assert {"fct_orders", "mart_customer_segments", "rfm_customer_features"} <= models
    failed = {(r.model, r.test, r.column_name) for r in report.filter("status = 'fail'").collect()}
    assert ("stg_order_items", "unique", "order_item_id") in failed       # known duplicate keys


def test_incremental_append_and_freshness(spark, smoke_dir):
    """Orders keep flowing (appended with continued keys, stamped now) while
    payments stop: freshness reports orders pass, payments error."""
    from martlet.operators.quality import source_freshness
    from martlet.sources.adapter import raw_payments
    from martlet.sources.ingest import append_batch, next_surrogate_keys, write_table

    base = tempfile.mkdtemp(prefix="martlet-incr-")
    orders = raw_orders(spark, smoke_dir)
    write_table(orders, f"{base}/raw_orders")
    existing = spark.read.parquet(f"{base}/raw_orders")
    batch = next_surrogate_keys(existing, existing.limit(3).drop("_loaded_at"), "order_id")
    append_batch(batch.select(*[c for c in orders.columns if c != "_loaded_at"]), f"{base}/raw_orders")
    after = spark.read.parquet(f"{base}/raw_orders")
    assert after.count() == orders.count() + 3
    assert after.groupBy("order_id").count().filter("count > 1").count() == 0
    rep = {r.source: r.status for r in source_freshness(
        {"raw_orders": after, "raw_payments": raw_payments(spark, smoke_dir)}).collect()}
    assert rep == {"raw_orders": "pass", "raw_payments": "error"}


def test_processing_time_trigger_picks_up_new_files(spark, smoke_dir):
    base = tempfile.mkdtemp(prefix="martlet-cont-")
    source = os.path.join(base, "landing")
    orders = raw_orders(spark, smoke_dir)
    orders.filter("order_date < DATE '1998-01-01'").coalesce(1).write.parquet(source)
    paths = medallion.StreamPaths(source, os.path.join(base, "bronze"), os.path.join(base, "ckpt"))
    q = medallion.bronze_query(spark, raw_schema("raw_orders", T.LongType()), paths, name="cont",
                               trigger={"processingTime": "200 milliseconds"})
    try:
        q.processAllAvailable()
        orders.filter("order_date >= DATE '1998-01-01'").coalesce(1).write.mode("append").parquet(source)
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(paths.sink).count() == orders.count()


def test_cli_build(spark, smoke_dir, tmp_path):
    from martlet.__main__ import main

    result = main(["build", "--source", smoke_dir, "--out", str(tmp_path / "job"),
                   "--buckets", "4"], spark=spark)
    assert len(result["medallion"]) == 13 and "fct_orders" in result["marts"]
    assert result["quality"]["fail"] >= 1          # the known non-unique order_item_id
    assert set(result["expectations"]) == {"customers", "orders", "order_items", "products", "payments"}
