"""Sources and sinks on the seed-shaped fixtures."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from martlet.plans import metrics as M
from martlet.plans.platform import Platform
from martlet.sources import ingest
from martlet.sources.schemas import raw_schema
from tests.fixtures import ORDERS, seed_raw


def test_typed_table_from_rows_and_scan_with_schema(spark, tmp_path):
    schema = raw_schema("raw_orders")
    df = ingest.create_typed_table(spark, ORDERS, schema, path=str(tmp_path / "orders"), name="o")
    assert df.count() == len(ORDERS)
    back = ingest.scan_source(spark, str(tmp_path / "orders"), schema)
    assert back.schema == schema and back.count() == len(ORDERS)


def test_param_source_default_and_override(spark):
    assert ingest.param_source(spark, "martlet.test_dir", "/default") == "/default"
    spark.conf.set("martlet.test_dir", "/configured")
    try:
        assert ingest.param_source(spark, "martlet.test_dir", "/default") == "/configured"
    finally:
        spark.conf.unset("martlet.test_dir")


def test_bronze_copy_view_and_audit(spark, tmp_path):
    raw = seed_raw(spark)
    copy = ingest.bronze_copy(spark, raw.orders, "bronze_orders", str(tmp_path / "b"))
    assert copy.exceptAll(raw.orders).count() == 0
    view = ingest.materialize_view(raw.products, "seed_products_view")
    assert spark.sql("SELECT count(*) AS n FROM seed_products_view").collect()[0].n == 3
    assert view.count() == 3
    audit = {r.tbl: (r.rows, r.last_loaded) for r in ingest.load_audit(raw.as_dict()).collect()}
    assert audit["raw_orders"][0] == len(ORDERS) and audit["raw_reviews"][0] == 3
    assert audit["raw_orders"][1] == dt.datetime(2026, 3, 31)


def test_append_keeps_one_stamp_type(spark, tmp_path):
    raw = seed_raw(spark)
    path = str(tmp_path / "orders")
    ingest.write_table(raw.orders, path)
    batch = ingest.next_surrogate_keys(raw.orders, raw.orders.drop("_loaded_at"), "order_id")
    ingest.append_batch(batch.select(*[c for c in raw.orders.columns if c != "_loaded_at"]), path)
    back = spark.read.parquet(path)
    assert back.schema["_loaded_at"].dataType.simpleString() == "timestamp_ntz"
    assert sorted(r.order_id for r in back.filter("order_id > 105").collect()) == \
        list(range(106, 112))


def test_metric_grains(spark):
    p = Platform(seed_raw(spark), as_of="2026-03-31")
    models = {"fct_orders": p.fct_orders, "dim_customers": p.dim_customers}
    q = {r.metric_time: r.total_recognised_revenue for r in
         M.metric_query(models, ["total_recognised_revenue"], grain="quarter").collect()}
    assert q[dt.date(2026, 1, 1)] == D("670.00")
    y = {r.metric_time: r.total_orders for r in
         M.metric_query(models, ["total_orders"], grain="year").collect()}
    assert y == {dt.date(2025, 1, 1): 2, dt.date(2026, 1, 1): 4}
    spine = p.fct_orders.agg(F.min("order_date").alias("start"),
                             F.date_add(F.max("order_date"), 1).alias("end"))
    from martlet.operators.marts import time_spine_daily
    filled = M.metric_time_spine(models, "total_recognised_revenue",
                                 time_spine_daily("2026-03-31", bounds=spine))
    days = filled.collect()
    assert len(days) == (dt.date(2026, 3, 25) - dt.date(2025, 6, 1)).days + 1
    assert sum(r.total_recognised_revenue for r in days) == D("670.00")


def test_append_casts_batch_to_table_types(spark, tmp_path):
    raw = seed_raw(spark)
    path = str(tmp_path / "orders")
    ingest.write_table(raw.orders, path)
    wide = raw.orders.drop("_loaded_at").withColumn("order_id", F.col("order_id").cast("bigint") + 1000)
    ingest.append_batch(wide, path)
    for f in spark.read.parquet(path).schema.fields:
        assert f.dataType == raw.orders.schema[f.name].dataType
    assert spark.read.parquet(path).count() == 2 * len(ORDERS)
