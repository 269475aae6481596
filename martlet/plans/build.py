"""Whole-graph builds: write every table of a layer in dependency order and
serve downstream models from the written copies (table materialisation).

* :func:`build_raw` — the six typed raw tables.
* :func:`build_medallion` — 5 bronze copies, 5 silver tables (expectations
  applied, violation counts observed in the same pass), 3 gold tables.
* :func:`build_marts` — platform marts through their contracts, then the
  consumer marts and feature tables over the *written* marts (each layer is
  read back, so lineage stays short and a lost executor re-reads files
  rather than recomputing raw), then the declared tests as one report.

Folders live under ``base`` (default: a fresh folder under the shared
``spark.checkpoint.dir``).  Returns {table: path} plus expectation metrics.
"""

from __future__ import annotations

import zlib
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import types as T

from martlet.operators import consumers, features, marts, staging
from martlet.operators.contracts import contract_cast
from martlet.operators.quality import quality_report
from martlet.operators.skew import parts_for
from martlet.plans.platform import Platform
from martlet.session import scratch_path
from martlet.sources.adapter import RawTables
from martlet.sources.schemas import CONTRACTS
from martlet.sources.ingest import materialize_table, write_table

ENTITIES = ("customers", "orders", "order_items", "products", "payments")


def _write(spark: SparkSession, df: DataFrame, base: str, name: str, out: dict) -> DataFrame:
    path = f"{base}/{name}"
    read = materialize_table(spark, df, name, path)
    out[name] = path
    return read


def _concurrently(tasks: dict, max_workers: int = 4) -> dict:
    """Run independent table builds as concurrent Spark jobs (driver threads
    only submit; the work is distributed by Spark).  Re-raises the first
    failure."""
    with ThreadPoolExecutor(max_workers=max_workers) as pool:
        futures = {name: pool.submit(fn) for name, fn in tasks.items()}
        return {name: f.result() for name, f in futures.items()}


def _write_bucketed(spark: SparkSession, df: DataFrame, base: str, name: str, out: dict,
                    buckets: int, key: str) -> DataFrame:
    """Write ``df`` as an external table bucketed (and sorted) by ``key``.

    Two tables bucketed by the same key into the same number of buckets join
    and group by that key without any shuffle: the partitioning is in the
    files.  The table name follows from the build folder; the data lives under
    ``base`` (shared storage), the catalog holds only the bucket spec."""
    path = f"{base}/{name}"
    table = f"martlet_{zlib.crc32(base.encode()):08x}_{name}"
    (df.write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table))
    out[name] = path
    return spark.table(table)


ORDER_TABLES = ("stg_orders", "stg_order_items", "stg_payments")


def build_order_layout(spark: SparkSession, platform: Platform, base: str | None = None, buckets: int = 200) -> Platform:
    """Write the staged orders, order items and payments bucketed and sorted by
    ``order_id`` and return a platform over them.

    The order fact, the line-level product marts and every other join or aggregate on
    the order key then read their partitioning from the files: items and payments are
    shuffled once, when the layout is written, however many marts are built from it.
    Each bucket is written by one task (the rows are dealt by the bucket's own hash), and
    an order, the largest group of the key, has a bounded number of lines.  ``buckets`` is
    the least number: one task reads a whole bucket, so the number follows the rows of the
    largest table and the memory of a task does not."""
    base = base or scratch_path(spark, "order-layout")
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
    buckets = min(most, max(parts_for(getattr(platform, name), buckets) for name in ORDER_TABLES))
    out = Platform(platform.raw, platform.as_of, platform.high, platform.mid)
    tables = _concurrently({name: (lambda name=name: _write_bucketed(
        spark, getattr(platform, name).repartition(buckets, "order_id"), base, name, {}, buckets, "order_id"))
        for name in ORDER_TABLES})
    out.__dict__.update(tables)
    return out


def build_raw(spark: SparkSession, raw: RawTables, base: str | None = None) -> dict[str, str]:
    base = base or scratch_path(spark, "raw")
    out = {}
    for name, df in raw.as_dict().items():
        write_table(df, f"{base}/{name}")
        out[name] = f"{base}/{name}"
    return out


def build_medallion(spark: SparkSession, raw: RawTables, base: str | None = None,
                    high=marts.DEFAULT_HIGH, mid=marts.DEFAULT_MID) -> dict:
    """13 tables: bronze_*, silver_*, gold_dim_customers, gold_fct_orders,
    gold_fct_revenue.  ``result['expectations']`` holds per-rule counts."""
    base = base or scratch_path(spark, "medallion")
    out: dict = {}
    bronze_src = {"customers": raw.customers, "orders": raw.orders,
                  "order_items": raw.order_items, "products": raw.products,
                  "payments": raw.payments}
    observations = {e: Observation(f"silver_{e}") for e in ENTITIES}

    def bronze_then_silver(entity):
        bronze = _write(spark, bronze_src[entity], base, f"bronze_{entity}", out)
        return _write(spark, staging.silver(entity, bronze, observations[entity]),
                      base, f"silver_{entity}", out)

    # the five bronze -> silver chains are independent Spark jobs
    silver = _concurrently({e: (lambda e=e: bronze_then_silver(e)) for e in ENTITIES})
    fct = _write(spark, marts.gold_fct_orders(silver["orders"], silver["order_items"],
                                              silver["payments"]), base, "gold_fct_orders", out)
    _concurrently({
        "gold_dim_customers": lambda: _write(spark, marts.gold_dim_customers(
            silver["customers"], silver["orders"], silver["payments"], high, mid),
            base, "gold_dim_customers", out),
        "gold_fct_revenue": lambda: _write(spark, marts.gold_fct_revenue(fct), base,
                                           "gold_fct_revenue", out),
    })
    out["expectations"] = {e: dict(o.get) for e, o in observations.items()}
    return out


def build_marts(spark: SparkSession, platform: Platform, base: str | None = None,
                enforce_contracts: bool = True, id_type: T.DataType = T.LongType(),
                run_tests: bool = True, customer_buckets: int | None = None) -> dict[str, str]:
    """Platform marts (through their contracts), then consumers/features over
    the written marts, then the declared tests of everything built.

    ``id_type`` is the key width of the contracts (the published contracts
    say INT; 64-bit keys are what a 100 TB order table needs).
    ``customer_buckets`` writes ``fct_orders`` and ``dim_customers`` bucketed
    by ``customer_id``: every consumer below groups or joins them by customer,
    and with co-bucketed inputs those steps read the files without a shuffle."""
    base = base or scratch_path(spark, "marts")
    out: dict[str, str] = {}
    as_of = platform.as_of

    def governed(name: str) -> DataFrame:
        df = getattr(platform, name)
        if enforce_contracts:
            make_contract, key = CONTRACTS[name]
            df = contract_cast(df, make_contract(id_type), primary_key=key)
        return df

    if customer_buckets:
        fct = _write_bucketed(spark, governed("fct_orders"), base, "fct_orders", out,
                              customer_buckets, "customer_id")
        dim = _write_bucketed(spark, governed("dim_customers"), base, "dim_customers", out,
                              customer_buckets, "customer_id")
    else:
        fct = _write(spark, governed("fct_orders"), base, "fct_orders", out)
        dim = _write(spark, governed("dim_customers"), base, "dim_customers", out)
    prod = _write(spark, governed("dim_products"), base, "dim_products", out)
    # consumers and features only read the written marts: independent jobs
    consumer_tables = {
        "mart_customer_segments": lambda: consumers.mart_customer_segments(dim, fct, as_of),
        "mart_country_performance": lambda: consumers.mart_country_performance(dim, fct),
        "fct_revenue": lambda: consumers.fct_revenue(fct),
        "fct_revenue_by_product": lambda: consumers.fct_revenue_by_product(fct, prod),
        "rfm_customer_features": lambda: features.rfm_scores(dim, fct, as_of),
        "customer_churn_features": lambda: features.customer_churn_features(dim, fct, as_of),
        "payment_method_affinity_pairs": lambda: features.payment_method_affinity_pairs(fct),
    }
    _concurrently({name: (lambda name=name, make=make: _write(spark, make(), base, name, out))
                   for name, make in consumer_tables.items()})
    if run_tests:
        models = {name: spark.read.parquet(path) for name, path in out.items()}
        models.update({name: getattr(platform, name) for name in
                       ("stg_customers", "stg_orders", "stg_order_items", "stg_products",
                        "stg_payments")})
        write_table(quality_report(models), f"{base}/quality_report")
        out["quality_report"] = f"{base}/quality_report"
    return out
