"""Structured Streaming form of the medallion pipeline.

* ``bronze_stream``: append-only copy of a raw source folder (file source with
  a fixed schema) into a bronze folder, exactly once via the checkpoint.
* ``silver_stream``: stateless projection + warn/drop expectations over the
  bronze stream; violation counts are published as observed metrics.
* ``gold_refresh``: once the ``availableNow`` streams have drained, the gold
  tables are recomputed in batch from the silver folders.

Restarting a query with the same checkpoint resumes after the last committed
file, so files already ingested are never written twice.  All folders are
caller-given or live under the shared ``spark.checkpoint.dir`` folder.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from martlet.operators import marts, staging
from martlet.session import scratch_path


@dataclass(frozen=True)
class StreamPaths:
    source: str
    sink: str
    checkpoint: str


def stream_paths(spark: SparkSession, name: str, source: str) -> StreamPaths:
    base = scratch_path(spark, f"stream-{name}")
    return StreamPaths(source=source, sink=f"{base}/data", checkpoint=f"{base}/_checkpoint")


def _start_available_now(df: DataFrame, paths: StreamPaths, name: str,
                         trigger: dict | None = None):
    """Start an append query to a parquet sink.  ``trigger`` defaults to
    ``availableNow`` (drain what is there, then stop); pass e.g.
    ``{"processingTime": "1 minute"}`` for continuous ingestion."""
    return (df.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", paths.checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .queryName(f"{name}_{abs(hash(paths.sink)) % 10**8}")
            .start(paths.sink))


def await_streams(queries: list, timeout_s: float | None = None) -> list:
    """Wait until every ``availableNow`` query has drained, however long that
    takes unless ``timeout_s`` is given; raise on failure."""
    for query in queries:
        query.awaitTermination(timeout_s) if timeout_s is not None else query.awaitTermination()
        if query.isActive:
            for q in queries:
                q.stop()
            raise TimeoutError(f"stream {query.name} did not drain in {timeout_s}s")
        if query.exception() is not None:
            raise query.exception()
    return queries


def start_stream(df: DataFrame, paths: StreamPaths, name: str, trigger: dict | None = None):
    """Start any streaming DataFrame into a parquet sink with a checkpoint."""
    return _start_available_now(df, paths, name, trigger)


def bronze_query(spark: SparkSession, schema: T.StructType, paths: StreamPaths,
                 name: str = "bronze", max_files_per_trigger: int | None = None,
                 trigger: dict | None = None):
    """Start (do not wait for) the bronze append stream of one source folder."""
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _start_available_now(reader.load(paths.source), paths, name, trigger)


def silver_query(spark: SparkSession, entity: str, bronze_schema: T.StructType, paths: StreamPaths,
                 trigger: dict | None = None):
    """Start (do not wait for) the silver stream of ``entity``."""
    bronze = spark.readStream.schema(bronze_schema).format("parquet").load(paths.source)
    silver = staging.silver(entity, bronze, observation=f"silver_{entity}_expectations")
    return _start_available_now(silver, paths, f"silver_{entity}", trigger)


def bronze_stream(spark: SparkSession, schema: T.StructType, paths: StreamPaths,
                  name: str = "bronze", timeout_s: float | None = None,
                  max_files_per_trigger: int | None = None):
    """Append every new file of ``paths.source`` to ``paths.sink``."""
    return await_streams([bronze_query(spark, schema, paths, name, max_files_per_trigger)],
                         timeout_s)[0]


def silver_stream(spark: SparkSession, entity: str, bronze_schema: T.StructType, paths: StreamPaths,
                  timeout_s: float | None = None):
    """Silver table ``entity`` from a bronze folder, with its expectations;
    per-batch violation counts appear in ``query.lastProgress['observedMetrics']``."""
    return await_streams([silver_query(spark, entity, bronze_schema, paths)], timeout_s)[0]


def read_sink(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def gold_refresh(spark: SparkSession, silver_paths: dict[str, str], high=marts.DEFAULT_HIGH,
                 mid=marts.DEFAULT_MID) -> dict[str, DataFrame]:
    """Batch gold tables over the drained silver folders."""
    s = {k: read_sink(spark, v) for k, v in silver_paths.items()}
    fct = marts.gold_fct_orders(s["orders"], s["order_items"], s["payments"])
    return {
        "gold_fct_orders": fct,
        "gold_dim_customers": marts.gold_dim_customers(s["customers"], s["orders"], s["payments"],
                                                       high, mid),
        "gold_fct_revenue": marts.gold_fct_revenue(fct),
    }
