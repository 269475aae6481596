"""Every registered query equals its DuckDB oracle on the smoke tables."""

import os

import pytest

import __spark_entry__ as entry
from martlet.plans import catalog
from scripts.oracle_check import TABLES, rows_of, type_mismatches


@pytest.fixture(scope="module")
def duck(smoke_dir):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        path = f"{smoke_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["customer_segment", "metric_time", "total_recognised_revenue", "total_orders"]


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) & set(catalog.REGISTRY)))
def test_query_matches_oracle(spark, duck, smoke_dir, name):
    df = entry.queries()[name](spark, smoke_dir)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    rel = duck.sql(entry.oracle_sql()[name])
    d_cols, d_types, d_rows = rel.columns, rel.types, rel.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert type_mismatches(df.schema, d_cols, d_types) == {}
    assert len(s_rows) == len(d_rows)
    assert rows_of(s_rows, s_cols) == rows_of(d_rows, d_cols)


def test_every_query_has_oracle_or_is_documented():
    missing = set(catalog.REGISTRY) - set(entry.oracle_sql())
    assert missing == {"rfm_customer_features_approx"}
