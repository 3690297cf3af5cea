"""Every registered query runs on the smallest tables; the oracle map is consistent."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from quarry import registry

SMOKE = "/root/testdata/sf0.001"


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["event_id", "ts", "user_id", "event_type", "value", "props"]


def test_oracle_keys_are_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 40


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_runs(spark, name):
    df = registry.QUERIES[name](spark, SMOKE)
    rows = df.collect()
    assert isinstance(rows, list)
    assert len(set(df.columns)) == len(df.columns)


def test_oracle_sql_runs_in_duckdb():
    import duckdb
    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents embeddings "
              "pages benchmark labels conversations").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    for name, sql in entry.oracle_sql().items():
        con.sql(sql).fetchall()
