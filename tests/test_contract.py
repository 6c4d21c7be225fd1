"""Every query of the engine against its SQL."""

import math

import duckdb
import pytest

from reelspark.plans import registry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def shown(rows):
    return sorted(repr([round(x, 9) if isinstance(x, float) and math.isfinite(x) else x for x in r]) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_sql(spark, duck, name):
    got, want = registry.QUERIES[name](spark, DATA), duck.sql(registry.ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    assert shown(map(tuple, got.select(columns).collect())) == shown(duck.sql(f"SELECT {', '.join(columns)} FROM ({registry.ORACLES[name]})").fetchall())


def test_queries_without_sql_run(spark):
    for name in sorted(set(registry.QUERIES) - set(registry.ORACLES)):
        assert registry.QUERIES[name](spark, DATA).count()


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["reason", "n"]
    assert set(e.oracle_sql()) <= set(e.queries())
