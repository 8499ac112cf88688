"""Every value-checked query against its DuckDB oracle on the smallest driver tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle_compare import compare, duck

SQL = entry.oracle_sql()
QUERIES = entry.queries()


def test_every_oracle_key_is_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, sf_small, name):
    ok, msg = compare(spark, sf_small, name, QUERIES[name], SQL[name], duck(sf_small))
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["genre", "game_count", "avg_weekly_revenue", "median_weekly_revenue", "avg_players"]
