"""Every registered query that has a DuckDB twin gives the twin's rows."""

from __future__ import annotations

import duckdb
import pytest

from gridlark.plans import catalogue

SF = "/root/testdata/sf0.01"
TABLES = ["lineitem", "events", "orders", "customer", "supplier", "part", "nation", "region"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted([*catalogue.QUERIES, *catalogue.FORMS]))
def test_query(spark, duck, name):
    df = (catalogue.QUERIES | catalogue.FORMS)[name](spark, SF)
    got = df.toPandas()
    assert len(got)
    sql = catalogue.SQL | catalogue.FORMS_SQL
    if name not in sql:
        return
    want = duck.sql(sql[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    got, want = (x[columns].sort_values(columns).reset_index(drop=True) for x in (got, want))
    assert len(got) == len(want)
    for c in columns:
        same = (got[c] == want[c]) | (got[c].isna() & want[c].isna())
        assert same.all(), (c, got[c][~same].head(), want[c][~same].head())


def test_every_query_is_covered_by_sql_or_listed():
    assert set(catalogue.QUERIES) == set(catalogue.SQL)
    assert set(catalogue.FORMS) - set(catalogue.FORMS_SQL) == {"heat1d_run"}


def test_registered_queries_read_tables(spark):
    """Each registered query fails on a folder without tables."""
    for name, fn in catalogue.QUERIES.items():
        with pytest.raises(Exception, match="(?i)path"):
            fn(spark, "/nowhere").count()
            raise AssertionError(name)
