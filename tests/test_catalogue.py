"""Every catalogue query against its SQL on DuckDB."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__
from lumenforge.plans import catalogue, catalogue_sql

SMALL = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    return value


@pytest.mark.parametrize("name", list(catalogue_sql.oracle_sql()))
def test_query_matches_its_sql(spark, duck, name):
    got = catalogue.queries()[name](spark, SMALL)
    columns = sorted(got.columns)
    ran = duck.execute(catalogue_sql.oracle_sql()[name])
    order = [d[0] for d in ran.description]
    assert sorted(order) == columns
    at = [order.index(c) for c in columns]
    want = Counter(tuple(plain(row[k]) for k in at) for row in ran.fetchall())
    assert Counter(tuple(plain(v) for v in row) for row in got.select(*columns).collect()) == want


@pytest.mark.parametrize("name", ["quality_issues", "merge_decisions"])
def test_tables_repeated_with_shifted_keys(spark, tmp_path, name):
    """Four copies, all keys of copy i shifted by i million: overrides look for crossmatch rows that are not there and have no source_id."""
    con = duckdb.connect()
    for t, keys in (("lineitem", ("l_orderkey", "l_partkey", "l_suppkey")), ("part", ("p_partkey",)), ("supplier", ("s_suppkey",))):
        shifted = ", ".join(f"{k} + i * 1000000 AS {k}" for k in keys)
        con.execute(f"COPY (SELECT * REPLACE ({shifted}) FROM read_parquet('{SMALL}/{t}.parquet'), range(4) r(i)) TO '{tmp_path}/{t}.parquet'")
        con.execute(f"CREATE VIEW {t} AS SELECT * EXCLUDE (i) FROM read_parquet('{tmp_path}/{t}.parquet')")
    ran = con.execute(catalogue_sql.oracle_sql()[name])
    columns = [d[0] for d in ran.description]
    want = Counter(tuple(map(plain, row)) for row in ran.fetchall())
    got = catalogue.queries()[name](spark, str(tmp_path)).select(*columns).collect()
    assert len(want) > 1 and Counter(tuple(map(plain, row)) for row in got) == want


def test_registered_queries_have_sql_or_a_reason():
    assert set(catalogue_sql.oracle_sql()) <= set(catalogue.queries()) <= set(__spark_entry__.queries())


def test_entry_is_the_flagship(spark):
    assert __spark_entry__.entry(spark).columns[:2] == ["source", "source_id"] or "source_id" in __spark_entry__.entry(spark).columns
