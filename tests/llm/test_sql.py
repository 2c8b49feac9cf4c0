"""The queries that have SQL, held against it on DuckDB."""

import duckdb
import pytest

from lumenforge.llm import queries
from tests.llm.conftest import SMALL


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    ran = con.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in ran.description]
    got = queries.queries()[name](spark, SMALL)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(ran.fetchall())
