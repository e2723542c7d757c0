"""Every registered query against its SQL, at the smallest scale."""

import os

import pytest

from ledgerflow.checks import job_queries, operator_queries  # noqa: F401 - registers the queries
from ledgerflow.checks.registry import ORACLE, QUERIES

duckdb = pytest.importorskip("duckdb")
SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def canon(value):
    return repr(round(value, 6)) if isinstance(value, float) else repr(value)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(canon(r[c]) for c in columns) for r in df.collect())
    if name not in ORACLE:
        assert got
        return
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    want = sorted(tuple(canon(r[i]) for i in places) for r in cursor.fetchall())
    assert got == want
