"""Every registered query against its SQL on the test tables, value for value."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402
from marketlens import oracle, registry  # noqa: E402

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(registry.queries()) == set(oracle.QUERIES)
    assert set(registry.queries()) <= set(contract.queries())


@pytest.mark.parametrize("key", sorted(registry.queries()))
def test_matches_sql(spark, duck, key):
    df = contract.queries()[key](spark, SF)
    names = sorted(df.columns)
    ours = sorted(repr(tuple(r)) for r in df.select(*[f"`{n}`" for n in names]).collect())
    cursor = duck.execute(contract.oracle_sql()[key])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == names
    order = [columns.index(n) for n in names]
    theirs = sorted(repr(tuple(r[i] for i in order)) for r in cursor.fetchall())
    assert ours == theirs
    assert ours, "a query without rows shows nothing"


def test_entry_runs(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "municipio"
    df.collect()
