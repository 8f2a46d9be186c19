"""Every named query against the SQL that must give the same rows."""

import math
import os
from pathlib import Path

import pytest

import __spark_entry__ as entry
from panelcast.workload.registry import QUERIES

duckdb = pytest.importorskip("duckdb")
SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def canonical(rows, columns):
    """Rows with columns by name, in an order that does not depend on the engine."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(value):
        if isinstance(value, float) and math.isnan(value):
            return ("nan",)
        return (value is not None, str(type(value) is str), value if value is not None else 0)

    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(name, spark, duck):
    df = entry.queries()[name](spark, SF_DIR)
    rows = [tuple(r) for r in df.collect()]
    assert rows, "no rows"
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return
    cursor = duck.execute(sql)
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert canonical(rows, df.columns) == canonical(cursor.fetchall(), columns)


def test_entry_has_rows(spark):
    assert not entry.entry(spark).isEmpty()
