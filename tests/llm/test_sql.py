"""Corpus queries that SQL can express, against their SQL."""

from pathlib import Path

import pytest

from cases import SF
from panelcast.llm.queries import QUERIES, SQL

duckdb = pytest.importorskip("duckdb")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    connection = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    found = QUERIES[name](spark, SF)
    cursor = connection.execute(SQL[name])
    columns = sorted(d[0] for d in cursor.description)
    assert columns == sorted(found.columns)
    at = [[d[0] for d in cursor.description].index(c) for c in columns]
    rows = sorted(tuple(r[i] for i in at) for r in cursor.fetchall())
    assert rows and sorted(tuple(r[c] for c in columns) for r in found.collect()) == rows
