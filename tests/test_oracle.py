"""Every query with an oracle against DuckDB on the smallest tables; the others run."""

import glob
import math
import os

import duckdb
import pytest

from stridelake.plans import catalog
from tests.conftest import DATA


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return round(float(value), 5) + 0.0
    return str(value)


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, DATA)
    rows = df.collect()
    if name not in catalog.ORACLE_SQL:
        assert df.columns
        return
    found = duck.sql(catalog.ORACLE_SQL[name])
    assert as_rows(df.columns, rows) == as_rows(found.columns, found.fetchall())
