"""Every registered query on the smallest tables, against its SQL."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver

SF = "/root/testdata/sf0.001"
QUERIES, SQL = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    picked = (tuple(row[i] for i in order) for row in rows)
    return sorted(picked, key=lambda row: [(v is None, v) for v in row])


def test_sql_has_a_query_for_each_name():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    assert rows and len(set(df.columns)) == len(df.columns)
    if name not in SQL:
        assert not any(isinstance(v, float) and math.isnan(v) for row in rows for v in row)
        return
    result = tables.execute(SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert canonical(df.columns, rows) == canonical(columns, result.fetchall())


def test_entry(spark):
    metrics = driver.entry(spark)
    assert metrics.columns[:2] == ["label", "category"]
    assert [r.category for r in metrics.orderBy("label").collect()] == ["low", "high"]
