"""Every registered query next to its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as driver

duckdb = pytest.importorskip("duckdb")
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for file in os.listdir(SF_DIR):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF_DIR}/{file}'")
    return con


def in_order(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([row[i] for i in order] for row in data), key=repr)


@pytest.mark.parametrize("name", list(driver.catalog.QUERIES))
def test_query(spark, db, name):
    frame = driver.queries()[name](spark, SF_DIR)
    mine = in_order(frame.columns, [tuple(r) for r in frame.collect()])
    assert mine
    sql = driver.oracle_sql().get(name)
    if sql is None:
        return
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(frame.columns)
    assert mine == in_order(names, result.fetchall())


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_oracles_belong_to_queries():
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert len(driver.catalog.ORACLES) >= len(driver.catalog.QUERIES) - 2
