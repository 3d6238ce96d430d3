"""Every registered query of the reference's operators against its SQL in DuckDB."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver
from martwright.testing import oracle, queries as registered

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def test_every_query_has_its_sql():
    assert set(registered.QUERIES) == set(oracle.statements())
    assert set(registered.QUERIES) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", registered.QUERIES)
def test_query_matches_its_sql(spark, duck, name):
    ours = driver.queries()[name](spark, SF)
    theirs = duck.execute(driver.oracle_sql()[name])
    columns = [column[0] for column in theirs.description]
    assert sorted(ours.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, ours.select(*columns).collect()))) == sorted(map(repr, theirs.fetchall()))


@pytest.mark.parametrize("folder", [SF, "/root/testdata/sf0.01"])
def test_every_rule_fires_and_every_silver_rule_removes_rows(spark, folder):
    report = registered.QUERIES["quality_report"](spark, folder)
    assert report.where("failed_rows > 0").count() == report.count() == 26
    metrics = registered.QUERIES["silver_run_metrics"](spark, folder)
    assert metrics.where("rows_removed > 0 and rows_after > 0").count() == 9


def test_entry(spark):
    assert driver.entry(spark).columns == ["year", "month", "month_name", "revenue", "orders"]
