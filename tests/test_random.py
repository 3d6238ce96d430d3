"""Random dirty tables through silver, gold and quality, against the SQL in DuckDB."""

import datetime as dt
import random
from decimal import Decimal

import duckdb
import pyarrow as pa
import pytest

from martwright.plans import gold, quality
from martwright.plans.datasets import DATASETS
from martwright.plans.jobs import GOLD_TABLES, gold_table
from martwright.plans.silver import silver
from martwright.testing import oracle
from tests.conftest import rows

CHOICES = {
    "int": [None, -1, 0, 1, 2, 5, 6],
    "double": [None, -1.5, 0.0, 2.5],
    "decimal(18,2)": [None, Decimal("-1.00"), Decimal("0.00"), Decimal("0.01"), Decimal("7.50")],
    "timestamp_ntz": [None, dt.datetime(2018, 1, 1, 23, 59, 59), dt.datetime(2020, 2, 29), dt.datetime(2018, 1, 2)],
}
TEXTS = [None, "", "  ", "a", " a", "a ", "b", "B", "é", "shipped", "\tb"]
IDS = [None, None, *(str(number) for number in range(40))]
ARROW = {
    "string": pa.string(), "int": pa.int32(), "double": pa.float64(), "decimal(18,2)": pa.decimal128(18, 2),
    "timestamp_ntz": pa.timestamp("us"),
}


def random_rows(spec, count):
    def value(name, kind):
        if kind != "string":
            return random.choice(CHOICES[kind])
        if name in oracle.TEXT:
            return random.choice(TEXTS)
        return random.choice(IDS)

    data = [tuple(value(name, kind) for name, kind in spec.required.items()) for _ in range(count)]
    return data + random.sample(data, count // 5) + [(None,) * len(spec.required)] * 2


@pytest.fixture(scope="module", params=range(3))
def tables(spark, request):
    random.seed(request.param)
    duck, bronze = duckdb.connect(), {}
    for name, spec in DATASETS.items():
        data = random_rows(spec, 120)
        ddl = ", ".join(f"{column} {kind}" for column, kind in spec.required.items())
        bronze[name] = spark.createDataFrame(data, ddl).repartition(3).cache()
        arrow = pa.table(
            {column: pa.array([row[i] for row in data], ARROW[kind]) for i, (column, kind) in
             enumerate(spec.required.items())}
        )
        duck.register(f"arrow_{name}", arrow)
        duck.execute(f"create table b_{name} as select * from arrow_{name}")
        duck.execute(f"create table s_{name} as {oracle._silver(name)}")
    for name, text in oracle.GOLD.items():
        duck.execute(f"create view {name} as {text}")
    return bronze, {name: silver(name, df).cache() for name, df in bronze.items()}, duck


def same(df, duck, sql):
    theirs = duck.execute(sql)
    columns = [column[0] for column in theirs.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.select(*columns)) == sorted(theirs.fetchall(), key=repr)


def test_silver(tables):
    _, clean, duck = tables
    for name, df in clean.items():
        same(df, duck, f"select * from s_{name}")
        assert df.count() > 0, name


def test_gold(tables):
    _, clean, duck = tables
    for name in GOLD_TABLES:
        same(gold_table(name, clean.get), duck, f"select * from {name}")
    same(
        gold.fanout_audit(clean["orders"], clean["order_items"], clean["payments"]),
        duck,
        oracle.STATEMENTS["fact_fanout_audit"],
    )


def test_quality(tables):
    bronze, clean, duck = tables
    same(quality.report(bronze), duck, oracle.STATEMENTS["quality_report"])
    same(quality.duplicate_report(bronze), duck, oracle.STATEMENTS["quality_duplicate_keys"])
    same(quality.record_counts(bronze, clean), duck, oracle.STATEMENTS["quality_record_counts"])
