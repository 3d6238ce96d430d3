"""Tables are replaced as a whole or not at all."""

import os
import threading
from datetime import timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from martwright.sources import versions
from martwright.sources.layout import Layout, publish, read_table, write_table
from tests.conftest import rows

SOON = timedelta(0)


def failing(spark, n=1000):
    """Rows of which the very last task's last one cannot be made."""
    return spark.range(0, n, 1, 4).select(F.when(F.col("id") == n - 1, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("bigint").alias("id"))


def data_folders(path):
    return sorted(name for name in os.listdir(path) if name.startswith("v-"))


@pytest.mark.parametrize("kind", ["plain", "partitioned", "bucketed"])
def test_a_failed_write_leaves_the_table(spark, tmp_path, kind):
    path = str(tmp_path / "t")
    how = {"plain": {}, "partitioned": {"partition_by": ["p"]}, "bucketed": {"bucket_by": ["id"], "buckets": 4}}[kind]
    with_p = lambda df: df.withColumn("p", F.col("id") % 2)
    assert write_table(with_p(spark.range(5)), path, **how) == 5
    before = rows(read_table(spark, path).select("id", "p"))
    with pytest.raises(PySparkException):
        write_table(with_p(failing(spark)), path, **how)
    assert rows(read_table(spark, path).select("id", "p")) == before == [(i, i % 2) for i in range(5)]
    assert len(data_folders(path)) == 1 and len(versions.versions(spark, path)) == 1
    assert write_table(with_p(spark.range(6)), path, **how) == 6
    assert read_table(spark, path).count() == 6


def test_a_first_write_that_fails_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(PySparkException):
        write_table(failing(spark), path)
    assert versions.current(spark, path) is None
    assert not os.path.isdir(path) or not data_folders(path)


def test_a_reader_ends_on_its_version(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(3), path)
    before = read_table(spark, path)
    write_table(spark.range(10).selectExpr("id", "id as more"), path)
    assert rows(before) == [(0,), (1,), (2,)]
    assert read_table(spark, path).columns == ["id", "more"]


def test_a_table_may_be_made_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(3), path)
    write_table(read_table(spark, path).selectExpr("id + 10 as id"), path)
    assert rows(read_table(spark, path)) == [(10,), (11,), (12,)]


def test_old_versions_go_by_the_rule(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(1, 6):
        versions.replace(spark.range(n), path, keep=3, grace=SOON)
        assert len(data_folders(path)) == min(n, 3)
    assert [v.number for v in versions.versions(spark, path)] == [3, 4, 5]
    # within the grace period everything stays
    versions.replace(spark.range(6), path, keep=1, grace=timedelta(hours=1))
    assert len(data_folders(path)) == 4
    # what was never committed goes with its time, what is current never
    os.makedirs(f"{path}/v-broken/x")
    assert versions.clean(spark, path, keep=1, grace=timedelta(hours=1)) == []
    assert "v-broken" in versions.clean(spark, path, keep=1, grace=SOON)
    assert len(data_folders(path)) == 1 and read_table(spark, path).count() == 6


def test_a_plain_folder_becomes_a_versioned_table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(4).write.parquet(path)
    assert read_table(spark, path).count() == 4
    write_table(spark.range(5), path)
    assert read_table(spark, path).count() == 5
    versions.replace(spark.range(6), path, grace=SOON)
    assert not [name for name in os.listdir(path) if name.endswith(".parquet")]
    assert read_table(spark, path).count() == 6


def test_the_last_of_several_writers_wins(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(1), path)
    threads = [threading.Thread(target=write_table, args=(spark.range(n), path)) for n in range(2, 8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    found = versions.versions(spark, path)
    assert [v.number for v in found] == list(range(1, 8)) and sorted(v.rows for v in found) == list(range(1, 8))
    assert read_table(spark, path).count() == found[-1].rows


def test_a_writer_that_follows_a_version_is_told_of_another(spark, tmp_path):
    path = str(tmp_path / "t")
    first = versions.replace(spark.range(1), path)
    write_table(spark.range(2), path)
    with pytest.raises(versions.Conflict):
        versions.replace(spark.range(3), path, follows=first.number)
    assert read_table(spark, path).count() == 2 and len(data_folders(path)) == 2


def test_buckets_and_odd_names(spark, tmp_path):
    path = str(tmp_path / "a table")
    df = spark.range(100).selectExpr("id % 7 as `the key`", "id as `a.b`", "array(id) as c", "cast(id as decimal(18,2)) as d")
    assert write_table(df, path, bucket_by=["the key"], buckets=4) == 100
    found = read_table(spark, path)
    assert found.dtypes == df.dtypes and rows(found) == rows(df)
    assert rows(found.groupBy("the key").count()) == rows(df.groupBy("the key").count())
    assert "Exchange" not in found.groupBy("the key").count()._jdf.queryExecution().executedPlan().toString()


def test_empty_tables(spark, tmp_path):
    for i, how in enumerate(({}, {"partition_by": ["p"]}, {"bucket_by": ["id"], "buckets": 2})):
        path = str(tmp_path / f"t{i}")
        empty = spark.createDataFrame([], "id long, p int")
        assert write_table(empty, path, **how) == 0
        assert read_table(spark, path).columns == ["id", "p"] and read_table(spark, path).count() == 0


def test_published_tables_keep_their_version_until_published_again(spark, tmp_path):
    layout = Layout(str(tmp_path))
    for name, how in (("dim_sellers", {}), ("dim_date", {"partition_by": ["p"]})):
        write_table(spark.range(4).withColumn("p", F.col("id") % 2), layout.table("gold", name), **how)
    try:
        publish(spark, layout, "gold", ["dim_sellers", "dim_date"], "versioned")
        for name, how in (("dim_sellers", {}), ("dim_date", {"partition_by": ["p"]})):
            write_table(spark.range(9).withColumn("p", F.col("id") % 3), layout.table("gold", name), **how)
            assert spark.table(f"versioned.{name}").count() == 4
        publish(spark, layout, "gold", ["dim_sellers", "dim_date"], "versioned")
        assert spark.table("versioned.dim_sellers").count() == spark.table("versioned.dim_date").count() == 9
        assert spark.sql("show partitions versioned.dim_date").count() == 3
    finally:
        spark.sql("drop database versioned cascade")


def test_parts(spark, tmp_path):
    path = str(tmp_path / "t")

    def part(values, p):
        return spark.createDataFrame([(v,) for v in values], "id int").withColumn(versions.PART, F.lit(p))

    one = versions.replace_parts(part([1, 2], 0).union(part([3], 2)), path, [0, 2], 3, None)
    assert rows(read_table(spark, path)) == [(1,), (2,), (3,)] and one.rows == 3
    before = read_table(spark, path)
    two = versions.replace_parts(part([9], 1).union(part([7, 8], 2)), path, [1, 2], 3, one)
    assert rows(read_table(spark, path)) == [(1,), (2,), (7,), (8,), (9,)] and two.rows == 5
    assert rows(versions.part_rows(spark, path, two, [2])) == [(7,), (8,)]
    # an emptied part is gone, and the folder of the untouched one stays whatever its age
    three = versions.replace_parts(part([5], 2), path, [1, 2], 3, two, keep=1, grace=SOON)
    assert rows(read_table(spark, path)) == [(1,), (2,), (5,)] and three.rows == 3
    assert len(data_folders(path)) == 2
    with pytest.raises(versions.Conflict):
        versions.replace_parts(part([6], 0), path, [0], 3, two)
    assert rows(read_table(spark, path)) == [(1,), (2,), (5,)]
    assert before.columns == ["id"]
    versions.replace_parts(part([], 0), path, [0, 2], 3, three)
    assert read_table(spark, path).count() == 0 and read_table(spark, path).columns == ["id"]
