"""Batches merged into silver give what a rebuild from all of them gives."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from martwright.plans import changes
from martwright.plans.datasets import DATASETS
from martwright.plans.silver import silver
from martwright.sources import versions
from martwright.sources.layout import Layout
from martwright.sources.raw_csv import CSV
from martwright.streaming import silver as stream
from martwright.testing.queries import Tables
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", DATASETS)
def test_any_split_gives_the_rebuild(spark, tmp_path, name):
    """Uneven batches, one of them twice, an empty one, and one that holds everything again."""
    bronze = Tables(spark, SF).bronze(name)
    expected = rows(silver(name, bronze))
    lot = F.pmod(F.xxhash64(*bronze.columns, F.lit(1)), F.lit(10))
    batches = [bronze.where(lot < 1), bronze.where(lot.between(1, 3)), bronze.where(lot.between(1, 3)), bronze.limit(0)]
    batches += [bronze.where(lot > 3)]
    layout = Layout(str(tmp_path))
    for batch in batches:
        changes.apply_batch(spark, layout, name, batch, parts=5)
    assert rows(changes.current_silver(spark, layout, name)) == expected
    changes.apply_batch(spark, layout, name, bronze)
    assert rows(changes.current_silver(spark, layout, name)) == expected


def customers(spark, *found):
    columns = "customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_city string, customer_state string"
    return spark.createDataFrame([(i, u, "1", city, "RJ") for i, u, city in found], columns)


def test_only_touched_parts_are_rewritten(spark, tmp_path):
    layout = Layout(str(tmp_path))
    first = changes.apply_batch(spark, layout, "customers", customers(spark, *[(f"c{i}", "u", "x") for i in range(300)]), parts=16)
    second = changes.apply_batch(spark, layout, "customers", customers(spark, ("c7", "a", "x")))
    assert len(first.parts) == 16
    assert len([part for part, at in second.parts.items() if at != first.parts[part]]) == 1
    assert second.rows == first.rows == 300


@pytest.mark.parametrize("name", ["orders", "categories"])
def test_many_batches_do_not_write_every_row_again(spark, tmp_path, monkeypatch, name):
    """Sixteen equal batches, with keys that come in several: the rows of a rebuild, and log2(16) further writes at most."""
    monkeypatch.setattr(changes, "FEW_ROWS", 0)
    bronze, layout = Tables(spark, SF).bronze(name).distinct(), Layout(str(tmp_path))
    lot = F.pmod(F.xxhash64(*bronze.columns), F.lit(16))
    path = changes.state_path(layout, name)
    for number in range(16):
        version = changes.apply_batch(spark, layout, name, bronze.where(lot == number), parts=2)
    assert rows(changes.current_silver(spark, layout, name)) == rows(silver(name, bronze))
    written = spark.read.option("recursiveFileLookup", True).parquet(path, pathGlobFilter="*.parquet").count()
    assert written <= 5 * bronze.count()
    assert version.later or name == "categories"
    for part in version.parts:
        sizes = [found for _, found in version.runs(part)]
        assert all(size > sum(sizes[i + 1 :]) for i, size in enumerate(sizes))
    again = changes.apply_batch(spark, layout, name, bronze)
    assert rows(changes.current_silver(spark, layout, name)) == rows(silver(name, bronze))
    assert not again.later and again.rows <= version.rows


def test_a_batch_is_made_once(spark, tmp_path):
    """Its rows are counted per part and then merged; a first batch is not counted at all."""
    layout, made = Layout(str(tmp_path)), spark.sparkContext.accumulator(0)
    seen = F.udf(lambda city: made.add(1) or city)
    for number in range(2):
        batch = customers(spark, *[(f"c{number}{i}", "u", "x") for i in range(100)])
        batch = batch.withColumn("customer_city", seen("customer_city"))
        changes.apply_batch(spark, layout, "customers", batch, parts=2)
    assert made.value == 200


def test_folders_that_stay():
    """Each is larger than what comes after it; small ones never stay."""
    assert changes._staying([100_000, 40_000], 30_000) == 2
    assert changes._staying([100_000, 40_000], 40_000) == 1
    assert changes._staying([100_000, 40_000], 70_000) == 0
    assert changes._staying([10_000], 1) == 0 and changes._staying([10_001], 1) == 1
    assert changes._staying([], 5) == 0


def test_a_survivor_that_fails_takes_its_key_along_until_a_smaller_one_comes(spark, tmp_path):
    layout = Layout(str(tmp_path))
    for unique, left in (("u2", [("c1", "u2")]), (None, []), ("u1", [])):
        changes.apply_batch(spark, layout, "customers", customers(spark, ("c1", unique, "x")), parts=2)
        found = changes.current_silver(spark, layout, "customers").select("customer_id", "customer_unique_id")
        assert rows(found) == left  # NULL is the smallest


def test_a_batch_number_is_merged_once(spark, tmp_path):
    layout = Layout(str(tmp_path))
    one = changes.apply_batch(spark, layout, "customers", customers(spark, ("c1", "u", "x")), 2, "b1")
    assert changes.apply_batch(spark, layout, "customers", customers(spark, ("c1", "u", "x")), 2, "b1") == one
    assert changes.apply_batch(spark, layout, "customers", customers(spark, ("c2", "u", "x")), 2, "b2").number == 2


def test_bad_batches_change_nothing(spark, tmp_path):
    layout = Layout(str(tmp_path))
    changes.apply_batch(spark, layout, "customers", customers(spark, ("c1", "u", "x")), 2)
    with pytest.raises(changes.MissingColumns):
        changes.apply_batch(spark, layout, "customers", customers(spark, ("c2", "u", "x")).drop("customer_city"))
    with pytest.raises(ValueError, match="columns"):
        changes.apply_batch(spark, layout, "customers", customers(spark, ("c2", "u", "x")).withColumn("more", F.lit(1)))
    assert versions.current(spark, changes.state_path(layout, "customers")).number == 1


def test_a_batch_is_merged_again_after_a_conflict(spark, tmp_path, monkeypatch):
    layout, merged, calls = Layout(str(tmp_path)), changes._merged, []

    def with_another_writer(*args):
        if not calls:
            calls.append(1)
            changes.apply_batch(spark, layout, "customers", customers(spark, ("c2", "u", "x")), 2)
        return merged(*args)

    monkeypatch.setattr(changes, "_merged", with_another_writer)
    changes.apply_batch(spark, layout, "customers", customers(spark, ("c1", "u", "x")), 2)
    assert changes.current_silver(spark, layout, "customers").count() == 2


def run_stream(spark, layout, columns, checkpoint):
    query = stream.start(spark, layout, "orders", checkpoint, files_per_batch=1, parts=4, columns=columns)
    query.awaitTermination()


def test_a_stream_gives_the_batch_rows(spark, tmp_path):
    """Also if it breaks off between merging a batch and noting it, and if files come while it is not running."""
    layout, tables = Layout(str(tmp_path)), Tables(spark, SF)
    raw, checkpoint = tables.raw("orders"), str(tmp_path / "checkpoint")
    raw.where("order_id % 3 = 0").repartition(3).write.options(**CSV).csv(layout.raw("orders"))
    run_stream(spark, layout, raw.columns, checkpoint)
    merged = versions.current(spark, changes.state_path(layout, "orders"))
    assert merged.number == 3
    last = max(glob.glob(f"{checkpoint}/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    os.remove(last)
    for crc in glob.glob(f"{checkpoint}/commits/.*.crc"):
        os.remove(crc)
    run_stream(spark, layout, raw.columns, checkpoint)
    assert versions.current(spark, changes.state_path(layout, "orders")) == merged
    raw.where("not (order_id % 3 = 0) or order_id is null").repartition(2).write.mode("append").options(**CSV).csv(layout.raw("orders"))
    run_stream(spark, layout, raw.columns, checkpoint)
    assert rows(changes.current_silver(spark, layout, "orders")) == rows(silver("orders", raw))
