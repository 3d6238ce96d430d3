import itertools
import random

import pytest

from martwright.operators import joins
from martwright.operators.joins import Details, find_oversized, left_join_details
from tests.conftest import rows
from tests.test_plans import exchanges


def brute_force(header, items, payments):
    out = []
    for order, name in header:
        mine = [item for item in items if item[0] == order] or [(order, None, None)]
        paid = [payment for payment in payments if payment[0] == order] or [(order, None, None)]
        out += [(order, name, i[1], i[2], p[1], p[2]) for i, p in itertools.product(mine, paid)]
    return sorted(out, key=repr)


def frames(spark, header, items, payments):
    return (
        spark.createDataFrame(header, "order_id int, name string"),
        Details(spark.createDataFrame(items, "order_id int, item int, price int"), "item"),
        Details(spark.createDataFrame(payments, "order_id int, seq int, value int"), "seq"),
    )


@pytest.mark.parametrize("seed", range(4))
def test_chunks_do_not_change_the_result(spark, seed):
    random.seed(seed)
    header = [(order, f"n{order}") for order in range(12)]
    items, payments = [], []
    for order in range(14):
        numbers = random.sample(range(-7, 30), random.choice([0, 1, 2, 9, 20]))
        items += [(order, number, random.randrange(9)) for number in numbers]
        numbers = random.sample(range(0, 15), random.choice([0, 1, 2, 8]))
        payments += [(order, number, random.randrange(9)) for number in numbers]
    items += [(3, None, 1), (None, 1, 1), (None, 99, 1)]
    head, item_rows, payment_rows = frames(spark, header, items, payments)
    expected = brute_force(header, items, payments)
    for size in (3, 1_000_000):
        found = find_oversized([item_rows, payment_rows], "order_id", size)
        out = left_join_details(head, "order_id", [item_rows, payment_rows], found, size)
        assert out.columns == ["order_id", "name", "item", "price", "seq", "value"]
        assert rows(out) == expected


def test_order_whose_rows_all_lie_beyond_the_first_chunk(spark):
    header = [(1, "a"), (2, "b"), (3, "c")]
    items = [(1, number, 0) for number in range(50, 60)]
    payments = [(1, 1, 10), (2, 1, 20)]
    head, item_rows, payment_rows = frames(spark, header, items, payments)
    assert find_oversized([item_rows, payment_rows], "order_id", 4) == [0]
    out = left_join_details(head, "order_id", [item_rows, payment_rows], [0], 4)
    assert rows(out) == brute_force(header, items, payments)


def test_high_numbers_without_many_rows_take_the_plain_join(spark):
    part = Details(spark.createDataFrame([(1, 900), (1, 901), (2, 950)], "k int, n int"), "n")
    assert not joins._oversized(part, "k", 10)
    many = Details(spark.createDataFrame([(1, n) for n in range(30)], "k int, n int"), "n")
    assert joins._oversized(many, "k", 10)


def test_null_keys_do_not_count_as_oversized(spark):
    part = Details(spark.createDataFrame([(None, n) for n in range(30)] + [(1, 50)], "k int, n int"), "n")
    assert not joins._oversized(part, "k", 10)


@pytest.mark.parametrize(
    "kind, numbers",
    [
        ("string", [str(n) for n in range(20)] + ["x", None, "1e3"]),
        ("double", [float(n) for n in range(20)] + [float("nan"), 1e300, None, 7.5, -9.5]),
    ],
)
def test_numbers_of_other_types(spark, kind, numbers):
    header = spark.createDataFrame([(1, "a"), (2, "b")], "order_id int, name string")
    rows_ = spark.createDataFrame([(1, number) for number in numbers], f"order_id int, n {kind}")
    assert find_oversized([Details(rows_, "n")], "order_id", 4) == [0]
    cut = left_join_details(header, "order_id", [Details(rows_, "n")], [0], 4)
    whole = header.join(rows_, "order_id", "left")
    assert list(map(repr, rows(cut))) == list(map(repr, rows(whole)))
    assert cut.count() == len(numbers) + 1


def test_no_summary_of_keys_that_would_be_unsure(spark, monkeypatch):
    """More rows beyond the first chunk than the summary has room for: they were counted before, so it is not made."""
    part = Details(spark.createDataFrame([(k, n) for k in range(50) for n in range(30)], "k int, n int"), "n")
    monkeypatch.setattr(joins, "heavy_hitters", lambda *_: pytest.fail("a summary was made"))
    monkeypatch.setattr(joins, "_SUMMARY_TASKS", 300)
    assert joins.oversized_keys([part], "k", 10) == {0: None}


def test_chunk_numbers_are_gathered_in_one_shuffle_per_table(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    header, items, payments = frames(spark, [(1, "a")], [(1, n, n) for n in range(9)], [(1, n, n) for n in range(9)])
    out = left_join_details(header, "order_id", [items, payments], [0, 1], 3)
    assert len(rows(out)) == 81
    # each table by its key and by its cells, and the chunk numbers of either table, once for each side that they meet
    assert exchanges(out) <= 10


def test_looking_for_a_wide_key_ends_with_the_first(spark, conf):
    """Rows per key are summed until one key has too many, not for every key; the rows are counted without a shuffle."""
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.shuffle.partitions", "64")
    part = Details(spark.range(0, 3000, 1, 2).selectExpr("id % 500 as k", "id div 500 as n"), "n")
    spark.sparkContext.setJobGroup("wide", "wide")
    try:
        found = joins.oversized_keys([part], "k", 2)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert set(found) == {0}
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(job) for job in tracker.getJobIdsForGroup("wide")]
    stages = [tracker.getStageInfo(stage) for job in jobs for stage in job.stageIds]
    assert jobs and sum(stage.numTasks for stage in stages if stage) < 64
