import pytest

from martwright.operators.rules import (
    count_failures, duplicate_keys, in_range, no_duplicates, no_negative, no_null, one_of,
)
from martwright.plans import quality
from martwright.plans.datasets import DATASETS
from tests.conftest import rows


def failures(df, *rules):
    return dict(rows(count_failures(df, rules)))


def test_predicates_that_are_null_do_not_fail(spark):
    df = spark.createDataFrame(
        [(None, None, None), ("ok", 0, 5), ("bad", -1, 6), ("", 1, 0)], "state string, n int, score int"
    )
    assert failures(
        df,
        no_null("state"),
        no_negative("n"),
        one_of("state", "state", ["ok"]),
        in_range("score", "score", 1, 5),
    ) == {"Null check: state": 1, "Negative value check: n": 1, "state": 2, "score": 2}


def test_malformed_numbers_do_not_fail_the_job(spark):
    df = spark.createDataFrame([("x",), ("-2",), ("7",)], "n string")
    assert failures(df, no_negative("n"), in_range("range", "n", 1, 5)) == {
        "Negative value check: n": 1, "range": 2
    }


def test_duplicates_are_counted_as_groups(spark):
    df = spark.createDataFrame(
        [(1, "a"), (1, "a"), (1, "a"), (1, "b"), (None, None), (None, None), (2, None)], "k int, s string"
    )
    assert duplicate_keys(df, ["k", "s"]).first()[0] == 2
    assert duplicate_keys(df, ["k"]).first()[0] == 2
    assert failures(df, no_duplicates("k", "s")) == {"Duplicate check: ['k', 's']": 2}


def test_suite_has_26_rules_with_distinct_labels_per_table():
    assert sum(len(rules) for rules in quality.SUITE.values()) == 26
    for rules in quality.SUITE.values():
        assert len({rule.label for rule in rules}) == len(rules)


@pytest.fixture
def empty(spark):
    return {
        name: spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in DATASETS[name].required.items()))
        for name in quality.SUITE
    }


def test_empty_tables_pass(empty):
    report = quality.report(empty)
    assert report.columns == ["dataset", "failed_rows", "rule", "status"]
    assert rows(report.select("failed_rows", "status").distinct()) == [(0, "PASS")]
    assert rows(quality.summary(report)) == [(0, 0, 26)]


def test_failure_messages(spark, empty):
    empty["sellers"] = spark.createDataFrame([(None, "1", "x", "X")], empty["sellers"].schema)
    assert rows(quality.failure_messages(quality.report(empty))) == [("sellers - Null check: seller_id: 1",)]


def test_record_counts_pass_only_with_rows_left(spark):
    many, few, none = (spark.range(n) for n in (3, 2, 0))
    out = quality.record_counts({"a": many, "b": few, "c": few}, {"a": few, "b": many, "c": none})
    assert rows(out) == [("a", 3, 2, "PASS"), ("b", 2, 3, "FAIL"), ("c", 2, 0, "FAIL")]
