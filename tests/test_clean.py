import math
import random

from hypothesis import HealthCheck, given, settings, strategies as st

from martwright.operators.clean import generic_clean, smallest_per_key, trim_strings
from tests.conftest import rows


def test_trim_cuts_blanks_only_and_leaves_other_types(spark):
    df = spark.createDataFrame([("  a b ", 1), ("\ta\n", 2), ("   ", 3), (None, 4)], "`x.y` string, n int")
    out = trim_strings(df)
    assert out.columns == ["x.y", "n"]
    assert rows(out) == [("", 3), ("\ta\n", 2), ("a b", 1), (None, 4)]


def test_generic_clean_is_distinct_then_drop_empty_then_trim(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 1), (" a", 1), (None, None), (None, None), ("  ", None)], "t string, n int"
    )
    assert rows(generic_clean(df)) == [("", None), ("a", 1), ("a", 1)]


def test_distinct_treats_nulls_nans_and_zeros_as_equal(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (math.nan,), (math.nan,), (None,), (None,)], "x double")
    assert generic_clean(df.selectExpr("x", "1 as one")).count() == 3


def test_smallest_row_wins_with_nulls_first(spark):
    df = spark.createDataFrame(
        [("k", "b", 1), ("k", "a", 9), ("k", "a", 2), ("m", "z", 1), ("m", None, 5)], "k string, a string, b int"
    )
    assert rows(smallest_per_key(df, ["k"])) == [("k", "a", 2), ("m", None, 5)]


def test_null_keys_form_one_group(spark):
    df = spark.createDataFrame([(None, 1, "y"), (None, 1, "x"), (None, 2, "z")], "k string, s int, v string")
    assert rows(smallest_per_key(df, ["k", "s"])) == [(None, 1, "x"), (None, 2, "z")]


def test_key_of_all_columns_is_a_distinct(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (2, 1)], "a int, b int")
    assert rows(smallest_per_key(df, ["b", "a"])) == [(1, 2), (2, 1)]


def test_column_order_is_kept_and_names_are_literal(spark):
    df = spark.createDataFrame([(1, "a", 2), (0, "a", 3)], "`v.w` int, k string, `a b` int")
    out = smallest_per_key(df, ["k"])
    assert out.columns == ["v.w", "k", "a b"]
    assert rows(out) == [(0, "a", 3)]


def test_survivor_does_not_depend_on_the_partitioning(spark):
    random.seed(1)
    data = [(random.randrange(50), random.choice("abc"), random.random()) for _ in range(2000)]
    expected = None
    for parts in (1, 3, 16):
        random.shuffle(data)
        df = spark.createDataFrame(data, "k int, a string, x double").repartition(parts)
        out = rows(smallest_per_key(df, ["k"]))
        expected = expected or out
        assert out == expected


value = st.one_of(st.none(), st.integers(-2, 2))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(value, value, value), min_size=1, max_size=30))
def test_smallest_per_key_against_brute_force(spark, data):
    def nulls_first(row):
        return tuple((cell is not None, cell or 0) for cell in row)

    expected = {}
    for row in sorted(data, key=nulls_first):
        expected.setdefault(row[0], row)
    df = spark.createDataFrame(data, "k int, a int, b int")
    assert rows(smallest_per_key(df, ["k"])) == sorted(expected.values(), key=repr)
