import pytest

from martwright.llm import ship


@pytest.mark.parametrize("before, after", [("64m", str(8 << 20)), ("1g", str(8 << 20)), ("2m", "2m")])
def test_batches_are_bounded(spark, conf, before, after):
    conf("spark.sql.execution.arrow.maxBytesPerBatch", before)
    ship.ship(spark)
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == after


def test_functions_keep_their_results():
    assert list(ship.lean(lambda items: (x + 1 for x in items))(iter([1, 2]))) == [2, 3]
    assert ship.lean_group(lambda table: table + 1)(1) == 2
    assert ship.lean_group(lambda left, right: left - right)(5, 2) == 3
