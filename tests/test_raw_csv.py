import csv
import datetime as dt
import random
import threading
from decimal import Decimal

import pytest

from martwright.plans.datasets import DATASETS
from martwright.sources.layout import Layout
from martwright.sources.raw_csv import read_raw
from martwright.testing import queries
from tests.conftest import rows


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_contract_types_keep_leading_zeros(spark, tmp_path):
    path = write(tmp_path / "s.csv", '﻿seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,"01409", rio ,\n')
    assert rows(read_raw(spark, path, DATASETS["sellers"])) == [("s1", "01409", " rio ", None)]
    inferred = read_raw(spark, path, DATASETS["sellers"], infer=True)
    assert rows(inferred.select("seller_zip_code_prefix")) == [(1409,)]


def test_money_and_times(spark, tmp_path):
    path = write(
        tmp_path / "i.csv",
        "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
        "o1,1,p1,s1,2017-09-19 09:45:35,58.90,13.29\no2,x,p1,s1,,abc,\n",
    )
    df = read_raw(spark, path, DATASETS["order_items"])
    assert dict(df.dtypes)["price"] == "decimal(18,2)"
    assert rows(df) == sorted(
        [
            ("o1", 1, "p1", "s1", dt.datetime(2017, 9, 19, 9, 45, 35), Decimal("58.90"), Decimal("13.29")),
            ("o2", None, "p1", "s1", None, None, None),
        ],
        key=repr,
    )


def test_header_decides_the_columns(spark, tmp_path):
    path = write(tmp_path / "c.csv", "note,product_category_name\n7,a\n")
    df = read_raw(spark, path, DATASETS["categories"])
    assert df.dtypes == [("note", "string"), ("product_category_name", "string")]
    assert rows(df) == [("7", "a")]


REVIEW_HEADER = ["review_id", "order_id", "review_score", "review_comment_title", "review_comment_message"]


def test_comments_may_span_lines(spark, tmp_path):
    path = write(
        tmp_path / "r.csv",
        ",".join(REVIEW_HEADER) + '\nr1,o1,5,"a, ""b""","line 1\nline 2"\nr2,o2,4,,""\n',
    )
    expected = sorted([("r1", "o1", 5, 'a, "b"', "line 1\nline 2"), ("r2", "o2", 4, None, None)], key=repr)
    assert rows(read_raw(spark, path, DATASETS["reviews"])) == expected


def as_file(folder, text):
    return write(folder / "r.csv", text)


def as_folder(folder, text):
    (folder / "parts").mkdir()
    write(folder / "parts" / "a.csv", text)
    write(folder / "parts" / "b.csv", ",".join(REVIEW_HEADER) + "\nlast,o,3,,\n")
    return str(folder / "parts")


HEAD = ",".join(REVIEW_HEADER)


@pytest.mark.parametrize("stored, more", [(as_file, []), (as_folder, [("last", "o", 3, None, None)])])
@pytest.mark.parametrize(
    "text, expected",
    [
        (  # an inch mark within a field that is not quoted is text
            HEAD + '\nr1,o1,1,t,screen 5" wide\nr2,o2,2,t,b\nr3,o3,3,t,c\nr4,o4,4,t,d\n',
            [("r1", "o1", 1, "t", 'screen 5" wide'), *[(f"r{i}", f"o{i}", i, "t", " abcd"[i]) for i in (2, 3, 4)]],
        ),
        (
            HEAD + '\nr1,o1,1,t,a 5" b\nr2,o2,2,t,c 6" d\nr3,o3,3,t,e\n',
            [("r1", "o1", 1, "t", 'a 5" b'), ("r2", "o2", 2, "t", 'c 6" d'), ("r3", "o3", 3, "t", "e")],
        ),
        ("\n" + HEAD + "\nr1,o1,1,t,a\nr2,o2,2,t,b\n", [("r1", "o1", 1, "t", "a"), ("r2", "o2", 2, "t", "b")]),
        (HEAD + "\rr1,o1,1,t,a\rr2,o2,2,t,b\r", [("r1", "o1", 1, "t", "a"), ("r2", "o2", 2, "t", "b")]),
        (HEAD + "\nr1,o1,1,t,a\n  \nr2,o2,2,t,b\n", [("r1", "o1", 1, "t", "a"), ("  ", *[None] * 4), ("r2", "o2", 2, "t", "b")]),
        (HEAD + '\nr1,o1,1,t,a\nr2,o2,2,t,"open\n', [("r1", "o1", 1, "t", "a"), ("r2", "o2", 2, "t", "open\n")]),
    ],
)
def test_awkward_files_are_read_alike_in_a_folder(spark, tmp_path, stored, more, text, expected):
    assert rows(read_raw(spark, stored(tmp_path, text), DATASETS["reviews"])) == sorted(expected + more, key=repr)


def test_files_with_another_header_raise(spark, tmp_path):
    write(tmp_path / "a.csv", HEAD + "\nr1,o1,1,title,comment\n")
    swapped = [*REVIEW_HEADER[:3], REVIEW_HEADER[4], REVIEW_HEADER[3]]
    write(tmp_path / "b.csv", ",".join(swapped) + "\nr2,o2,2,comment,title\n")
    with pytest.raises(Exception, match="header"):
        read_raw(spark, str(tmp_path), DATASETS["reviews"]).collect()


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_written_records_come_back(spark, tmp_path, line_end):
    random.seed(7)
    expected = []
    for part in range(2):
        with open(tmp_path / f"r{part}.csv", "w", newline="", encoding="utf-8") as file:
            out = csv.writer(file, lineterminator=line_end)
            out.writerow(REVIEW_HEADER)
            for i in range(800):
                text = "".join(random.choices(["a", '"', "\n", ",", " ", "é"], k=random.choice([0, 1, 5, 80])))
                out.writerow([f"r{part}-{i}", f"o{i}", i % 7, "t", text])
                expected.append((f"r{part}-{i}", f"o{i}", i % 7, "t", text or None))
    assert rows(read_raw(spark, str(tmp_path), DATASETS["reviews"])) == sorted(expected, key=repr)


def test_raw_files_are_written_several_at_a_time(tmp_path):
    """Each of four writes ends only when the others have begun."""
    together = threading.Barrier(4, timeout=20)

    class Waiting:
        def raw(self, name):
            return self

        @property
        def write(self):
            return self

        def options(self, **_):
            return self

        def csv(self, path):
            together.wait()

    queries._raw_files(Layout(str(tmp_path)), Waiting(), "orders", "sellers", "products", "payments")
