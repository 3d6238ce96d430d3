"""Filter audit against a plain simulation of every order."""

import random
import re
from itertools import permutations

import pytest
from llm_helpers import awkward_documents
from pyspark.sql import functions as F

from martwright.llm import filter_audit

LABELS = "doc_id long, quality int, toxic int"


def failures(text):
    words = re.findall("[^\x20\x09-\x0d]+", text)
    found = set()
    found |= {"A"} if len(words) < 200 else set()
    found |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
    found |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text) else set()
    found |= {"D"} if re.search("[#$%&*|]", text) else set()
    return found


def simulated(docs, labels):
    """docs: (doc_id, text, lang) rows; labels: (doc_id, quality, toxic) rows."""
    rows = []
    for doc_id, text, lang in docs:
        fails = failures(text or "")
        if doc_id is not None and any(i is not None and i < doc_id and (t or "") == (text or "") for i, t, _ in docs):
            fails.add("E")
        good = any(i == doc_id and q == 1 for i, q, _ in labels if i is not None)
        toxic = any(i == doc_id and x == 1 for i, _, x in labels if i is not None)
        rows.append((lang or "", fails, good, toxic))
    result, shapley = {}, {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        for order in permutations("ABCDE"):
            left = own
            for step, name in enumerate(order, 1):
                gone = [r for r in left if name in r[1]]
                left = [r for r in left if name not in r[1]]
                shapley[part, name] = shapley.get((part, name), 0) + len(gone)
                result[part, "".join(order), step] = [
                    name,
                    len(left),
                    len(gone),
                    sum(name in r[1] for r in own) - len(gone),
                    sum(r[1] == {name} for r in own),
                    sum(r[2] for r in gone),
                    sum(r[3] for r in gone),
                ]
    return {key: (*value, shapley[key[0], value[0]]) for key, value in result.items()}


def audited(docs, labels):
    rows = filter_audit.audit(docs, labels).collect()
    found = {tuple(r)[:3]: tuple(r)[3:] for r in rows}
    assert len(found) == len(rows)
    return found


def made(seed, n=150):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "DELTA", "#tag", "épsilon", "50%", "日本"]
    texts = [
        " ".join(rng.choice(words[: rng.randint(1, 8)]) if rng.random() < 0.5 else f"w{rng.random()}" for _ in range(rng.choice([3, 150, 210, 400])))
        for _ in range(n // 3)
    ]
    docs = [(rng.choice([None, *range(n)]), rng.choice([*texts, None, ""]), rng.choice(["en", "de", "", None])) for _ in range(n)]
    labels = [(rng.choice([None, *range(n)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(n)]
    return docs, labels


@pytest.mark.parametrize("seed", range(3))
def test_all_orders_simulated(spark, seed):
    docs, labels = made(seed)
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(5)
    assert audited(frame, spark.createDataFrame(labels, LABELS)) == simulated(docs, labels)


def test_awkward_rows_and_clashing_columns(spark):
    docs = awkward_documents(spark).withColumns({name: F.lit("x") for name in ("mask", "part", "n", "words", "good", "first")})
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()]
    labels = [(1, 1, 0), (1, 0, 1), (None, 1, 1), (2, None, None), (99, 1, 1)]
    frame = spark.createDataFrame(labels, LABELS).withColumn("part", F.lit("x"))
    assert audited(docs, frame) == simulated(rows, labels)


def test_empty_tables(spark):
    docs, labels = awkward_documents(spark), spark.createDataFrame([], LABELS)
    assert audited(docs.limit(0), labels) == {}
    found = audited(docs, labels)
    assert len({key[0] for key in found}) * 600 == len(found) and all(f[5] == f[6] == 0 for f in found.values())


def test_no_task_gets_all_copies(spark):
    """Whatever the copies of a text, its digest's group has a row for each language and label."""
    docs = spark.range(3000).selectExpr("id as doc_id", "'the same text' as text", "if(id % 2 = 0, 'en', 'de') as lang")
    labels = spark.createDataFrame([(5, 1, 0), (8, 0, 1)], LABELS)
    found = {tuple(r) for r in filter_audit.patterns(docs, labels, filter_audit.CONDITIONS).collect() if r["all"]}
    # the first copy fails A (3 words) only, the others are copies too
    assert found == {("en", 1, 1, 0, 0), ("en", 17, 1499, 0, 1), ("de", 17, 1500, 1, 0)}
    plan = filter_audit.patterns(docs, labels, filter_audit.CONDITIONS)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
