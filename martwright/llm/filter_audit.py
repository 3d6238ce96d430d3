"""Interaction of filters: what each one removes in every order of application, and what it adds on average.

Removal is a game of the filters: a coalition is worth the documents that fail any of its filters. Every document has a
bit for each filter it fails, so documents are counted once per part and bit pattern, and the worth of all coalitions is
a sum over at most 2**n patterns of each part. The potential of Hart and Mas-Colell is computed from the empty coalition
upwards: |S| P(S) = v(S) + the sum of P(S without i) over its filters i. The Shapley value of a filter is the potential
of all filters less the potential without it; a step of an order is the difference of two coalitions.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window, functions as F

#: A filter's condition of failure, from the text and its words.
Condition = Callable[[Column, Column], Column]

#: Name of each filter in its place, and when a document fails it.
CONDITIONS: dict[str, Condition] = {
    "A": lambda text, words: F.size(words) < 200,
    "B": lambda text, words: F.size(F.array_distinct(words)) * 100 < F.size(words) * 50,
    "C": lambda text, words: F.length(F.regexp_replace(text, "[^A-Z]+", "")) * 100 > F.length(text) * 3,
    "D": lambda text, words: text.rlike("[#$%&*|]"),
}
#: The filter that is failed by copies of a document with a smaller id.
COPIES = "E"

WORTHS = ("all", "good", "toxic")


def words(text: Column) -> Column:
    """Maximal runs of other characters than ASCII white space."""
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda word: word != "")


def _id_key(doc_id: Column, digest: Column | None = None) -> Column:
    """The id as text; a null id has the digest for a key, which no id equals, so that null ids do not meet in one task."""
    key = F.concat(F.lit("id "), doc_id.cast("string"))
    return key if digest is None else F.coalesce(key, F.concat(F.lit("no id "), F.hex(digest)))


def patterns(docs: DataFrame, labels: DataFrame, conditions: dict[str, Condition]) -> DataFrame:
    """(part, mask, all, good, toxic): documents of each language by the filters they fail, bit i for the i-th filter.

    ``docs`` (doc_id, text, lang): a null text is empty, a null language is the empty string. A row fails the last filter if a
    row with a smaller id has the same text; rows of one id are no copies of each other, a null id is neither smaller nor
    larger than another. ``labels`` (doc_id, quality, toxic): a document is good, or toxic, if any label of its id says so.
    Texts are read once, in one pass without a shuffle; from there on rows are an id, a digest and small numbers.
    """
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    read = docs.select(
        docs["doc_id"].alias("doc_id"),
        F.coalesce(docs["lang"].cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        text.alias("text"),
        words(text).alias("words"),
    )
    bits = [
        F.when(fails(F.col("text"), F.col("words")), 1 << place).otherwise(0)
        for place, fails in enumerate(conditions.values())
    ]
    marked = read.select("doc_id", "part", "digest", reduce(lambda a, b: a + b, bits, F.lit(0)).alias("mask"))
    counted = marked.groupBy("doc_id", "part", "digest", "mask").agg(F.count("*").alias("n"))
    keyed = counted.withColumn("id_key", _id_key(F.col("doc_id"), F.col("digest")))
    judged = (
        labels.where(labels["doc_id"].isNotNull())
        .groupBy(_id_key(labels["doc_id"]).alias("id_key"))
        .agg(F.max((labels["quality"] == 1).cast("int")).alias("good"), F.max((labels["toxic"] == 1).cast("int")).alias("toxic"))
        .where("good = 1 or toxic = 1")
    )
    said = [F.coalesce(F.col(name), F.lit(0)).alias(name) for name in ("good", "toxic")]
    known = keyed.join(judged, "id_key", "left").select("doc_id", "part", "digest", "mask", "n", *said)
    # At most a row for each language and label of a text leaves a task, however many copies the text has. The smallest
    # id of a text and its rows are found in two steps: within the group, then over the groups of the text.
    here = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))
    grouped = known.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.min("doc_id").alias("smallest"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("nameless"),
        F.min(here).alias("first"),
    )
    # an id may stand in several groups of a text, but has one row in each
    first = F.min("smallest").over(Window.partitionBy("digest"))
    originals = F.when(F.col("smallest") == first, F.col("first.n")).otherwise(0) + F.col("nameless")
    split = grouped.withColumn("originals", originals)
    bit = 1 << len(conditions)
    sides = F.explode(
        F.array(
            F.struct(F.col("mask").alias("mask"), F.col("originals").alias("n")),
            F.struct((F.col("mask") + bit).alias("mask"), (F.col("n") - F.col("originals")).alias("n")),
        )
    )
    each = split.select("part", "good", "toxic", sides.alias("side")).select("part", "good", "toxic", "side.mask", "side.n")
    return each.groupBy("part", "mask").agg(
        F.sum("n").alias("all"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")
    )


def worths(found: DataFrame, filters: int) -> DataFrame:
    """(part, n, all, good, toxic): rows of the part, and for each worth an array by coalition (a mask of its filters)."""
    coalitions = range(1 << filters)

    def worth(name: str) -> Column:
        fails = [F.sum(F.when(F.col("mask").bitwiseAND(s) != 0, F.col(name)).otherwise(0)) for s in coalitions]
        return F.array(*fails).alias(name)

    return found.groupBy("part").agg(F.sum("all").alias("n"), *(worth(name) for name in WORTHS))


def potentials(worth: Column, filters: int) -> Column:
    """Array by coalition S of |S|! times the potential of S, which is a whole number.

    With Q(S) = |S|! P(S) the recursion |S| P(S) = v(S) + sum of P(S - i) reads Q(S) = (|S| - 1)! v(S) + sum of Q(S - i). It
    is a fold over the coalitions in the order of their masks, in which every S - i stands before S.
    """

    bits = F.array(*(F.lit(1 << i) for i in range(filters)))
    factorials = F.array(*(F.lit(factorial(k)).cast("long") for k in range(filters)))

    def step(done: Column, s: Column) -> Column:
        members = F.filter(bits, lambda bit: s.bitwiseAND(bit) != 0)
        own = F.element_at(factorials, F.size(members)) * F.element_at(worth, s + 1)
        return F.concat(done, F.array(F.aggregate(members, own, lambda q, bit: q + F.element_at(done, s - bit + 1))))

    coalitions = F.sequence(F.lit(1), F.lit((1 << filters) - 1))
    return F.aggregate(coalitions, F.array(F.lit(0).cast("long")), step)


def audit(
    docs: DataFrame, labels: DataFrame, conditions: dict[str, Condition] = CONDITIONS, copies: str = COPIES
) -> DataFrame:
    """Per part, order of the filters and step: documents kept after the step, and what its filter does there.

    ``removed`` is what it takes here, ``redundant`` what fails it but was taken before, ``unique_fails`` what fails no other
    filter, ``good_lost`` and ``toxic_lost`` the removed ones so labelled, ``shapley`` its removals summed over all orders.
    Names of filters are one character each; an order is written as their names, applied left to right. All rows of the
    result come from one row for each part. Without documents there are no parts and no rows.
    """
    names = "".join([*conditions, copies])
    count, whole = len(names), (1 << len(names)) - 1
    orders = F.split(F.lit(",".join("".join(order) for order in permutations(names))), ",")
    parts = worths(patterns(docs, labels, conditions), count).withColumn("potential", potentials(F.col("all"), count))
    steps = parts.withColumn("filter_order", F.explode(orders)).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(count))).alias("step")
    )

    def coalition(letters: Column) -> Column:
        return reduce(lambda a, b: a + b, (F.when(F.instr(letters, name) > 0, 1 << i).otherwise(0) for i, name in enumerate(names)))

    def worth(name: str, mask: Column) -> Column:
        return F.element_at(name, mask + 1)

    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    before, own = F.col("before"), F.col("own")
    steps = steps.withColumn("filter", letter).withColumns(
        {"own": coalition(F.col("filter")), "before": coalition(F.substring("filter_order", F.lit(1), F.col("step") - 1))}
    )
    removed = worth("all", before + own) - worth("all", before)
    return steps.select(
        "part",
        "filter_order",
        "step",
        "filter",
        (F.col("n") - worth("all", before + own)).alias("kept"),
        removed.alias("removed"),
        (worth("all", own) - removed).alias("redundant"),
        (worth("all", F.lit(whole)) - worth("all", whole - own)).alias("unique_fails"),
        (worth("good", before + own) - worth("good", before)).alias("good_lost"),
        (worth("toxic", before + own) - worth("toxic", before)).alias("toxic_lost"),
        (worth("potential", F.lit(whole)) - count * worth("potential", whole - own)).alias("shapley"),
    )
