"""The corpus pipeline: quality, near-duplicates, benchmark passages, personal data, tokens.

Every stage reads all that its predecessor kept, applies one operator of ``martwright.llm`` to it and returns rows with
the columns of ``documents``, whatever these are; the last one returns token rows. ``run`` writes what a stage returns
as Parquet to the shared folder and reads it again.

Decisions meet their rows without relying on doc_id, which may be null or repeated: a row is filtered or carried through
the operator, or is found again by a digest of its text, on which alone the decision depends. An empty table gives an empty
one in every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from martwright.llm import bpe, decontaminate, pii, quality_classifier, simhash
from martwright.llm.queries import public_tokenizer, remainder, table
from martwright.llm.store import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Rows below it are rejected by the quality classifier.
LEAST_QUALITY = 0.5


def _row(docs: DataFrame) -> Column:
    """All columns of ``docs`` as one, so that their names clash with none."""
    return F.struct(*(docs[name] for name in docs.columns)).alias("row")


def _digest(docs: DataFrame) -> Column:
    """Of the text; a null text counts as empty."""
    return F.sha2(F.coalesce(docs["text"].cast("string"), F.lit("")), 256)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier gives at least an even chance of good quality. Empty and null texts score by the bias."""
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"), remainder(3) != 1)
    return quality_classifier.accepted(docs, model, LEAST_QUALITY)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: the smallest doc_id, then text digest; rows with null ids come last.

    Of several rows with that id and text one stays, by a hash of its columns. Texts without words are one group.
    """
    key = F.struct(docs["doc_id"].isNull().alias("missing"), docs["doc_id"].alias("id"), _digest(docs).alias("digest"))
    keyed = docs.select(_row(docs), key.alias("doc_id"), docs["text"].alias("text"))
    found = simhash.near_duplicates(keyed, shingle=3, radius=2)
    first = found.select(F.col("component_id").alias("doc_id")).distinct()
    plain = [f"row.`{f.name}`" for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    one = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64(*plain)))
    kept = keyed.select("row", "doc_id").join(first, "doc_id", "left_semi").withColumn("one", one)
    return kept.where("one = 1").select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in which no window of the benchmark occurs. Texts without words stay."""
    keyed = docs.select(_row(docs), _digest(docs).alias("doc_id"), docs["text"].alias("text"))
    index = stored(decontaminate.positional_index(keyed))
    found = decontaminate.contamination(index, table(spark, sf_dir, "benchmark"))
    hit = found.where("n_hit > 0").select("doc_id").distinct()
    return keyed.join(hit, "doc_id", "left_anti").select("row.*")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows; spans of personal data are replaced by their kind in brackets, and n_chars of such rows follows."""
    found = pii.personal_data(docs, _row(docs))
    text = pii.redacted(F.coalesce(F.col("carried.text").cast("string"), F.lit("")), F.col("spans"))
    some = F.size("spans") > 0
    columns = []
    for f in docs.schema.fields:
        old = F.col(f"carried.`{f.name}`")
        new = {"text": text, "n_chars": F.length(text)}.get(f.name)
        columns.append((old if new is None else F.when(some, new.cast(f.dataType)).otherwise(old)).alias(f.name))
    return found.select(*columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256) of every row; null texts have no tokens."""
    tokenizer = public_tokenizer()
    decoded = bpe.decode(bpe.encode(docs, tokenizer), tokenizer)
    return decoded.select(
        "doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("pii", personal_data),
    ("byte_level_bpe", tokens),
]

#: The classifier's weights and the tokens have no SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
