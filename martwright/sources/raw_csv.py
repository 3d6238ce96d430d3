"""Raw CSV files with a header row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from martwright.plans.datasets import Dataset

# RFC 4180: a quote inside a quoted field is doubled.
CSV = {"header": True, "quote": '"', "escape": '"'}


# The raw text of a record that does not fit the contract.
RECORD = "__record"

REJECTED = "record string, reasons array<string>, file string"


def read_raw(spark: SparkSession, path: str, dataset: Dataset, infer: bool = False) -> DataFrame:
    """The raw rows of ``dataset``: one file, or a folder of files with the same header.

    The types come from the dataset's contract, so the data is parsed once and codes such as zip
    prefixes keep their leading zeros; header columns outside the contract are read as text. A
    field that does not parse is NULL; a file whose header differs from the first one's raises.
    ``infer`` reads the way schema inference does instead: types guessed from a first pass, one
    record per line.

    Records of a multi-line dataset may span lines, so each of its files is read by one task,
    whatever its size; large raw data of that kind belongs in a folder of files.
    """
    if infer:
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    return read_checked(spark, path, dataset).drop(RECORD)


def read_checked(spark: SparkSession, path: str, dataset: Dataset) -> DataFrame:
    """The rows of ``read_raw`` with ``RECORD``: the record as it stands in the file if a field of it does not parse or it
    has another number of fields than the header, NULL otherwise. All columns must be read for it to be right."""
    header = spark.read.options(**CSV).csv(path).columns
    ddl = ", ".join(f"`{name}` {dataset.types.get(name, 'string')}" for name in header)
    reader = spark.read.options(**CSV, multiLine=dataset.multiline, enforceSchema=False, columnNameOfCorruptRecord=RECORD)
    return reader.schema(f"{ddl}, `{RECORD}` string").csv(path)


def rejected_records(checked: DataFrame, dataset: Dataset) -> DataFrame:
    """The rejected ones of ``read_checked``: the record, what is wrong with it, and its file.

    A reason names the column, its type and the text found there; a record without such a field has too few or too many.
    """
    columns = [name for name in checked.columns if name != RECORD]
    texts = ", ".join(f"`{name}` string" for name in columns)
    options = {key: str(value) for key, value in CSV.items() if key != "header"}
    bad = checked.where(F.col(RECORD).isNotNull()).withColumn("__text", F.from_csv(F.col(RECORD), texts, options))
    wrong = []
    for name in columns:
        text = F.nullif(F.col(f"__text.`{name}`"), F.lit(""))
        told = F.concat(F.lit(f"{name}: no {dataset.types.get(name, 'string')}: "), text)
        wrong.append(F.when(F.col(f"`{name}`").isNull() & text.isNotNull(), told))
    found = F.array_compact(F.array(*wrong))
    return bad.select(
        F.col(RECORD).alias("record"),
        F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("another number of fields"))).alias("reasons"),
        F.col("_metadata.file_path").alias("file"),
    )
