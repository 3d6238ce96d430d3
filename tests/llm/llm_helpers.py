"""Tables and helpers of the corpus tests."""

import pytest

SF = "/root/testdata/sf0.001"
SF_LARGER = "/root/testdata/sf0.01"


def rows(df):
    """The rows as a sorted list of tuples."""
    return sorted((tuple(row) for row in df.collect()), key=repr)


@pytest.fixture(scope="module")
def documents(spark):
    """All documents of the smallest tables, as (doc_id, text)."""
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture
def tables(tmp_path, spark):
    """Writes tables into a folder and returns it; the others are those of the smallest size."""

    def write(**frames):
        for name in ("documents", "labels", "benchmark", "pages", "embeddings"):
            frame = frames.get(name)
            path = f"{tmp_path}/{name}.parquet"
            (spark.read.parquet(f"{SF}/{name}.parquet") if frame is None else frame).write.parquet(path)
        return str(tmp_path)

    return write


def equal_hashes(letters="ab"):
    """Two words of 2048 letters with equal polynomial hashes modulo 2**64, whatever the base and the letters' values."""
    word = ""
    for i in range(2048):
        word += letters[bin(i).count("1") % 2]
    return word, word.translate(str.maketrans(letters, letters[::-1]))


def awkward_documents(spark, empty=False):
    """Nulls in every column, empty, blank and long texts, repeated rows and ids, columns whose names the operators use."""
    rows = [
        (1, "The quick brown fox. " * 60, "en", "a", 1260),
        (1, "The quick brown fox. " * 60, "en", "a", 1260),
        (1, "another text under the same number, jo@mail.example.com and +1 (988) 555-2485", "en", None, None),
        (2, "The quick brown fox. " * 60, "en", "b", 1260),
        (3, None, None, None, None),
        (None, "a text of nobody with the card 4539 1488 0343 6467 in it", "en", "a", 5),
        (None, None, None, None, None),
        (4, "", "de", "a", 0),
        (5, " \t\n\x0b\x0c\r ", "de", "a", 7),
        (6, "  é日本語🙂 \x00\x01\n\n### 123 !!", "fr", "a", 3),
        (7, " ".join(f"word{i % 997}" for i in range(60_000)), "de", "long", 1),
        (8, "x" * 300_000, "de", "long", 1),
        (9, "| a | b |\n" * 400, "es", "a", 1),
        (10, "eins zwei drei", "de", "a", 1),
    ]
    clashing = "score double, held_out string, predicted int, n_words string, kept string, ids int, row string, carried int"
    clashing += ", digest string, one int, fingerprint string, component_id int, shard string, place int, spans string, key int"
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {clashing}"
    n = len(clashing.split(","))
    return spark.createDataFrame([] if empty else [(*r, *[None] * n) for r in rows], schema)
