import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def corpus(spark):
    """All documents of the smallest tables."""
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns with
    the names that operators use for their own."""
    long = "one two three four five six seven eight nine ten " * 4000 + "\n"
    rows = [(1, "plain words in a short text that says something new today", "en", "a"),
            (2, None, "en", "a"), (3, "", "en", None), (4, " \n\t ", None, "a"), (5, long, "en", "b"),
            (6, "same text here for all of us to read", "en", "b"), (7, "same text here for all of us to read", "de", "b"),
            (7, "same text here for all of us to read", "de", "b"), (7, "another text under the same id as before", "de", "b"),
            (None, "a row without any id but with words", "en", "c"), (None, None, None, None),
            (8, "x", "fr", "c"), (9, "çà déjà vu\n\nöffnen ß   \r\n漢字 \U0001f600\n", "fr", "c"), (10, "1 2 3 4 5", "fr", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for name in ("n_chars", "n_words", "kept", "fp", "key", "shard", "part", "rest", "ids", "start", "score", "k", "kd", "h"):
        df = df.withColumn(name, F.lit(7).cast("long"))
    return df.repartition(3).cache()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
