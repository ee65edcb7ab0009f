"""Rows that the tests of this folder share."""

import duckdb
import pytest

SF_SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: nulls, empties, ties, repeated rows, odd characters and one very long text
ODD = [
    (1, None), (2, ""), (3, " \t\n\r\v\f "), (4, "one"), (5, "one"), (5, "one"), (6, "a b c"), (7, "A  b\nc"),
    (8, "é ñ 日本 𝒳𝒴 😀 ́x"), (9, "<s> </s> <|endoftext|> ▁ \x00"), (10, "word " * 4000),
    (11, "longword" * 900), (12, "1.2.3.4 x@y.zz +1 (555) 123-4567 4111 1111 1111 1111 " * 30), (None, "a text without id"),
    (13, " leading  double   blanks "), (14, "… 　\x1c\x85 strange blanks"), (15, "the same line\n" * 50),
]


@pytest.fixture(scope="session")
def small_rows():
    return duckdb.sql(f"SELECT doc_id, text, lang, source, n_chars FROM '{SF_SMALL}/documents.parquet'").fetchall()


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, with extra columns whose names clash with the operators' own."""
    rows = [(i, t, None if k % 3 else "en", f"s{k}", len(t or "")) for k, (i, t) in enumerate(ODD)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    from pyspark.sql import functions as F
    return df.select("*", F.lit(7).alias("score"), F.lit("x").alias("spans"), F.lit(True).alias("kept"),
                     F.lit(1).alias("class"), F.lit(2).alias("slice"), F.lit(3).alias("start"), F.lit("t").alias("_t"))


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
