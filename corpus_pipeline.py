"""Corpus pipeline over the documents table.

Five stages, each on all that its predecessor kept, each written as Parquet in
the shared folder and read again. All but the last return the columns of the
documents they get.

* language: documents without a letter, or whose best language has less than
  half of the likelihood, go.
* near_duplicates: of each group of documents linked by five-word shingle sets
  with Jaccard similarity 0.8 or more one row stays: the one with the smallest id
  (null last), then the least text key, then the least hash of all columns. Rows of
  one id with texts that are not linked are different documents. Texts without words
  belong to no group and stay.
* decontamination: documents that hold a benchmark item go.
* personal_data: found spans are replaced by their kind; n_chars follows.
* pieces: two sampled piece encodings of each text, with inclusion scores.

Nulls, empty tables and extra columns pass as the operators' docstrings say; a
null text has no letter and goes in the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardpulse.llm.common import land, table
from wardpulse.llm.gumbel_pieces import sample_segmentations
from wardpulse.llm.partenum import ngram_jaccard_components, text_key
from wardpulse.llm.pii_boost import personal_data, redacted
from wardpulse.llm.piece_langid import predict_language
from wardpulse.llm.simhash_windows import without_contaminated

LEAST_SHARE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = predict_language(docs, carry=True)
    return judged.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SHARE)).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    name = lambda i, t: F.concat_ws("/", F.coalesce(i.cast("string"), F.lit("-")), t)
    groups = ngram_jaccard_components(docs, n=5, percent=80, detail=True)
    first = (groups.where("component is not null").groupBy("component")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("bare"), "doc_id", "text_key")).alias("r"))
             .select(name(F.col("r.doc_id"), F.col("r.text_key")).alias("name")))
    whole = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    rows = docs.select(whole, name(docs["doc_id"], text_key(docs["text"])).alias("name"),
                       F.coalesce(docs["text"], F.lit("")).rlike(r"[^\x20\x09-\x0D]").alias("worded"),
                       F.xxhash64(*[docs[c] for c in docs.columns]).alias("hash"))
    # repeated rows first: the window's limit leaves one of them in each task before the shuffle
    once = (rows.where("worded").withColumn("place", F.row_number().over(Window.partitionBy("name").orderBy("hash")))
            .where("place = 1").join(first, "name", "left_semi"))
    return once.select("row.*").unionAll(rows.where("not worded").select("row.*"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = personal_data(docs, carry=True).select("row", redacted(F.col("spans")).alias("clean"))
    # a null text stays null; the other columns are those of the row
    text = F.when(F.col("row.text").isNotNull(), F.col("clean"))
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    return clean.select(*[(new[c] if c in new else F.col("row")[c]).alias(c) for c in docs.columns])


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sample_segmentations(docs, k=2)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("personal_data", pii), ("pieces", pieces)]

#: No stage after the first is expressible in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = land(docs, name)
    return docs
