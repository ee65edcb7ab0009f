"""The registered queries ``opN_<name>`` of this subpackage and their DuckDB SQL.

Each query applies its operator with production parameters to its whole
table; where SQL cannot express the result, ``tests/llm`` compares it with a
brute-force version instead.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .bond_scan import hard_negatives
from .common import table
from .gumbel_pieces import sample_segmentations
from .heap_bpe import token_counts
from .orc_ids import orc_round_trip
from .partenum import ngram_jaccard_components
from .periodic_runs import periodic_runs, planted, run_columns
from .piece_langid import predict_language
from .pii_boost import digest, personal_data
from .preference import ORACLE as PREFERENCE_SQL
from .preference import format_preferences
from .simhash_windows import contaminated
from .stable_kdtree import nearest
from .suffix_rules import repetition_rules
from .toxic_automata import toxicity

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_pii_boost(spark, sf_dir):
    return digest(personal_data(table(spark, sf_dir, "documents")))


@query
def op2_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"))


@query
def op5_gumbel_pieces(spark, sf_dir):
    return sample_segmentations(table(spark, sf_dir, "documents"), k=2, digest=True)


@query
def op6_toxic_automata(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_orc_ids(spark, sf_dir):
    return orc_round_trip(table(spark, sf_dir, "documents"))


@query
def op3_piece_langid(spark, sf_dir):
    return predict_language(table(spark, sf_dir, "documents"))


@query
def op4_suffix_rules(spark, sf_dir):
    return repetition_rules(table(spark, sf_dir, "documents"))


@query
def op8_preference(spark, sf_dir):
    """Pairs of one conversation: as it is, and with its last assistant turn replaced
    by that of the conversation whose id differs in the last bit (if there is one)."""
    turns = table(spark, sf_dir, "conversations").where("conv_id is not null")
    last = (turns.where("role = 'assistant'").groupBy("conv_id")
            .agg(F.max(F.struct("turn", "text")).alias("last")).select("conv_id", "last.*"))
    other = last.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.col("text").alias("other"), F.lit(True).alias("has"))
    swap = last.select("conv_id", F.col("turn").alias("at")).join(other, "conv_id")
    changed = turns.join(swap, "conv_id", "left")
    here = (F.col("role") == "assistant") & (F.col("turn") == F.col("at")) & F.col("has")
    rejected = changed.withColumn("text", F.when(here, F.col("other")).otherwise(F.col("text"))).select(*turns.columns)
    pairs = (turns.withColumn("is_chosen", F.lit(True)).unionAll(rejected.withColumn("is_chosen", F.lit(False)))
             .withColumnRenamed("conv_id", "pair_id"))
    return format_preferences(pairs)


ORACLES["op8_preference"] = PREFERENCE_SQL


@query
def op9_simhash_windows(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op10_partenum_join(spark, sf_dir):
    return ngram_jaccard_components(table(spark, sf_dir, "documents"), n=4, percent=85)


@query
def op11_bond_negatives(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


ORACLES["op11_bond_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike,
         CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
pos AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM p WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS "rank",
       other_id AS negative_id, positive_score, score AS negative_score
FROM pos JOIN p USING (anchor_id)
WHERE NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY "rank" <= 3"""


@query
def op12_stable_kdtree(spark, sf_dir):
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op13_periodic_runs(spark, sf_dir):
    return run_columns(periodic_runs(planted(table(spark, sf_dir, "documents")), digest=True))
