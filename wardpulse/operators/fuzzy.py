"""G-8 fuzzy ward-name match: trigram similarity as a top-1 set-similarity join.

Trigrams follow pg_trgm: lower-cased words (runs of letters and digits), each
padded with two spaces in front and one behind, as a set. Similarity is
|A n B| / |A u B|; a match needs similarity above the threshold (0.3 by
default), the best ward wins, ties to the lowest id.

Only the best ward of a name is wanted, so thresholds fall: first names whose
trigrams equal a ward's (an equi-join on the sorted set), then 0.9, 0.7, 0.5 and
the threshold itself. A name that has any ward at a threshold has its best ward
there, is resolved and leaves; only the rest meet the many candidates of a low
threshold. Steps end early when no name is left.

Each step is exact without comparing all pairs: tokens are ordered by global
frequency (rarest first) and two sets with Jaccard >= t must share a token among
their first |S| - ceil(t |S|) + 1 tokens (prefix filtering), with sizes within t
of each other and enough tokens left after the shared one (positional
filtering). Candidates come from an equi-join on those prefix tokens only; the
exact similarity is then computed on the candidate pairs with array functions.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardpulse.functions.numeric import round_ratio
from wardpulse.session import checkpoint_dir


def trigrams(c: Column) -> Column:
    words = F.filter(F.split(F.lower(c), "[^\\p{L}\\p{N}]+"), lambda w: w != "")
    grams = F.flatten(F.transform(words, lambda w: F.transform(
        F.sequence(F.lit(1), F.length(w) + 1),
        lambda i: F.substr(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3)))))
    return F.array_distinct(grams)


STEPS = (0.9, 0.7, 0.5)


def _ordered(sets: DataFrame, key: str, freq: DataFrame) -> DataFrame:
    """(key, _o): each set's tokens, rarest first."""
    return (sets.select(key, F.explode("_g").alias("_t")).join(freq, "_t")
            .groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_f", "_t"))).alias("_o"))
            .select(key, F.transform("_o", lambda x: x["_t"]).alias("_o")))


def _prefixed(ordered: DataFrame, key: str, t: float, side: str) -> DataFrame:
    """Each set's prefix tokens for threshold t, one row per token, with the
    token's position and the set's size."""
    size = F.size("_o")
    return ordered.select(key, size.alias(f"_n{side}"), F.posexplode(
        F.slice("_o", F.lit(1), size - F.ceil(F.lit(t) * size).cast("int") + 1)).alias(f"_i{side}", "_t"))


def candidate_pairs(a: DataFrame, b: DataFrame, t: float) -> DataFrame:
    """(_name, _wid) pairs that hold every pair with Jaccard >= t, from the ordered
    sets of names and wards."""
    # a little lower, so that rounding keeps the filter complete
    t = math.nextafter(t, 0.0)
    pa, pb = _prefixed(a, "_name", t, "a"), _prefixed(b, "_wid", t, "b")
    # positional filter: at a pair's first shared token the overlap is at most
    # 1 + the tokens left on the shorter side; Jaccard >= t needs an overlap of
    # t/(1+t) * (|A| + |B|). A pair that can qualify keeps that row, so the
    # other rows may be dropped before the dedup.
    need = F.ceil(F.lit(t / (1 + t)) * (F.col("_na") + F.col("_nb")) - 1e-9)
    room = 1 + F.least(F.col("_na") - 1 - F.col("_ia"), F.col("_nb") - 1 - F.col("_ib"))
    sizes = (F.col("_na") >= F.lit(t) * F.col("_nb") - 1e-9) & (F.col("_nb") >= F.lit(t) * F.col("_na") - 1e-9)
    return pa.join(pb, "_t").where(sizes & (room >= need)).select("_name", "_wid").distinct()


def fuzzy_match(names: DataFrame, wards: DataFrame, name_col: str, threshold: float = 0.3,
                key: str = "ward_id", ward_name: str = "ward_name", steps: tuple[float, ...] = STEPS) -> DataFrame:
    """Best ward per distinct ``name_col`` value: (name, ward_id, similarity)."""
    checkpoint_dir(names.sparkSession)
    a = (names.select(F.col(name_col).alias("_name")).where(F.col("_name").isNotNull()).distinct()
         .withColumn("_g", F.array_sort(trigrams(F.col("_name")))).where(F.size("_g") > 0))
    b = (wards.select(F.col(key).alias("_wid"), F.col(ward_name).alias("_wname"))
         .withColumn("_g", F.array_sort(trigrams(F.col("_wname")))).where(F.size("_g") > 0))
    same = b.groupBy("_g").agg(F.min("_wid").alias("_wid"))
    a = a.join(same, "_g", "left").checkpoint()
    found = [a.where("_wid is not null").select("_name", "_wid", F.size("_g").alias("_sh"), F.size("_g").alias("_un"))]
    rest = a.where("_wid is null").drop("_wid")
    falling = [t for t in sorted(steps, reverse=True) if t > threshold] + [threshold]
    if not rest.isEmpty():
        freq = (rest.select(F.explode("_g").alias("_t")).unionByName(b.select(F.explode("_g").alias("_t")))
                .groupBy("_t").agg(F.count(F.lit(1)).alias("_f")))
        left = _ordered(rest, "_name", freq).checkpoint()
        right = _ordered(b, "_wid", freq).checkpoint()
        for t in falling:           # five steps at most
            pairs = (candidate_pairs(left, right, t)
                     .join(left.select("_name", F.col("_o").alias("_ga")), "_name")
                     .join(right.select("_wid", F.col("_o").alias("_gb")), "_wid")
                     .withColumn("_sh", F.size(F.array_intersect("_ga", "_gb")))
                     .withColumn("_un", F.size("_ga") + F.size("_gb") - F.col("_sh"))
                     .withColumn("_sim", F.col("_sh").cast("double") / F.col("_un").cast("double"))
                     .where(F.col("_sim") > t if t == threshold else F.col("_sim") >= t))
            best = (pairs.groupBy("_name").agg(F.min_by(F.struct("_wid", "_sh", "_un"),
                                                        F.struct(-F.col("_sim"), F.col("_wid"))).alias("_b"))
                    .select("_name", "_b.*").checkpoint())
            found.append(best)
            if t == threshold:
                break
            left = left.join(best, "_name", "left_anti").checkpoint()
            if left.isEmpty():
                break
    best = reduce(DataFrame.unionAll, found)
    return best.select(F.col("_name").alias(name_col), F.col("_wid").alias(key),
                       round_ratio(F.col("_sh"), F.col("_un"), 4, precision=6).alias("similarity"))
