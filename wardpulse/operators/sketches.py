"""Mergeable statistics (A-3, A-8, A-14): a sketch per small group, such as a ward's
month, from which any coarser group (year, city) is answered without its rows.

* quantiles by KLL sketches, as a quick way beside the exact percentile;
* distinct values by HyperLogLog (quick) or theta sketches (quick, and exact as long
  as a group holds fewer values than the sketch's entries);
* counts, sums, minima and maxima, which merge exactly.

A sketch is a column of bytes of bounded size, so a table of them grows with the
groups, not with the readings, and new months only add rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Entries of a KLL sketch (rank error about 1.3 % at 200) and log2 of a theta sketch's.
KLL_K, THETA_LOG = 200, 12


def build(rows: DataFrame, keys: Sequence[str], value: str, member: str | None = None) -> DataFrame:
    """One row per key with exact ``n``, ``total``, ``least``, ``most`` of a value, its
    quantile sketch and, of ``member``, distinct sketches. NULL values count nowhere."""
    v = F.col(value).cast("double")
    parts = [F.count(value).alias("n"), F.sum(value).alias("total"), F.min(value).alias("least"), F.max(value).alias("most"),
             F.kll_sketch_agg_double(v, KLL_K).alias("quantiles")]
    if member:
        parts += [F.hll_sketch_agg(member).alias("distinct_hll"), F.theta_sketch_agg(member, THETA_LOG).alias("distinct_theta")]
    return rows.groupBy(*keys).agg(*parts)


def merge(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Coarser groups from finer ones; the same columns."""
    parts = [F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("least").alias("least"), F.max("most").alias("most"),
             F.kll_merge_agg_double("quantiles").alias("quantiles")]
    if "distinct_hll" in sketches.columns:
        parts += [F.hll_union_agg("distinct_hll").alias("distinct_hll"), F.theta_union_agg("distinct_theta").alias("distinct_theta")]
    return sketches.groupBy(*keys).agg(*parts)


def quantile(share: float, sketch: str = "quantiles") -> Column:
    """About the value below which a share of the group's values lie."""
    return F.kll_sketch_get_quantile_double(sketch, F.lit(share))


def distinct(exact_below: bool = True) -> Column:
    """The number of distinct members: exact up to the theta sketch's entries."""
    name = "distinct_theta" if exact_below else "distinct_hll"
    fn = F.theta_sketch_estimate if exact_below else F.hll_sketch_estimate
    return F.round(fn(name)).cast("bigint")
