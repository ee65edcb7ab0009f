"""Distributed ranks on more rows than a range sampler reads, with exchange
reuse off: every rank once, every median exact."""

import pytest
from pyspark.sql import functions as F

from wardpulse.operators.aggregates import merged_percentile, percentile_cont, running_before, running_last

N = 1_000_000


@pytest.fixture()
def no_reuse(spark):
    spark.conf.set("spark.sql.exchange.reuse", "false")
    yield spark
    spark.conf.unset("spark.sql.exchange.reuse")


def _rows(spark, n=N):
    return (spark.range(n).withColumn("g", (F.col("id") % 3).cast("int"))
            .withColumn("o", F.xxhash64("id")).withColumn("pad", F.concat(F.lit("x"), F.col("id").cast("string")))
            .withColumn("w", F.lit(1).cast("bigint")).repartition(9))


def test_every_rank_once(no_reuse):
    out = running_before(_rows(no_reuse), ["g"], ["o"], "w", "r")
    got = out.groupBy("g").agg(F.count("*").alias("n"), F.countDistinct("r").alias("d"), F.min("r").alias("lo"),
                               F.max("r").alias("hi"), F.countDistinct("pad").alias("p")).collect()
    assert sum(r.n for r in got) == N
    for r in got:
        assert (r.d, r.lo, r.hi, r.p) == (r.n, 0, r.n - 1, r.n)


def test_last_value_carried(no_reuse):
    rows = _rows(no_reuse).withColumn("v", F.when(F.col("id") % 1000 == 0, F.col("id")))
    out = running_last(rows, ["g"], ["o"], "v", "l").groupBy("g").agg(
        F.countDistinct("l").alias("d"), F.count("*").alias("n"),
        F.sum((F.col("v").isNotNull() & (F.col("v") != F.col("l"))).cast("int")).alias("bad")).collect()
    want = {r.g: r.d for r in rows.groupBy("g").agg(F.countDistinct("v").alias("d")).collect()}
    assert {r.g: r.d for r in out} == want and all(r.bad == 0 for r in out) and sum(r.n for r in out) == N


def test_medians_equal_builtin(no_reuse):
    rows = _rows(no_reuse).withColumn("x", F.pmod("o", F.lit(10 ** 9)).cast("double"))
    got = {r.g: r.median for r in percentile_cont(rows, ["g"], "x").collect()}
    want = {r.g: r.m for r in rows.groupBy("g").agg(F.percentile("x", 0.5).alias("m")).collect()}
    assert got == want


def test_merged_medians_equal_builtin(no_reuse):
    rows = _rows(no_reuse).withColumn("x", F.pmod("o", F.lit(10 ** 9)).cast("double"))
    named = rows.where("id < 600000").withColumn("k", F.col("g") % 2).select("k", "g", "x")
    shared = rows.where("id >= 600000").withColumn("k", F.col("id") % 2).withColumn("k", F.col("k").cast("int"))
    groups = named.select("k", "g").distinct()
    got = {(r.k, r.g): r.median for r in merged_percentile(named, shared.select("k", "x"), ["k", "g"], "k", "x",
                                                           groups).collect()}
    both = named.unionByName(shared.select("k", "x").join(groups, "k").select("k", "g", "x"))
    want = {(r.k, r.g): r.m for r in both.groupBy("k", "g").agg(F.percentile("x", 0.5).alias("m")).collect()}
    assert got == want and len(got) == 3
