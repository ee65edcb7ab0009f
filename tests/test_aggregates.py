"""Exact percentile and mode against brute force, with a hot group and NULL keys."""

import random
from decimal import Decimal

import numpy as np

from wardpulse.operators.aggregates import grouped_mode, percentile_cont


def test_percentile_matches_numpy(spark):
    rnd = random.Random(7)
    rows = [("hot", float(rnd.randint(0, 500)))for _ in range(3000)]
    rows += [(f"g{i % 37}", float(rnd.randint(0, 99))) for i in range(2000)]
    rows += [(None, 1.0), (None, 4.0), ("single", 3.5), ("nulls", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    got = {r.g: r.m for r in percentile_cont(df, ["g"], "v", 0.5, out="m").collect()}
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    for g, vals in groups.items():
        assert abs(got[g] - float(np.percentile(vals, 50))) < 1e-9, g
    assert "nulls" not in got
    p90 = {r.g: r.m for r in percentile_cont(df, ["g"], "v", 0.9, out="m").collect()}
    assert abs(p90["hot"] - float(np.percentile(groups["hot"], 90))) < 1e-9


def test_percentile_decimal_exact(spark):
    df = spark.createDataFrame([("a", Decimal("1.00")), ("a", Decimal("1.01"))], "g string, v decimal(10,2)")
    m = percentile_cont(df, ["g"], "v").collect()[0]["median"]
    assert m == Decimal("1.005")


def test_mode_ties_lowest_nulls_ignored(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, "a"), (1, None), (1, None), (1, None),
                                (2, "z"), (2, "y"), (3, None)], "k int, v string")
    got = {r.k: r.m for r in grouped_mode(df, ["k"], "v", "m").collect()}
    assert got == {1: "a", 2: "y"}
