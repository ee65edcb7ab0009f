"""Merged percentile (a group's values plus a shared per-key set) vs brute force."""

import random

import numpy as np

from wardpulse.operators.aggregates import merged_percentile, running_before, running_last


def test_running_scans(spark):
    rows = [("a", i, 1 if i % 3 else 0, (i * 10 if i % 4 == 0 else None)) for i in range(50)]
    rows += [("b", i, 2, None) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, o int, w int, v int").repartition(5)
    rb = {(r.k, r.o): r._before for r in running_before(df, ["k"], ["o"], "w").collect()}
    rl = {(r.k, r.o): r._last for r in running_last(df, ["k"], ["o"], "v").collect()}
    for k, o, w, v in rows:
        assert rb[(k, o)] == sum(x[2] for x in rows if x[0] == k and x[1] < o)
        prev = [x[3] for x in rows if x[0] == k and x[1] <= o and x[3] is not None]
        assert rl[(k, o)] == (prev[-1] if prev else None)


def test_merged_percentile_brute_force(spark):
    rnd = random.Random(5)
    named = [(w, y, float(rnd.randint(1, 40))) for w in range(1, 9) for y in (1, 2)
             for _ in range(rnd.randint(0, 12))]
    shared = [(y, float(rnd.randint(1, 40))) for y in (1, 2) for _ in range(rnd.randint(5, 30))]
    groups = [(w, y) for w in range(1, 9) for y in (1, 2, 3)]
    N = spark.createDataFrame(named, "w int, y int, v double")
    U = spark.createDataFrame(shared, "y int, v double")
    G = spark.createDataFrame(groups, "w int, y int")
    for p in (0.5, 0.25, 0.9):
        got = {(r.w, r.y): r.m for r in merged_percentile(N, U, ["w", "y"], "y", "v", G, p, "m").collect()}
        for w, y in groups:
            vals = [v for ww, yy, v in named if (ww, yy) == (w, y)] + [v for yy, v in shared if yy == y]
            if vals:
                assert abs(got[(w, y)] - float(np.percentile(vals, p * 100))) < 1e-9, (w, y, p)
            else:
                assert (w, y) not in got
