"""Operators on vectors (11, 12) against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import SF_SMALL
from wardpulse.llm import queries as Q
from wardpulse.llm import stable_kdtree, vector_blocks
from wardpulse.llm.bond_scan import Block, hard_negatives, in_windows, nearest_alike
from wardpulse.llm.stable_kdtree import chi_square, nearest, stop_ratio
from wardpulse.llm.vector_blocks import to_bytes

SCHEMA = "vec_id long, embedding array<double>, label int, row long, dim string"


def _frame(spark, rows):
    """Rows (vec_id, embedding, label), with extra columns whose names clash."""
    return spark.createDataFrame([(i, v, c, 9, "x") for i, v, c in rows], SCHEMA).repartition(3)


def _odd_vectors(rng, n=300, dim=6):
    """Ties, repeated rows and ids, nulls, bad components, other lengths, zeros."""
    rows = [(k, rng.normal(size=dim).round(1).tolist(), int(rng.integers(0, 3))) for k in range(n)]
    rows += [(k + 1000, rows[5][1], int(rng.integers(0, 3))) for k in range(40)]          # copies
    rows += [rows[50], rows[50], (100, rows[7][1], 1), (7, rows[9][1], 2)]
    rows += [(2000, None, 1), (2050, [None] + [0.0] * (dim - 1), 1), (2100, [math.nan] + [0.0] * (dim - 1), 1),
             (2150, [math.inf] + [1.0] * (dim - 1), 0), (2200, rows[0][1], None), (None, rows[0][1], 1),
             (2250, [0.0] * dim, 1), (2300, [], 1), (2350, [], 2), (2400, [1.0, 2.0], 1), (2450, [1.0, 2.5], 1),
             (2500, [1.0, 1.5], 2), (2550, [1e300, 1e-300] + [0.0] * (dim - 2), 1)]
    return rows


def _hard(rows):
    """Brute force: each row stands for itself."""
    rows = [(i, v, c) for i, v, c in rows if i is not None and c is not None and v is not None
            and all(x is not None and math.isfinite(x) for x in v)]
    rows = [(i, [math.floor(256 * x) for x in v], c) for i, v, c in rows if all(abs(x) < 2 ** 19 for x in v)]
    out = []
    for a, (i, v, c) in enumerate(rows):
        if i % 50:
            continue
        others = [(-sum(x * y for x, y in zip(v, w)), j, d) for b, (j, w, d) in enumerate(rows)
                  if b != a and len(v) == len(w)]
        others.sort(key=lambda o: o[:2])
        for s, j, _ in [o for o in others if o[2] == c][:5]:
            hard = [o for o in others if o[2] != c and -50 * s <= -100 * o[0] <= -95 * s][:3]
            out += [(i, j, r + 1, h[1], -s, -h[0]) for r, h in enumerate(hard)]
    return out


def test_hard_negatives_equal_brute_force(spark):
    rows = _odd_vectors(np.random.default_rng(1))
    got = hard_negatives(_frame(spark, rows), F.col("vec_id") % 50 == 0).collect()
    # a repeated positive id gives the same rows twice, in the same ranks
    assert sorted(map(tuple, got)) == sorted(_hard(rows))


def test_hard_negatives_over_several_blocks_and_slices(spark, monkeypatch):
    from wardpulse.llm import bond_scan
    monkeypatch.setattr(vector_blocks, "BLOCK_ROWS", 64)
    monkeypatch.setattr(bond_scan, "SLICE_ROWS", 3)
    rows = _odd_vectors(np.random.default_rng(2), n=700)
    got = hard_negatives(_frame(spark, rows), F.col("vec_id") % 50 == 0).collect()
    assert sorted(map(tuple, got)) == sorted(_hard(rows))


def test_bond_scan_keeps_the_exact_first_and_shrinks():
    rng = np.random.default_rng(3)
    n, dim = 2000, 64
    vec = rng.integers(-60, 60, (n, dim))
    vec[:40] = vec[0] + rng.integers(-3, 3, (40, dim))
    label = np.sort(rng.integers(0, 2, n))
    block = Block(to_bytes(row=np.arange(n), id=np.arange(n), label=label,
                           dims=np.ascontiguousarray(vec.T.astype(np.int32))))
    for a in (0, 17, 1999):
        score = vec @ vec[a]
        places, got = nearest_alike(block, vec[a], a, int(label[a]), 5)
        mine = [p for p in np.lexsort((np.arange(n), -score)) if label[p] == label[a] and p != a][:5]
        assert places.tolist() == mine and got.tolist() == score[mine].tolist()
        windows = [(100, 20000), (-5000, 0), (10 ** 7, 10 ** 8)]
        for (lo, hi), (where, s) in zip(windows, in_windows(block, vec[a], int(label[a]), windows, 3)):
            want = [p for p in np.lexsort((np.arange(n), -score)) if label[p] != label[a] and lo <= score[p] <= hi][:3]
            assert where.tolist() == want and s.tolist() == score[want].tolist()
    seen = []

    def shrink(part, least, most):
        seen.append(len(part))
        return part + most >= np.sort(part)[-5] + least

    block.scan(vec[0], np.ones(n, bool), shrink)
    assert seen[0] == n and seen[-1] < n // 10 and seen == sorted(seen, reverse=True)


def test_hard_negatives_equal_sql(spark):
    import duckdb
    got = Q.QUERIES["op11_bond_negatives"](spark, SF_SMALL)
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{SF_SMALL}/embeddings.parquet'")
    want = duckdb.sql(Q.ORACLES["op11_bond_negatives"])
    assert sorted(tuple(r[c] for c in want.columns) for r in got.collect()) == sorted(want.fetchall())


def test_vector_operators_on_empty_and_query_free_tables(spark):
    for rows in ([], [(1, [1.0, 2.0], 1), (2, [2.0, 1.0], 2)], [(50, None, 1)]):
        frame = spark.createDataFrame([(i, v, c, 9, "x") for i, v, c in rows], SCHEMA)
        assert hard_negatives(frame, F.col("vec_id") % 50 == 0).collect() == []
        assert nearest(frame, F.col("vec_id") % 50 == 0).collect() == []


def _cosines(rows):
    rows = [(i, np.array(v, float)) for i, v, _ in rows if i is not None and v is not None
            and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)]
    out = {}
    for a, (i, v) in enumerate(rows):
        if i % 50 == 0:
            s = v / np.abs(v).max()
            near = []
            for b, (j, w) in enumerate(rows):
                if b != a and len(v) == len(w):
                    t = w / np.abs(w).max()
                    near.append((-float((s * t).sum() / math.sqrt((s * s).sum() * (t * t).sum())), j))
            out.setdefault(i, []).append(sorted(near, key=lambda x: (round(x[0], 12), x[1]))[:5])
    return out


def test_nearest_finds_at_least_nine_of_ten(spark):
    rows = _odd_vectors(np.random.default_rng(4), n=600, dim=16)
    want = _cosines(rows)
    got = {}
    for r in nearest(_frame(spark, rows), F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(want)
    hit = total = 0
    for i, lists in want.items():
        mine = sorted(got[i])
        assert len(mine) == sum(map(len, lists))            # a repeated query gives its result twice
        for near in lists:
            total += len(near)
            hit += sum(any(j == m and abs(-c - s) < 1e-12 for _, m, s in mine) for c, j in near)
    assert hit >= 0.9 * total


def test_nearest_recall_and_exact_scores_on_the_given_vectors(spark):
    import duckdb
    got = Q.QUERIES["op12_stable_kdtree"](spark, "/root/testdata/sf0.01").collect()
    x = duckdb.sql("SELECT vec_id, embedding FROM '/root/testdata/sf0.01/embeddings.parquet' ORDER BY vec_id").fetchall()
    ids, vec = np.array([r[0] for r in x]), np.array([r[1] for r in x], float)
    size = np.sqrt((vec * vec).sum(axis=1))
    hit = total = 0
    for q in np.flatnonzero(ids % 50 == 0):
        score = (vec * vec[q]).sum(axis=1) / (size * size[q])
        score[q] = -9
        best = set(ids[np.lexsort((ids, -score))[:5]].tolist())
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == ids[q])
        assert [r for r, _, _ in mine] == [1, 2, 3, 4, 5]
        assert mine == sorted(mine, key=lambda m: (-m[2], m[1]))
        for _, j, s in mine:
            assert abs(s - score[j]) < 1e-12
        hit += len(best & {j for _, j, _ in mine})
        total += 5
    assert hit >= 0.9 * total


def test_nearest_over_many_cells_and_hot_copies(spark, monkeypatch):
    """Several cells, blocks and slices; a third of all rows is one vector."""
    monkeypatch.setattr(vector_blocks, "BLOCK_ROWS", 64)
    monkeypatch.setattr(stable_kdtree, "SLICE_ROWS", 4)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(30, 16))
    rows = [(k, (centres[k % 30] + 0.1 * rng.normal(size=16)).tolist(), 0) for k in range(1200)]
    rows = [(i, rows[0][1] if i % 3 == 0 else v, c) for i, v, c in rows]
    want = _cosines(rows)
    got = {}
    for r in nearest(_frame(spark, rows), F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hit = 0
    for i, lists in want.items():
        mine = [j for _, j, _ in sorted(got[i])]
        if i % 3 == 0:
            assert mine == [j for j in range(0, 30, 3) if j != i][:5]        # ties to the smaller id
        hit += len(set(mine) & {j for _, j in lists[0]})
    assert hit >= 0.9 * 5 * len(want)


def test_chi_square_stop():
    for freedom in (2, 6, 12):
        x = np.random.default_rng(6).chisquare(freedom, 200_000)
        for p in (0.5, 0.9, 0.95):
            r = stop_ratio(p, freedom)
            assert chi_square(r, freedom) == pytest.approx(p, abs=1e-9)
            assert (x < r).mean() == pytest.approx(p, abs=0.005)


