"""Periodic runs (13) against brute force."""

import hashlib
import re
import zlib

import numpy as np
import pytest

from llm_fixtures import SF_SMALL, none, odd, small_rows  # noqa: F401
from wardpulse.llm import periodic_runs as P
from wardpulse.llm import queries as Q
from wardpulse.llm.periodic_runs import Octave, fragments, octaves, periodic_runs, planted, stitched, tiles, z_function

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, least=12):
    """(start, length, period) of every run: all periods, longest stretches, the
    smallest period of a stretch."""
    n = len(words)
    best = {}
    for p in range(1, n // 2 + 1):
        same = [words[k] == words[k + p] for k in range(n - p)] + [False]
        a = 0
        for k, x in enumerate(same):
            if not x:
                if k > a and k - a + p >= max(least, 2 * p):
                    best.setdefault((a, k + p), p)
                a = k + 1
    return sorted((a, e - a, p) for (a, e), p in best.items())


def collapsed(words, runs):
    gone = {k for s, length, p in runs for k in range(s + p, s + length)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def plant(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def _texts(rng):
    """Small alphabets, nested and overlapping repeats, runs of all scales."""
    out = []
    for k in range(120):
        n = int(rng.integers(0, 400))
        words = [f"w{x}" for x in rng.integers(0, int(rng.integers(1, 6)) if k % 3 else 300, n)]
        for _ in range(int(rng.integers(0, 4))):
            at, p, m = (int(x) for x in rng.integers(1, (len(words) + 2, 70, 6)))
            part = words[at:at + p]
            words[at:at + len(part)] = part * m + part[:int(rng.integers(0, p))]
        out.append(words)
    a, b = ["a"], ["a", "b"]
    while len(b) < 600:
        a, b = b, b + a                              # a Fibonacci word: runs within runs
    return [*out, b, ["x"] * 500, ["x", "y"] * 300, ["p"] + ["x"] * 11, ["x"] * 12, list("abcabcabcabc") + ["d"] * 11]


def test_runs_equal_brute_force(spark):
    texts = _texts(np.random.default_rng(7))
    df = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in periodic_runs(df.repartition(5)).collect()}
    assert len(got) == len(texts)
    for k, words in enumerate(texts):
        runs = brute(words)
        assert [tuple(x) for x in got[k]["runs"]] == runs, k
        assert got[k]["collapsed"] == collapsed(words, runs), k


@pytest.mark.parametrize("least", [2, 7, 13, 40])
def test_other_least_lengths(spark, least):
    texts = _texts(np.random.default_rng(8))[::3]
    df = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(texts)], "doc_id long, text string")
    for r in periodic_runs(df, least=least).collect():
        assert [tuple(x) for x in r["runs"]] == brute(texts[r["doc_id"]], least), r["doc_id"]


def test_runs_over_many_small_tiles(spark, monkeypatch):
    """Tiles much smaller than the runs: fragments are cut and stitched."""
    monkeypatch.setattr(P, "TILE", 16)
    rng = np.random.default_rng(9)
    for words in _texts(rng)[-6:] + [[f"w{x}" for x in rng.integers(0, 50, 37)] * 40]:
        codes = np.unique(words, return_inverse=True)[1]
        distance = P.gram_distances(codes.astype(np.uint64) + np.uint64(1), np.zeros(len(codes), np.int32))
        found = []
        for o, s, e, first, last in tiles(distance, 12):
            found += [(1, p, a + s, b + s) for p, a, b in fragments(codes[s:e].tolist(), first - s, last - s, o, 12)]
        frame = spark.createDataFrame(found, "key long, period long, start long, end long")
        got = sorted((r["start"], r["length"], r["period"]) for r in stitched(frame).collect())
        assert got == brute(words)


def test_z_function():
    rng = np.random.default_rng(10)
    for _ in range(200):
        t = rng.integers(0, 2, int(rng.integers(1, 40))).tolist()
        for k, z in enumerate(z_function(t, len(t))):
            m = 0
            while k + m < len(t) and t[m] == t[k + m]:
                m += 1
            assert z == m


def test_octaves_cover_all_periods():
    for least in (2, 12, 40):
        told = [p for o in octaves(5000, least) for p in range(o.lo, o.hi)]
        assert told[:2500] == list(range(1, 2501))
        for number in range(8):
            o = Octave(number, least)
            for p in range(o.lo, o.hi):
                assert o.gap <= max(least, 2 * p) - p + 1 and 1 <= o.need <= max(least, 2 * p) - p - P.gram(least) + 1


def _expected(doc_id, text):
    words = plant(doc_id, WORD.findall(text or ""))
    runs = brute(words)
    lines = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha(lines),
            sha(collapsed(words, runs)))


def test_query_equals_brute_force(spark, small_rows):  # noqa: F811
    got = Q.QUERIES["op13_periodic_runs"](spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                           "collapsed_sha256"]
    rows = {r["doc_id"]: tuple(r) for r in got.collect()}
    short = [(i, t) for i, t, *_ in small_rows if len((t or "").split()) < 1500]
    assert len(rows) == len(small_rows) and len(short) > 100
    for i, text in short:
        assert rows[i] == _expected(i, text), i
    assert any(r[1] for r in rows.values())


def test_odd_rows_and_empty_table(spark, odd, none):  # noqa: F811
    from llm_fixtures import ODD
    got = P.run_columns(periodic_runs(planted(odd), digest=True)).collect()
    texts = [(i, t) for i, t in ODD if len((t or "").split()) < 1000]
    want = [_expected(i, t) for i, t in texts]
    assert len(got) == len(ODD)
    long = {i for i, t in ODD if len((t or "").split()) >= 1000}
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r) for r in got if r["doc_id"] not in long), key=key) == sorted(want, key=key)
    everything = {r["doc_id"]: r for r in periodic_runs(odd).collect() if r["doc_id"] in long}
    assert [tuple(x) for x in everything[10]["runs"]] == [(0, 4000, 1)]
    assert everything[10]["collapsed"] == "word"
    for frame in (periodic_runs(none), P.run_columns(periodic_runs(planted(none), digest=True))):
        assert frame.collect() == []


def test_one_very_long_text(spark):
    rng = np.random.default_rng(11)
    words = [f"w{x}" for x in rng.integers(0, 10 ** 6, 30_000)]
    words[4000:22_000] = words[4000:10_000] * 3
    df = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    r = periodic_runs(df).first()
    assert [tuple(x) for x in r["runs"]] == [(4000, 18_000, 6000)]
    assert r["collapsed"] == " ".join(words[:10_000] + words[22_000:])
