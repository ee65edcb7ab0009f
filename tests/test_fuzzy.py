"""G-8 prefix-filtered trigram match equals the all-pairs answer."""

import random

from pyspark.sql import functions as F

from wardpulse.operators import fuzzy
from wardpulse.operators.fuzzy import fuzzy_match


def grams(s):
    import re
    out = set()
    for w in re.split(r"[^0-9a-z]+", s.lower()):
        if w:
            p = "  " + w + " "
            out |= {p[i:i + 3] for i in range(len(w) + 1)}
    return out


def test_fuzzy_matches_brute_force(spark):
    rnd = random.Random(11)
    base = ["Koramangala", "Jayanagar", "Indiranagar", "Shanti Nagar", "Hebbal", "BTM Layout", "HSR Layout",
            "Jakkur", "Yelahanka", "Basavanagudi", "Malleswaram", "Rajaji Nagar", "Vijay Nagar"]
    wards = [(i + 1, n) for i, n in enumerate(base)]

    def garble(s):
        s = list(s.lower())
        for _ in range(rnd.randint(0, 3)):
            i = rnd.randrange(len(s))
            s[i] = rnd.choice("abcdefghijklmnopqrstuvwxyz ")
        return "".join(s)
    names = sorted({garble(rnd.choice(base)) for _ in range(60)} | {"zzz", "nagar"})
    got = {r.name: r.ward_id for r in fuzzy_match(
        spark.createDataFrame([(n,) for n in names], "name string"),
        spark.createDataFrame(wards, "ward_id int, ward_name string"), "name").collect()}
    want = {}
    for n in names:
        a = grams(n)
        best = None
        for wid, wn in wards:
            b = grams(wn)
            sim = len(a & b) / len(a | b) if a | b else 0.0
            if sim > 0.3 and (best is None or (-sim, wid) < (-best[0], best[1])):
                best = (sim, wid)
        if best:
            want[n] = best[1]
    assert got == want


def _pairs_seen(monkeypatch):
    """Count the candidate pairs of every step."""
    seen = []
    real = fuzzy.candidate_pairs

    def counted(a, b, t):
        out = real(a, b, t)
        seen.append((t, out.count()))
        return out
    monkeypatch.setattr(fuzzy, "candidate_pairs", counted)
    return seen


def test_falling_thresholds_meet_fewer_candidates(spark, monkeypatch):
    """Most names are slightly changed wards: they leave at a high threshold, and the
    low one meets only what is left. The result is that of one low step."""
    rnd = random.Random(12)
    parts = ["nagar", "halli", "pura", "layout", "gere", "palya", "sandra", "cross"]
    wards = [(i, f"{rnd.choice('bcdghjklmnprstv')}{rnd.choice('aeiou')}{rnd.choice('bdklmnrst')}a {rnd.choice(parts)} {rnd.choice(parts)} {i % 50}")
             for i in range(300)]
    names = []
    for i, w in wards:
        names.append(w.upper())                                   # equal trigrams
        k = rnd.randrange(len(w) - 4)
        names.append(w[:k] + "x" + w[k + 1:])                     # one letter changed
    names += ["zzz", "", "...", "nagar"]
    n = spark.createDataFrame([(x,) for x in names] + [(None,)], "name string")
    w = spark.createDataFrame(wards, "ward_id int, ward_name string")
    order = lambda df: sorted(map(tuple, df.collect()))
    seen = _pairs_seen(monkeypatch)
    falling = order(fuzzy_match(n, w, "name"))
    steps = list(seen)
    seen.clear()
    assert order(fuzzy_match(n, w, "name", steps=())) == falling
    assert [t for t, _ in steps][:3] == [0.9, 0.7, 0.5] and len(seen) == 1
    assert sum(c for _, c in steps) < 0.5 * seen[0][1]
    assert {x for x, *_ in falling} >= {w.upper() for _, w in wards}


def test_all_names_equal_end_after_the_first_join(spark, monkeypatch):
    w = spark.createDataFrame([(2, "Jaya Nagar"), (1, "jaya  nagar"), (3, "Hebbal")], "ward_id int, ward_name string")
    seen = _pairs_seen(monkeypatch)
    got = fuzzy_match(w.select(F.upper("ward_name").alias("name")), w, "name").collect()
    assert {(r.name, r.ward_id, float(r.similarity)) for r in got} == {
        ("JAYA NAGAR", 1, 1.0), ("JAYA  NAGAR", 1, 1.0), ("HEBBAL", 3, 1.0)} and not seen
