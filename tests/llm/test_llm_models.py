"""Fitted operators (3, 5, 6): exact parts against enumeration, held-out accuracy."""

import itertools
import random
from collections import Counter

import numpy as np

from llm_fixtures import SF_SMALL, none, odd, small_rows  # noqa: F401
from wardpulse.llm.common import table
from wardpulse.llm.gumbel_pieces import Sampler, sample_segmentations
from wardpulse.llm.lattice import PieceTable
from wardpulse.llm.piece_langid import expected_counts, log_probabilities, predict_language
from wardpulse.llm.toxic_automata import FuzzyLexicon, toxicity

MODEL = "piece_bpe_32k.model"


def _segmentations(table, word):
    """All (piece numbers) of a word; -1 is a character without a piece."""
    if not word:
        return [()]
    out = []
    for k in range(1, len(word) + 1):
        n = table.index.get(word[:k], -1 if k == 1 else None)
        if n is not None:
            out += [(n, *rest) for rest in _segmentations(table, word[k:])]
    return out


def test_forward_algorithm_equals_enumeration():
    t = PieceTable(MODEL)
    p = np.random.default_rng(0).random((len(t.pieces) + 1, 3))
    words = ["the", "tion", "日q日", "erthing", "é", "straße"]
    want = [np.log(sum(np.prod(p[list(s)], axis=0) for s in _segmentations(t, "▁" + w))) for w in words]
    assert np.allclose(log_probabilities(t, words, p), want)
    counts = expected_counts(t, ["tion"], np.array([1]), np.array([3.0]), p)
    ways = [(np.prod(p[list(s), 1]), Counter(s)) for s in _segmentations(t, "▁tion")]
    total = sum(w for w, _ in ways)
    for k in set(itertools.chain(*[c for _, c in ways])):
        assert np.isclose(counts[k, 1], 3 * sum(w * c[k] for w, c in ways) / total)


def test_language_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = predict_language(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 100 and sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edge_rows(spark, odd, none):
    got = {r.doc_id: r for r in predict_language(odd).collect()}
    assert got[1].lang_pred == got[2].lang_pred == got[3].lang_pred == "und" and got[1].score == 0
    assert got[4].lang_pred == "en" and not got[None].held_out
    assert predict_language(none).count() == 0
    carried = predict_language(odd, carry=True)
    assert carried.columns == ["doc_id", "held_out", "row", "lang_pred", "score"]
    assert sorted(carried.select("row.*").collect(), key=repr) == sorted(odd.collect(), key=repr)


def test_samples_without_replacement_follow_the_distribution():
    s = Sampler(MODEL, 1.0, 7)
    t = s.lat.table
    ways = {w: np.prod(s.lat.weight[list(w)]) for w in _segmentations(t, "▁the▁ab") if all(
        "▁" not in t.pieces[k][1:] for k in w if k >= 0)}
    z = sum(ways.values())
    ways = {w: v / z for w, v in ways.items()}
    n = 4000
    paths, kappa = s.sample(["the ab"] * n, np.arange(n), 3)
    pieces = [[tuple(s.lat.piece[p.step].tolist()) for p in ps] for ps in paths]
    assert all(len(set(x)) == 3 for x in pieces)
    assert all(ps[0].value >= ps[1].value >= ps[2].value >= k for ps, k in zip(paths, kappa))
    for ps, x in zip(paths[:200], pieces):
        assert all(np.isclose(p.total[-1], np.log(ways[w])) for p, w in zip(ps, x))
    first = Counter(x[0] for x in pieces)
    both = Counter((x[0], x[1]) for x in pieces)
    best = sorted(ways, key=ways.get)[::-1][:3]
    for a in best:
        assert abs(first[a] / n - ways[a]) < 4 * np.sqrt(ways[a] / n) + 1e-3
    for a, b in itertools.permutations(best, 2):
        want = ways[a] * ways[b] / (1 - ways[a])
        assert abs(both[a, b] / n - want) < 4 * np.sqrt(want / n) + 2e-3


def test_samples_exhaust_a_small_lattice():
    s = Sampler(MODEL, 1.0, 7)
    n = len(_segmentations(s.lat.table, "▁ab"))
    paths, kappa = s.sample(["ab"] * 3, np.arange(3), n + 5)
    assert [len(p) for p in paths] == [n] * 3 and all(k == -np.inf for k in kappa)


def test_samples_decode_to_the_text(spark, small_rows, odd, none):
    import public_tokenizers as P
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path(MODEL))
    rows = sample_segmentations(odd, k=2).collect()
    assert all(r.round_trip for r in rows) and len({r.doc_id for r in rows}) == odd.select("doc_id").distinct().count()
    assert all(r.n_tokens == 0 and r.sample == 0 and r.log_prob == 0 and r.log_inclusion == 0 for r in rows if r.doc_id in (1, 2))
    text = {r[0]: r[1] for r in small_rows}
    small = spark.createDataFrame(small_rows[:40], "doc_id long, text string, lang string, source string, n_chars long")
    got = sample_segmentations(small, k=2).collect()
    for r in got:
        assert sp.decode(list(r.ids)) == text[r.doc_id] and r.round_trip
    again = sample_segmentations(small.repartition(7), k=2).collect()
    assert sorted(got) == sorted(again)
    assert sample_segmentations(none).count() == 0


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton_equals_edit_distance():
    rnd = random.Random(1)
    terms = [("abcab", True), ("bbbbb", False), ("cabac", False), ("abab", False), ("ccabca", True)]
    lexicon = FuzzyLexicon(terms, 5)
    for _ in range(5000):
        w = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 9)))
        exact = any(w.startswith(t) if stem else w == t for t, stem in terms)
        near = any(len(t) >= 5 and (min(_edits(w[:k], t) for k in range(len(w) + 1)) <= 1 if stem else _edits(w, t) <= 1)
                   for t, stem in terms)
        assert lexicon.match(w) == (2 if exact else 1 if near else 0), w


def test_context_windows_tell_quotation_from_abuse():
    from wardpulse.llm.toxic_automata import Scorer
    s = Scorer([("blorg", False), ("zwickel", True)], 5, 3)
    #           text -> share of quoted hits, share of addressed hits
    for text, quoted, addressed in [
            ("you are a blorg", 0, 1), ('he said the word "blorg" there', 1, 0), ("the «blorg» here", 1, 0),
            ("she wrote blorg again", 1, 0), ("a b c d blorg e f g h", 0, 0), ("you one two three four blorg", 0, 0),
            ("you blorg a b c d he said blorg", 0.5, 0.5), ("you are a blorgg", 0, 1), ("du bist ein zwickelmann", 0, 1)]:
        f = s.features(text)
        assert (round(f[3], 2), round(f[4], 2)) == (quoted, addressed), text
    own = Scorer([("blorg", False)], 5, 3, reporting=frozenset(["quoth"]), address=frozenset(["thou"]))
    assert own.features("thou blorg")[4] == 1 and own.features("you blorg")[4] == 0 and own.features("quoth blorg")[3] == 1
    assert s.features("word " * 50_000 + "blorg")[0] > 0 and s.features(None) == [0.0] * 6


def test_toxicity_held_out(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.1", x) for x in ("documents", "labels"))
    rows = toxicity(docs, labels).where("held_out").join(labels, "doc_id").collect()
    toxic, clean = [r for r in rows if r.toxic == 1], [r for r in rows if r.toxic == 0]
    assert sum(r.predicted for r in toxic) >= 0.85 * len(toxic) and sum(r.predicted for r in clean) <= 0.02 * len(clean)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def test_toxicity_edge_rows(spark, odd, none):
    labels = spark.createDataFrame([(4, 1), (6, 0), (None, 1), (7, None)], "doc_id long, toxic int")
    assert toxicity(odd, labels).count() == odd.count()
    assert {r.score for r in toxicity(odd, labels.limit(0)).collect()} == {0.0}
    assert toxicity(none, table(spark, SF_SMALL, "labels")).count() == 0
