"""Operators on pairs (8, 9, 10) and the pipeline against brute force."""

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from llm_fixtures import SF_SMALL, none, odd, small_rows  # noqa: F401
from tools.check_oracle import digest
from wardpulse.llm import queries as Q
from wardpulse.llm.links import components
from wardpulse.llm.partenum import Bands, ngram_jaccard_components, shingle_sets, signatures
from wardpulse.llm.preference import ORACLE, format_preferences
from wardpulse.llm.simhash_windows import ItemIndex, contaminated, without_contaminated

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {k: k + 32 for k in range(65, 91)}


def _sets(rows, n):
    out = {}
    for i, text in rows:
        w = WORD.findall((text or "").translate(LOWER))
        out[i] = frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])
    return out


def _components(sets, percent):
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    owners = defaultdict(list)
    for i in sorted(sets):
        common = Counter(j for s in sets[i] for j in owners[s])
        for j, k in common.items():
            if 100 * k >= percent * (len(sets[i]) + len(sets[j]) - k):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
        for s in sets[i]:
            owners[s].append(i)
    return {i: root(i) for i in sets}


def _near_copies(rng, n):
    """Texts of all sizes with near copies around the threshold."""
    rows = []
    for k in range(n):
        words = [f"w{x}" for x in rng.integers(0, 400, int(rng.integers(1, 160)))]
        for _ in range(int(rng.integers(1, 5))):
            own = list(words)
            for _ in range(int(rng.integers(0, 1 + len(own) // 25))):
                own[int(rng.integers(0, len(own)))] = f"e{rng.integers(0, 10 ** 6)}"
            rows.append((len(rows), " ".join(own)))
    return rows


@pytest.mark.parametrize("n,percent", [(4, 85), (5, 80)])
def test_join_equals_brute_force(spark, small_rows, n, percent):
    rows = _near_copies(np.random.default_rng(n), 200)
    rows += [(10 ** 4 + r[0], r[1]) for r in small_rows]
    sets = _sets(rows, n)
    want = _components(sets, percent)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard_components(df, n, percent).collect()}
    assert got == {i: (len(sets[i]), want[i]) for i in sets}
    assert sum(1 for i in want if want[i] != i) > 100


def test_join_edge_rows(spark, odd, none):
    rows = ngram_jaccard_components(odd, 4, 85).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == odd.count()
    assert [got[i].n_shingles for i in (1, 2, 3)] == [0, 0, 0] and got[1].component_id == 1
    assert got[5].component_id == 4 and got[7].component_id == 6 and got[None].component_id is None
    assert ngram_jaccard_components(none).count() == 0


def test_linked_sets_share_a_signature():
    """Whatever the sizes: any pair at or over the threshold meets."""
    rng = np.random.default_rng(2)
    bands = Bands(85)
    for size in [6, 7, 9, 12, 20, 34, 60, 101, 250, 700]:
        for _ in range(60):
            gone = int(rng.integers(0, bands.bound(np.array([size]))[0] + 1))
            a = rng.integers(0, 1 << 63, size).astype(np.uint64)
            left = int(rng.integers(0, gone + 1))
            b = np.concatenate([a[left:], rng.integers(0, 1 << 63, gone - left).astype(np.uint64)])
            common = size - left
            if 100 * common < 85 * (len(a) + len(b) - common):
                continue
            owner = np.concatenate([np.zeros(len(a), np.int32), np.ones(len(b), np.int32)])
            doc, sig = signatures(owner, np.concatenate([a, b]), 2, bands)
            assert gone == 0 or set(sig[doc == 0].tolist()) & set(sig[doc == 1].tolist()), (size, gone, left)


def test_short_shingle_sets():
    owner, prints = shingle_sets(pa.array(["a b", "A B", "a b c d e", None, "", "a"]), 4)
    count = np.bincount(owner, minlength=6)
    assert count.tolist() == [1, 1, 2, 0, 0, 1] and prints[0] == prints[1]


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 140)] + [(200, 200), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(61)}, **{k: 100 for k in range(100, 140)}}


PLAIN = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")


def _plain(text):
    return PLAIN.findall((text or "").lower())


def _leaks(rows, items):
    """(doc, item) where the document holds all words of the item in a row."""
    out = set()
    docs = {i: " " + " ".join(_plain(t)) + " " for i, t in rows}
    for k, text in items:
        whole = " " + " ".join(_plain(text)) + " "
        out |= {(i, k) for i, t in docs.items() if whole in t}
    return out


def test_all_exact_leaks_found(spark, small_rows):
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF_SMALL}/benchmark.parquet'").fetchall()
    got = Q.QUERIES["op9_simhash_windows"](spark, SF_SMALL).collect()
    exact = _leaks([r[:2] for r in small_rows], items)
    assert exact and exact <= {(r.doc_id, r.item_id) for r in got}
    text = {r[0]: _plain(r[1]) for r in small_rows}
    item = {k: _plain(t) for k, t in items}
    for r in got:       # verified: weighted Jaccard of the window and the item
        w, q = text[r.doc_id][r.start_word:r.start_word + r.n_words], item[r.item_id]
        a, b = ({tuple(x[k:k + 5]): len(set(x[k:k + 5])) for k in range(len(x) - 4)} for x in (w, q))
        both = sum(v for s, v in a.items() if s in b)
        assert abs(r.similarity - both / (sum(a.values()) + sum(b.values()) - both)) < 1e-12 and r.similarity >= 0.8


def test_hamming_blocks_find_all_within_the_radius():
    index = ItemIndex([" ".join(f"x{k}{j}" for j in range(30)) for k in range(50)], 5, 1)
    (cls,) = index.classes
    rng = np.random.default_rng(0)
    for _ in range(300):
        i = int(rng.integers(0, 50))
        flips = rng.choice(64, int(rng.integers(0, 8)), replace=False)
        mask = np.uint64(sum(1 << int(b) for b in flips))
        w, k = cls.hits(np.array([cls.of[i] ^ mask]))
        assert i in k.tolist()


def _brute_pairs(docs, items, threshold):
    """The best window of every (text, item) at or over the threshold."""
    out = {}
    for d, doc in enumerate(docs):
        for k, item in enumerate(items):
            q = min(5, len(item))
            sets = lambda x: {tuple(x[j:j + q]): len(set(x[j:j + q])) for j in range(len(x) - q + 1)}
            a = sets(item)
            for at in range(len(doc)):
                b = sets(doc[at:at + len(item)])
                both = sum(v for s, v in a.items() if s in b)
                got = both / (sum(a.values()) + sum(b.values()) - both)
                if got >= threshold and got > out.get((d, k), (0, 0))[1]:
                    out[d, k] = at, got
    return out


def test_altered_copies_are_all_found():
    rng = np.random.default_rng(8)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 3000, n)]
    docs, items = [], []
    for size, changed in [(3, 0), (50, 1), (60, 1), (80, 1), (100, 1), (100, 2), (150, 2), (200, 3)] * 2:
        item = word(size) if size < 80 else word(size - 12) + items[1][:12]
        copy = list(item)
        for at in rng.choice(size, changed, replace=False):
            copy[at] = "other"
        items.append(item)
        docs.append(word(40) + copy + word(int(rng.integers(0, 2)) * 40))
        docs.append(word(20) + item[:int(size * 0.9)])       # the text ends before the item does
    docs += [["a", "b"] * 60 + ["c"] * 40, word(10)]
    items += [["a", "b"] * 15, ["c"] * 30]
    want = _brute_pairs(docs, items, 0.8)
    assert len([s for _, s in want.values() if s < 0.95]) > 15
    index = ItemIndex([" ".join(x) for x in items], 5, 1)
    for chunk in (16384, 300):
        got = index.search(pa.array([" ".join(x) for x in docs]), 0.8, chunk)
        assert {(d, k): (at, s) for d, k, at, s in got} == want


def test_decontamination_edge_rows(spark, odd, none):
    bench = spark.createDataFrame([(1, "one"), (2, None), (3, ""), (4, "leading double blanks"), (5, "ONE"), (6, "A  B")],
                                  "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in contaminated(odd, bench).collect()}
    assert got >= {(4, 1), (5, 1), (4, 5), (13, 4), (6, 6), (7, 6)} and not {g for g in got if g[1] in (2, 3)}
    clean = without_contaminated(odd, bench)
    assert clean.columns == odd.columns and not {4, 5, 13} & {r.doc_id for r in clean.select("doc_id").collect()}
    assert contaminated(none, bench).count() == 0 and contaminated(odd, bench.limit(0)).count() == 0
    assert without_contaminated(odd, bench.limit(0)).count() == odd.count()
    many = {(r.doc_id, r.item_id) for r in contaminated(odd, bench, block_items=2).collect()}
    assert many == got


def test_preferences_equal_oracle(spark, scratch):
    con = duckdb.connect()
    con.execute(f"""CREATE VIEW conversations AS SELECT CASE WHEN conv_id % 7 = 1 THEN NULL
        ELSE conv_id - (conv_id % 5 = 0)::INT * (turn > 1)::INT END::BIGINT AS conv_id,
        CASE WHEN turn > 2 THEN 2 ELSE turn END AS turn, CASE WHEN turn = 3 THEN NULL ELSE role END AS role,
        CASE turn WHEN 0 THEN 'same start' WHEN 4 THEN NULL ELSE text END AS text
        FROM '{SF_SMALL}/conversations.parquet'""")
    con.execute(f"COPY conversations TO '{scratch}/conversations.parquet' (FORMAT parquet)")
    for folder, c in ((scratch, con), (SF_SMALL, None)):
        if c is None:
            c = duckdb.connect()
            c.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF_SMALL}/conversations.parquet'")
        df = Q.QUERIES["op8_preference"](spark, folder)
        cur = c.execute(ORACLE)
        cols = [d[0] for d in cur.description]
        assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(cols, cur.fetchall())[0]


def test_preference_query_has_real_prefixes(spark):
    """Both sides are one conversation up to its last assistant turn."""
    rows = Q.QUERIES["op8_preference"](spark, SF_SMALL).collect()
    assert all(r.paired for r in rows) and max(r.n_prefix_turns for r in rows) > 0
    changed = [r for r in rows if r.chosen != r.rejected]
    assert len(changed) > len(rows) // 2 and all(r.prompt and r.chosen_mask and r.rejected_mask for r in changed if r.n_prefix_turns)


def test_links_run_through_rows_without_id(spark):
    """A links with N and N with B, A does not link with B: one component, also
    where N has no id; rows that share an id keep their own texts."""
    words = [f"w{k}" for k in range(100)]
    a, n, b = words, words[:97] + ["x1", "x2", "x3"], ["y1", "y2", "y3"] + words[3:97] + ["x1", "x2", "x3"]
    rows = [(7, " ".join(a)), (None, " ".join(n)), (9, " ".join(b)), (9, "something else entirely it is"), (None, "alone without any id")]
    schema = "doc_id long, text string"
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_jaccard_components(
        spark.createDataFrame(rows, schema), n=4, percent=85).collect()), key=str)
    assert got == sorted([(7, 97, 7), (None, 97, 7), (9, 97, 7), (9, 2, 9), (None, 1, None)], key=str)


def test_copies_and_near_copies_in_large_groups(spark):
    """A base with many near copies that do not link with each other, exact copies,
    and strangers: brute force."""
    rng = np.random.default_rng(21)
    base = [f"b{k}" for k in range(200)]
    rows = []
    for k in range(120):
        own = list(base)
        for at in rng.integers(0, 200, int(rng.integers(0, 5))):
            own[at] = f"c{k}_{at}"
        rows.append((k, " ".join(own)))
    rows += [(200 + k, rows[3][1]) for k in range(40)]
    rows += [(300 + k, " ".join(f"s{x}" for x in rng.integers(0, 500, 60))) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    want = _components(_sets(rows, 4), 85)
    assert {r.doc_id: r.component_id for r in ngram_jaccard_components(df, n=4, percent=85).collect()} == want


def test_large_sets_that_share_a_passage_are_not_compared(spark, monkeypatch):
    """Sets of thousands that share a passage meet under its signatures, but only those
    that may link are compared element by element; linked ones on both sides of a
    power of two are found."""
    from wardpulse.llm import partenum
    compared = []
    verified = partenum._verified

    def counted(pairs, *args):
        compared.append(pairs.count())
        return verified(pairs, *args)

    monkeypatch.setattr(partenum, "_verified", counted)
    passage = [f"p{x}" for x in range(300)]
    rows = [(k, " ".join(passage + [f"d{k}_{x}" for x in range(2000 + 10 * k)])) for k in range(8)]
    body = [f"c{x}" for x in range(1100)]
    rows += [(100 + k, " ".join(body[:size])) for k, size in enumerate((980, 1020, 1030, 1100))]
    want = _components(_sets(rows, 5), 80)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in ngram_jaccard_components(df, n=5, percent=80).collect()}
    assert got == want and want[103] == 100 and len(set(want.values())) == 9
    assert 0 < sum(compared) <= 6           # of the four linked texts; 31 pairs came this far before


def test_pipeline_keeps_other_texts_of_one_id(spark, tmp_path):
    """Near duplicates: rows of one id with texts that are not linked stay, repeated
    rows and copies go, whichever ids they have."""
    one, two = " ".join(f"a{k}" for k in range(60)), " ".join(f"z{k}" for k in range(60))
    rows = [(1, one, "en", "s", 1), (1, two, "en", "s", 1), (1, one, "en", "s", 1), (2, one, "fr", "t", 1), (None, two, "en", "s", 1),
            (None, "a lonely text without an id here", "en", "s", 1), (3, "", "en", "s", 1), (3, "", "en", "s", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_duplicates(spark, df, "")
    assert got.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(
        [(1, one), (1, two), (None, "a lonely text without an id here"), (3, ""), (3, "")], key=str)


def test_preferences_masks(spark):
    rows = [(1, True, 0, "user", "hi"), (1, True, 1, "assistant", "yes"), (1, False, 0, "user", "hi"),
            (1, False, 1, "assistant", "no"), (2, True, 0, "assistant", None), (None, True, 0, "user", "x")]
    schema = "pair_id long, is_chosen boolean, turn long, role string, text string"
    got = {r.pair_id: r for r in format_preferences(spark.createDataFrame(rows, schema)).collect()}
    a = got[1]
    assert a.prompt == "<|user|>\nhi<|end|>\n" and a.n_prefix_turns == 1 and a.paired
    for body, mask, said in ((a.chosen, a.chosen_mask, "yes"), (a.rejected, a.rejected_mask, "no")):
        lo, hi = map(int, mask.split(":"))
        assert body[lo:hi] == f"{said}<|end|>\n"
    assert not got[2].paired and got[2].rejected is None and set(got) == {1, 2}
    assert format_preferences(spark.createDataFrame([], schema)).count() == 0


def test_pipeline_against_brute_force(spark, small_rows):
    from wardpulse.llm.common import land, table
    docs = table(spark, SF_SMALL, "documents")
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF_SMALL}/benchmark.parquet'").fetchall()
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = land(stage(spark, docs, SF_SMALL), name)
        if name != "pieces":
            assert out.schema == docs.schema
            kept[name] = {r.doc_id: r.text for r in out.collect()}
        docs = out
    text = {r[0]: r[1] for r in small_rows}
    assert set(kept["language"]) == {i for i, t in text.items() if t and any(map(str.isalpha, t))}
    sets = _sets(kept["language"].items(), 5)
    assert set(kept["near_duplicates"]) == {i for i, c in _components(sets, 80).items() if i == c}
    gone = set(kept["near_duplicates"]) - set(kept["decontamination"])
    leaks = _leaks(kept["near_duplicates"].items(), items)
    assert {i for i, _ in leaks} == gone
    assert set(kept["personal_data"]) == set(kept["decontamination"])
    left = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    assert not any(left.search(t) for t in kept["personal_data"].values())
    rows = docs.collect()
    assert {r.doc_id for r in rows} == set(kept["personal_data"]) and all(r.round_trip for r in rows)


def test_pipeline_edge_rows(spark, odd, none):
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF_SMALL)
            if name != "pieces":
                assert out.columns == docs.columns
            docs = out.persist()
        docs.count()
