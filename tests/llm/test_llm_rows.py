"""Row-wise operators (1, 2, 4, 7) against brute force and the libraries."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import SF_SMALL, none, odd, small_rows  # noqa: F401
from wardpulse.llm import pii_boost
from wardpulse.llm import queries as Q
from wardpulse.llm.heap_bpe import token_counts
from wardpulse.llm.orc_ids import lookup, orc_round_trip, read_ids, write_ids
from wardpulse.llm.pii_boost import BASE, KINDS, digest, fit, joined, personal_data
from wardpulse.llm.suffix_rules import judge, repetition_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
# the contract's patterns, as given
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _valid(kind, found):
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    digits = re.sub("[^0-9]", "", found)
    if kind == "card":
        return 13 <= len(digits) <= 19 and _luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def _base(text):
    spans = {k: [(m.start(), m.end()) for m in re.finditer(PLAIN[k], text or "") if _valid(k, m.group())] for k in KINDS}
    flat = [f"{k}:{a}:{b}" for k in KINDS for a, b in spans[k]]
    return [len(spans[k]) for k in KINDS], flat


def test_pii_base_equals_plain_patterns(spark, small_rows, odd):
    rng = np.random.default_rng(4)
    noise = ["".join(rng.choice(list("a1.@+- ()4é_%"), 100)) for _ in range(300)]
    rows = [(r[0], r[1]) for r in small_rows] + [(10 ** 6 + k, t) for k, t in enumerate(noise)]
    rows += [(2 * 10 ** 6, "1 " * 700), (2 * 10 ** 6 + 1, "x@y.z " * 400), (2 * 10 ** 6 + 2, "9" * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in digest(personal_data(df)).collect()}
    for i, text in rows:
        counts, flat = _base(text)
        r = got[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts, i
        assert r.base_sha256 == hashlib.sha256(",".join(flat).encode()).hexdigest()
        assert set(flat) <= set(r.spans.split(",")) | {""}
        assert r.n_added == len([s for s in r.spans.split(",") if s]) - len(flat)
    assert digest(personal_data(odd)).count() == odd.count()


def test_pii_trees_learn_formats(spark):
    """Numbers like the learned ones but without the plus are added; numbers
    that the training rows hold as harmless are not."""
    rng = np.random.default_rng(1)
    rows = []
    for k in range(400):
        a, b, c = rng.integers(200, 999), rng.integers(200, 999), rng.integers(1000, 9999)
        rows.append((k, f"call me +1 ({a}) {b}-{c} soon" if k % 2 else f"on 20{a % 90 + 10}-11-{b % 18 + 10} it was"))
    models = fit(spark.createDataFrame(rows, "doc_id long, text string"))
    probe = spark.createDataFrame([(1, "phone (988) 555-2485 now"), (2, "on 2024-11-12 it was"), (3, "nothing")],
                                  "doc_id long, text string")
    got = {r.doc_id: r.spans for r in digest(personal_data(probe, models)).collect()}
    assert got == {1: "phone:6:20", 2: "", 3: ""}


def test_pii_missed_numbers_in_the_fitted_corpus_are_added(spark):
    """One phone number in ten has no plus; the corpus is the one that is fitted."""
    rng = np.random.default_rng(6)
    rows, missed = [], {}
    for k in range(800):
        a, b, c = rng.integers(200, 999), rng.integers(200, 999), rng.integers(1000, 9999)
        number = f"({a}) {b}-{c}"
        if k % 2:
            rows.append((k, f"on 20{a % 90 + 10}-11-{b % 18 + 10} it was"))
        elif k % 20:
            rows.append((k, f"call me +1 {number} soon"))
        else:
            rows.append((k, f"call me {number} soon"))
            missed[k] = f"phone:8:{8 + len(number)}"
    for k in range(800, 840):       # what the checks or the context speak against
        a, b, c = rng.integers(200, 999), rng.integers(200, 999), rng.integers(1000, 9999)
        rows.append((k, [f"the server/({a}) {b}-{c}/log", "at +5 2024-11-12 then", f"v {a}.{b}.{a}.{b} out", "no 4111 1111 1111 1112"][k % 4]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = personal_data(df).select("doc_id", joined("added").alias("added")).where("added != ''").collect()
    assert len(missed) == 40 and {r.doc_id: r.added for r in found} == missed


def test_pii_fits_on_every_document(spark):
    """More documents than any bound: the features of a rare kind of number, and
    digits that stand apart, are counted wherever they are."""
    n = 30_000
    text = (F.when(F.col("id") % 1500 == 0, F.concat(F.lit("call me +1 (212) 5"), 10 + F.col("id") % 90, F.lit("-4567 soon")))
            .otherwise(F.concat(F.lit("version 20"), 10 + F.col("id") % 90, F.lit(" of it"))))
    docs = spark.range(n).select(F.col("id").alias("doc_id"), text.alias("text"))
    seen = []
    own, pii_boost.Trees = pii_boost.Trees, lambda rows: seen.append(rows) or own(rows)
    try:
        fit(docs.unionAll(spark.createDataFrame([(n, "at 1 2 3 4 5 6 7 8")], "doc_id long, text string")))
    finally:
        pii_boost.Trees = own
    assert len(seen) == 1 and sum(r[1] for r in seen[0]) == spark.range(n).select(F.col("id"), text.alias("text")).where(
        "id % 1500 = 0").where(F.pmod(F.xxhash64("id", "text", F.lit(31)), F.lit(2)) == 0).count()


def test_pii_plan_has_no_python(spark, small_rows):
    plan = Q.QUERIES["op1_pii_boost"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and BASE.keys() == PLAIN.keys()


def test_token_counts_equal_library(spark, small_rows, odd, none):
    import public_tokenizers as P
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    for df in (spark.createDataFrame(small_rows, "doc_id long, text string, lang string, source string, n_chars long"), odd):
        texts = sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)
        got = sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(df).collect()), key=repr)
        want = []
        for i, t in texts:
            n = len(sp.encode(t or ""))
            want.append((i, len((t or "").encode()), n, n > 4096))
        assert got == sorted(want, key=repr)
    assert token_counts(none).count() == 0


@pytest.mark.parametrize("slice_bytes", [1 << 14, 32 << 20])
def test_orc_round_trip_equals_library(spark, small_rows, odd, none, slice_bytes):
    import public_tokenizers as P
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    small = spark.createDataFrame(small_rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    for df in (small, odd):
        got = {}
        for r in orc_round_trip(df, slice_bytes=slice_bytes).collect():
            got.setdefault(r.doc_id, []).append((r.start, r.n_tokens, r.ids_crc32))
        start = 0
        rows = sorted(((r.doc_id, r.text) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
        for i, t in rows:
            ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
            assert (start, len(ids), zlib.crc32(ids.tobytes())) in got[i], i
            start += len(ids)
    assert orc_round_trip(none).count() == 0


def test_orc_lookup_reads_by_id(spark, small_rows, scratch):
    df = spark.createDataFrame(small_rows, "doc_id long, text string, lang string, source string, n_chars long")
    path = f"{scratch}/ids.orc"
    write_ids(df, path, slice_bytes=1 << 16)
    got = lookup(spark, path, [3, 77, 10 ** 9]).collect()
    assert sorted(r.doc_id for r in got) == [3, 77]
    plan = lookup(spark, path, [3])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*doc_id", plan)
    assert read_ids(spark, path).count() == len(small_rows)


def test_orc_spreads_a_hot_id_and_sums_up_blocks(spark, scratch, monkeypatch):
    """One id holds nearly all rows: it fills several slices, and starts still follow."""
    from wardpulse.llm import orc_ids
    rows = [(5, f"text number {k} of the hot id " * 3) for k in range(400)] + [(1, "first"), (9, "last")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(orc_ids, "BLOCK", 3)
    write_ids(df, f"{scratch}/hot.orc", slice_bytes=4096)
    sizes = {r["slice"]: r["count"] for r in spark.read.orc(f"{scratch}/hot.orc").groupBy("slice").count().collect()}
    assert len(sizes) >= 8 and max(sizes.values()) < 150
    got = sorted((r.start, r.n_tokens) for r in read_ids(spark, f"{scratch}/hot.orc").collect())
    assert [s for s, _ in got] == [sum(n for _, n in got[:k]) for k in range(len(got))]
    totals = spark.createDataFrame([(k, k * k) for k in range(60)], "k long, n long")
    found = {r.k: r.before for r in orc_ids.totals_before(totals).collect()}
    assert found == {k: sum(i * i for i in range(k)) for k in range(60)}


def test_sparse_phone_numbers_are_base_spans(spark):
    """The phone pattern allows any run of signs between digits."""
    texts = ["call +1---2---3---4---5---6---7---8---9 now", "+1(((2)))3...4   5(((6)))7...8   9---0"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in digest(personal_data(df)).collect()}
    for k, text in enumerate(texts):
        m = re.search(r"\+[0-9][\x20().0-9-]+[0-9]", text)
        span = f"phone:{m.start()}:{m.end()}"
        assert rows[k].n_phone == 1 and rows[k].base_sha256 == hashlib.sha256(span.encode()).hexdigest()


def test_planted_forms_are_added_in_the_given_corpus(spark):
    """Unprefixed phones, spelled-out addresses and loosely spaced cards among the given
    documents: most are added, few other numbers are."""
    from pyspark.sql import functions as F
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    pick = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 40
    n = F.crc32(F.concat(F.lit("x"), F.col("doc_id").cast("string")).cast("binary"))
    phone = F.format_string("call me on (%03d) 555-%04d soon", n % 900 + 100, n % 10000)
    mail = F.format_string("write to name%d [at] mail%d [dot] example [dot] com please", n % 100, n % 10)
    card = F.lit("pay with card 4111  1111  1111  1111 today")
    text = (F.when(pick == 0, F.concat_ws(" ", "text", phone)).when(pick == 1, F.concat_ws(" ", "text", mail))
            .when(pick == 2, F.concat_ws(" ", "text", card)).otherwise(F.col("text")))
    planted = docs.withColumn("text", text)
    rows = digest(personal_data(planted)).join(docs.select("doc_id", pick.alias("pick")), "doc_id").select("pick", "n_added").collect()
    hit = {k: [r.n_added for r in rows if r.pick == k] for k in (0, 1, 2)}
    found = {k: sum(x > 0 for x in v) / len(v) for k, v in hit.items()}
    wrong = sum(r.n_added for r in rows if r.pick > 2)
    right = sum(min(1, r.n_added) for r in rows if r.pick <= 2)
    print("recall by form", found, "added elsewhere", wrong, "precision", right / max(1, right + wrong))
    assert right / max(1, right + wrong) >= 0.9
    assert found[0] >= 0.9


def _rules(text):
    words = WORD.findall(text or "")
    seen, covered = defaultdict(list), set()
    for k in range(len(words) - 7):
        seen[tuple(words[k:k + 8])].append(k)
    for at in seen.values():
        if len(at) > 1:
            for k in at:
                covered.update(range(k, k + 8))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            len(covered), len(words) < 20 or 100 * len(covered) > 30 * len(words))


def test_rules_equal_brute_force(spark, small_rows, odd, none):
    for df in (spark.createDataFrame(small_rows, "doc_id long, text string, lang string, source string, n_chars long"), odd):
        want = sorted(((r.doc_id, *_rules(r.text)) for r in df.collect()), key=repr)
        rows = repetition_rules(df).collect()
        got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                      for r in rows), key=repr)
        assert got == want and not any(r.kept and r.base_failed for r in rows)
    assert repetition_rules(none).count() == 0


def test_maximal_repeats_equal_brute_force():
    import pyarrow as pa
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(list("ab" if k % 2 else "abc"), rng.integers(5, 80))) for k in range(60)]
    texts += [" ".join((["p", "q", "r"] * int(rng.integers(4, 12)) + ["x"] * int(rng.integers(1, 20))) * 2) for _ in range(10)]
    got = judge(pa.array(texts), 9, 0.25, 200)
    for i, text in enumerate(texts):
        w = text.split()
        occ = defaultdict(list)
        for a in range(len(w)):
            for b in range(a + 9, len(w) + 1):
                occ[tuple(w[a:b])].append(a)
        n = longest = 0
        covered = set()
        for s, at in occ.items():
            if len(at) > 1:
                before = {w[a - 1] if a else ("start", a) for a in at}
                after = {w[a + len(s)] if a + len(s) < len(w) else ("end", a) for a in at}
                n += len(before) > 1 and len(after) > 1
                longest = max(longest, len(s))
                for a in at:
                    covered.update(range(a, a + len(s)))
        mine = got["longest_repeat"][i]
        assert (n, longest, len(covered)) == (got["n_maximal_repeats"][i], mine if mine >= 9 else 0, got["covered_words"][i])
