"""Toxicity by Levenshtein automata over a lexicon trie, with context windows.

The lexicon is learned: terms (whole words, or stems: word beginnings) that far
more toxic than other training documents hold, in a trie. A word is run through
the product of the trie with a Levenshtein automaton of at most one edit (none
for terms under ``fuzzy_from`` letters): a state is the set of (trie node, edits
left) pairs, made on first use and remembered, so each character of a word is
one step. A whole-word term accepts at the word's end, a stem anywhere.

Each hit is judged in its context window of ``window`` words to both sides:
quotation marks and reporting words speak for a quotation, words of address
for abuse. A document's features (exact, fuzzy, quoted and addressed hits and
their density) go to a logistic regression.

Lexicon and regression are fitted on labelled training documents only: those
whose CRC-32 of the id modulo 5 is not 0, at most ``max_docs`` per label by a
hash of the id (the documented bound of the sample). Term counts are summed by
Spark; only candidate terms and the bounded sample's few features per document
reach the driver. Every document is scored.

Null and empty texts have no hits and get the regression's score for that.
Without labels of both kinds every score is 0. Rows without id are never
learned from and not held out. Labels that repeat for an id count as the
largest. Each row is scored alone; extra columns are left out.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memory, arrow, land, pieces_of, resident
from .piece_langid import held_out

WORD = re.compile(r"[^\W\d_]+")
#: Defaults of two parameters: words that report speech, and words of address.
REPORTING = frozenset("said says wrote quoted called word term sagte schrieb zitiert dijo escribió dit écrit".split())
ADDRESS = frozenset("you your u du dich dein ihr tu te vous toi tú usted ti".split())
QUOTES = "\"'`«»“”„‘’"
STEM_SIZES = range(4, 8)
FEATURES = 6
MEMORY = 150_000


class FuzzyLexicon:
    """The trie-automaton product as a lazily determinised automaton."""

    def __init__(self, terms: list[tuple[str, bool]], fuzzy_from: int):
        self.children: list[dict[str, int]] = [{}]
        self.word_end: list[bool] = [False]
        self.stem_end: list[bool] = [False]
        self.height: list[int] = [0]        # letters of the longest term below
        for term, stem in terms:
            node = 0
            for c in term:
                if c not in self.children[node]:
                    self.children.append({})
                    self.word_end.append(False)
                    self.stem_end.append(False)
                    self.children[node][c] = len(self.children) - 1
                node = self.children[node][c]
            (self.stem_end if stem else self.word_end)[node] = True
        self.fuzzy = FuzzyLexicon([t for t in terms if len(t[0]) >= fuzzy_from], 0) if fuzzy_from else None
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.stem_at: list[bool] = []
        self.word_at: list[bool] = []
        self.begin = self._state({(0, 1)})

    def _state(self, pairs: set) -> int:
        """Close under deletions of term letters; keep the best edits per node."""
        todo, have = list(pairs), {}
        while todo:
            node, left = todo.pop()
            if have.get(node, -1) >= left:
                continue
            have[node] = left
            if left:
                todo += [(c, left - 1) for c in self.children[node].values()]
        key = frozenset(have.items())
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
            self.stem_at.append(any(self.stem_end[n] for n, _ in key))
            self.word_at.append(any(self.word_end[n] for n, _ in key))
        return self.states[key]

    def _step(self, state: int, c: str) -> int:
        out = set()
        for node, left in self.sets[state]:
            to = self.children[node].get(c)
            if to is not None:
                out.add((to, left))
            if left:
                out.add((node, left - 1))                                       # an added letter
                out.update((x, left - 1) for x in self.children[node].values())  # a changed letter
        new = self._state(out)
        self.steps[state][c] = new
        return new

    def near(self, word: str) -> bool:
        """Within one edit of a term."""
        state = self.begin
        for c in word:
            if self.stem_at[state]:
                return True
            to = self.steps[state].get(c)
            state = self._step(state, c) if to is None else to
            if not self.sets[state]:
                return False
        return self.stem_at[state] or self.word_at[state]

    def exact(self, word: str) -> bool:
        node = 0
        for c in word:
            node = self.children[node].get(c)
            if node is None:
                return False
            if self.stem_end[node]:
                return True
        return self.word_end[node]

    def match(self, word: str) -> int:
        """2 for a term itself, 1 within one edit of one, else 0."""
        if self.exact(word):
            return 2
        return 1 if self.fuzzy is not None and self.fuzzy.near(word) else 0


class Scorer:
    def __init__(self, terms: list[tuple[str, bool]], fuzzy_from: int, window: int,
                 reporting: frozenset = REPORTING, address: frozenset = ADDRESS):
        self.lexicon = FuzzyLexicon(terms, fuzzy_from)
        self.window, self.reporting, self.address = window, reporting, address
        self.memory = Memory(self.lexicon.match, MEMORY)

    def features(self, text: str | None) -> list[float]:
        if not text:
            return [0.0] * FEATURES
        low = text.lower()
        words = WORD.findall(low)
        kinds = self.memory.get_all(words)
        exact, fuzzy = kinds.count(2), kinds.count(1)
        if not exact + fuzzy:
            return [0.0] * FEATURES
        quoted = addressed = 0
        for k, (kind, m) in enumerate(zip(kinds, WORD.finditer(low))):
            if not kind:
                continue
            around = words[max(0, k - self.window):k] + words[k + 1:k + 1 + self.window]
            marks = low[max(0, m.start() - 1):m.start()] + low[m.end():m.end() + 1]
            if any(q in marks for q in QUOTES) or not self.reporting.isdisjoint(around):
                quoted += 1
            elif not self.address.isdisjoint(around):
                addressed += 1
        hits = exact + fuzzy
        return [float(np.log1p(exact)), float(np.log1p(fuzzy)), float(exact > 0), quoted / hits, addressed / hits,
                min(1.0, 10.0 * exact / len(words))]


def _term_counts(train: DataFrame) -> DataFrame:
    """Documents per label that hold each word and each stem."""
    def run(batches):
        for batch in batches:
            for part in pieces_of(batch, "text", 1 << 20):
                counts: dict[tuple[str, bool], list[int]] = {}
                for label, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    words = set(WORD.findall((text or "").lower()))
                    terms = {(w, False) for w in words if len(w) >= 3}
                    terms |= {(w[:k], True) for w in words for k in STEM_SIZES if len(w) >= k}
                    for t in terms:
                        counts.setdefault(t, [0, 0])[label] += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t[0] for t in counts], pa.string()), pa.array([t[1] for t in counts], pa.bool_()),
                     pa.array([c[0] for c in counts.values()], pa.int64()),
                     pa.array([c[1] for c in counts.values()], pa.int64())], names=["term", "stem", "n0", "n1"])

    rows = arrow(train.select("label", "text"), run, "term string, stem boolean, n0 long, n1 long")
    return rows.groupBy("term", "stem").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def learn_lexicon(train: DataFrame, sizes: dict[int, int]) -> list[tuple[str, bool]]:
    """Terms in at least 5 toxic documents (and 1 in 400) that are at least 20
    times as frequent there as elsewhere; a term that a shorter chosen stem
    covers is left out, and a stem none of whose words is common stays a word. Every
    term that meets these rules counts; as a document of the bounded sample holds a
    bounded number of such terms, 400 times that number bounds the table."""
    counts = _term_counts(train)
    least = max(5, sizes[1] // 400)
    lift = ((F.col("n1") + 0.0) / sizes[1]) / ((F.col("n0") + 0.5) / sizes[0])
    rows = sorted(counts.where((F.col("n1") >= least) & (lift >= 20.0)).collect(),
                  key=lambda r: (-r["n1"], r["term"], r["stem"]))
    support = {(r["term"], r["stem"]): r["n1"] for r in rows}
    stems: list[str] = []
    for (term, stem), n in sorted(support.items(), key=lambda x: (len(x[0][0]), x[0][0])):
        if not stem or any(term.startswith(s) for s in stems):
            continue
        # worth a stem only if it gathers more than any one word that begins so
        top = max((m for (w, s), m in support.items() if not s and w.startswith(term)), default=0)
        if n >= 1.5 * top:
            stems.append(term)
    words = [w for (w, s) in support if not s and not any(w.startswith(x) for x in stems)]
    return sorted([(s, True) for s in stems] + [(w, False) for w in words])


def logistic(x: np.ndarray, y: np.ndarray, share: np.ndarray, ridge: float = 1e-3, rounds: int = 40) -> np.ndarray:
    """Weights (last: intercept) by Newton steps; ``share`` weighs the rows."""
    x = np.column_stack([x, np.ones(len(x))])
    share = share * len(y) / share.sum()
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (share * (y - p)) - ridge * len(y) * w * np.append(np.ones(len(w) - 1), 0)
        hess = (x * (share * p * (1 - p))[:, None]).T @ x + ridge * len(y) * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _scorer(*how) -> Scorer:
    terms, *rest = how
    return resident(("toxic_automata", tuple(terms), *rest), lambda: Scorer(*how))


def toxicity(docs: DataFrame, labels: DataFrame, max_docs: int = 8000, fuzzy_from: int = 5, window: int = 3,
             id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
             reporting: frozenset = REPORTING, address: frozenset = ADDRESS) -> DataFrame:
    """doc_id, held_out, score, predicted for every document. ``reporting`` and
    ``address`` are the words that speak for a quotation and for abuse."""
    docs = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    marks = (labels.select(labels["doc_id"].alias("doc_id"), labels[label_col].cast("int").alias("label"))
             .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    sizes = {0: 0, 1: 0} | {r["label"]: r["n"] for r in marks.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    out = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    if not sizes[0] or not sizes[1]:
        return out.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).cast("int").alias("predicted"))
    share = F.when(F.col("label") == 1, min(1.0, max_docs / sizes[1])).otherwise(min(1.0, max_docs / sizes[0]))
    drawn = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(23)), F.lit(1 << 30)) / float(1 << 30)
    chosen = marks.where(drawn < share)
    # the drawn ids are few by the sample's bound, so the documents stay where they are
    train = land(docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text"), "labelled")
    have = {0: 0, 1: 0} | {r["label"]: r["n"] for r in train.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not have[0] or not have[1]:
        return out.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).cast("int").alias("predicted"))
    terms = learn_lexicon(train, have)

    def describe(batches):
        scorer = _scorer(terms, fuzzy_from, window, reporting, address)
        for batch in batches:
            got = [scorer.features(t) for t in batch.column(1).to_pylist()]
            cols = np.array(got).reshape(-1, FEATURES).T
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c) for c in cols]],
                                             names=["label", *[f"f{k}" for k in range(FEATURES)]])

    cells = ", ".join(f"f{k} double" for k in range(FEATURES))
    sample = arrow(train.select("label", "text"), describe, f"label int, {cells}")
    # features repeat a lot: their groups are what the bounded sample sends
    rows = sample.groupBy(*sample.columns).agg(F.count(F.lit(1)).alias("n")).collect()
    rows = sorted(rows, key=tuple)
    x = np.repeat(np.array([[r[f"f{k}"] for k in range(FEATURES)] for r in rows]), [r["n"] for r in rows], axis=0)
    y = np.repeat(np.array([r["label"] for r in rows]), [r["n"] for r in rows])
    # each label weighs as much as it has training documents, drawn or not
    weights = logistic(x, y, np.where(y == 1, sizes[1] / have[1], sizes[0] / have[0]))

    def score(batches):
        scorer = _scorer(terms, fuzzy_from, window, reporting, address)
        for batch in batches:
            for part in pieces_of(batch, "text", 8 << 20):
                f = np.array([scorer.features(t) for t in part.column(2).to_pylist()]).reshape(-1, FEATURES)
                p = 1.0 / (1.0 + np.exp(-np.clip(f @ weights[:-1] + weights[-1], -30, 30)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"])

    return arrow(out, score, f"doc_id {kind}, held_out boolean, score double, predicted int")
