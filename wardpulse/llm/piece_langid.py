"""Language identification by segmentation-marginalised unigrams.

Over a fixed public piece vocabulary each language has piece probabilities. A
word's probability is the sum over all its segmentations into pieces (forward
algorithm; a character without a piece has a floor probability); words are
independent, as no piece crosses a word's start. A text's score per language is
the sum of its words' log probabilities; the largest wins and the returned
score is its share of the likelihoods.

Fitting: expectation-maximisation over the lattices, from uniform
probabilities. It uses up to ``max_docs`` labelled documents per language,
chosen by a hash of the id (the documented bound of the sample); their words
are counted by Spark, the expected piece counts are summed by Spark, and only
the vocabulary-sized table of probabilities reaches the driver.

Words are runs of letters, lower-cased; a run longer than 32 characters is
taken in parts of 32. A null text, an empty one or one without a letter gets
`und` with score 0; so does every text if nothing can be learned from. Rows
without id are never learned from and not held out. Each row is judged alone;
extra columns are left out; equal scores go to the first language by name.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow, land, pieces_of, resident
from .lattice import MARK, PieceTable, by_length

WORDS = re.compile(r"[^\W\d_]+")
LONGEST = 32
#: Words that a worker remembers before it starts anew.
MEMORY = 300_000

_TABLES: dict[str, PieceTable] = {}


def _table(model: str) -> PieceTable:
    if model not in _TABLES:
        _TABLES[model] = PieceTable(model)
    return _TABLES[model]


def _parts(word: str) -> list[str]:
    word = MARK + word
    return [word[k:k + LONGEST] for k in range(0, len(word), LONGEST)]


def log_probabilities(table: PieceTable, words: list[str], p: np.ndarray) -> np.ndarray:
    """log p(word) by language; ``p`` has a row per piece and a last one, the floor."""
    parts, owner = [], []
    for k, w in enumerate(words):
        for part in _parts(w):
            parts.append(part)
            owner.append(k)
    out = np.zeros((len(words), p.shape[1]))
    owner = np.array(owner, np.int64)
    for places, chars in by_length(parts, 20000):
        alpha = np.zeros((chars.shape[1] + 1, len(chars), p.shape[1]))
        alpha[0] = 1.0
        for i, size, rows, piece in table.edges(chars):
            alpha[i + size][rows] += alpha[i][rows] * p[piece]
        np.add.at(out, owner[places], np.log(alpha[-1]))
    return out


def expected_counts(table: PieceTable, words: list[str], lang: np.ndarray, times: np.ndarray,
                    p: np.ndarray) -> np.ndarray:
    """Expected uses of each piece by language, summed over words and their
    segmentations (forward-backward)."""
    out = np.zeros_like(p)
    parts, owner = [], []
    for k, w in enumerate(words):
        for part in _parts(w):
            parts.append(part)
            owner.append(k)
    owner = np.array(owner, np.int64)
    for places, chars in by_length(parts, 20000):
        who = owner[places]
        mine, many = lang[who], times[who]
        edges = [(i, size, rows, piece, p[piece, mine[rows]]) for i, size, rows, piece in table.edges(chars)]
        width = chars.shape[1]
        alpha, beta = np.zeros((width + 1, len(chars))), np.zeros((width + 1, len(chars)))
        alpha[0] = beta[-1] = 1.0
        for i, size, rows, _, prob in edges:
            alpha[i + size][rows] += alpha[i][rows] * prob
        for i, size, rows, _, prob in reversed(edges):
            beta[i][rows] += beta[i + size][rows] * prob
        for i, size, rows, piece, prob in edges:
            share = many[rows] * alpha[i][rows] * prob * beta[i + size][rows] / alpha[-1][rows]
            np.add.at(out, (piece, mine[rows]), share)
    return out


def _word_counts(docs: DataFrame, langs: list[str]) -> DataFrame:
    number = {name: k for k, name in enumerate(langs)}

    def run(batches):
        for batch in batches:
            for part in pieces_of(batch, "text", 16 << 20):
                counts = [Counter() for _ in langs]
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    counts[number[lang]].update(WORDS.findall((text or "").lower()))
                for k, c in enumerate(counts):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k] * len(c), pa.int32()), pa.array(list(c), pa.string()),
                         pa.array(list(c.values()), pa.int64())], names=["lang", "word", "n"])

    rows = arrow(docs.select("lang", "text"), run, "lang int, word string, n long")
    return rows.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, model: str, rounds: int, max_docs: int, floor: float = 1e-7) -> tuple[list[str], np.ndarray]:
    """Languages by name and their piece probabilities (last row: floor).
    ``docs`` has doc_id, text and lang; only its labelled training rows count."""
    train = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = {r["lang"]: r["n"] for r in train.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return [], np.zeros((0, 0))
    share = F.lit(0.0)
    for name in langs:
        share = F.when(F.col("lang") == name, F.lit(min(1.0, max_docs / sizes[name]))).otherwise(share)
    drawn = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    words = land(_word_counts(train.where(drawn < share), langs), "words")
    table = _table(model)
    size = len(table.pieces)
    p = np.full((size + 1, len(langs)), 1.0 / size)
    p[-1] = floor
    n_langs = len(langs)
    for _ in range(rounds):
        now = p

        def run(batches):
            t = _table(model)
            total = np.zeros_like(now)
            for batch in batches:
                total += expected_counts(t, batch.column(1).to_pylist(), batch.column(0).to_numpy(),
                                         batch.column(2).to_numpy().astype(float), now)
            piece, lang = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(lang), pa.array(total[piece, lang])],
                                             names=["piece", "lang", "n"])

        got = arrow(words.select("lang", "word", "n"), run, "piece long, lang long, n double")
        rows = got.groupBy("piece", "lang").agg(F.sum("n").alias("n")).collect()   # pieces x languages at most
        total = np.zeros((size + 1, n_langs))
        for r in rows:
            total[r["piece"], r["lang"]] = r["n"]
        total = np.round(total, 6)
        common = total[:size].sum(axis=1, keepdims=True)
        common = (common + 0.01) / (common.sum() + 0.01 * size)
        p = np.full((size + 1, n_langs), floor)
        p[:size] = (total[:size] + 50.0 * common) / (total[:size].sum(axis=0) + 50.0)
    return langs, p


class Scorer:
    """Word log probabilities, remembered by word as rows of a matrix."""

    def __init__(self, model: str, langs: list[str], p: np.ndarray):
        self.table, self.langs, self.p = _table(model), langs, p
        self._anew()

    def _anew(self):
        self.row: dict[str, int] = {}
        self.values = np.zeros((1 << 16, len(self.langs) + 1))

    def _learn(self, words: list[str]):
        have = len(self.row)
        while have + len(words) > len(self.values):
            self.values = np.concatenate([self.values, np.zeros_like(self.values)])
        self.values[have:have + len(words), :-1] = log_probabilities(self.table, words, self.p)
        self.values[have:have + len(words), -1] = [any(map(str.isalpha, w)) for w in words]
        self.row.update(zip(words, range(have, have + len(words))))

    def score(self, texts: list) -> tuple[list[str], np.ndarray]:
        found = [WORDS.findall(t.lower()) if t else [] for t in texts]
        seen = set().union(*found)
        new = seen - self.row.keys()
        if len(self.row) + len(new) > MEMORY:
            self._anew()
            new = seen
        if new:
            self._learn(sorted(new))
        get = self.row.__getitem__
        total = np.zeros((len(texts), len(self.langs) + 1))
        for k, words in enumerate(found):
            if words:
                total[k] = self.values[np.fromiter(map(get, words), np.int64, len(words))].sum(axis=0)
        letters = total[:, -1] > 0
        value = total[:, :-1]
        best = value.argmax(axis=1)
        share = 1.0 / np.exp(value - value.max(axis=1, keepdims=True)).sum(axis=1)
        return ([self.langs[b] if ok else "und" for b, ok in zip(best.tolist(), letters.tolist())],
                np.where(letters, share, 0.0))


def predict_language(docs: DataFrame, model: str = "piece_bpe_32k.model", rounds: int = 2, max_docs: int = 10_000,
                     id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                     carry: bool = False) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document; with ``carry`` also
    the whole input row as a struct column ``row``."""
    own = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), docs[lang_col].alias("lang"))
    langs, p = fit(own, model, rounds, max_docs)
    rows = docs.select(docs[text_col].alias("_t"), docs[id_col].alias("doc_id"),
                       held_out(docs[id_col]).alias("held_out"),
                       *([F.struct(*[docs[c] for c in docs.columns]).alias("row")] if carry else []))
    if not langs:
        return rows.drop("_t").select("*", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    key = hash((model, tuple(langs), p.tobytes()))

    def run(batches):
        scorer = resident(("piece_langid", key), lambda: Scorer(model, langs, p))
        for batch in batches:
            for part in pieces_of(batch, "_t", 4 << 20):
                lang, score = scorer.score(part.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(lang, pa.string()), pa.array(score)],
                                                 names=[*part.schema.names[1:], "lang_pred", "score"])

    return arrow(rows, run, f"{schema}, lang_pred string, score double")
