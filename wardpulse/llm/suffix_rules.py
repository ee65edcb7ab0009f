"""Quality rules with suffix-array repetition.

Words are the alphabet. Prefix doubling ranks all suffixes of a batch of texts
(a symbol is a word of one text, so texts never mix) by their first 1, 2, 4
and 8 words; from there only suffixes that still share a rank go on, until
every suffix is unique: the suffix array of all that repeats in 8 words or
more. Longest common prefixes of neighbours come from the same ranks by binary
lifting. LCP intervals whose suffixes follow different words are the maximal
repeated substrings; the spans of all that have ``min_repeat`` words or more
are united, and a text fails if the union covers more than ``max_covered`` of
its words or one repeat has more than ``max_longest`` words.

Null and empty texts have no words: counts 0, base_failed true, kept false.
Memory follows a few megabytes of text at a time, or the longest single text.
Every row is judged alone: ties, copies and repeated ids change nothing; extra
columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Words, arrow, fold, pieces_of

SYMBOLS = b"#*$%&|<>"
WINDOW = 8


def _group_ranks(keys: np.ndarray) -> np.ndarray:
    """For each element the number of smaller ones: equal keys, equal ranks."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    at = np.flatnonzero(new)
    out = np.empty(len(keys), np.int64)
    out[order] = np.repeat(at, np.diff(np.append(at, len(keys))))
    return out


def _after(ranks: np.ndarray, at: np.ndarray, step: int, end: np.ndarray) -> np.ndarray:
    """Rank of the suffix ``step`` words on, -1 beyond the text's end."""
    to = at + step
    inside = to < end
    out = np.full(len(at), -1, np.int64)
    out[inside] = ranks[to[inside]]
    return out


class Repeats:
    """Suffixes that share WINDOW words with another one of their text."""

    def __init__(self, symbols: np.ndarray, first: np.ndarray, doc: np.ndarray):
        n = len(symbols)
        self.n, self.doc = n, doc
        end = first[doc + 1] if n else np.zeros(0, np.int64)
        self.end = end
        every = np.arange(n)
        ranks = _group_ranks(symbols) if n else np.zeros(0, np.int64)
        self.levels = [ranks]                     # levels[k]: ranks by 2**k words
        for step in (1, 2, 4):
            key = ranks * (n + 1) + _after(ranks, every, step, end) + 1
            ranks = _group_ranks(key) if n else key
            self.levels.append(ranks)
        size = np.bincount(ranks, minlength=n)
        at = np.flatnonzero(size[ranks] > 1) if n else every
        self.at = at                              # in text order
        step = WINDOW
        open_ = at
        while len(open_):
            ranks = self.levels[-1].copy()
            a, b = ranks[open_], _after(ranks, open_, step, end[open_])
            order = np.lexsort((b, a))
            sa, sb = a[order], b[order]
            group = np.ones(len(order), bool)
            group[1:] = sa[1:] != sa[:-1]
            new = group.copy()
            new[1:] |= sb[1:] != sb[:-1]
            place = np.arange(len(order))
            base = np.maximum.accumulate(np.where(group, place, 0))
            sub = np.maximum.accumulate(np.where(new, place, 0))
            ranks[open_[order]] = sa + (sub - base)
            self.levels.append(ranks)
            many = np.bincount(sub, minlength=len(order))[sub] > 1
            open_ = np.sort(open_[order][many])
            step *= 2
        self.order = at[np.argsort(self.levels[-1][at], kind="stable")] if n else at
        self.lcp = self._common()

    def _common(self) -> np.ndarray:
        """LCP of each suffix in ``order`` with the one before it; 0 where they
        do not share WINDOW words."""
        a = self.order[:-1]
        b = self.order[1:]
        out = np.zeros(len(self.order), np.int64)
        base = self.levels[3]
        pick = np.flatnonzero(base[a] == base[b]) if len(a) else np.zeros(0, np.int64)
        x, y = a[pick].copy(), b[pick].copy()
        total = np.zeros(len(pick), np.int64)
        ex, ey = self.end[x], self.end[y]
        for k in range(len(self.levels) - 1, -1, -1):
            ranks, size = self.levels[k], 1 << k
            live = (x < ex) & (y < ey)
            same = np.zeros(len(pick), bool)
            same[live] = ranks[x[live]] == ranks[y[live]]
            x, y, total = x + size * same, y + size * same, total + size * same
        out[pick + 1] = total
        return out

    def longest_at(self) -> np.ndarray:
        """For each suffix in ``order`` its longest repeat."""
        nxt = np.zeros(len(self.lcp), np.int64)
        nxt[:-1] = self.lcp[1:]
        return np.maximum(self.lcp, nxt)

    def covered(self, size: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        """Words under the spans [order, order + size) of the chosen suffixes."""
        edge = np.zeros(self.n + 1, np.int64)
        at = self.order[chosen]
        np.add.at(edge, at, 1)
        np.add.at(edge, at + size[chosen], -1)
        return np.cumsum(edge[:-1]) > 0

    def maximal(self, least: int) -> list[tuple[int, int, int]]:
        """(text, words, occurrences) of the maximal repeated substrings: LCP
        intervals of ``least`` words or more whose suffixes follow differing
        words (or a text's start)."""
        order = self.order
        first = np.zeros(len(order), bool)
        prev = np.maximum(order - 1, 0)
        first = (order == 0) | (self.doc[prev] != self.doc[order])
        left = np.where(first, -1 - order, self.levels[0][prev]).tolist()
        lcp = self.lcp.tolist() + [0]
        docs = self.doc[order].tolist()
        out = []
        stack: list[list] = []                     # [lcp, word before or None, start]
        for k in range(1, len(lcp)):
            side, start, v = left[k - 1], k - 1, lcp[k]
            while stack and stack[-1][0] > v:
                size, before, start = stack.pop()
                side = side if side == before else None
                if side is None and size >= least:
                    out.append((docs[k - 1], size, k - start))
                if stack and stack[-1][0] >= v:
                    top = stack[-1]
                    top[1] = top[1] if top[1] == side else None
                    side = top[1]
            if v > 0 and (not stack or stack[-1][0] < v):
                stack.append([v, side, start])
            elif v > 0:
                top = stack[-1]
                top[1] = top[1] if top[1] == side else None
        return out


def _counts_by_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return np.diff(total[offsets])


def _repeated_lines(text: str | None) -> int:
    if not text or "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def judge(texts: pa.Array, min_repeat: int, max_covered: float, max_longest: int) -> dict[str, np.ndarray]:
    words = Words(texts, lower=False)
    n_words = np.diff(words.first)
    symbols = fold(words.hash() + fold(words.doc.astype(np.uint64) + np.uint64(1)))
    rep = Repeats(symbols, words.first.astype(np.int64), words.doc.astype(np.int64))
    data = words.data
    table = np.zeros(256, bool)
    table[list(SYMBOLS)] = True
    space = np.zeros(256, bool)
    space[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
    chars = _counts_by_text(((data & 0xC0) != 0x80) & ~space[data], words.offsets)
    by_word = lambda mask: _counts_by_text(mask, words.first)
    windows = np.full(len(rep.order), WINDOW, np.int64)
    repeated = by_word(rep.covered(windows, np.ones(len(rep.order), bool)))
    longest_at = rep.longest_at()
    covered = by_word(rep.covered(longest_at, longest_at >= min_repeat))
    longest = np.zeros(words.n_docs, np.int64)
    np.maximum.at(longest, words.doc[rep.order], longest_at)
    found = rep.maximal(min_repeat)
    n_maximal = np.bincount(np.array([f[0] for f in found], np.int64), minlength=words.n_docs)
    base_failed = (n_words < 20) | (100 * repeated > 30 * n_words)
    fraction = covered / np.maximum(n_words, 1)
    kept = ~base_failed & (fraction <= max_covered) & (longest <= max_longest)
    return {"n_words": n_words.astype(np.int64), "word_chars": chars,
            "n_symbols": _counts_by_text(table[data], words.offsets),
            "n_dup_lines": np.array([_repeated_lines(t) for t in texts.to_pylist()], np.int64),
            "n_repeat_words": repeated, "base_failed": base_failed, "kept": kept, "covered_words": covered,
            "longest_repeat": longest, "n_maximal_repeats": n_maximal.astype(np.int64)}


def repetition_rules(docs: DataFrame, min_repeat: int = 12, max_covered: float = 0.2, max_longest: int = 100,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the base counts, base_failed, kept, and the
    covered words, longest repeat and number of maximal repeats."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in pieces_of(batch, "_t", 4 << 20):
                got = judge(part.column(1), min_repeat, max_covered, max_longest)
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(v) for v in got.values()]],
                                                 names=["doc_id", *got])

    return arrow(docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("_t")), run,
                 f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                 "n_repeat_words long, base_failed boolean, kept boolean, covered_words long, "
                 "longest_repeat long, n_maximal_repeats long")
