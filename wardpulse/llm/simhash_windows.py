"""Benchmark decontamination by SimHash over item-sized windows.

The benchmark is a stated query set against all documents, taken in blocks of
``block_items`` items; a block's texts travel with the task. Items of about one
size form a class, whose window has the size of its smallest item rung (rungs
grow by 25 %). Every window of every text, one for each word and class, gets a
64-bit SimHash of its weighted word shingles (weight: distinct words in the
shingle) from sums that double from shingle to shingle.

Multi-index Hamming blocks: 64 bits are four blocks of 16; fingerprints within
``4 * (spread + 1) - 1`` bits agree to within ``spread`` bits in some block, so
filing each item under all block values within ``spread`` of its own finds all
windows within that radius. Each hit is then verified exactly: the weighted
Jaccard similarity of the item's shingles and those of the item-sized window
(at the text's end what is left of it) must reach ``threshold``.

Altered copies may lie beyond any radius, so the rest is found by shingles: a
window that reaches the threshold shares at least that part of the item's
weight, so it holds one of the item's rarest shingles (rare among the block's
items) that together weigh more than what may be missing. All windows over such
a shingle are compared, sliding word by word. So every pair at or over the
threshold is found, with its best window, the first one of equals.

Words are lower-cased runs of letters and digits, so that marks stuck to an
item's words do not hide it.

Returned are the verified (document, item) pairs with the best window. Null or
empty texts and items match nothing; texts of any length are searched whole, a
few thousand windows at a time. Items of fewer words than a shingle have one
shingle, all their words. Items with equal texts are all reported; rows that
repeat a doc_id are searched row by row. Extra columns are left out.
"""

from __future__ import annotations

from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, arrow, fold, pieces_of, resident
from .partenum import _MIX

RADIUS_BLOCKS = 4


def _rungs(most: int) -> list[int]:
    # up to ten words every size is a rung of its own
    out, x = list(range(1, 11)), 10
    while x < most:
        x = max(x + 1, int(x * 1.25))
        out.append(x)
    return out


def shingle_prints(words: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint and weight of the q words from each word on."""
    m = len(words) - q + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int16)
    total = np.zeros(m, np.uint64)
    weight = np.ones(m, np.int16)
    for j in range(q):
        total += words[j:j + m] * _MIX[j]
        if j:
            fresh = np.ones(m, bool)
            for i in range(j):
                fresh &= words[j:j + m] != words[i:i + m]
            weight += fresh
    return fold(total), weight


class WindowSums:
    """SimHashes of all windows of given sizes over a row of shingles.

    A bit of a window is set if the weights of its shingles with that bit
    exceed half of the window's weight. Sums over 1, 2, 4, ... shingles come
    from doubling, those over n from the binary digits of n.
    """

    def __init__(self, prints: np.ndarray, weight: np.ndarray, most: int):
        top = int(weight.max(initial=1)) * max(most, 1)
        self.kind = np.uint8 if top < 256 else np.uint16 if top < 65536 else np.uint32
        weight = weight.astype(self.kind)
        bits = np.unpackbits(prints.view(np.uint8)).reshape(-1, 64)
        self.levels = [(bits * weight[:, None], weight)]
        size = 1
        while size * 2 <= most:
            self.levels.append(tuple(x[:-size] + x[size:] for x in self.levels[-1]))
            size *= 2

    def prints(self, n: int) -> np.ndarray:
        total, at = None, 0
        count = len(self.levels[0][1]) - n + 1
        for k, level in enumerate(self.levels):
            if n >> k & 1:
                part = [x[at:at + count] for x in level]
                total = part if total is None else [x + y for x, y in zip(total, part)]
                at += 1 << k
        sums, weight = total
        return np.packbits((sums > (weight >> 1)[:, None]).ravel()).view(np.uint64)


class ItemClass:
    """The items of one window size and their Hamming blocks."""

    def __init__(self, size: int, q: int, spread: int):
        self.size, self.q, self.spread = size, q, spread
        self.items: list[int] = []
        self.prints: list[int] = []

    def close(self):
        prints = np.array(self.prints, np.uint64)
        self.of = prints
        blocks = prints.view(np.uint16).reshape(-1, RADIUS_BLOCKS)
        masks = [sum(1 << b for b in c) for k in range(self.spread + 1) for c in combinations(range(16), k)]
        masks = np.array(masks, np.uint16)
        self.tables = []
        for b in range(RADIUS_BLOCKS):
            values = (blocks[:, b][:, None] ^ masks[None, :]).ravel()
            owner = np.repeat(np.arange(len(prints)), len(masks))
            order = np.argsort(values, kind="stable")
            start = np.zeros(65537, np.int32)
            np.cumsum(np.bincount(values, minlength=65536), out=start[1:])
            self.tables.append((start, owner[order].astype(np.int32), np.diff(start) > 0))
        self.items = np.array(self.items)

    def hits(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs within the radius."""
        radius = RADIUS_BLOCKS * (self.spread + 1) - 1
        blocks = prints.view(np.uint16).reshape(-1, RADIUS_BLOCKS)
        some = np.zeros(len(prints), bool)
        for b, (_, _, has) in enumerate(self.tables):
            some |= has.take(blocks[:, b])
        some = np.flatnonzero(some)
        ws, its = [], []
        for b, (start, owner, has) in enumerate(self.tables):
            v = blocks[some, b]
            at = has.take(v)
            at, v = some[at], v[at].astype(np.int64)
            n = start[v + 1] - start[v]
            w = np.repeat(at, n)
            place = np.arange(len(w)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[v], n)
            i = owner[place]
            near = np.bitwise_count(prints[w] ^ self.of[i]) <= radius
            ws.append(w[near])
            its.append(i[near])
        both = np.unique(np.concatenate(ws).astype(np.int64) * len(self.of) + np.concatenate(its))
        return both // len(self.of), both % len(self.of)


def _words(texts: pa.Array) -> Words:
    return Words(pc.utf8_lower(texts), lower=False, plain=True)


class ItemIndex:
    def __init__(self, texts: list[str], shingle: int, spread: int):
        self.shingle = shingle
        self._rare: dict[float, dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        words = _words(pa.array(texts, pa.string()))
        h = words.hash()
        self.sets: list[dict[int, int]] = []
        self.sizes = np.diff(words.first)
        rungs = np.array(_rungs(int(max([1, *self.sizes]))))
        classes: dict[int, ItemClass] = {}
        for i, n in enumerate(self.sizes):
            own = h[words.first[i]:words.first[i + 1]]
            if n == 0:
                self.sets.append({})
                continue
            prints, weight = shingle_prints(own, min(shingle, n))
            self.sets.append(dict(zip(prints.tolist(), weight.tolist())))
            size = int(rungs[np.searchsorted(rungs, n, side="right") - 1])
            q = min(shingle, size)
            c = classes.setdefault(size, ItemClass(size, q, spread))
            if q != min(shingle, n):
                raise ValueError("a rung below the shingle size must be exact")
            n = size - q + 1
            c.items.append(i)
            c.prints.append(int(WindowSums(prints[:n], weight[:n], n).prints(n)[0]))
        self.classes = [classes[k] for k in sorted(classes)]
        for c in self.classes:
            c.close()

    def rare(self, threshold: float) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each shingle size the sorted shingles of which a window at or
        over the threshold holds one, where their items start, and the items."""
        if threshold not in self._rare:
            usual = Counter(p for mine in self.sets for p in mine)
            pairs: dict[int, list[tuple[int, int]]] = {}
            for i, mine in enumerate(self.sets):
                left = sum(mine.values())
                need = threshold * left * (1 - 1e-9)
                of = pairs.setdefault(min(self.shingle, int(self.sizes[i])), [])
                for p in sorted(mine, key=lambda p: (usual[p], p)):
                    if left < need:         # what remains cannot reach the threshold alone
                        break
                    of.append((p, i))
                    left -= mine[p]
            out = {}
            for q, of in pairs.items():
                of.sort()
                prints, start = np.unique(np.array([p for p, _ in of], np.uint64), return_index=True)
                out[q] = prints, np.append(start, len(of)), np.array([i for _, i in of], np.int64)
            self._rare[threshold] = out
        return self._rare[threshold]

    def best_window(self, item: int, h: np.ndarray, lo: int, hi: int, end: int, threshold: float):
        """(similarity, first word) of the best window that starts in lo..hi-1
        of a text that ends at ``end``, or None below the threshold."""
        n, q, mine = int(self.sizes[item]), min(self.shingle, int(self.sizes[item])), self.sets[item]
        prints, weight = shingle_prints(h[lo:min(hi - 1 + n, end)], q)
        total = sum(mine.values())
        shared = np.array([mine.get(p, 0) for p in prints.tolist()], np.int64)
        sums = np.append(0, np.cumsum(shared))
        at = np.arange(min(hi - lo, len(prints)))
        # repeats counted, so never less than what the window shares
        fit = np.flatnonzero(sums[np.minimum(at + n - q + 1, len(prints))] - sums[at] >= threshold * total * (1 - 1e-9))
        if not len(fit):
            return None
        prints, weight, shared = prints.tolist(), weight.tolist(), shared.tolist()
        inside: dict[int, int] = {}
        best, common, whole, k = None, 0, 0, int(fit[0])
        for s in range(int(fit[0]), int(fit[-1]) + 1):
            while k < min(s + n - q + 1, len(prints)):
                c = inside.get(prints[k], 0)
                if not c:
                    common, whole = common + shared[k], whole + weight[k]
                inside[prints[k]] = c + 1
                k += 1
            got = common / (total + whole - common)
            if got >= threshold and (best is None or got > best[0]):
                best = got, lo + s
            c = inside[prints[s]] - 1
            inside[prints[s]] = c
            if not c:
                common, whole = common - shared[s], whole - weight[s]
        return best

    def _near_rare(self, prints: np.ndarray, q: int, lo: int, words: Words, threshold: float):
        """(item, first start, last start + 1, text) of the windows over rare
        shingles among ``prints``, those of the words from ``lo`` on."""
        rare, start, owner = self.rare(threshold)[q]
        place = np.minimum(np.searchsorted(rare, prints), len(rare) - 1)
        at = np.flatnonzero(rare[place] == prints)
        at = at[words.doc[lo + at] == words.doc[lo + at + q - 1]]
        place = place[at]
        n = start[place + 1] - start[place]
        w = np.repeat(at, n) + lo
        i = owner[np.arange(len(w)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[place], n)]
        order = np.lexsort((w, i))
        run = None
        for k, hit in zip(i[order].tolist(), w[order].tolist()):
            d = int(words.doc[hit])
            first = max(hit - int(self.sizes[k]) + q, int(words.first[d]))
            if run is not None and run[0] == k and run[3] == d and first <= run[2]:
                run = (k, run[1], hit + 1, d)
                continue
            if run is not None:
                yield run
            run = (k, first, hit + 1, d)
        if run is not None:
            yield run

    def similarity(self, item: int, own: np.ndarray) -> float:
        """Weighted Jaccard of the item and a window's word fingerprints."""
        prints, weight = shingle_prints(own, min(self.shingle, int(self.sizes[item])))
        window = dict(zip(prints.tolist(), weight.tolist()))
        mine = self.sets[item]
        common = sum(w for p, w in mine.items() if p in window)
        union = sum(mine.values()) + sum(window.values()) - common
        return common / union if union else 0.0

    def search(self, texts: pa.Array, threshold: float, chunk: int = 16384):
        """(text, item, first word, similarity) of the best verified windows."""
        words = _words(texts)
        h, doc = words.hash(), words.doc
        best: dict[tuple[int, int], tuple[float, int]] = {}

        def keep(d, k, s, at):
            best[d, k] = max(best.get((d, k), (0.0, 0)), (s, int(words.first[d]) - at))

        most = max([c.size for c in self.classes], default=0)
        for q in sorted({c.q for c in self.classes}):
            classes = [c for c in self.classes if c.q == q]
            for lo in range(0, len(h), chunk):
                prints, weight = shingle_prints(h[lo:lo + chunk + most - 1], q)
                if not len(prints):
                    continue
                for k, first, last, d in self._near_rare(prints[:chunk], q, lo, words, threshold):
                    got = self.best_window(k, h, first, last, int(words.first[d + 1]), threshold)
                    if got is not None:
                        keep(d, k, *got)
                sums = WindowSums(prints, weight, most - q + 1)
                for c in classes:
                    n = c.size - q + 1
                    if len(prints) < n:
                        continue
                    own = sums.prints(n)[:chunk]
                    first = doc[lo:lo + len(own)]
                    inside = np.flatnonzero(first == doc[lo + c.size - 1:lo + c.size - 1 + len(own)])
                    if len(inside) < len(own):
                        own = np.ascontiguousarray(own[inside])
                    w, i = c.hits(own)
                    for at, k in zip((inside[w] + lo).tolist(), c.items[i].tolist()):
                        d = int(doc[at])
                        end = min(at + int(self.sizes[k]), int(words.first[d + 1]))
                        s = self.similarity(k, h[at:end])
                        if s >= threshold:
                            keep(d, k, s, at)
        return [(d, k, -at, s) for (d, k), (s, at) in sorted(best.items())]


def _index(texts: list[str], shingle: int, spread: int) -> ItemIndex:
    return resident(("simhash_windows", shingle, spread, tuple(texts)), lambda: ItemIndex(texts, shingle, spread))


def _search_block(docs: DataFrame, ids: list, texts: list[str], shingle: int, spread: int, threshold: float,
                  item_kind: str) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    item_type = pa.int64() if item_kind == "bigint" else None

    def run(batches):
        index = _index(texts, shingle, spread)
        for batch in batches:
            for part in pieces_of(batch, "_t", 4 << 20):
                found = index.search(part.column(1), threshold)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array([f[0] for f in found], pa.int64())),
                     pa.array([ids[f[1]] for f in found], item_type),
                     pa.array([f[2] for f in found], pa.int64()),
                     pa.array([int(index.sizes[f[1]]) for f in found], pa.int64()),
                     pa.array([f[3] for f in found], pa.float64())],
                    names=["doc_id", "item_id", "start_word", "n_words", "similarity"])

    return arrow(docs, run, f"doc_id {kind}, item_id {item_kind}, start_word long, n_words long, similarity double")


def _blocks(benchmark: DataFrame, block_items: int, item_col: str, item_text_col: str):
    """The benchmark's items in blocks of about ``block_items``: (ids, texts)."""
    items = (benchmark.select(benchmark[item_col].alias("item_id"), benchmark[item_text_col].alias("text"))
             .where("text is not null"))
    blocks = max(1, -(-items.count() // block_items))
    dealt = items.withColumn("_b", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    for b in range(blocks):
        rows = dealt.where(F.col("_b") == b).orderBy("item_id", "text").collect()
        yield [r["item_id"] for r in rows], [r["text"] for r in rows]


def contaminated(docs: DataFrame, benchmark: DataFrame, shingle: int = 5, threshold: float = 0.8, spread: int = 1,
                 block_items: int = 2000, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, start_word, n_words, similarity) of every verified
    pair; ``start_word`` counts the document's words from 0."""
    docs = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("_t"))
    item_kind = benchmark.schema[item_col].dataType.simpleString()
    out = None
    for ids, texts in _blocks(benchmark, block_items, item_col, item_text_col):   # a pass over the documents each
        got = _search_block(docs, ids, texts, shingle, spread, threshold, item_kind)
        out = got if out is None else out.unionAll(got)
    return out


def without_contaminated(docs: DataFrame, benchmark: DataFrame, shingle: int = 5, threshold: float = 0.8,
                         spread: int = 1, block_items: int = 2000, text_col: str = "text",
                         item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The documents, all columns as they are, that hold no benchmark item."""
    for _, texts in _blocks(benchmark, block_items, item_col, item_text_col):
        docs = _drop_block(docs, texts, shingle, spread, threshold, text_col)
    return docs


def _drop_block(docs: DataFrame, texts: list[str], shingle: int, spread: int, threshold: float,
                text_col: str) -> DataFrame:
    def run(batches):
        index = _index(texts, shingle, spread)
        for batch in batches:
            for part in pieces_of(batch, text_col, 4 << 20):
                column = part.column(part.schema.get_field_index(text_col))
                clean = np.ones(part.num_rows, bool)
                clean[[f[0] for f in index.search(column, threshold)]] = False
                yield part.filter(pa.array(clean))

    return arrow(docs, run, docs.schema)
