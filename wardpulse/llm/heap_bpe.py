"""Token counts by heap-and-linked-list byte-pair merging.

The symbols of a text are a doubly linked list; a heap holds the adjacent
pairs whose concatenation is a piece, best rank first and leftmost on ties.
Popping the best pair merges it and offers its two new neighbours. The count
is the initial symbols (an unknown character stands for its UTF-8 bytes)
minus the merges; no identifiers are made.

Merging never joins two characters that stand side by side in no piece: there
(and before a run of word marks, as no piece has a mark after another
character) the text falls into independent segments. Counts of repeated
segments are remembered per Python worker (a bounded memory; counts do not
depend on it).

Nulls count as empty texts (0 tokens); an empty text has none. Texts of any
length are counted whole, in n log n of their longest segment. Repeated rows
and ids are counted row by row; extra columns are left out.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Memory, arrow, local_path, pieces_of, resident

MARK = "▁"
#: Segments that a generation of a worker's memory holds.
MEMORY = 400_000


class PieceCounter:
    """Counts as the model file's own library does (BPE type, identity
    normaliser, a mark in front, byte fallback)."""

    def __init__(self, model: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=local_path(model))
        normal = [i for i in range(sp.vocab_size())
                  if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        order = sorted(normal, key=lambda i: (-sp.get_score(i), i))
        self.rank = {sp.id_to_piece(i): k for k, i in enumerate(order)}
        longer = [p for p in self.rank if len(p) > 1]
        if max(map(len, longer)) >= 64:
            raise ValueError("pieces of 64 characters or more are not supported")
        if any(MARK in p.lstrip(MARK) for p in longer):
            raise ValueError("pieces with an inner word mark are not supported")
        if not sp.encode("\x00a", out_type=str)[0].startswith(MARK):
            raise ValueError("the model must put a word mark in front")
        inner = {c for p in longer for c in p}
        # a line end that no longer piece holds is a segment of its own
        self.lines_apart = "\n" not in inner
        self.beside = {p[k:k + 2] for p in longer for k in range(len(p) - 1)}
        self.memory = Memory(self.tokens, MEMORY)

    def tokens(self, segment: str) -> int:
        """Tokens of a segment, cut where its characters never meet."""
        beside = self.beside
        cuts = [k + 1 for k in range(len(segment) - 1) if segment[k:k + 2] not in beside]
        if not cuts:
            return self.merges(segment)
        get = self.memory.get
        return sum(get(segment[i:j]) for i, j in zip([0, *cuts], [*cuts, len(segment)]))

    def merges(self, segment: str) -> int:
        """Initial symbols minus merges."""
        rank = self.rank
        n = len(segment)
        total = 0
        for c in segment:
            total += 1 if c in rank else len(c.encode("utf-8", "surrogatepass"))
        if n < 2:
            return total
        piece: list = list(segment)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        get = rank.get
        # an entry: rank, then place, then length of the merged piece
        wide, place = 64 * n, 64
        heap = [r * wide + i * place + 2 for i in range(n - 1) if (r := get(segment[i:i + 2])) is not None]
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            i, size = divmod(pop(heap) % wide, place)
            a, j = piece[i], after[i]
            if a is None or j >= n or len(a) + len(piece[j]) != size:
                continue                          # one of the two has merged since
            merged = piece[i] = a + piece[j]
            piece[j] = None
            total -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                both = merged + piece[k]
                r = get(both)
                if r is not None:
                    push(heap, r * wide + i * place + len(both))
            h = before[i]
            if h >= 0:
                both = piece[h] + merged
                r = get(both)
                if r is not None:
                    push(heap, r * wide + h * place + len(both))
        return total

    def segments(self, text: str) -> list[str]:
        """Independent segments of a non-empty text, marks written out."""
        if MARK not in text and "  " not in text and text[0] != " ":
            if self.lines_apart and "\n " not in text:
                return (MARK + text.replace(" ", " " + MARK).replace("\n", " \n ")).split(" ")
            return (MARK + text.replace(" ", " " + MARK)).split(" ")
        return re.findall(f"{MARK}*[^{MARK}]+|{MARK}+$", MARK + text.replace(" ", MARK))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        return sum(self.memory.get_all(self.segments(text)))


def token_counts(docs: DataFrame, model: str = "piece_bpe_32k.model", limit: int = 4096,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_bytes, n_tokens, over_limit (n_tokens > limit)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        count = resident(("heap_bpe", model), lambda: PieceCounter(model)).count
        for batch in batches:
            for part in pieces_of(batch, "_t"):
                texts = part.column(1).to_pylist()
                n = np.fromiter(map(count, texts), np.int64, len(texts))
                size = np.fromiter((len(t.encode()) if t else 0 for t in texts), np.int64, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(size), pa.array(n), pa.array(n > limit)],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return arrow(docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("_t")), run,
                 f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
