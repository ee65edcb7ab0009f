"""Segmentation lattices of many words at once, over a fixed piece vocabulary.

Words of one length form a matrix of code points; substrings are looked up by
rolling fingerprints, which also tell when no longer piece can follow.
"""

from __future__ import annotations

import numpy as np

from .common import local_path

MARK = "▁"
_B = np.uint64(0x9E3779B97F4A7C15 | 1)


class PieceTable:
    """The normal pieces of a model file: ``pieces[k]`` with library id ``ids[k]``
    and ``score[k]``; ``single[c]`` is the piece of a character."""

    def __init__(self, model: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=local_path(model))
        self.ids = np.array([i for i in range(sp.vocab_size()) if not (
            sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))], np.int64)
        self.pieces = [sp.id_to_piece(int(i)) for i in self.ids]
        self.score = np.array([sp.get_score(int(i)) for i in self.ids])
        bytes_ = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(sp.vocab_size()) if sp.is_byte(i)}
        self.byte_ids = np.array([bytes_.get(b, 0) for b in range(256)], np.int64)
        self.index = {p: k for k, p in enumerate(self.pieces)}
        prefixes = sorted({p[:k] for p in self.pieces for k in range(1, len(p) + 1)})
        prints = np.array([self.fingerprint(p) for p in prefixes], np.uint64)
        if len(np.unique(prints)) != len(prints):
            raise ValueError("fingerprints of two pieces collide")
        order = np.argsort(prints)
        owner = np.array([self.index.get(p, -1) for p in prefixes], np.int64)
        self._keys, self._piece = self._spread(prints[order], owner[order])

    @staticmethod
    def fingerprint(text: str) -> int:
        h = 0
        for c in text:
            h = (h * int(_B) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    def _spread(self, prints: np.ndarray, piece: np.ndarray):
        """Open addressing with linear probes; an empty slot ends a search."""
        self._shift = np.uint64(64 - 19)
        size = 1 << 19
        keys = np.zeros(size, np.uint64)
        owner = np.full(size, -2, np.int64)          # -2 nothing, -1 prefix only
        slot = (prints * np.uint64(0xD6E8FEB86659FD93) >> self._shift).astype(np.int64)
        for h, p, s in zip(prints.tolist(), piece.tolist(), slot.tolist()):
            while owner[s] != -2:
                s = (s + 1) % size
            keys[s], owner[s] = h, p
        return keys, owner

    def find(self, prints: np.ndarray) -> np.ndarray:
        """Piece number, -1 for a proper prefix of pieces, -2 for neither."""
        slot = (prints * np.uint64(0xD6E8FEB86659FD93) >> self._shift).astype(np.int64)
        got = self._piece[slot]
        wrong = np.flatnonzero((got != -2) & (self._keys[slot] != prints))
        while len(wrong):
            slot[wrong] = (slot[wrong] + 1) % len(self._keys)
            got[wrong] = self._piece[slot[wrong]]
            wrong = wrong[(got[wrong] != -2) & (self._keys[slot[wrong]] != prints[wrong])]
        return got

    def edges(self, chars: np.ndarray):
        """Of words as rows of code points: (start, length, rows, piece numbers),
        by ascending start; -1 stands for a character without a piece."""
        rows_all = np.arange(len(chars))
        width = chars.shape[1]
        chars = chars.astype(np.uint64) + np.uint64(1)
        for i in range(width):
            rows = rows_all
            h = np.zeros(len(rows), np.uint64)
            for size in range(1, width - i + 1):
                h = h * _B + chars[rows, i + size - 1]
                got = self.find(h)
                if size == 1:
                    yield i, 1, rows, np.maximum(got, -1)
                else:
                    hit = got >= 0
                    if hit.any():
                        yield i, size, rows[hit], got[hit]
                more = got >= -1
                if not more.all():
                    rows, h = rows[more], h[more]
                if not len(rows):
                    break


def by_length(words: list[str], most: int = 0):
    """(places, code point matrix) for the words of each length; if ``most``,
    matrices have at most that many rows."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(size, kind="stable")
    cuts = np.flatnonzero(np.diff(size[order])) + 1
    for group in np.split(order, cuts):
        if not len(group) or not size[group[0]]:
            continue
        step = most or len(group)
        for lo in range(0, len(group), step):
            part = group[lo:lo + step]
            raw = "".join([words[k] for k in part.tolist()]).encode("utf-32-le", "surrogatepass")
            yield part, np.frombuffer(raw, np.uint32).reshape(len(part), -1)
