"""Sampled SentencePiece encodings: Gumbel top-k without replacement.

A text's segmentations into pieces form a lattice; a piece weighs
``(1 + its rank) ** -alpha`` and a segmentation has the product of its pieces'
weights, normalised by backward sums. Each segmentation's log probability plus
an independent standard Gumbel number is its perturbed value; the k largest are
a sample without replacement. They are found by A* over prefixes: an open
node is a set of segmentations (a prefix and the choices left after it) whose
largest perturbed value is drawn before its members, top down: the chosen child
of a node inherits its value, the siblings' maximum is a Gumbel number at their
log mass, truncated at that value. Popping the best open node completes its
path by sampling and opens the nodes beside it, so paths come out in order of
their perturbed values and none comes twice.

All numbers come from mixing the seed, the row's id and the place of the draw,
so a row's samples depend on its id and text alone. No piece crosses a word's
start, nor a pair of characters that no piece holds, so lattices are built per
distinct part of a word and remembered by the worker within bounds; draws and sums
run over all parts of a few megabytes of text.

Per sample: the ids, the log probability, the perturbed value and the inclusion
score: with kappa the (k+1)-th largest perturbed value (the best open node
left), ``log(1 - exp(-exp(log_prob - kappa)))``, 0 when nothing is left.

Decoding joins the pieces (an unknown character is its UTF-8 bytes), turns word
marks into blanks and drops the one in front; a text that holds the mark
character itself decodes to a blank there, as in the library.

A null or empty text has one segmentation, the empty one (0 tokens, log
probability 0). A text with fewer than k segmentations gives all of them. Rows
with one id draw alike; a null id draws as id 0. Extra columns are left out.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import _powers, arrow, fold, pieces_of, resident
from .lattice import MARK, PieceTable, by_length

#: Lattices that a worker remembers; beyond it the half used least goes.
MEMORY = 200_000
#: Bytes of text that are drawn together: more are quicker and take more memory.
_TOGETHER = 1 << 20

_U = np.uint64


def uniform(key: np.ndarray, salt: int, place: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from a row key, a salt and a place."""
    x = fold(key + place.astype(_U) * _U(0x9E3779B97F4A7C15) + _U(salt * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF))
    return ((x >> _U(11)).astype(np.float64) + 0.5) * 2.0 ** -53


class Lattices:
    """Normalised lattices of distinct words as flat transition arrays.

    Node ``first[w] + i`` is place i of word w; its transitions are
    ``start[node]:start[node + 1]``, each with its cumulated probability, log
    probability, piece (or -1 - code point) and next node (-1 at the end).
    """

    def __init__(self, model: str, alpha: float):
        self.table = PieceTable(model)
        order = np.argsort(-self.table.score, kind="stable")
        rank = np.empty(len(order))
        rank[order] = np.arange(len(order))
        self.weight = np.append((1.0 + rank) ** -alpha, (2.0 + len(order)) ** -alpha)
        self.prints, self.number = np.zeros(0, _U), np.zeros(0, np.int64)      # by ascending fingerprint
        self.first = np.zeros(0, np.int64)
        self.start = np.zeros(1, np.int64)
        self.cum = self.logp = np.zeros(0)
        self.piece = self.next = np.zeros(0, np.int32)
        self.used = np.zeros(0)

    def forget(self):
        """Keep the half of the words that most batches used, the newer ones first;
        older uses count half from now on."""
        keep = np.sort(np.argsort(self.used, kind="stable")[len(self.used) // 2:])
        nodes = np.append(self.first, len(self.start) - 1)
        node = _stretches(nodes[keep], nodes[keep + 1])
        edge = _stretches(self.start[node], self.start[node + 1])
        count = self.start[node + 1] - self.start[node]
        size = nodes[keep + 1] - nodes[keep]
        first = np.cumsum(size) - size
        # a transition stays in its word, which moves as a whole
        moved = np.repeat(np.repeat(first - nodes[keep], size), count)
        self.next = np.where(self.next[edge] < 0, -1, self.next[edge] + moved).astype(np.int32)
        self.cum, self.logp, self.piece = self.cum[edge], self.logp[edge], self.piece[edge]
        self.start = np.append(np.cumsum(count) - count, len(edge))
        self.first, self.used = first, self.used[keep] / 2
        at = np.full(len(nodes) - 1, -1, np.int64)
        at[keep] = np.arange(len(keep))
        stay = at[self.number] >= 0
        self.prints, self.number = self.prints[stay], at[self.number[stay]]

    def learn(self, words: list[str]) -> np.ndarray:
        """Add the lattices of words, none of them empty or known yet; their numbers."""
        bases, starts, cums, logps, pieces, nexts, names = [], [], [], [], [], [], []
        node0, edge0 = len(self.start) - 1, len(self.cum)
        for places, chars in by_length(words, 20000):
            m, width = chars.shape
            edges = [(i, size, rows, piece, self.weight[piece]) for i, size, rows, piece in self.table.edges(chars)]
            # backward sums; those of long words are scaled so as not to underflow
            beta, scale = np.zeros((width + 1, m)), np.zeros((width + 1, m))
            beta[width] = 1.0
            far = width > 60
            by_start: list[list] = [[] for _ in range(width)]
            for e in edges:
                by_start[e[0]].append(e)
            flat = []
            for i in range(width - 1, -1, -1):
                top = np.full(m, -np.inf) if far else np.zeros(m)
                for _, size, rows, _, _ in by_start[i] if far else ():
                    top[rows] = np.maximum(top[rows], scale[i + size][rows])
                total = np.zeros(m)
                parts = []
                for _, size, rows, piece, w in by_start[i]:
                    part = w * beta[i + size][rows]
                    if far:
                        part *= np.exp(scale[i + size][rows] - top[rows])
                    total[rows] += part
                    parts.append((size, rows, piece, part))
                for size, rows, piece, part in parts:
                    kind = piece if size > 1 else np.where(piece >= 0, piece, -1 - chars[rows, i].astype(np.int64))
                    flat.append((rows * (width + 1) + i, np.full(len(rows), size), kind, part / total[rows]))
                beta[i], scale[i] = (1.0, top + np.log(total)) if far else (total, 0.0)
            node = np.concatenate([f[0] for f in flat])
            size = np.concatenate([f[1] for f in flat])
            kind = np.concatenate([f[2] for f in flat])
            prob = np.concatenate([f[3] for f in flat])
            order = np.argsort(node * (width + 1) + size)
            node, size, kind, prob = node[order], size[order], kind[order], prob[order]
            count = np.bincount(node, minlength=m * (width + 1))
            begin = np.cumsum(count) - count
            # sums along each node's own transitions: they depend on the word alone
            run = prob.copy()
            place = np.arange(len(prob)) - begin[node]
            later = np.flatnonzero(place > 0)
            step = 1
            while len(later):
                now = later[place[later] == step]
                run[now] += run[now - 1]
                later = later[place[later] > step]
                step += 1
            at_end = node % (width + 1) + size == width
            base = node0 + np.arange(m) * (width + 1)
            names.append(places)
            bases.append(base)
            starts.append(begin + edge0)
            cums.append(run)
            logps.append(np.log(prob))
            pieces.append(kind)
            nexts.append(np.where(at_end, -1, node0 + node + size))
            node0 += m * (width + 1)
            edge0 += len(node)
        number = np.empty(len(words), np.int64)
        number[np.concatenate(names)] = len(self.first) + np.arange(len(words))
        self.first = np.concatenate([self.first, *bases])
        self.start = np.concatenate([self.start[:-1], *starts, [edge0]])
        self.cum = np.concatenate([self.cum, *cums])
        self.logp = np.concatenate([self.logp, *logps])
        self.piece = np.concatenate([self.piece, *[x.astype(np.int32) for x in pieces]])
        self.next = np.concatenate([self.next, *[x.astype(np.int32) for x in nexts]])
        self.used = np.concatenate([self.used, np.zeros(len(words))])
        return number

    def numbers(self, text: str, chars: np.ndarray, cut: np.ndarray) -> np.ndarray:
        """The numbers of the parts ``cut[k]:cut[k + 1]`` of a text; new ones are learned."""
        prints, first, part = np.unique(_prints(chars, cut[:-1], cut[1:]), return_index=True, return_inverse=True)
        for again in (False, True):
            at = np.minimum(np.searchsorted(self.prints, prints), max(len(self.prints) - 1, 0))
            known = self.prints[at] == prints if len(self.prints) else np.zeros(len(prints), bool)
            if again or known.all() or len(self.first) + int((~known).sum()) <= MEMORY or len(self.first) < MEMORY // 4:
                break
            self.forget()
        number = np.zeros(len(prints), np.int64)
        number[known] = self.number[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            number[new] = self.learn([text[a:b] for a, b in zip(cut[first[new]].tolist(), cut[first[new] + 1].tolist())])
            where = np.searchsorted(self.prints, prints[new])
            self.prints = np.insert(self.prints, where, prints[new])
            self.number = np.insert(self.number, where, number[new])
        self.used[number] += 1
        return number[part]

    def choose(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        """The transition of each node at which its cumulated probability passes u."""
        t = self.start[node]
        last = self.start[node + 1] - 1
        live = np.flatnonzero((t < last) & (u > self.cum[t]))
        while len(live):
            t[live] += 1
            live = live[(t[live] < last[live]) & (u[live] > self.cum[t[live]])]
        return t

    def walk(self, node: np.ndarray, key: np.ndarray, salt: int, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sample from each node to its word's end: (row, transition) in row
        order. ``place`` tells the draws of one key apart."""
        rows, steps = [], []
        row = np.arange(len(node), dtype=np.int32)
        hop = 0
        while len(row):
            t = self.choose(node, uniform(key, salt, (place << _U(32)) + _U(hop)))
            rows.append(row)
            steps.append(t.astype(np.int32))
            node = self.next[t]
            go = node >= 0
            row, node, key, place = row[go], node[go], key[go], place[go]
            hop += 1
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        row, step = np.concatenate(rows), np.concatenate(steps)
        del rows, steps
        order = np.argsort(row, kind="stable")
        return row[order], step[order].astype(np.int64)


def _prints(chars: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of stretches of characters, by prefix sums of blocks."""
    out = np.zeros(len(start), _U)
    lo = 0
    while lo < len(start):
        at = start[lo]
        hi = max(lo + 1, int(np.searchsorted(end, at + (1 << 20), side="right")))
        part = chars[at:end[hi - 1]]
        up, down = _powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, _U)
        np.cumsum((part.astype(_U) + _U(1)) * up[:len(part)], out=sums[1:])
        s, e = start[lo:hi] - at, end[lo:hi] - at
        out[lo:hi] = (sums[e] - sums[s]) * down[s]
        lo = hi
    return fold(out ^ ((end - start).astype(_U) * _U(0xA24BAED4963EE407)))


def _stretches(first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The numbers of several stretches, one after the other."""
    size = end - first
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


class Paths:
    """One segmentation of each text, flat: transitions ``step`` and the word each
    belongs to (text d has ``off[d]:off[d + 1]``), running log probabilities, the
    perturbed values and those of the nodes open beside each step. ``there`` tells
    which texts have one; ``taken`` holds, for a text, the place of the path's branch
    and the choices gone there."""

    __slots__ = ("step", "word", "off", "owner", "total", "value", "open", "there", "taken")

    def __init__(self, step, word, owner, n):
        self.step, self.word, self.owner = step, word, owner
        self.off = np.searchsorted(owner, np.arange(n + 1))
        self.taken: dict[int, tuple[int, tuple]] = {}

    def best_open(self) -> tuple[np.ndarray, np.ndarray]:
        """Each text's largest open value and its place (-inf, -1 without one)."""
        n = len(self.off) - 1
        value, at = np.full(n, -np.inf), np.full(n, -1, np.int64)
        some = np.flatnonzero(self.off[1:] > self.off[:-1])
        if len(some):
            value[some] = np.maximum.reduceat(self.open, self.off[some])
            top = np.flatnonzero((self.open == value[self.owner]) & (self.open > -np.inf))
            who, first = np.unique(self.owner[top], return_index=True)
            at[who] = top[first]
        return value, at


class Path:
    """One segmentation of one text, cut out of :class:`Paths`."""

    def __init__(self, paths: Paths, d: int):
        cut = slice(paths.off[d], paths.off[d + 1])
        self.step, self.total, self.value = paths.step[cut], paths.total[cut], float(paths.value[d])


class Sampler:
    def __init__(self, model: str, alpha: float, seed: int):
        self.lat = Lattices(model, alpha)
        self.seed = seed
        table = self.lat.table
        # characters that pieces join have classes from 1 on; together[a, b]: some piece holds a before b
        pairs = {p[k:k + 2] for p in table.pieces for k in range(len(p) - 1)}
        joined = sorted({c for pair in pairs for c in pair} | {MARK})
        self.kind = np.zeros(0x110000, np.int16)
        self.kind[[ord(c) for c in joined]] = np.arange(1, len(joined) + 1)
        self.together = np.zeros((len(joined) + 1,) * 2, bool)
        for a, b in pairs:
            self.together[self.kind[ord(a)], self.kind[ord(b)]] = b != MARK or a == MARK
        known = [(int(i), p.encode()) for i, p in zip(table.ids, table.pieces)]
        known += [(int(i), bytes([b])) for b, i in enumerate(table.byte_ids)]
        size = np.zeros(1 + max(i for i, _ in known), np.int64)
        for i, raw in known:
            size[i] = len(raw)
        self._size, self._at = size, np.cumsum(size) - size
        self._bytes = np.zeros(int(size.sum()), np.uint8)
        for i, raw in known:
            self._bytes[self._at[i]:self._at[i] + len(raw)] = np.frombuffer(raw, np.uint8)

    def parts(self, texts: list) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
        """The texts with their marks as one, its characters, where its parts begin
        (and the end), and how many parts each text has. A text is cut before a mark
        that starts a word and wherever no piece can span."""
        marked = [MARK + t.replace(" ", MARK) if t else "" for t in texts]
        text = "".join(marked)
        chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = self.kind[chars]
        begin = np.ones(len(chars) + 1, bool)
        begin[1:-1] = ~self.together[kind[:-1], kind[1:]]
        del kind
        begin[-1] = True
        end = np.cumsum(np.fromiter(map(len, marked), np.int64, len(marked)))
        begin[end] = True
        cut = np.flatnonzero(begin)
        return text, chars, cut, np.diff(np.searchsorted(cut, np.concatenate([[0], end])))

    def _opened(self, paths: Paths, keys: np.ndarray, salt: int, limit: np.ndarray, at: np.ndarray, gone: np.ndarray):
        """Draw the largest values of the siblings from step ``at`` of each text on;
        ``gone`` is the probability already taken at that step besides the path's."""
        logp = self.lat.logp[paths.step]
        paths.total, paths.value = np.empty(len(logp)), limit
        for a, b in zip(paths.off[:-1].tolist(), paths.off[1:].tolist()):
            np.cumsum(logp[a:b], out=paths.total[a:b])          # each text's sums depend on it alone
        place = np.arange(len(logp)) - paths.off[paths.owner]
        prob = np.exp(logp)
        branch = np.flatnonzero(place == at[paths.owner])
        prob[branch] += gone[paths.owner[branch]]
        left = np.maximum(1.0 - prob, 0.0)
        # a node whose choices are all taken is closed (its rest is rounding)
        live = np.flatnonzero((left >= 1e-12) & (place >= at[paths.owner]))
        who = paths.owner[live]
        u = uniform(keys[who], salt, place[live])
        g = paths.total[live] - logp[live] + np.log(left[live]) - np.log(-np.log(u))
        paths.open = np.full(len(logp), -np.inf)
        paths.open[live] = -np.logaddexp(-limit[who], -g)

    def draw(self, texts: list, keys: np.ndarray, k: int) -> tuple[list[Paths], np.ndarray]:
        """Up to k segmentations of each text, best first, and kappa."""
        lat = self.lat
        text, chars, cut, count = self.parts(texts)
        flat = lat.numbers(text, chars, cut) if len(chars) else np.zeros(0, np.int64)
        del text, chars, cut                        # batches are large: let go what is not needed any more
        n = len(texts)
        owner = np.repeat(np.arange(n), count)
        place = (np.arange(len(flat)) - np.repeat(np.cumsum(count) - count, count)).astype(_U)
        keys = fold(keys.astype(np.int64).view(_U) + _U(self.seed * 0xA0761D6478BD642F & 0xFFFFFFFFFFFFFFFF))
        row, step = lat.walk(lat.first[flat], keys[owner], 1, place)
        first = Paths(step, place[row].astype(np.int64), owner[row], n)
        del row, step
        first.there = np.ones(n, bool)
        none = np.zeros(n)
        self._opened(first, keys, 3, -np.log(-np.log(uniform(keys, 2, np.zeros(n, _U)))), none.astype(np.int64), none)
        out = [first]
        while len(out) < k and out[-1].there.any():
            out.append(self._next(out, flat, owner, place, keys))
        kappa = np.max([p.best_open()[0] for p in out], axis=0) if n else np.zeros(0)
        return out, kappa

    def _next(self, out: list[Paths], flat: np.ndarray, owner: np.ndarray, place: np.ndarray, keys: np.ndarray) -> Paths:
        """Pop each text's best open node and complete it; one walk for all."""
        lat, r, n = self.lat, len(out), len(keys)
        value, at, of = np.full(n, -np.inf), np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        for b, p in enumerate(out):
            v, a = p.best_open()
            better = v > value
            value[better], at[better], of[better] = v[better], a[better], b
        todo = np.flatnonzero(of >= 0)
        draws = uniform(keys, 10 + 4 * r, np.zeros(n, _U))
        new, word, branch, gone, taken = (np.zeros(n, np.int64), np.full(n, -1, np.int64), np.zeros(n, np.int64),
                                          np.zeros(n), {})
        for d in todo.tolist():
            best, i = out[of[d]], int(at[d])
            best.open[i] = -np.inf
            first, branch[d] = int(best.step[i]), i - best.off[d]
            held = best.taken.get(d)
            left = (held[1] if held and held[0] == branch[d] else ()) + (first,)
            # a path's own branch remembers what went there before; any place popped remembers the path's step
            node = int(np.searchsorted(lat.start, first, side="right")) - 1
            lo, hi = int(lat.start[node]), int(lat.start[node + 1])
            prob = np.exp(lat.logp[lo:hi])
            gone[d] = prob[[t - lo for t in left]].sum()
            prob[[t - lo for t in left]] = 0.0
            run = np.cumsum(prob)
            new[d] = lo + min(int(np.searchsorted(run, draws[d] * run[-1])), int(np.flatnonzero(prob)[-1]))
            word[d] = best.word[i]
            taken[d] = (int(branch[d]), left)
        # the words after the branch, and the rest of the branch's own word before them
        inner = todo[lat.next[new[todo]] >= 0]
        rest = np.flatnonzero((of >= 0)[owner] & (place.astype(np.int64) > word[owner]))
        who = np.concatenate([inner, owner[rest]])
        order = np.argsort(who, kind="stable")
        node = np.concatenate([lat.next[new[inner]].astype(np.int64), lat.first[flat[rest]]])[order]
        where = np.concatenate([word[inner], place[rest].astype(np.int64)])[order]
        who = who[order]
        row, step = lat.walk(node, keys[who], 11 + 4 * r, where.astype(_U))
        # the new path: the old one up to the branch, the new choice, what was walked
        steps, words, owners = [], [], []
        for b, p in enumerate(out):
            head = np.flatnonzero((of == b)[p.owner] & (np.arange(len(p.step)) - p.off[p.owner] < branch[p.owner]))
            steps.append(p.step[head])
            words.append(p.word[head])
            owners.append(p.owner[head])
        steps += [new[todo], step]
        words += [word[todo], where[row]]
        owners += [todo, who[row]]
        order = np.argsort(np.concatenate(owners), kind="stable")
        path = Paths(np.concatenate(steps)[order], np.concatenate(words)[order], np.concatenate(owners)[order], n)
        path.taken = taken
        path.there = of >= 0
        self._opened(path, keys, 12 + 4 * r, value, branch, gone)
        return path

    def sample(self, texts: list, keys: np.ndarray, k: int) -> tuple[list[list[Path]], np.ndarray]:
        """For each text a list of paths (best first) and kappa."""
        out, kappa = self.draw(texts, keys, k)
        return [[Path(p, d) for p in out if p.there[d]] for d in range(len(texts))], kappa

    def ids(self, paths: Paths) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts' paths, and where each text's begin (n + 1 numbers)."""
        table, piece = self.lat.table, self.lat.piece[paths.step]
        ids = table.ids[np.maximum(piece, 0)]
        odd = np.flatnonzero(piece < 0)
        if not len(odd):
            return ids.astype(np.int32), paths.off
        # an unknown character stands as its bytes
        raw = [chr(-1 - c).encode("utf-8", "surrogatepass") for c in piece[odd].tolist()]
        size = np.ones(len(piece), np.int64)
        size[odd] = [len(x) for x in raw]
        at = np.concatenate([[0], np.cumsum(size)])
        out = np.empty(at[-1], np.int64)
        plain = piece >= 0
        out[at[:-1][plain]] = ids[plain]
        out[_stretches(at[odd], at[odd + 1])] = table.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        return out.astype(np.int32), at[paths.off]

    def decode_all(self, ids: np.ndarray, off: np.ndarray) -> list[str]:
        """The texts of several id lists, from the vocabulary alone."""
        size = self._size[ids]
        raw = self._bytes[_stretches(self._at[ids], self._at[ids] + size)].tobytes()
        at = np.concatenate([[0], np.cumsum(size)])[off].tolist()
        texts = (raw[a:b].decode("utf-8", "surrogatepass").replace(MARK, " ") for a, b in zip(at[:-1], at[1:]))
        return [t[1:] if t else t for t in texts]

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_all(np.asarray(ids), np.array([0, len(ids)]))[0]


def sample_segmentations(docs: DataFrame, k: int = 2, alpha: float = 1.0, seed: int = 7,
                         model: str = "piece_bpe_32k.model", digest: bool = False,
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Up to k rows per document, ``sample`` 0 to k - 1 by falling perturbed value:
    doc_id, sample, n_tokens, log_prob, perturbed, log_inclusion, round_trip (the
    decoded ids give the text) and ``ids``, or with ``digest`` their CRC-32 as
    little-endian 32-bit integers (``ids_crc32``)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        sampler = resident(("gumbel_pieces", model, alpha, seed), lambda: Sampler(model, alpha, seed))
        for batch in batches:
            for part in pieces_of(batch, "_t", _TOGETHER):
                texts = part.column(1).to_pylist()
                keys = part.column(0).cast(pa.int64()).fill_null(0).to_numpy()
                out, kappa = sampler.draw(texts, keys, k)
                want = [(t or "").replace(MARK, " ") for t in texts]
                rows = []
                for r, paths in enumerate(out):
                    ids, off = sampler.ids(paths)
                    decoded = sampler.decode_all(ids, off)
                    raw = ids.astype("<i4")
                    for d in np.flatnonzero(paths.there).tolist():
                        mine = raw[off[d]:off[d + 1]]
                        phi = float(paths.total[paths.off[d + 1] - 1]) if paths.off[d + 1] > paths.off[d] else 0.0
                        x = phi - kappa[d]
                        # log(1 - exp(-exp(x))), for small exp(x) nearly x
                        score = x if x < -30 else float(np.log(-np.expm1(-np.exp(min(x, 50.0)))))
                        rows.append((d, r, len(mine), phi, float(paths.value[d]), score, decoded[d] == want[d],
                                     zlib.crc32(mine.tobytes()) if digest else mine))
                rows.sort(key=lambda x: x[:2])
                cols = list(zip(*rows)) if rows else [()] * 8
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32()),
                     pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.float64()), pa.array(cols[4], pa.float64()),
                     pa.array(cols[5], pa.float64()), pa.array(cols[6], pa.bool_()),
                     pa.array(cols[7], pa.int64() if digest else pa.list_(pa.int32()))],
                    names=["doc_id", "sample", "n_tokens", "log_prob", "perturbed", "log_inclusion", "round_trip",
                           "ids_crc32" if digest else "ids"])

    last = "ids_crc32 long" if digest else "ids array<int>"
    return arrow(docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("_t")), run,
                 f"doc_id {kind}, sample int, n_tokens long, log_prob double, perturbed double, "
                 f"log_inclusion double, round_trip boolean, {last}")
