"""Periodic runs of words, tile by tile at the scale of the period.

A run is a stretch of consecutive words with smallest period q (words q apart are
identical), at least ``least`` and 2 q words long, that no neighbouring word
extends with period q.

Periods fall into octaves. For an octave a document is cut into tiles whose size
follows the octave's periods; a tile overlaps its neighbours by more than a
period, and is solved by itself. Inside, boundaries stand as close as the
octave's least period. For a boundary b, the Z-function of the words after b tells
for every period p how far they agree with the words p later, and the Z-function
of the reversed words before b how far back they do. Where both together give
``least`` and 2 p words, a fragment of a run is found, cut at the ends of the tile
or of the functions' windows. Any run holds such a boundary near its start, one
near its end and all between, and neighbouring fragments overlap by p words or
more, while different runs of period p never do. So fragments are shuffled by
(document, period) and those that overlap by p words are stitched. Of the periods
of one stretch the smallest stays.

Tiles are only made where a run can be: within a run of period p every 4-gram
(of fewer words for short runs) after the first period came before at a distance of p
at most, so an octave needs
a stretch of such places. The others need no tile, and documents without any tile
are done in the first pass. Words are compared by 64-bit fingerprints.

A null text has no words; it, an empty text and one without runs have an empty
list of runs. Every row is judged by itself, also where ids repeat or are null.
Extra columns are left out; an empty table gives an empty one. A text of any length
is one row; its tiles are spread over tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Words, arrow, fold, land, pieces_of

#: Words of a gram at most; a shorter least run takes shorter ones.
GRAM = 4
#: Words in a tile besides its overlaps, at least.
TILE = 4096
_MIX = [np.uint64(c) for c in (0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


def gram(least: int) -> int:
    """Words of a gram: a run repeats half of the least length at least."""
    return max(1, min(GRAM, (least + 1) // 2))


class Octave:
    """Periods ``lo`` to ``hi - 1``; boundaries every ``gap`` words; fragments reach
    ``back`` words before and ``on`` words after a boundary at most."""

    def __init__(self, number: int, least: int):
        self.number = number
        self.lo, self.hi = (1, 8) if number == 0 else (4 << number, 8 << number)
        # the starts of [b, b + p) inside a shortest run must span a boundary
        repeated = min(max(least, 2 * p) - p for p in (self.lo, self.hi - 1, min(max(self.lo, least // 2), self.hi - 1)))
        self.gap = repeated
        unit = max(self.hi, least)
        self.back, self.on = unit, 3 * unit
        # places of a shortest run whose gram came before
        self.need = repeated - gram(least) + 1
        self.core = -(-max(TILE, 8 * unit) // self.gap) * self.gap


def octaves(words: int, least: int) -> Iterator[Octave]:
    number = 0
    while True:
        o = Octave(number, least)
        if 2 * o.lo > words:
            return
        yield o
        number += 1


def gram_distances(hashes: np.ndarray, doc: np.ndarray, size: int = GRAM) -> np.ndarray:
    """For each word, how many words before the same gram of ``size`` words started
    last (0: never)."""
    n = len(hashes) - size + 1
    out = np.zeros(len(hashes), np.int64)
    if n < 1:
        return out
    total = doc[:n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for j in range(size):
        total += hashes[j:n + j] * _MIX[j]
    total = fold(total)
    order = np.argsort(total)
    run = total[order]
    same = np.flatnonzero(run[1:] == run[:-1])
    if not len(same):
        return out
    twice = np.zeros(n, bool)                        # places whose gram occurs again
    twice[order[same]] = twice[order[same + 1]] = True
    at = np.flatnonzero(twice & (doc[:n] == doc[size - 1:]))
    at = at[np.argsort(total[at], kind="stable")]
    back = np.zeros(len(at), np.int64)
    back[1:] = np.where(total[at[1:]] == total[at[:-1]], at[1:] - at[:-1], 0)
    out[at] = back
    return out


def regions(distance: np.ndarray, octave: Octave) -> tuple[np.ndarray, np.ndarray]:
    """(first, last + 1) of the stretches of places that a run of the octave needs."""
    near = np.zeros(len(distance) + 2, np.int8)
    near[1:-1] = (distance > 0) & (distance < octave.hi)
    step = np.diff(near)
    first, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    long = end - first >= octave.need
    return first[long], end[long]


def tiles(distance: np.ndarray, least: int) -> Iterator[tuple[Octave, int, int, int, int]]:
    """(octave, start, end, first boundary, end of boundaries) of a document's
    tiles; ``distance`` is that of its words."""
    n = len(distance)
    for o in octaves(n, least):
        spans: list[list[int]] = []
        for a, b in zip(*(x.tolist() for x in regions(distance, o))):
            a, b = max(0, a - o.hi), min(n, b + gram(least))
            if spans and a <= spans[-1][1]:
                spans[-1][1] = b
            else:
                spans.append([a, b])
        for a, b in spans:
            at = -(-a // o.gap) * o.gap
            while at < b:
                end = min(at + o.core, b)
                yield o, max(a, at - o.back), min(b, end + o.on), at, end
                at += o.core


def z_function(t: list, upto: int) -> list[int]:
    """How many items ``t[k:]`` and ``t`` agree in at their starts, for k < upto."""
    n = len(t)
    z = [0] * upto
    if upto:
        z[0] = n
    left = right = 0
    for k in range(1, upto):
        if k < right:
            m = z[k - left]
            if m < right - k:
                z[k] = m
                continue
            e = right
        else:
            e = k
        while e < n and t[e] == t[e - k]:
            e += 1
        z[k] = e - k
        left, right = k, e
    return z


def fragments(codes: list, first: int, end: int, octave: Octave, least: int) -> list[tuple[int, int, int]]:
    """(period, start, end) of the run fragments at a tile's boundaries, in places of
    the tile; those of neighbouring boundaries are stitched already."""
    n = len(codes)
    open_: dict[int, list[int]] = {}
    out = []
    for b in range(first, end, octave.gap):
        most = min(octave.hi - 1, n - b)             # [b, b + p) lies in the tile
        if most < octave.lo:
            break
        ahead = codes[b:b + octave.on]
        on = z_function(ahead, min(most + 1, len(ahead)))
        on += [0] * (most + 1 - len(on))
        before = codes[max(0, b - octave.back):b][::-1]
        # the words before b + p, reversed, begin at place most - p of the second part
        later = codes[max(0, b - octave.back):b + most][::-1]
        size = len(before)
        back = z_function([*before, -1, *later], size + 2 + most - octave.lo) if size else None
        for p in range(octave.lo, most + 1):
            behind = back[size + 1 + most - p] if size else 0
            length = behind + p + on[p]
            if length >= least and length >= 2 * p:
                s, e = b - behind, b + p + on[p]
                held = open_.get(p)
                if held and s + p <= held[1]:
                    held[1] = max(held[1], e)
                else:
                    if held:
                        out.append((p, *held))
                    open_[p] = [s, e]
    out.extend((p, *held) for p, held in open_.items())
    return out


def _kept(words: list, runs: list) -> list:
    """The words that no run holds after its first period."""
    keep = np.ones(len(words), bool)
    for r in runs:
        keep[r["start"] + r["period"]:r["start"] + r["length"]] = False
    return [words[k] for k in np.flatnonzero(keep).tolist()]


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def periodic_runs(docs: DataFrame, least: int = 12, digest: bool = False,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, runs (array of start, length, period by start, then period), and the
    ``collapsed`` text: the words that no run holds after its first period, joined by
    one blank. With ``digest`` ``collapsed`` is its SHA-256 in hexadecimal digits."""
    kind = docs.schema[id_col].dataType.simpleString()
    shape = (f"key long, doc_id {kind}, kind int, text string, octave int, at long, first long, last long, codes binary")

    def look(batches):
        """Kind 0: documents without tiles, done. Kind 1: the others' words. Kind 2: tiles."""
        for batch in batches:
            for part in pieces_of(batch, "_t", 4 << 20):
                words = Words(part.column(2), lower=False)
                hashes = words.hash()
                distance = gram_distances(hashes, words.doc, gram(least))
                cuts = words.first.tolist()
                texts = part.column(2).to_pylist()
                rows: list[tuple] = []
                for d, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                    line = b" ".join((texts[d] or "").encode("utf-8", "surrogatepass").split())
                    line = line.decode("utf-8", "surrogatepass")
                    found = list(tiles(distance[a:b], least)) if distance[a:b].any() else []
                    if not found:
                        rows.append((d, 0, _sha(line) if digest else line, None, None, None, None, None))
                        continue
                    rows.append((d, 1, line, None, None, None, None, None))
                    codes = np.unique(hashes[a:b], return_inverse=True)[1].astype("<i4")
                    rows.extend((d, 2, None, o.number, s, first, last, codes[s:e].tobytes())
                                for o, s, e, first, last in found)
                cols = list(zip(*rows)) if rows else [()] * 8
                of = pa.array(cols[0], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(of), part.column(1).take(of), pa.array(cols[1], pa.int32()),
                     pa.array(cols[2], pa.string()), pa.array(cols[3], pa.int32()),
                     *[pa.array(c, pa.int64()) for c in cols[4:7]], pa.array(cols[7], pa.binary())],
                    names=["key", "doc_id", "kind", "text", "octave", "at", "first", "last", "codes"])

    given = docs.select(F.monotonically_increasing_id().alias("key"), docs[id_col].alias("doc_id"),
                        docs[text_col].alias("_t"))
    told = land(arrow(given, look, shape), "tiles")

    def solve(batches):
        for batch in batches:
            keys, octave, at, first, last = (batch.column(i).to_pylist() for i in range(5))
            out: list = [[] for _ in range(4)]
            for r, body in enumerate(batch.column(5)):
                codes = np.frombuffer(body.as_buffer(), "<i4").tolist()
                for p, s, e in fragments(codes, first[r] - at[r], last[r] - at[r], Octave(octave[r], least), least):
                    for col, x in zip(out, (keys[r], p, at[r] + s, at[r] + e)):
                        col.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out],
                                             names=["key", "period", "start", "end"])

    # tiles of one document go to different tasks
    tile = told.where("kind = 2").select("key", "octave", "at", "first", "last", "codes")
    tile = tile.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key", "octave", "at")
    runs = stitched(arrow(tile, solve, "key long, period long, start long, end long"))
    runs = runs.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "length", "period"))).alias("runs"))

    none = F.expr("cast(array() as array<struct<start: long, length: long, period: long>>)")
    rest = (told.where("kind = 1").select("key", "doc_id", "text").join(runs, "key", "left")
            .select("doc_id", F.coalesce("runs", none).alias("runs"), "text"))

    def collapse(batches):
        for batch in batches:
            out = []
            for text, held in zip(batch.column(2).to_pylist(), batch.column(1).to_pylist()):
                line = " ".join(_kept(text.split(" "), held)) if held else text
                out.append(_sha(line) if digest else line)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())],
                                             names=["doc_id", "runs", "collapsed"])

    shape = f"doc_id {kind}, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    done = told.where("kind = 0").select("doc_id", none.alias("runs"), F.col("text").alias("collapsed"))
    return arrow(rest, collapse, shape).unionAll(done)


def stitched(pieces: DataFrame) -> DataFrame:
    """key, start, length, period of the runs whose fragments (key, period, start,
    end) are given: those of one period that overlap by the period are one."""
    order = Window.partitionBy("key", "period").orderBy("start", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    joins = (F.col("start") + F.col("period") <= reached)
    whole = (pieces.withColumn("new", F.when(joins, 0).otherwise(1))
             .withColumn("part", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
             .groupBy("key", "period", "part").agg(F.min("start").alias("start"), F.max("end").alias("end")))
    return (whole.groupBy("key", "start", "end").agg(F.min("period").alias("period"))
            .select("key", "start", (F.col("end") - F.col("start")).alias("length"), "period"))


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and text, where about a tenth of the documents become periodic: with
    h the CRC-32 of the decimal id and g = h div 10, where h is divisible by 10 each
    word i >= a becomes word a + (i - a) % p, with a = g % n and
    p = 1 + (n - a) div (3 + g % 8). A null id plants nothing."""
    words = F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    base = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).withColumn("h", h)
    chosen = base.where("h % 10 = 0 and text is not null").withColumn("w", words)
    chosen = (chosen.withColumn("n", F.size("w")).withColumn("g", F.expr("h div 10"))
              .withColumn("a", F.expr("cast(if(n > 0, g % n, 0) as int)"))
              .withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
              .withColumn("many", F.expr("cast(if(n > 0, (n - a + p - 1) div p, 0) as int)")))
    text = F.expr("array_join(slice(concat(slice(w, 1, a), flatten(array_repeat(slice(w, a + 1, p), many))), 1, n), ' ')")
    rest = base.where("not coalesce(h % 10 = 0 and text is not null, false)")
    return rest.select("doc_id", "text").unionAll(chosen.select("doc_id", text.alias("text")))


def run_columns(found: DataFrame) -> DataFrame:
    """The digest columns of a result whose ``collapsed`` is a digest already."""
    best: Column = F.expr("array_max(transform(runs, r -> struct(r.length as l, -r.start as s, -r.period as p)))")
    lines = F.expr(r"array_join(transform(runs, r -> concat(concat_ws(',', r.start, r.length, r.period), '\n')), '')")
    return (found.withColumn("_best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("_best.s")).alias("start"),
                    F.col("_best.l").alias("length"), (-F.col("_best.p")).alias("period"),
                    F.expr("(1000 * _best.l) div (-_best.p)").alias("exponent_milli"),
                    F.sha2(lines, 256).alias("runs_sha256"), F.col("collapsed").alias("collapsed_sha256")))
