"""Hard negatives by vertical scans with shrinking candidate bitmaps (BOND).

Vectors become integers, ``floor(scale * x)``; a row's score against an anchor is
their inner product. The rows are cut into blocks, and each block holds one array
per dimension. For an anchor the dimensions are read by falling magnitude of the
anchor's component. After some of them a candidate's score lies between its
partial sum plus the least and plus the greatest that the unread dimensions can
add, which follow from each dimension's minimum and maximum in the block. What
can no longer reach the result leaves the bitmap; the few that stay are read to
the end, so scores are exact.

* Positives: the first rows of the anchor's own label, by falling score, then id.
  A candidate leaves when its upper end is under the k-th largest lower end.
* Negatives: rows of another label with ``low * p <= 100 * score <= high * p`` for
  the score p of one of the positives; the first few for each positive. A
  candidate leaves when no window can still hold it, or when enough others surely
  lie in each such window with a larger score.

Each block yields its own first rows; the first of those are the result. Every
anchor meets every block: anchors are a stated query set, sent to the blocks in
slices, and a task's memory holds one block and one batch of anchors.

Rows with a null id, label or vector, or with a null or non-finite component take
no part; nor do those with a component whose integer is 2**27 or more in magnitude
(scores would not fit a long). Vectors meet vectors of the same length only.
Every row stands for itself, also if its id or vector repeats: an anchor's other
rows are all rows but that one, and a repeated anchor gives its result twice. A
negative positive score has an empty window. An empty table gives an empty result;
extra columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import land
from .vector_blocks import SLICE_ROWS, block_rows, dealt, finite, from_bytes, matrix, meet, packed, per_key, to_bytes

MOST = 1 << 27


def _pack(part: pa.Table) -> bytes:
    rows = part.combine_chunks()
    vec = matrix(rows.column("vec").combine_chunks(), np.int32)
    return to_bytes(row=rows.column("row").to_numpy(), id=rows.column("vec_id").to_numpy(),
                    label=rows.column("label").to_numpy(), dims=np.ascontiguousarray(vec.T))


class Block:
    """Rows by label; ``dims[d]`` is the array of component d."""

    def __init__(self, body: bytes):
        x = from_bytes(body)
        self.row, self.id, self.label, self.dims = x["row"], x["id"], x["label"], x["dims"]
        some = self.dims.shape[1] > 0 and self.dims.shape[0] > 0
        self.least = self.dims.min(axis=1).astype(np.int64) if some else np.zeros(0, np.int64)
        self.most = self.dims.max(axis=1).astype(np.int64) if some else np.zeros(0, np.int64)

    def alike(self, label: int) -> tuple[int, int]:
        """The stretch of the rows with this label."""
        return int(np.searchsorted(self.label, label)), int(np.searchsorted(self.label, label, side="right"))

    def scan(self, anchor: np.ndarray, bitmap: np.ndarray, shrink) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of the candidates that ``shrink(partial, least, most)``
        leaves; it gets what the unread dimensions add at least and at most."""
        order = np.argsort(-np.abs(anchor), kind="stable")
        weight = anchor[order]
        ends = weight * self.least[order], weight * self.most[order]
        below = np.append(np.cumsum(np.minimum(*ends)[::-1])[::-1], 0)
        above = np.append(np.cumsum(np.maximum(*ends)[::-1])[::-1], 0)
        places = np.flatnonzero(bitmap)
        score = np.zeros(len(places), np.int64)
        whole = len(places) * 2 > len(bitmap)         # read whole columns while most rows are candidates
        if whole:
            score = np.zeros(len(bitmap), np.int64)
        n = len(order)
        for j in range(n):
            column = self.dims[order[j]]
            score += weight[j] * (column if whole else column[places])
            read = j + 1
            if read == n or (read >= n // 4 and read % 8 == 0):
                part = score[places] if whole else score
                if not len(part):
                    break
                stay = shrink(part, int(below[read]), int(above[read]))
                if stay.all() and not whole:
                    continue
                kept = places[stay]
                if whole and read < n and len(kept) * 2 > len(bitmap):
                    places = kept
                else:
                    places, score, whole = kept, part[stay], False
        return (places, score[places]) if whole else (places, score)

    def first(self, places: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
        """Which of the places come first: by falling score, id, row."""
        return np.lexsort((self.row[places], self.id[places], -score))[:k]


def nearest_alike(block: Block, anchor: np.ndarray, row: int, label: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first k other rows of the label: places and scores."""
    a, b = block.alike(label)
    bitmap = np.zeros(len(block.row), bool)
    bitmap[a:b] = block.row[a:b] != row

    def shrink(part, least, most):
        if len(part) <= k:
            return np.ones(len(part), bool)
        sure = np.partition(part, len(part) - k)[len(part) - k] + least
        return part + most >= sure

    places, score = block.scan(anchor, bitmap, shrink)
    pick = block.first(places, score, k)
    return places[pick], score[pick]


def in_windows(block: Block, anchor: np.ndarray, label: int, windows: list[tuple[int, int]],
               k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The first k rows of other labels in each window of scores (ends included)."""
    a, b = block.alike(label)
    bitmap = np.ones(len(block.row), bool)
    bitmap[a:b] = False

    def shrink(part, least, most):
        stay = np.zeros(len(part), bool)
        for lo, hi in windows:
            can = (part >= lo - most) & (part <= hi - least)
            sure = part[(part >= lo - least) & (part <= hi - most)]
            if len(sure) >= k:
                can &= part >= np.partition(sure, len(sure) - k)[len(sure) - k] + least - most
            stay |= can
        return stay

    places, score = block.scan(anchor, bitmap, shrink)
    out = []
    for lo, hi in windows:
        held = np.flatnonzero((score >= lo) & (score <= hi))
        pick = held[block.first(places[held], score[held], k)]
        out.append((places[pick], score[pick]))
    return out


def _anchors(probe: pa.StructArray):
    vec = matrix(probe.field("vec"), np.int64)
    cols = [probe.field(f).to_pylist() for f in ("row", "vec_id", "label")]
    return zip(vec, *cols)


def hard_negatives(items: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50,
                   high: int = 95, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding",
                   label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score;
    ``anchor`` is a condition on the rows of ``items``."""
    spark = items.sparkSession
    given = items.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
                         F.coalesce(anchor, F.lit(False)).alias("is_anchor"), F.col(vec_col).alias("vec"))
    whole = F.transform("vec", lambda x: F.floor(x.cast("double") * scale))
    rows = (given.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite(F.col("vec")))
            .withColumn("vec", whole).where(F.forall("vec", lambda x: (x < MOST) & (x > -MOST)))
            .select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "is_anchor",
                    F.size("vec").alias("dim"), F.col("vec").cast("array<int>").alias("vec")))
    rows = land(rows, "vectors")
    schema = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
              "negative_score long")
    # one row for each length of vector
    sizes = rows.groupBy("dim").agg(F.count("*").alias("n"), F.count_if("is_anchor").alias("a")).collect()
    sizes = [s for s in sizes if s["a"]]
    if not sizes:
        return spark.createDataFrame([], schema)
    blocks = {s["dim"]: -(-s["n"] // block_rows(s["dim"])) for s in sizes}
    slices = {s["dim"]: -(-s["a"] // SLICE_ROWS) for s in sizes}
    cells = sum(blocks[d] * slices[d] for d in blocks)
    dim = F.col("dim")

    rows = rows.where(dim.isin(list(blocks)))
    placed = rows.withColumn("block", dealt(per_key(blocks, dim), "row")).drop("is_anchor")
    stored = land(packed(placed, ["dim", "block"], ["label", "vec_id", "row"], sum(blocks.values()), _pack), "blocks")
    keys = ["dim", "block", "slice"]
    stored = stored.withColumn("slice", F.explode(F.sequence(F.lit(0), per_key(slices, dim) - 1)))

    def sent(anchors: DataFrame, *columns: str) -> DataFrame:
        """Anchors for every block of their length."""
        return anchors.select("dim", F.explode(F.sequence(F.lit(0), per_key(blocks, dim).cast("int") - 1))
                              .alias("block"), dealt(per_key(slices, dim), "row").alias("slice"),
                              F.struct("row", "vec_id", "label", "vec", *columns).alias("probe"))

    def nearest(block: Block, probe: pa.StructArray) -> pa.RecordBatch:
        out: list = [[], [], [], []]
        for vec, row, _, label in _anchors(probe):
            places, score = nearest_alike(block, vec, row, label, positives)
            for col, x in zip(out, ([row] * len(places), block.row[places], block.id[places], score)):
                col.extend(x)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out],
                                          names=["anchor", "row", "vec_id", "score"])

    anchors = rows.where("is_anchor")
    found = meet(stored, sent(anchors), keys, cells, Block, nearest,
                 "anchor long, row long, vec_id long, score long")
    best = Window.partitionBy("anchor").orderBy(F.desc("score"), "vec_id", "row")
    found = (found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives)
             .groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("place", "row", "vec_id", "score")))
                                    .alias("positives")))
    found = land(found.withColumnRenamed("anchor", "row"), "positives")      # at most `positives` entries a row

    def windowed(block: Block, probe: pa.StructArray) -> pa.RecordBatch:
        out: list = [[] for _ in range(8)]
        for (vec, row, name, label), chosen in zip(_anchors(probe), probe.field("positives").to_pylist()):
            # low * p <= 100 * n <= high * p, in integers
            ends = [(-(-low * p["score"] // 100), high * p["score"] // 100) for p in chosen]
            live = [(p, w) for p, w in zip(chosen, ends) if w[0] <= w[1]]
            if not live:
                continue
            for (p, _), (places, score) in zip(live, in_windows(block, vec, label, [w for _, w in live], negatives)):
                m = len(places)
                for col, x in zip(out, ([row] * m, [name] * m, [p["place"]] * m, [p["vec_id"]] * m,
                                        [p["score"]] * m, block.row[places], block.id[places], score)):
                    col.extend(x)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in out],
            names=["anchor", "anchor_id", "place", "positive_id", "positive_score", "row", "negative_id",
                   "negative_score"])

    fields = ["anchor", "anchor_id", "place", "positive_id", "positive_score", "row", "negative_id", "negative_score"]
    hard = meet(stored, sent(anchors.join(found, "row"), "positives"), keys, cells, Block, windowed,
                ", ".join(f"{f} long" for f in fields))
    best = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), "negative_id", "row")
    return (hard.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
