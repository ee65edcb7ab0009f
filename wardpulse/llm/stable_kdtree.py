"""Nearest neighbours by stable projections in kd-trees, with a chi-square stop.

Vectors are scaled to length one, so the largest cosine is the least Euclidean
distance (``d**2 = 2 - 2 cos``). A matrix of independent standard normal numbers
(a 2-stable law) projects them to a few dimensions: for any pair the squared
distance of the projections over ``d**2`` follows a chi-square law with as many
degrees of freedom. A kd-tree holds the projections. A query takes projected
neighbours outwards, leaf after leaf by the distance of the leaf's box, and
verifies each by its cosine on the original vectors. With d the distance of the
k-th best verified so far and r the projected distance reached, the search stops
when the chi-square law puts ``r**2 / d**2`` at the wanted probability: a row
nearer than d would have come before with that probability.

Distribution: the upper levels of the tree are cut at medians of a bounded sample
of projections (``SAMPLE`` rows at most, by a hash of the vector); every row is then
placed in its cell, and cells are cut into blocks of bounded size, each with its
own tree below. A query first searches the blocks of its own cell. With the k-th
distance found there it goes only to blocks of cells whose bounding box the
stopping test does not already exclude. Memory of a task is one block and a batch
of queries; the broadcast is one box for each cell, ``CELLS`` for each length.

Equal vectors are one entry that keeps its k + 1 first rows by id: no query can
return more of them. Queries with equal vectors are searched once.

The result is approximate: a neighbour is missed when its projection is much
longer than its distance, with probability 1 - ``sure`` at most. Scores and the
order of what is found are exact, ties to the smaller id.

Rows with a null id or vector, with a null or non-finite component, or with no
component other than zero take no part. Vectors meet vectors of the same length
only. Every row stands for itself, also if ids repeat: a query's own row is left
out, rows that repeat its id are not, and a repeated query gives its result twice.
An empty table gives an empty result; extra columns are left out.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from .common import arrow, land
from .vector_blocks import SLICE_ROWS, block_rows, dealt, finite, from_bytes, matrix, meet, packed, per_key, to_bytes

#: Rows of the sample that places the upper cuts, and cells at most, for each length of vector.
SAMPLE, CELLS = 16_384, 256
_LEAF = 64


def chi_square(x: float, freedom: int) -> float:
    """The chi-square distribution function for an even number of degrees."""
    term = total = 1.0
    for i in range(1, freedom // 2):
        term *= x / 2 / i
        total += term
    return 1.0 - math.exp(-x / 2) * total


def stop_ratio(sure: float, freedom: int) -> float:
    """The value of r**2 / d**2 at which the stopping test holds."""
    lo, hi = 0.0, 2.0
    while chi_square(hi, freedom) < sure:
        hi *= 2
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square(mid, freedom) < sure else (lo, mid)
    return hi


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings them near one: cosines stay the same,
    and squares of very large or small components stay finite."""
    _, power = np.frexp(np.abs(vectors).max(axis=1)) if vectors.size else (0, np.zeros(len(vectors), np.int32))
    return np.ldexp(vectors, -power[:, None])


def lengths(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors * vectors).sum(axis=1))


def projection(dim: int, to: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, to))


class Cuts:
    """The upper levels of the tree: medians of the sample on its widest axis."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth = depth
        self.axis = np.zeros((1 << depth) - 1, np.int64)
        self.at = np.zeros((1 << depth) - 1)
        held = {0: sample}
        for node in range(len(self.axis)):
            part = held.pop(node)
            if len(part):
                self.axis[node] = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
                self.at[node] = np.median(part[:, self.axis[node]])
            right = part[:, self.axis[node]] > self.at[node] if len(part) else np.zeros(0, bool)
            held[2 * node + 1], held[2 * node + 2] = part[~right], part[right]

    def cell(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        rows = np.arange(len(points))
        for _ in range(self.depth):
            node = 2 * node + 1 + (points[rows, self.axis[node]] > self.at[node])
        return node - len(self.axis)


class Tree:
    """A kd-tree over the projections of a block, and its vectors in leaf order."""

    def __init__(self, body: bytes):
        x = from_bytes(body)
        order = self._build(x["low"])
        self.low, self.vec = x["low"][order], x["vec"][order]
        self.length = lengths(self.vec)
        # first rows of each entry, flat
        size = x["size"]
        begin = np.cumsum(size) - size
        self.begin, self.size, self.id, self.row = begin[order], size[order], x["id"], x["row"]
        self.box_lo = np.array([self.low[a:b].min(axis=0) for a, b in zip(self.a, self.b)])
        self.box_hi = np.array([self.low[a:b].max(axis=0) for a, b in zip(self.a, self.b)])

    def _build(self, points: np.ndarray) -> np.ndarray:
        """Nodes as stretches ``a:b`` of the order; ``child`` is 0 at a leaf, else
        the first of two."""
        order = np.arange(len(points))
        self.a, self.b, self.child = [0], [len(points)], [0]
        node = 0
        while node < len(self.a):
            a, b = self.a[node], self.b[node]
            if b - a > _LEAF:
                part = points[order[a:b]]
                axis = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
                mid = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(part[:, axis], mid)]
                self.child[node] = len(self.a)
                self.a += [a, a + mid]
                self.b += [a + mid, b]
                self.child += [0, 0]
            node += 1
        return order

    def search(self, low: np.ndarray, vec: np.ndarray, k: int, ratio: float,
               bound: float) -> tuple[np.ndarray, np.ndarray]:
        """(entries, cosines) of the best k found; ``bound`` is a cosine that k
        others are known to reach."""
        gap = np.maximum(np.maximum(self.box_lo - low, low - self.box_hi), 0.0)
        far = (gap * gap).sum(axis=1).tolist()
        length = math.sqrt((vec * vec).sum())
        found, cosine = np.zeros(0, np.int64), np.zeros(0)
        reach = ratio * max(2.0 - 2.0 * bound, 0.0)
        heap = [(far[0], 0)]
        while heap:
            d, node = heapq.heappop(heap)
            if d > reach:                      # the stopping test holds for all that is left
                break
            child = self.child[node]
            if child:
                heapq.heappush(heap, (far[child], child))
                heapq.heappush(heap, (far[child + 1], child + 1))
                continue
            a, b = self.a[node], self.b[node]
            apart = self.low[a:b] - low
            near = a + np.flatnonzero((apart * apart).sum(axis=1) <= reach)
            if not len(near):
                continue
            # a product and a sum along each row: equal vectors get equal numbers
            score = (self.vec[near] * vec).sum(axis=1) / (self.length[near] * length)
            good = score >= bound
            found, cosine = np.concatenate([found, near[good]]), np.concatenate([cosine, score[good]])
            if len(found) >= k:
                kth = float(np.partition(cosine, len(cosine) - k)[len(cosine) - k])
                bound = max(bound, kth)
                stay = cosine >= bound
                found, cosine = found[stay], cosine[stay]
                reach = ratio * max(2.0 - 2.0 * bound, 0.0)
        return found, cosine


def _pack(part: pa.Table) -> bytes:
    part = part.combine_chunks()
    members = part.column("members").combine_chunks()
    flat = members.flatten()
    return to_bytes(vec=matrix(part.column("vec").combine_chunks(), np.float64),
                    low=matrix(part.column("low").combine_chunks(), np.float64),
                    size=np.asarray(members.value_lengths(), np.int64),
                    id=flat.field("vec_id").to_numpy(zero_copy_only=False).astype(np.int64),
                    row=flat.field("row").to_numpy(zero_copy_only=False).astype(np.int64))


def nearest(items: DataFrame, is_query: Column, k: int = 5, to: int = 12, sure: float = 0.95, seed: int = 11,
            id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each query row.
    ``is_query`` is a condition on the rows of ``items``; ``to`` is even."""
    spark = items.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    given = items.select(F.col(id_col).cast("long").alias("vec_id"), F.coalesce(is_query, F.lit(False)).alias("asks"),
                         F.col(vec_col).cast("array<double>").alias("vec"))
    rows = (given.where(F.col("vec_id").isNotNull() & finite(F.col("vec")))
            .where(F.exists("vec", lambda x: x != 0.0))
            .select(F.monotonically_increasing_id().alias("row"), "vec_id", "asks", "vec",
                    F.xxhash64(F.lit(1), "vec").alias("h1"), F.xxhash64(F.lit(2), "vec").alias("h2")))
    rows = land(rows, "vectors")
    more = k + 1

    # entries: equal vectors once, with their first rows; the window's limit works before the shuffle
    by_id = Window.partitionBy("h1", "h2").orderBy("vec_id", "row")
    entries = (rows.withColumn("place", F.row_number().over(by_id)).where(F.col("place") <= more)
               .groupBy("h1", "h2").agg(F.first("vec").alias("vec"),
                                        F.array_sort(F.collect_list(F.struct("vec_id", "row"))).alias("members"))
               .withColumn("dim", F.size("vec")))

    def project(batches):
        for batch in batches:
            col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            dims = col["dim"].to_numpy()
            for dim in np.unique(dims).tolist():
                at = pa.array(np.flatnonzero(dims == dim))
                vec = scaled(matrix(col["vec"].take(at), np.float64))
                low = (vec / lengths(vec)[:, None]) @ projection(dim, to, seed)
                lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * m.shape[1]),
                                                  pa.array(m.ravel())) for m in (vec, low)]
                yield pa.RecordBatch.from_arrays([*[col[c].take(at) for c in ("h1", "h2", "members", "dim")], *lists],
                                                 names=["h1", "h2", "members", "dim", "vec", "low"])

    entries = land(arrow(entries, project, "h1 long, h2 long, members array<struct<vec_id: long, row: long>>, "
                                           "dim int, vec array<double>, low array<double>"), "entries")

    # one row for each length of vector
    counts = {r["dim"]: r["n"] for r in entries.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return spark.createDataFrame([], schema)
    cuts = {}
    for d, n in counts.items():
        depth = min(int(math.log2(CELLS)), max(0, math.ceil(math.log2(n / block_rows(d)))))
        mix = F.xxhash64(F.lit(3), "h1", "h2")
        some = entries.where((F.col("dim") == d) & (F.pmod(mix, F.lit(max(1, n // SAMPLE))) == 0))
        some = some.orderBy(mix).limit(SAMPLE).select("low").collect() if depth else []
        cuts[d] = Cuts(np.array([r["low"] for r in some]).reshape(-1, to), depth)

    def place(batches):
        for batch in batches:
            dims = batch.column(batch.schema.get_field_index("dim")).to_numpy()
            low = matrix(batch.column(batch.schema.get_field_index("low")), np.float64)
            cell = np.zeros(len(dims), np.int32)
            for dim in np.unique(dims).tolist():
                of = dims == dim
                cell[of] = cuts[dim].cell(low[of])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=[*batch.schema.names, "cell"])

    indexed = land(arrow(entries, place, StructType([*entries.schema.fields, StructField("cell", IntegerType())])), "cells")
    ends = [f(F.col("low")[i]).alias(f"{n}{i}") for n, f in (("lo", F.min), ("hi", F.max)) for i in range(to)]
    cells = indexed.groupBy("dim", "cell").agg(F.count("*").alias("n"), *ends).collect()     # CELLS for each length
    n_blocks, boxes = {}, {}
    for r in cells:
        n_blocks[(r["dim"], r["cell"])] = -(-r["n"] // block_rows(r["dim"]))
        names, lo, hi = boxes.setdefault(r["dim"], ([], [], []))
        names.append(r["cell"])
        lo.append([r[f"lo{i}"] for i in range(to)])
        hi.append([r[f"hi{i}"] for i in range(to)])
    boxes = {d: (np.array(names), np.array(lo), np.array(hi)) for d, (names, lo, hi) in boxes.items()}
    blocks_of = per_key({f"{d}:{c}": n for (d, c), n in n_blocks.items()}, F.concat_ws(":", "dim", "cell"))
    keys = ["dim", "cell", "block"]
    placed = indexed.withColumn("block", dealt(blocks_of, "h1", "h2"))
    stored = land(packed(placed.select(*keys, "h1", "h2", "vec", "low", "members"), keys, ["h1", "h2"],
                         sum(n_blocks.values()), _pack), "trees")

    asked = rows.where("asks").select(F.col("row").alias("own"), F.col("vec_id").alias("query_id"), "h1", "h2")
    queries = indexed.join(asked.select("h1", "h2").distinct(), ["h1", "h2"], "left_semi").drop("members")
    queries = land(queries.withColumn("bound", F.lit(-1.0)), "queries")
    n_queries = queries.count()
    if not n_queries:
        return spark.createDataFrame([], schema)
    n_slices = -(-n_queries // SLICE_ROWS)
    n_cells = sum(n_blocks.values()) * n_slices
    ratio = stop_ratio(sure, to)
    trees = stored.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(n_slices - 1))))

    def look(tree: Tree, probe: pa.StructArray) -> pa.RecordBatch:
        low, vec = matrix(probe.field("low"), np.float64), matrix(probe.field("vec"), np.float64)
        bound = probe.field("bound").to_numpy(zero_copy_only=False)
        h1, h2 = probe.field("h1").to_numpy(), probe.field("h2").to_numpy()
        out: list = [[] for _ in range(5)]
        for q in range(len(low)):
            found, cosine = tree.search(low[q], vec[q], more, ratio, float(bound[q]))
            for e, c in zip(found.tolist(), cosine.tolist()):
                a, m = tree.begin[e], int(tree.size[e])
                for col, x in zip(out, ([h1[q]] * m, [h2[q]] * m, tree.id[a:a + m], tree.row[a:a + m], [c] * m)):
                    col.extend(x)
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in out[:4]], pa.array(out[4], pa.float64())],
                                          names=["h1", "h2", "vec_id", "row", "score"])

    def best(found: DataFrame) -> DataFrame:
        first = Window.partitionBy("h1", "h2").orderBy(F.desc("score"), "vec_id", "row")
        return found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= more)

    def search(probes: DataFrame, name: str) -> DataFrame:
        to_blocks = probes.select("dim", "cell", F.explode(F.sequence(F.lit(0), blocks_of - 1)).alias("block"),
                                  dealt(F.lit(n_slices), "h1", "h2").alias("slice"),
                                  F.struct("h1", "h2", "vec", "low", "bound").alias("probe"))
        found = meet(trees, to_blocks, [*keys, "slice"], n_cells, Tree, look,
                     "h1 long, h2 long, vec_id long, row long, score double")
        return land(best(found), name)

    home = search(queries, "home")
    # the cosine that k + 1 rows reach already; with fewer found there is no bound yet
    kth = home.groupBy("h1", "h2").agg(F.min("score").alias("kth"), F.count("*").alias("n"))
    known = (queries.join(kth, ["h1", "h2"], "left")
             .withColumn("bound", F.when(F.col("n") >= more, F.col("kth")).otherwise(F.lit(-1.0))).drop("kth", "n"))

    def route(batches):
        """A row for each other cell that the stopping test does not exclude."""
        for batch in batches:
            col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            dims, own = col["dim"].to_numpy(), col["cell"].to_numpy()
            low, bound = matrix(col["low"], np.float64), col["bound"].to_numpy(zero_copy_only=False)
            take, cell = [], []
            for q in range(batch.num_rows):
                names, lo, hi = boxes[int(dims[q])]
                gap = np.maximum(np.maximum(lo - low[q], low[q] - hi), 0.0)
                open_ = names[((gap * gap).sum(axis=1) <= ratio * max(2.0 - 2.0 * bound[q], 0.0)) & (names != own[q])]
                take.extend([q] * len(open_))
                cell.extend(open_.tolist())
            at = pa.array(take, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell, pa.int32()) if n == "cell" else col[n].take(at) for n in batch.schema.names],
                names=batch.schema.names)

    away = search(arrow(known, route, known.schema), "away")
    merged = best(home.drop("place").unionAll(away.drop("place")))
    lists = merged.groupBy("h1", "h2").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "row", "score")))
                                           .alias("found"))           # k + 1 entries at most
    # each query leaves its own row out and keeps k
    out = asked.join(lists, ["h1", "h2"]).select("query_id", F.expr(
        f"slice(filter(found, x -> x.row <> own), 1, {k})").alias("found"))
    return (out.select("query_id", F.posexplode("found").alias("at", "x"))
            .select("query_id", (F.col("at") + 1).alias("rank"), "x.vec_id", "x.score"))
