"""Spatial joins: a clipped-edge cell index for polygons, pyramids of cells for
nearest points.

Polygons are cut by a grid (cell size in degrees). A cell that lies wholly inside
a polygon says so and needs no test; a cell at its boundary carries the few edges
that a ray from inside the cell can cross, and whether an odd number of edges
farther right is crossed by every such ray. No cell holds a ring. Points join the
index on (cx, cy) -- an equi-join, so Spark picks a broadcast hash join when the
index is small (AQE checks the runtime size) and a sort-merge join with skew
splitting otherwise. Exact tests then run with higher-order functions on what the
cell carries: one row per point in, no pair explosion, no Python.

Nearest points are found by branch and bound on pairs of cells, of the rows and of
the target points, level by level: see :func:`nearest_point`.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardpulse.functions import geo
from wardpulse.session import checkpoint_dir

DEFAULT_CELL_DEG = 0.01
#: Rounding margin of cell borders, as a share of the cell.
_MARGIN = 1e-9


def _cell(v: Column, cell: float) -> Column:
    return F.floor(v / F.lit(cell)).cast("bigint")


def _cells(lo: Column, hi: Column, cell: float) -> Column:
    """The numbers of the cells that a stretch touches, margins included."""
    e = cell * _MARGIN
    return F.sequence(_cell(lo - e, cell), _cell(hi + e, cell))


def _edges_of(polys: DataFrame, id_col: str, carry: tuple[str, ...]) -> DataFrame:
    """A row (poly, who, e) per ring edge; ``poly`` numbers the polygons, as ids
    may repeat."""
    who = F.struct(F.col(id_col).alias("id"), *[F.col(c) for c in carry]).alias("who")
    # numbered first: in one step with the explode each edge would get a number
    numbered = polys.select(F.monotonically_increasing_id().alias("poly"), who, geo.ring_edges(F.col("rings")).alias("es"))
    return numbered.select("poly", "who", F.explode("es").alias("e"))


def cell_index(polys: DataFrame, cell: float = DEFAULT_CELL_DEG, id_col: str = "ward_id",
               carry: tuple[str, ...] = ("ward_name",)) -> DataFrame:
    """(cx, cy) -> ``inside``, an array of (who, whole, flip, edges) for the polygons
    that meet the cell. Its size grows with the cells polygons cover and with their
    edges in the rows of boundary cells, not with points."""
    e = cell * _MARGIN
    edge = F.col("e")
    lo_x, hi_x = F.least("e.ax", "e.bx"), F.greatest("e.ax", "e.bx")
    # the edges of a polygon in one row of cells
    rows = (_edges_of(polys, id_col, carry)
            .select("poly", "who", edge, F.explode(_cells(F.least("e.ay", "e.by"), F.greatest("e.ay", "e.by"), cell))
                    .alias("cy"))
            .groupBy("poly", "cy").agg(F.first("who").alias("who"), F.collect_list("e").alias("row"),
                                       F.min(lo_x).alias("min_x"), F.max(hi_x).alias("max_x")))
    x0, x1 = F.col("cx") * cell - e, (F.col("cx") + 1) * cell + e
    y0, y1 = F.col("cy") * cell - e, (F.col("cy") + 1) * cell + e
    right = F.filter("row", lambda s: F.greatest(s["ax"], s["bx"]) >= x0)

    def beyond(s: Column) -> Column:
        """Right of the cell and crossed by the ray from any of its points."""
        return ((F.least(s["ax"], s["bx"]) > x1) & (F.least(s["ay"], s["by"]) <= y0)
                & (F.greatest(s["ay"], s["by"]) >= y1))

    cells = (rows.select("who", "row", "cy", F.explode(_cells(F.col("min_x"), F.col("max_x"), cell)).alias("cx"))
             .withColumn("right", right)
             .withColumn("touched", F.exists("right", lambda s: F.least(s["ax"], s["bx"]) <= x1))
             .withColumn("flip", F.size(F.filter("right", beyond)) % 2 == 1)
             .withColumn("edges", F.filter("right", lambda s: ~beyond(s)))
             .withColumn("whole", ~F.col("touched") & geo.odd_crossings(
                 F.col("flip"), F.col("edges"), (F.col("cx") + 0.5) * cell, (F.col("cy") + 0.5) * cell))
             .where("touched or whole"))
    held = F.struct("who", "whole", "flip", F.when(F.col("touched"), F.col("edges"))
                    .otherwise(F.slice("edges", F.lit(1), F.lit(0))).alias("edges"))
    return cells.groupBy("cx", "cy").agg(F.collect_list(held).alias("inside"))


def near_index(polys: DataFrame, cell: float, grow_km: float, id_col: str = "ward_id",
               carry: tuple[str, ...] = ("ward_name",)) -> DataFrame:
    """(cx, cy) -> ``near``, an array of (who, edges): the polygons with an edge whose
    box, grown by ``grow_km``, touches the cell, with these edges only."""
    gy = grow_km / geo.KM_PER_DEG
    far = F.least(F.greatest(F.abs(F.col("e.ay")), F.abs(F.col("e.by"))) + gy, F.lit(89.0))
    gx = F.lit(grow_km) / (F.lit(geo.KM_PER_DEG) * F.cos(F.radians(far)))
    lo_x, hi_x = F.least("e.ax", "e.bx"), F.greatest("e.ax", "e.bx")
    lo_y, hi_y = F.least("e.ay", "e.by"), F.greatest("e.ay", "e.by")
    return (_edges_of(polys, id_col, carry)
            .select("poly", "who", "e", F.explode(_cells(lo_x - gx, hi_x + gx, cell)).alias("cx"),
                    _cells(lo_y - gy, hi_y + gy, cell).alias("_cys"))
            .select("poly", "who", "e", "cx", F.explode("_cys").alias("cy"))
            .groupBy("cx", "cy", "poly").agg(F.first("who").alias("who"), F.collect_list("e").alias("edges"))
            .groupBy("cx", "cy").agg(F.collect_list(F.struct("who", "edges")).alias("near")))


def _join_index(points: DataFrame, index: DataFrame, x: str, y: str, cell: float) -> DataFrame:
    p = points.withColumn("_cx", _cell(F.col(x), cell)).withColumn("_cy", _cell(F.col(y), cell))
    # a plain equi-join on the cell: its runtime size tells AQE whether to broadcast
    # the index or to split hot cells
    idx = index.withColumnRenamed("cx", "_cx").withColumnRenamed("cy", "_cy")
    return p.join(idx, ["_cx", "_cy"], "left").drop("_cx", "_cy")


def _inside(x: Column, y: Column) -> Column:
    """The entries of ``inside`` whose polygon contains the point."""
    return F.filter(F.coalesce(F.col("inside"), F.array()), lambda c: c["whole"] | (
        geo.odd_crossings(c["flip"], c["edges"], x, y) & ~geo.on_edges(c["edges"], x, y)))


def points_in_polygons(points: DataFrame, polys: DataFrame, x: str = "longitude",
                       y: str = "latitude", cell: float = DEFAULT_CELL_DEG,
                       how: str = "left", id_col: str = "ward_id",
                       carry: tuple[str, ...] = ("ward_name",)) -> DataFrame:
    """J-6 ``points JOIN polys ON ST_Contains(geom, point)``: one output row per
    (point, containing polygon); with ``how='left'`` a point in no polygon
    keeps one row with NULL polygon columns. Points with NULL x/y never match."""
    joined = _join_index(points, cell_index(polys, cell, id_col, carry), x, y, cell)
    # outer for both: a plain explode would first test each point's candidates once more, for their number
    out = joined.withColumn("_hit", F.explode_outer(_inside(F.col(x), F.col(y)))).drop("inside")
    if how != "left":
        out = out.where("_hit is not null")
    return out.select(*[c for c in out.columns if c != "_hit"],
                      F.col("_hit.who.id").alias(id_col), *[F.col(f"_hit.who.{c}").alias(c) for c in carry])


def locate_points(points: DataFrame, polys: DataFrame, x: str = "longitude",
                  y: str = "latitude", cell: float = DEFAULT_CELL_DEG,
                  snap_km: float | None = 0.5, id_col: str = "ward_id",
                  carry: tuple[str, ...] = ("ward_name",)) -> DataFrame:
    """J-14/J-15 one ward per point: the containing ward with the lowest id;
    else (``snap_km``) the nearest ward within that distance, ties to the lowest
    id; else NULL. Adds ``ward_id``, carried columns and ``match``
    ('contains' / 'nearest' / NULL) and ``distance_km``."""
    X, Y = F.col(x), F.col(y)
    joined = _join_index(points, cell_index(polys, cell, id_col, carry), x, y, cell)
    best_in = F.array_min(F.transform(_inside(X, Y), lambda c: F.struct(c["who"]["id"].alias("k"), c["who"].alias("c"))))
    res = joined.withColumn("_in", best_in).drop("inside")
    if snap_km:
        res = _join_index(res, near_index(polys, cell, snap_km, id_col, carry), x, y, cell)
        near = F.transform(F.coalesce(F.col("near"), F.array()), lambda c: F.struct(
            geo.edges_distance_km(c["edges"], X, Y).alias("d"), c["who"]["id"].alias("k"), c["who"].alias("c")))
        best_near = F.array_min(F.filter(near, lambda s: s["d"] <= F.lit(snap_km)))
        res = res.withColumn("_near", F.when(F.col("_in").isNull(), best_near)).drop("near")
    else:
        nothing = ("cast(null as struct<d: double, k: bigint, c: struct<" +
                   ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in res.schema["_in"].dataType["c"].dataType)
                   + ">>)")
        res = res.withColumn("_near", F.expr(nothing))
    pick = F.coalesce(F.col("_in.c"), F.col("_near.c"))
    return res.select(*[c for c in res.columns if c not in ("_in", "_near")],
                      pick["id"].alias(id_col), *[pick[c].alias(c) for c in carry],
                      F.when(F.col("_in").isNotNull(), F.lit("contains"))
                       .when(F.col("_near").isNotNull(), F.lit("nearest")).alias("match"),
                      F.when(F.col("_in").isNotNull(), F.lit(0.0))
                       .otherwise(F.col("_near.d")).alias("distance_km"))


# ------------------------------------------------------------------ nearest points

#: The pyramid: cells of the first level (degrees), children of a cell along one side,
#: and the most points that a left cell may still meet to be divided no more.
TOP, FAN, HELD = 22.5, 4, 16
#: Right cells of the level that the search starts at, and targets that need no search.
FIRST, FEW = 64, 256
#: Points of a left cell that come to its rows together.
CHUNK = 64


def _widest(a: Column, b: Column) -> Column:
    """The greatest cosine of a latitude between two."""
    return F.when((a <= 0) & (b >= 0), F.lit(1.0)).otherwise(
        F.cos(F.radians(F.least(F.least(F.abs(a), F.abs(b)), F.lit(90.0)))))


def haversine_below(extent: tuple[str, str, str, str]):
    """A lower bound (km) of the great-circle distance from a left extent to
    any point of a box, also across the 180th meridian."""
    min_x, min_y, max_x, max_y = (F.col(c) for c in extent)

    def below(box: Column) -> Column:
        lat = F.greatest(F.lit(0.0), box["y0"] - max_y, min_y - box["y1"])
        lon = F.least(*[F.greatest(F.lit(0.0), box["x0"] + turn - max_x, min_x - box["x1"] - turn)
                        for turn in (-360.0, 0.0, 360.0)])
        narrow = lambda a, b: F.cos(F.radians(F.least(F.greatest(F.abs(a), F.abs(b)), F.lit(90.0))))
        h = (F.pow(F.sin(F.radians(F.least(lat, F.lit(180.0))) / 2), 2)
             + narrow(min_y, max_y) * narrow(box["y0"], box["y1"])
             * F.pow(F.sin(F.radians(F.least(lon, F.lit(180.0))) / 2), 2))
        return 2 * geo.EARTH_RADIUS_KM * F.asin(F.sqrt(F.greatest(F.lit(0.0), F.least(F.lit(1.0), h)))) * (1 - 1e-9)

    return below


def haversine_above(extent: tuple[str, str, str, str]):
    """An upper bound (km) of the great-circle distance from any place of a left
    extent to a point (x, y)."""
    min_x, min_y, max_x, max_y = (F.col(c) for c in extent)

    def above(p: Column) -> Column:
        lat = F.greatest(F.abs(p["y"] - min_y), F.abs(p["y"] - max_y))
        lon = F.least(F.lit(180.0), *[F.greatest(F.abs(p["x"] + turn - min_x), F.abs(p["x"] + turn - max_x))
                                      for turn in (-360.0, 0.0, 360.0)])
        h = (F.pow(F.sin(F.radians(F.least(lat, F.lit(180.0))) / 2), 2)
             + _widest(min_y, max_y) * F.cos(F.radians(F.least(F.abs(p["y"]), F.lit(90.0))))
             * F.pow(F.sin(F.radians(lon) / 2), 2))
        return 2 * geo.EARTH_RADIUS_KM * F.asin(F.sqrt(F.greatest(F.lit(0.0), F.least(F.lit(1.0), h)))) * (1 + 1e-9) + 1e-9

    return above


def plane_below(extent: tuple[str, str, str, str]):
    """The same bound for the local equirectangular distance of G-4."""
    min_x, min_y, max_x, max_y = (F.col(c) for c in extent)

    def below(box: Column) -> Column:
        lat = F.greatest(F.lit(0.0), box["y0"] - max_y, min_y - box["y1"])
        lon = F.greatest(F.lit(0.0), box["x0"] - max_x, min_x - box["x1"])
        narrow = F.cos(F.radians(F.least(F.greatest(F.abs(box["y0"]), F.abs(box["y1"])), F.lit(90.0))))
        return F.sqrt(lat * lat + lon * lon * narrow * narrow) * geo.KM_PER_DEG * (1 - 1e-9)

    return below


def plane_above(extent: tuple[str, str, str, str]):
    """And the upper one."""
    min_x, min_y, max_x, max_y = (F.col(c) for c in extent)

    def above(p: Column) -> Column:
        lat = F.greatest(F.abs(p["y"] - min_y), F.abs(p["y"] - max_y))
        lon = F.greatest(F.abs(p["x"] - min_x), F.abs(p["x"] - max_x)) * F.cos(F.radians(p["y"]))
        return F.sqrt(lat * lat + lon * lon) * geo.KM_PER_DEG * (1 + 1e-9) + 1e-9

    return above


#: The bounds of a distance, each made for the four columns of an extent.
HAVERSINE, PLANE = (haversine_below, haversine_above), (plane_below, plane_above)


def _up(c: str, level: int, fine: int) -> Column:
    """The number of a finest cell's ancestor on a level."""
    return F.floor(F.col(c) / float(FAN ** (fine - level))).cast("bigint")


def nearest_point(left: DataFrame, right: DataFrame, key: str, *, x: str = "longitude",
                  y: str = "latitude", rx: str = "longitude", ry: str = "latitude",
                  extent: tuple[str, str, str, str] | None = None, cell: float = 0.005,
                  dist=None, bounds=HAVERSINE, out: str = "nearest_km", work: str | None = None) -> DataFrame:
    """Exact distance from every ``left`` row to its nearest ``right`` point (J-13, G-5).

    Branch and bound on two pyramids of cells, one over the left rows and one over
    the distinct right points, from cells of ``TOP`` degrees down to about ``cell``.
    The search works on pairs of a left and a right cell. The least upper bound of
    the distance from the left cell's box to a point of a right cell is the bound of
    the left cell; pairs whose lower bound is above it go. A left cell whose remaining
    right cells hold ``HELD`` points at most is done; the pairs of the others are
    divided, down to the finest level. Rows meet only the points that remain for their
    cell, ``CHUNK`` at a time. A pair is one narrow row, so what is shuffled grows with
    the left cells, not with rows times points.

    One aggregate over the right points tells which level the search starts at: the
    finest with ``FIRST`` cells at most. With ``FEW`` targets at most they come to
    every row as one value, without a join or shuffle of the left rows. The finest
    cells of both sides and the pairs of each level are checkpointed, as they are read
    more than once; the search ends at the level where every left cell is done.

    ``extent`` (min_x, min_y, max_x, max_y) defaults to the point (x, y). ``dist(px,
    py)`` is a column expression over the left row's columns, by default haversine km
    from (x, y); ``bounds`` are its lower and upper bound. Every left row gives one
    row, also where ``key`` repeats; it is NULL when ``right`` is empty or the row has
    no place. ``work`` names a column for the number of cells and points looked at.
    """
    extent = extent or (x, y, x, y)
    dist = dist or (lambda px, py: geo.haversine_km(F.col(x), F.col(y), px, py))
    fine = max(0, math.ceil(math.log(TOP / cell, FAN)))
    size = TOP / FAN ** fine
    spark = left.sparkSession
    checkpoint_dir(spark)
    # the finest right cells with all their points are never gathered: points stay rows
    points = (right.where(F.col(rx).isNotNull() & F.col(ry).isNotNull())
              .select(F.col(rx).cast("double").alias("px"), F.col(ry).cast("double").alias("py")).distinct()
              .withColumn("cx", _cell(F.col("px"), size)).withColumn("cy", _cell(F.col("py"), size)).checkpoint())
    p = F.struct(F.col("px").alias("x"), F.col("py").alias("y"))
    told = points.agg(F.count(F.lit(1)).alias("n"), *[F.approx_count_distinct(F.struct(_up("cx", i, fine), _up("cy", i, fine)))
                                                      .alias(f"l{i}") for i in range(fine + 1)]).first()
    if not told["n"]:
        return left.withColumn(out, F.lit(None).cast("double")).select("*", *([F.lit(0).cast("bigint").alias(work)] if work else []))
    columns = left.columns
    placed = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in extent])
    if told["n"] <= FEW:                   # the row alone is enough
        targets = points.select(F.collect_list(p)).scalar()
        below, above = (b(extent) for b in bounds)
        rows = left.select(F.struct(*columns).alias("_left"), *columns, F.when(placed, targets).alias("_targets"))
        rows = rows.withColumn("_bound", F.array_min(F.transform("_targets", above)))
        box = lambda t: {"x0": t["x"], "x1": t["x"], "y0": t["y"], "y1": t["y"]}
        rows = rows.withColumn("_near", F.filter("_targets", lambda t: below(box(t)) <= F.col("_bound")))
        rows = rows.withColumn("_best", F.array_min(F.transform("_near", lambda t: dist(t["x"], t["y"]))))
        extra = [F.coalesce(F.size("_targets") + F.size("_near"), F.lit(0)).cast("bigint").alias(work)] if work else []
        return rows.select(*[F.col("_left")[c].alias(c) for c in columns], F.col("_best").alias(out), *extra)
    first = max((i for i in range(fine + 1) if told[f"l{i}"] <= FIRST), default=0)

    def right_cells(level: int) -> DataFrame:
        return points.groupBy(_up("cx", level, fine).alias("rx"), _up("cy", level, fine).alias("ry")).agg(
            F.count(F.lit(1)).alias("n"), F.struct(F.min("px").alias("x0"), F.min("py").alias("y0"), F.max("px").alias("x1"),
                                                   F.max("py").alias("y1")).alias("box"), F.min(p).alias("one"))

    # a row's cell is that of its extent's middle; rows without a place get many different ones that no cell has
    middle = lambda a, b: _cell((F.col(a) + F.col(b)) / 2, size)
    nowhere = F.lit(-(1 << 40)) - F.pmod("_row", F.lit(1 << 16))
    rows = (left.select(F.monotonically_increasing_id().alias("_row"), F.struct(*columns).alias("_left"), *columns)
            .withColumn("_tx", F.when(placed, middle(extent[0], extent[2])).otherwise(nowhere))
            .withColumn("_ty", F.when(placed, middle(extent[1], extent[3])).otherwise(nowhere)))
    least, most = (lambda f, c: f(F.col(c).cast("double"))), ("_x0", "_y0", "_x1", "_y1")
    tiles = (left.where(placed).groupBy(middle(extent[0], extent[2]).alias("_tx"), middle(extent[1], extent[3]).alias("_ty"))
             .agg(least(F.min, extent[0]).alias("_x0"), least(F.min, extent[1]).alias("_y0"), least(F.max, extent[2]).alias("_x1"),
                  least(F.max, extent[3]).alias("_y1")).checkpoint())

    def left_cells(level: int) -> DataFrame:
        return tiles.groupBy(_up("_tx", level, fine).alias("lx"), _up("_ty", level, fine).alias("ly")).agg(
            F.min("_x0").alias("_x0"), F.min("_y0").alias("_y0"), F.max("_x1").alias("_x1"), F.max("_y1").alias("_y1"))

    below, above = (b(most) for b in bounds)
    of_left = Window.partitionBy("lx", "ly")

    def judged(pairs: DataFrame) -> DataFrame:
        """The pairs that can hold a row's nearest point, and what the left cell has
        cost and still holds."""
        seen = pairs.withColumn("lo", below(F.col("box"))).withColumn("hi", above(F.col("one")))
        seen = (seen.withColumn("best", F.min("hi").over(of_left))
                .withColumn("cost", F.col("cost") + F.count(F.lit(1)).over(of_left)).where("lo <= best"))
        return seen.withColumn("left_n", F.sum("n").over(of_left)).select("lx", "ly", "rx", "ry", "cost", "left_n").checkpoint()

    pairs = judged(left_cells(first).crossJoin(F.broadcast(right_cells(first))).withColumn("cost", F.lit(0).cast("bigint")))
    parent = lambda c: F.floor(F.col(c) / float(FAN)).cast("bigint")
    found = None
    for level in range(first, fine + 1):
        done = pairs if level == fine else pairs.where(F.col("left_n") <= HELD)
        own = points.select(_up("cx", level, fine).alias("rx"), _up("cy", level, fine).alias("ry"), p.alias("p"))
        part = F.pmod(F.xxhash64("p"), F.ceil(F.col("left_n") / CHUNK).cast("bigint"))
        held = (done.join(own, ["rx", "ry"]).groupBy(F.lit(level).alias("level"), "lx", "ly", part.alias("part"))
                .agg(F.collect_list("p").alias("_held"), F.max("cost").alias("_cost")))
        found = held if found is None else found.unionAll(held)
        if level == fine or pairs.where(F.col("left_n") > HELD).isEmpty():
            break
        open_ = pairs.where(F.col("left_n") > HELD).select(F.col("lx").alias("_plx"), F.col("ly").alias("_ply"),
                                                          F.col("rx").alias("_prx"), F.col("ry").alias("_pry"), "cost")
        ls = left_cells(level + 1).withColumn("_plx", parent("lx")).withColumn("_ply", parent("ly"))
        rs = right_cells(level + 1).withColumn("_prx", parent("rx")).withColumn("_pry", parent("ry"))
        pairs = judged(open_.join(ls, ["_plx", "_ply"]).join(rs, ["_prx", "_pry"]))
    # from a done left cell to its finest cells, then to their rows
    ways = F.array(*[F.struct(F.lit(i).alias("level"), _up("_tx", i, fine).alias("lx"), _up("_ty", i, fine).alias("ly"))
                     for i in range(first, level + 1)])
    by_tile = (tiles.select("_tx", "_ty", F.explode(ways).alias("w")).select("_tx", "_ty", "w.*")
               .join(found, ["level", "lx", "ly"]).select("_tx", "_ty", "_held", "_cost"))
    met = rows.join(by_tile, ["_tx", "_ty"], "left").select(
        "_row", "_left", F.array_min(F.transform("_held", lambda t: dist(t["x"], t["y"]))).alias("_best"),
        F.coalesce(F.size("_held"), F.lit(0)).alias("_met"), F.coalesce("_cost", F.lit(0)).alias("_cost"))
    best = met.groupBy("_row").agg(F.first("_left").alias("_left"), F.min("_best").alias(out),
                                   (F.max("_cost") + F.sum("_met")).alias("_work"))
    extra = [F.col("_work").cast("bigint").alias(work)] if work else []
    return best.select(*[F.col("_left")[c].alias(c) for c in columns], out, *extra)


__all__ = ["cell_index", "near_index", "points_in_polygons", "locate_points", "nearest_point", "haversine_below",
           "haversine_above", "plane_below", "plane_above", "HAVERSINE", "PLANE"]
