"""Geometry as column expressions (no geometry library, no UDF).

A ward geometry is ``rings: array<array<struct<x:double, y:double>>>`` --
every ring of every polygon of a MultiPolygon, (x, y) = (lon, lat) degrees --
plus its bounding box ``min_x, min_y, max_x, max_y``. Containment is the
even-odd rule over all ring edges, evaluated with ``aggregate`` (JVM-side).
Distances: haversine on a sphere of radius 6371.0088 km for point-point;
point-segment distance in a local equirectangular plane for point-polygon.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardpulse.config import EARTH_RADIUS_KM

KM_PER_DEG = EARTH_RADIUS_KM * math.pi / 180.0


def point(lon: Column, lat: Column) -> Column:
    """G-2 make a point: struct<lon, lat>."""
    return F.struct(lon.cast("double").alias("lon"), lat.cast("double").alias("lat"))


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column,
                 radius_km: float = EARTH_RADIUS_KM) -> Column:
    """G-3 great-circle distance in km."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dphi = p2 - p1
    dlmb = F.radians(lon2) - F.radians(lon1)
    h = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return 2 * radius_km * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def ring_edges(rings: Column) -> Column:
    """All edges of all rings as structs (ax, ay, bx, by); a ring closes itself."""
    def of(r: Column) -> Column:
        return F.transform(r, lambda a, i: F.struct(
            a["x"].alias("ax"), a["y"].alias("ay"), r[(i + 1) % F.size(r)]["x"].alias("bx"),
            r[(i + 1) % F.size(r)]["y"].alias("by")))
    return F.flatten(F.transform(rings, of))


def _crosses(e: Column, x: Column, y: Column) -> Column:
    ax, ay, bx, by = (e[c] for c in ("ax", "ay", "bx", "by"))
    straddles = (ay > y) != (by > y)
    # x < ax + (bx-ax)(y-ay)/(by-ay), written without a division
    left_of = ((x - ax) * (by - ay) - (bx - ax) * (y - ay)) * F.signum(by - ay) < 0
    return straddles & left_of


def _on_edge(e: Column, x: Column, y: Column) -> Column:
    ax, ay, bx, by = (e[c] for c in ("ax", "ay", "bx", "by"))
    collinear = (bx - ax) * (y - ay) - (by - ay) * (x - ax) == 0
    return (collinear & (x >= F.least(ax, bx)) & (x <= F.greatest(ax, bx))
            & (y >= F.least(ay, by)) & (y <= F.greatest(ay, by)))


def odd_crossings(start: Column, edges: Column, x: Column, y: Column) -> Column:
    """``start``, turned over by each edge that the ray to +x crosses."""
    return F.aggregate(edges, start, lambda acc, e: acc != _crosses(e, x, y))


def on_edges(edges: Column, x: Column, y: Column) -> Column:
    return F.exists(edges, lambda e: _on_edge(e, x, y))


def even_odd(rings: Column, x: Column, y: Column) -> Column:
    """Odd number of ring-edge crossings of the ray to +x."""
    return odd_crossings(F.lit(False), ring_edges(rings), x, y)


def on_boundary(rings: Column, x: Column, y: Column) -> Column:
    return on_edges(ring_edges(rings), x, y)


def contains(rings: Column, x: Column, y: Column) -> Column:
    """G-1 ST_Contains(polygon, point): inside, boundary excluded."""
    return even_odd(rings, x, y) & ~on_boundary(rings, x, y)


def _seg_dist_km(e: Column, x: Column, y: Column) -> Column:
    ax, ay, bx, by = (e[c] for c in ("ax", "ay", "bx", "by"))
    kx = F.cos(F.radians(y)) * KM_PER_DEG
    ky = F.lit(KM_PER_DEG)
    ux, uy = (bx - ax) * kx, (by - ay) * ky
    wx, wy = (x - ax) * kx, (y - ay) * ky
    len2 = ux * ux + uy * uy
    t = F.when(len2 > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), (wx * ux + wy * uy) / F.when(len2 > 0, len2)))).otherwise(0.0)
    dx, dy = wx - t * ux, wy - t * uy
    return F.sqrt(dx * dx + dy * dy)


def edges_distance_km(edges: Column, x: Column, y: Column) -> Column:
    """Distance from a point to the nearest of some edges."""
    return F.aggregate(edges, F.lit(None).cast("double"), lambda a, e: F.least(a, _seg_dist_km(e, x, y)))


def polygon_distance_km(rings: Column, x: Column, y: Column) -> Column:
    """G-4 distance from a point to a polygon, 0 inside (boundary counts as 0)."""
    return F.when(even_odd(rings, x, y), F.lit(0.0)).otherwise(edges_distance_km(ring_edges(rings), x, y))


def in_bbox(x: Column, y: Column, west, south, east, north) -> Column:
    """S-29 inclusive bounding-box test."""
    return (y >= south) & (y <= north) & (x >= west) & (x <= east)
