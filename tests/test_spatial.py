"""Containment, nearest ward within 500 m, exact nearest point vs brute force."""

import math
import random

from pyspark.sql import functions as F

from wardpulse.functions import geo
from wardpulse.operators.spatial import cell_index, locate_points, nearest_point, points_in_polygons


def polys(spark):
    # ward 1: concave "U" shape; ward 2: square next to it
    u = [(0.0, 0.0), (0.03, 0.0), (0.03, 0.03), (0.02, 0.03), (0.02, 0.01), (0.01, 0.01), (0.01, 0.03), (0.0, 0.03)]
    sq = [(0.05, 0.0), (0.07, 0.0), (0.07, 0.02), (0.05, 0.02)]
    rows = []
    for wid, ring in ((1, u), (2, sq)):
        xs, ys = [p[0] for p in ring], [p[1] for p in ring]
        rows.append((wid, f"w{wid}", [[{"x": x + 77.5, "y": y + 12.9} for x, y in ring]],
                     min(xs) + 77.5, min(ys) + 12.9, max(xs) + 77.5, max(ys) + 12.9))
    return spark.createDataFrame(rows, "ward_id int, ward_name string, rings array<array<struct<x:double,y:double>>>, "
                                       "min_x double, min_y double, max_x double, max_y double")


def pts(spark, coords):
    return spark.createDataFrame([(i, x + 77.5, y + 12.9) for i, (x, y) in enumerate(coords)],
                                 "pid int, longitude double, latitude double")


def test_points_in_polygons_concave_and_boundary(spark):
    p = pts(spark, [(0.005, 0.02), (0.015, 0.02), (0.025, 0.02), (0.06, 0.01), (0.04, 0.01), (0.0, 0.015)])
    got = {r.pid: r.ward_id for r in points_in_polygons(p, polys(spark), how="left").collect()}
    # inside the left arm, in the notch (outside), right arm, square, gap, on the boundary (excluded)
    assert got == {0: 1, 1: None, 2: 1, 3: 2, 4: None, 5: None}


def test_locate_points_snaps_within_500m(spark):
    p = pts(spark, [(0.015, 0.02), (0.0455, 0.01), (0.04, 0.01), (0.2, 0.2)])
    got = {r.pid: (r.ward_id, r.match) for r in locate_points(p, polys(spark), snap_km=0.5).collect()}
    # notch point: 0.005 deg (~0.54 km) from both arms -> outside 500 m; 0.0045 deg from ward 2 -> snapped
    assert got[1] == (2, "nearest")
    assert got[3] == (None, None)
    assert got[0][1] in (None, "nearest")


def test_nearest_point_matches_brute_force(spark):
    rnd = random.Random(3)
    left = [(i, 77.0 + rnd.random() * 0.8, 12.5 + rnd.random() * 0.8) for i in range(300)]
    right = [(77.0 + rnd.random() * 0.8, 12.5 + rnd.random() * 0.8) for _ in range(25)]
    L = spark.createDataFrame(left, "k int, longitude double, latitude double")
    R = spark.createDataFrame(right, "longitude double, latitude double")
    got = {r.k: r.nearest_km for r in nearest_point(L, R, "k", cell=0.01).collect()}

    def hav(a, b, c, d):
        p1, p2 = math.radians(b), math.radians(d)
        h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin((math.radians(c) - math.radians(a)) / 2) ** 2
        return 2 * 6371.0088 * math.asin(math.sqrt(min(1.0, h)))
    for k, x, y in left:
        want = min(hav(x, y, rx, ry) for rx, ry in right)
        assert abs(got[k] - want) < 1e-9


def test_haversine_reference_distance(spark):
    # BTM Layout to Peenya, 15.878 km on the sphere
    df = spark.createDataFrame([(77.6101, 12.9165, 77.5192, 13.0285)], "a double, b double, c double, d double")
    km = df.select(geo.haversine_km(F.col("a"), F.col("b"), F.col("c"), F.col("d"))).collect()[0][0]
    assert abs(km - 15.878) < 0.001


def test_nearest_point_far_and_sparse(spark):
    # stops in Bengaluru, the only "metro" points in Delhi: the search must coarsen, not explode
    L = spark.createDataFrame([(1, 77.59, 12.97), (2, 77.60, 12.98)], "k int, longitude double, latitude double")
    R = spark.createDataFrame([(77.21, 28.61), (77.10, 28.70)], "longitude double, latitude double")
    got = {r.k: r.nearest_km for r in nearest_point(L, R, "k", cell=0.01).collect()}

    def hav(a, b, c, d):
        p1, p2 = math.radians(b), math.radians(d)
        h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin((math.radians(c) - math.radians(a)) / 2) ** 2
        return 2 * 6371.0088 * math.asin(math.sqrt(min(1.0, h)))
    for k, x, y in [(1, 77.59, 12.97), (2, 77.60, 12.98)]:
        assert abs(got[k] - min(hav(x, y, 77.21, 28.61), hav(x, y, 77.10, 28.70))) < 1e-9
    empty = spark.createDataFrame([], "longitude double, latitude double")
    assert all(r.nearest_km is None for r in nearest_point(L, empty, "k").collect())


def _hav(a, b, c, d):
    p1, p2 = math.radians(b), math.radians(d)
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin((math.radians(c) - math.radians(a)) / 2) ** 2
    return 2 * 6371.0088 * math.asin(math.sqrt(min(1.0, h)))


def test_nearest_point_across_the_180th_meridian(spark):
    R = spark.createDataFrame([(-179.9, 0.0), (178.0, 0.0)], "longitude double, latitude double")
    L = spark.createDataFrame([(1, 179.9, 0.0), (2, -178.5, 1.0), (3, 90.0, 89.5)], "k int, longitude double, latitude double")
    got = {r.k: r.nearest_km for r in nearest_point(L, R, "k").collect()}
    assert abs(got[1] - _hav(179.9, 0, -179.9, 0)) < 1e-9 and got[1] < 23
    assert abs(got[2] - _hav(-178.5, 1, -179.9, 0)) < 1e-9
    assert abs(got[3] - min(_hav(90, 89.5, -179.9, 0), _hav(90, 89.5, 178, 0))) < 1e-9


def test_nearest_point_keeps_one_row_for_each_left_row(spark):
    """Repeated keys and rows, rows without a place, repeated targets."""
    L = spark.createDataFrame([(1, 77.5, 12.9), (1, 77.6, 12.8), (2, 77.5, 12.9), (2, 77.5, 12.9), (3, None, 12.9)],
                              "k int, longitude double, latitude double")
    R = spark.createDataFrame([(77.4, 12.9)] * 40 + [(77.7, 12.8), (None, 1.0)], "longitude double, latitude double")
    got = sorted((r.k, r.longitude is None, round(r.nearest_km or -1, 9)) for r in nearest_point(L, R, "k").collect())
    a, b = round(_hav(77.5, 12.9, 77.4, 12.9), 9), round(_hav(77.6, 12.8, 77.7, 12.8), 9)
    assert got == sorted([(1, False, a), (1, False, b), (2, False, a), (2, False, a), (3, True, -1)])


def test_nearest_point_work_stays_near_linear_with_a_far_dense_cluster(spark):
    """No row meets the whole cluster: 2,000 targets in a far city, 400 rows here."""
    rnd = random.Random(4)
    left = [(i, 77.0 + rnd.random(), 12.5 + rnd.random()) for i in range(400)]
    right = [(77.1 + rnd.random() * 0.3, 28.4 + rnd.random() * 0.3) for _ in range(2000)]
    L = spark.createDataFrame(left, "k int, longitude double, latitude double")
    R = spark.createDataFrame(right, "longitude double, latitude double")
    rows = nearest_point(L, R, "k", work="work").collect()
    for r in rows[::20]:
        assert abs(r.nearest_km - min(_hav(r.longitude, r.latitude, x, y) for x, y in right)) < 1e-9
    assert sum(r.work for r in rows) < 400 * 2000 * 0.25
    # rows amid the cluster: four times the targets cost a row less than twice the work
    N = spark.createDataFrame([(i, 77.1 + rnd.random() * 0.3, 28.4 + rnd.random() * 0.3) for i in range(400)], L.schema)
    more = right + [(77.1 + rnd.random() * 0.3, 28.4 + rnd.random() * 0.3) for _ in range(6000)]
    work = []
    for targets in (right, more):
        rows = nearest_point(N, spark.createDataFrame(targets, "longitude double, latitude double"), "k", work="work").collect()
        work.append(sum(r.work for r in rows) / 400)
    assert work[1] < 2 * work[0] and work[1] < 0.1 * len(more)


def test_nearest_point_to_few_targets_needs_no_join(spark):
    """Some hundred targets: one level, a map over the left rows; the plan shuffles none of them."""
    rnd = random.Random(8)
    L = spark.createDataFrame([(i, 77 + rnd.random(), 12.5 + rnd.random()) for i in range(50)], "k int, longitude double, latitude double")
    targets = [(77 + rnd.random() * 0.6, 12.5 + rnd.random() * 0.6) for _ in range(150)]
    R = spark.createDataFrame(targets, "longitude double, latitude double")
    found = nearest_point(L, R, "k")
    plan = found._jdf.queryExecution().optimizedPlan().toString().split("Subquery")[0]
    assert "Join" not in plan.split("scalar-subquery")[0] and "Window" not in plan
    for r in found.collect():
        assert abs(r.nearest_km - min(_hav(r.longitude, r.latitude, x, y) for x, y in targets)) < 1e-9


def _star(rnd, n, x, y, r):
    """A ring of n corners around a point, at changing distance: concave."""
    angles = [2 * math.pi * k / n for k in range(n)]
    return [(x + r * (0.4 + 0.6 * rnd.random()) * math.cos(a), y + r * (0.4 + 0.6 * rnd.random()) * math.sin(a)) for a in angles]


def _wards(spark, shapes):
    rows = [(i, f"w{i}", [[{"x": x, "y": y} for x, y in ring] for ring in rings]) for i, rings in shapes]
    return spark.createDataFrame(rows, "ward_id int, ward_name string, rings array<array<struct<x:double,y:double>>>")


def _even_odd(rings, x, y):
    odd = False
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
            if (ay > y) != (by > y) and x < ax + (bx - ax) * (y - ay) / (by - ay):
                odd = not odd
    return odd


def test_clipped_cells_equal_brute_force_on_rough_polygons(spark):
    """Concave rings, a hole, overlapping wards, two wards with one id, several cell sizes."""
    rnd = random.Random(5)
    outer, hole = _star(rnd, 90, 77.5, 12.9, 0.2), _star(rnd, 20, 77.5, 12.9, 0.05)
    shapes = [(1, [outer, hole]), (2, [_star(rnd, 60, 77.6, 12.95, 0.15)]), (3, [_star(rnd, 7, 77.9, 13.2, 0.03)]),
              (3, [_star(rnd, 5, 77.2, 12.7, 0.02)]), (4, [[(77.0, 12.5), (77.1, 12.5), (77.1, 12.6), (77.0, 12.6)]])]
    places = [(i, 77.0 + rnd.random(), 12.5 + rnd.random()) for i in range(1500)]
    P = spark.createDataFrame(places, "pid int, longitude double, latitude double")
    want = sorted((p, i) for p, x, y in places for i, rings in shapes if _even_odd(rings, x, y))
    assert len(want) > 100
    for cell in (0.007, 0.05, 0.6):
        got = points_in_polygons(P, _wards(spark, shapes), how="inner", cell=cell).collect()
        assert sorted((r.pid, r.ward_id) for r in got) == want, cell


def test_cell_index_holds_few_edges_and_no_rings(spark):
    """A ring of 4,000 corners over thousands of cells: no cell carries more than a
    small part of it, and inner cells carry nothing."""
    ring = [(77.5 + 0.4 * math.cos(2 * math.pi * k / 4000), 12.9 + 0.4 * math.sin(2 * math.pi * k / 4000)) for k in range(4000)]
    index = cell_index(_wards(spark, [(1, [ring])]), cell=0.01)
    cells = [(c["whole"], len(c["edges"])) for r in index.collect() for c in r["inside"]]
    inner = [n for whole, n in cells if whole]
    edge = [n for whole, n in cells if not whole]
    assert len(inner) > 4000 and max(inner) == 0
    assert max(edge) < 300 and sum(edge) < 20 * 4000
    assert "rings" not in index.schema.simpleString()


def test_locate_points_equals_brute_force_distance(spark):
    rnd = random.Random(6)
    shapes = [(i, [_star(rnd, 12, 77.0 + 0.05 * (i % 5), 12.5 + 0.05 * (i // 5), 0.03)]) for i in range(25)]
    places = [(i, 76.95 + 0.3 * rnd.random(), 12.45 + 0.3 * rnd.random()) for i in range(600)]
    P = spark.createDataFrame(places, "pid int, longitude double, latitude double")
    km = 6371.0088 * math.pi / 180

    def far(ring, x, y):
        best = 1e9
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
            kx = math.cos(math.radians(y)) * km
            ux, uy, wx, wy = (bx - ax) * kx, (by - ay) * km, (x - ax) * kx, (y - ay) * km
            t = max(0.0, min(1.0, (wx * ux + wy * uy) / (ux * ux + uy * uy)))
            best = min(best, math.hypot(wx - t * ux, wy - t * uy))
        return best

    got = {r.pid: (r.ward_id, r.match) for r in locate_points(P, _wards(spark, shapes), snap_km=0.5).collect()}
    assert len(got) == 600
    seen = set()
    for p, x, y in places:
        inside = [i for i, rings in shapes if _even_odd(rings, x, y)]
        near = min((far(rings[0], x, y), i) for i, rings in shapes)
        want = (min(inside), "contains") if inside else (near[1], "nearest") if near[0] <= 0.5 else (None, None)
        assert got[p] == want
        seen.add(want[1])
    assert seen == {"contains", "nearest", None}
    only = {r.pid: (r.ward_id, r.match) for r in locate_points(P, _wards(spark, shapes), snap_km=None).collect()}
    assert all(only[p] == (got[p] if got[p][1] == "contains" else (None, None)) for p in got)


def test_nearest_point_to_many_targets_searches_by_cells_not_rows(spark):
    """Over some hundred targets, wards and copies of rows amid them: right distances,
    and no window or sort over rows that carry cells."""
    from wardpulse.operators.spatial import PLANE
    rnd = random.Random(9)
    targets = [(77 + rnd.random() * 0.5, 12.5 + rnd.random() * 0.5) for _ in range(700)] + [(-179.99, 0.0)]
    R = spark.createDataFrame(targets, "longitude double, latitude double")
    places = [(77 + rnd.random() * 0.6, 12.5 + rnd.random() * 0.6) for _ in range(60)] * 5 + [(179.9, 0.1), (None, 1.0)]
    L = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(places)], "k int, longitude double, latitude double")
    found = nearest_point(L, R, "k")
    assert "Window" not in found._jdf.queryExecution().optimizedPlan().toString()
    got = {r.k: r.nearest_km for r in found.collect()}
    assert len(got) == len(places) and got[len(places) - 1] is None
    for i, (x, y) in enumerate(places[:-1]):
        assert abs(got[i] - min(_hav(x, y, a, b) for a, b in targets)) < 1e-9
    wards = _wards(spark, [(i, [_star(rnd, 9, 76.9 + rnd.random() * 0.8, 12.4 + rnd.random() * 0.8, 0.02 + 0.1 * (i % 7 == 0))])
                           for i in range(60)])
    xs, ys = F.transform(F.flatten("rings"), lambda p: p["x"]), F.transform(F.flatten("rings"), lambda p: p["y"])
    wards = wards.select("*", F.array_min(xs).alias("a"), F.array_min(ys).alias("b"), F.array_max(xs).alias("c"), F.array_max(ys).alias("d"))
    far = lambda px, py: geo.polygon_distance_km(F.col("rings"), px, py)
    got = {r.ward_id: r.nearest_km for r in nearest_point(wards, R, "ward_id", extent=("a", "b", "c", "d"), bounds=PLANE, dist=far).collect()}
    want = wards.crossJoin(R).groupBy("ward_id").agg(F.min(far(F.col("longitude"), F.col("latitude"))).alias("d")).collect()
    assert len(got) == 60 and all(abs(got[r.ward_id] - r.d) < 1e-9 for r in want)
