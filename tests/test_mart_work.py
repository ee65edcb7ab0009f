"""The property and NDVI models against brute force, and what they move to get there."""

import random
from collections import Counter, defaultdict
from decimal import Decimal

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardpulse.operators.aggregates import near_targets
from wardpulse.plans import staging as S


def test_few_own_values_are_ranked_among_shared_ones(spark):
    """F16: only values near a group's middle ranks meet the shared values."""
    rnd = random.Random(3)
    named = [(g, 1, rnd.randint(1, 100000)) for g in range(40) for _ in range(rnd.randint(1, 60))]
    named += [(g, 2, rnd.randint(1, 9)) for g in range(5) for _ in range(4)]          # no shared value in this key
    shared = [(1, rnd.randint(1, 100000)) for _ in range(5000)]
    rows = (spark.createDataFrame(named, "g int, y int, v int").groupBy("g", "y", "v")
            .agg(F.count(F.lit(1)).alias("_c")))
    w = Window.partitionBy("g", "y").orderBy("v")
    ranked = (rows.withColumn("_ltN", F.coalesce(F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("_nx", F.lead("v").over(w)).withColumn("_n", F.sum("_c").over(Window.partitionBy("g", "y"))))
    hist = spark.createDataFrame(shared, "y int, v int").groupBy("y", "v").agg(F.count(F.lit(1)).alias("_cu")).checkpoint()
    kept = near_targets(ranked, hist, "y", "v", 0.5).collect()
    assert len(kept) < len(named) / 4
    have = defaultdict(set)
    for r in kept:
        have[r.g, r.y].add(r.v)
    for g, y in {(g, y) for g, y, _ in named}:
        own = [v for a, b, v in named if (a, b) == (g, y)]
        both = sorted(own + [v for b, v in shared if b == y])
        for k in ((len(both) - 1) // 2, len(both) // 2):
            assert both[k] in have[g, y] or any(both[k] == v for b, v in shared if b == y)
        below = [v for v in own if v < both[(len(both) - 1) // 2]]
        assert not below or max(below) in have[g, y]


def test_property_of_repeated_and_nameless_wards(spark):
    rnd = random.Random(11)
    wards = [(1, "Alpha"), (2, " ALPHA"), (3, "Beta"), (3, "Beta"), (4, "Gamma"), (None, "Beta"), (5, None)]
    names = ["alpha ", "Beta", "beta", "Nowhere", None, None, None]
    kinds = ["flat", "house", "villa", "plot", None]
    rows = [(rnd.choice(names), Decimal(rnd.randint(100000, 130000)) / 100, rnd.choice(kinds), rnd.choice((1995, 1996)))
            for _ in range(400)]
    feed = spark.createDataFrame(rows, "ward_name string, price_sqft decimal(10,2), property_type string, y int").select(
        "ward_name", "price_sqft", "property_type", F.make_date("y", F.lit(3), F.lit(1)).alias("listing_date"),
        F.lit(None).cast("timestamp").alias("scraped_at"))
    w = spark.createDataFrame(wards, "ward_id int, ward_name string")
    got = S.stg_property(feed, w, 1995, 1997).collect()
    norm = lambda s: s.strip().lower() if s is not None else None
    want = Counter()
    for wid, name in wards:
        times = sum(1 for x in wards if x == (wid, name))
        for year in (1995, 1996):
            of_year = [r for r in rows if r[3] == year]
            shared = [r for r in of_year if r[0] is None]
            whole = wid is not None and name is not None
            own = [r for r in of_year if r[0] is not None and norm(r[0]) == norm(name)] * times if whole else []
            every = own + shared
            types = Counter(r[2] for r in every if r[2] is not None)
            best = min(types, key=lambda t: (-types[t], t)) if whole else None
            med = Decimal(str(round(float(np.percentile([float(r[1]) for r in every], 50)) + 1e-9, 2))) if whole else None
            want[wid, name, year, len(every), min(r[1] for r in every), max(r[1] for r in every), best, med] += 1
    assert Counter((r.ward_id, r.ward_name, r.year, r.listing_count, r.min_price_sqft, r.max_price_sqft,
                    r.dominant_property_type, r.median_price_sqft) for r in got) == want


def test_zone_medians_need_no_slices(spark, monkeypatch):
    """F8: a zone's values are few; its ranks come with its other statistics."""
    rnd = random.Random(4)
    rows = [(rnd.choice((1, 2, None)), rnd.choice((1995, 1996)), rnd.randint(1, 3), Decimal(rnd.randint(-20, 60)) / 100) for _ in range(500)]
    rows += [(2, 1995, 1, None)]
    pixels = spark.createDataFrame(rows, "ward_id int, year int, month int, ndvi decimal(6,4)")

    def refuse(self, *args):
        raise AssertionError("a checkpoint of the histogram")

    monkeypatch.setattr(type(pixels), "checkpoint", refuse)
    monkeypatch.setattr(DataFrame, "checkpoint", refuse)
    zones = S.zonal_stats(pixels)
    got = {(r.ward_id, r.year, r.month): (r.median_ndvi, r.pixel_count) for r in zones.collect()}
    want = defaultdict(list)
    for a, y, m, v in rows:
        if a is not None and v is not None:
            want[a, y, m].append(float(v))
    assert set(got) == set(want)
    for k, vs in want.items():
        assert got[k][1] == len(vs) and abs(float(got[k][0]) - float(np.median(vs))) < 1e-9
    named = zones.withColumn("ward_name", F.concat(F.lit("W"), "ward_id"))
    years = {(r.ward_id, r.year): r.median_ndvi for r in S.stg_ndvi(named, 1995, 1996).collect()}
    for (a, y), v in years.items():
        of = [float(got[k][0]) for k in got if k[:2] == (a, y)]
        assert abs(float(v) - round(float(np.median(of)) + 1e-9, 4)) < 1e-9


def _repetitive(spark, path: str, *columns: str) -> DataFrame:
    """Many ward-years in a small file: 25 MB of rows in less than 3."""
    none = [F.lit(0).cast("bigint").alias(c) for c in columns]
    spark.range(300_000).select(F.col("id").alias("ward_id"), F.lit(1999).alias("year"), *none).coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


def _planned(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_ward_years_are_not_broadcast_by_the_size_of_their_files(spark, scratch):
    from wardpulse.plans.mart import MART_FEATURES, mart_ward_features
    staged = {feed: _repetitive(spark, f"{scratch}/{feed}", *cols) for feed, cols in MART_FEATURES.items() if feed in ("crime", "aqi")}
    wards = spark.range(50).select(F.col("id").alias("ward_id"), F.lit("w").alias("ward_name"), F.lit(1).alias("ward_number"),
                                   F.lit("z").alias("zone_name"), F.lit("c").alias("city"))
    m = mart_ward_features(wards, staged, 1999, 2000)
    assert "BroadcastHashJoin" not in _planned(m)
    assert m.where("total_ipc_offenses = 0 and avg_aqi = 0").count() == 50 and m.count() == 100


def test_a_landed_model_is_planned_by_the_size_of_rows(spark, scratch):
    from wardpulse.plans.warehouse import landed
    key = "spark.sql.sources.fileCompressionFactor"
    a, b = (_repetitive(spark, f"{scratch}/{t}.parquet", *[f"{t}{i}" for i in range(8)]) for t in "ab")
    before, plans = spark.conf.get(key), []

    def build() -> DataFrame:
        both = spark.read.parquet(f"{scratch}/a.parquet").join(spark.read.parquet(f"{scratch}/b.parquet"), ["ward_id", "year"])
        plans.append(_planned(both))
        return both

    assert landed(spark, scratch, ("a", "b"), "both", build).count() == a.count() == b.count()
    assert "BroadcastHashJoin" not in plans[0] and spark.conf.get(key) == before
