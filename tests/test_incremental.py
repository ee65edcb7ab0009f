"""The incremental mart equals a full rebuild; merged sketches against exact figures;
landed models follow their input files; the warehouse's layers."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wardpulse.operators import sketches
from wardpulse.plans import staging as S
from wardpulse.plans.incremental import IncrementalMart, touched_ward_years
from wardpulse.plans.mart import mart_ward_features, scores
from wardpulse.plans.warehouse import Warehouse, landed

LO, HI = 2020, 2023
WARDS = [(i, f"Ward {i}", i, "Bengaluru" if i % 2 else "Mumbai", "z") for i in range(1, 9)]


@pytest.fixture(scope="module")
def wards(spark):
    return spark.createDataFrame(WARDS, "ward_id int, ward_name string, ward_number int, city string, zone_name string")


def _complaints(spark, rnd, n, first=0):
    rows = [(first + k, rnd.choice(["Roads", "Water"]), f" ward {rnd.randint(1, 8)} ", dt.date(rnd.randint(LO, HI), 3, 4),
             rnd.choice(["Resolved", "Pending", "Rejected"])) for k in range(n)]
    return spark.createDataFrame(rows, "complaint_id int, category string, ward_name string, date_filed date, status string")


def _ndvi(spark, rnd, wards_, years):
    from decimal import Decimal
    d = lambda x: Decimal(str(round(x, 4)))
    rows = []
    for w in wards_:
        for y in years:
            for m in (1, 6):
                v = rnd.random() * 0.8
                rows.append((w, f"Ward {w}", y, m, d(v), d(v), d(v / 2), d(v + 0.1), 10))
    return spark.createDataFrame(rows, "ward_id int, ward_name string, year int, month int, mean_ndvi decimal(6,4), "
                                       "median_ndvi decimal(6,4), min_ndvi decimal(6,4), max_ndvi decimal(6,4), pixel_count int")


def _sorted(df):
    return sorted(map(str, df.collect()))


def test_batches_of_two_feeds_equal_a_full_rebuild(spark, scratch, wards):
    rnd = random.Random(1)
    old, new = _complaints(spark, rnd, 150), _complaints(spark, rnd, 12, 1000)
    green, more = _ndvi(spark, rnd, range(1, 9), range(LO, HI)), _ndvi(spark, rnd, [2, 5], [HI])
    inc = IncrementalMart(spark, scratch)
    inc.rebuild(wards, {"complaints": S.stg_complaints(old, wards, LO, HI), "ndvi": S.stg_ndvi(green, LO, HI)}, LO, HI)
    both, greens = old.unionByName(new), green.unionByName(more)

    hit = touched_ward_years("complaints", new, wards, F.year("date_filed"), year_lo=LO, year_hi=HI)
    assert 0 < hit.count() < 8 * 4
    told = inc.apply("complaints", hit, lambda t: S.stg_complaints(
        both, wards.join(t.select("ward_id").distinct(), "ward_id", "left_semi"), LO, HI))
    hit = touched_ward_years("ndvi", more, wards, F.col("year"), year_lo=LO, year_hi=HI)
    assert sorted(map(tuple, hit.collect())) == [(2, HI), (5, HI)]
    told = inc.apply("ndvi", hit, lambda t: S.stg_ndvi(greens.join(t.select("ward_id").distinct(), "ward_id", "left_semi"), LO, HI))
    assert told["years"] == [HI]                                    # only its partition is rewritten
    full = mart_ward_features(wards, {"complaints": S.stg_complaints(both, wards, LO, HI), "ndvi": S.stg_ndvi(greens, LO, HI)}, LO, HI)
    assert _sorted(inc.mart.read()) == _sorted(full)
    assert _sorted(inc.scores.read()) == _sorted(scores(full))


def test_scores_follow_when_an_extreme_moves_and_only_then(spark, scratch, wards):
    from decimal import Decimal
    green = _ndvi(spark, random.Random(2), range(1, 9), range(LO, HI + 1))
    inc = IncrementalMart(spark, scratch)
    model = lambda rows: lambda t: S.stg_ndvi(rows, LO, HI)
    inc.rebuild(wards, {"ndvi": S.stg_ndvi(green, LO, HI)}, LO, HI)
    middle = sorted(r.avg_ndvi for r in inc.mart.read().collect())[16]

    def changed(value):
        at = (F.col("ward_id") == 3) & (F.col("year") == 2021)
        return green.withColumn("mean_ndvi", F.when(at, F.lit(value).cast("decimal(6,4)")).otherwise(F.col("mean_ndvi")))

    touched = spark.createDataFrame([(3, 2021), (3, 2022)], "ward_id int, year int")
    rows = changed(middle)
    small = inc.apply("ndvi", touched, model(rows))
    whole = inc.apply("ndvi", touched, model(changed(Decimal("0.9999"))))
    assert (small["all_scores"], whole["all_scores"]) == (False, True)
    full = mart_ward_features(wards, {"ndvi": S.stg_ndvi(changed(Decimal("0.9999")), LO, HI)}, LO, HI)
    assert _sorted(inc.mart.read()) == _sorted(full) and _sorted(inc.scores.read()) == _sorted(scores(full))


def test_a_replayed_batch_changes_nothing(spark, scratch, wards):
    green = _ndvi(spark, random.Random(3), range(1, 9), [LO])
    inc = IncrementalMart(spark, scratch)
    inc.rebuild(wards, {"ndvi": S.stg_ndvi(green, LO, HI)}, LO, HI)
    touched = spark.createDataFrame([(1, LO)], "ward_id int, year int")
    for _ in range(2):
        inc.apply("ndvi", touched, lambda t: S.stg_ndvi(green, LO, HI), ("ndvi", 4))
        version = inc.mart.state()["version"]
    assert version == 2


def test_touched_ward_years(spark, wards):
    rows = spark.createDataFrame([("Ward 3", 2021), (None, 2022), ("no such", 2020), ("WARD 4 ", None)], "ward_name string, y int")
    got = {tuple(r) for r in touched_ward_years("property", rows, wards, F.col("y"), year_lo=LO, year_hi=HI).collect()}
    assert got == {(3, 2021), (3, 2022)} | {(w, y) for w in range(1, 9) for y in (2022, 2023)}
    got = {tuple(r) for r in touched_ward_years("crime", rows.where("y = 2020"), wards, F.col("y"), year_lo=LO, year_hi=HI).collect()}
    assert got == {(w, 2020) for w in range(1, 9)}


def test_merged_sketches(spark):
    rnd = random.Random(4)
    rows = [(rnd.randint(1, 12), rnd.choice("AB"), rnd.gauss(50, 20), rnd.randint(1, 900)) for _ in range(30_000)]
    df = spark.createDataFrame([*rows, (1, "A", None, None)], "month int, city string, v double, member int")
    months = sketches.build(df, ["city", "month"], "v", member="member")
    assert months.count() == 24
    for group, keys in (("city", ["city"]), (None, [])):
        for r in sketches.merge(months, keys).select("*", sketches.distinct().alias("d"), sketches.distinct(False).alias("h"), *[
                sketches.quantile(q).alias(f"q{int(q * 100)}") for q in (0.1, 0.5, 0.9)]).collect():
            mine = [x for x in rows if not group or x[1] == r.city]
            values = sorted(x[2] for x in mine)
            members = len({x[3] for x in mine})
            assert (r.n, r.least, r.most) == (len(values), values[0], values[-1]) and abs(r.total - sum(values)) < 1e-6
            assert r.d == members and abs(r.h - members) < 0.06 * members
            for q in (0.1, 0.5, 0.9):
                rank = sum(x <= r[f"q{int(q * 100)}"] for x in values) / len(values)
                assert abs(rank - q) < 0.03


def test_landed_models_follow_their_files(spark, scratch):
    path = f"{scratch}/in"
    spark.range(3).write.parquet(f"{path}/t.parquet")
    built = []

    def build():
        built.append(1)
        return spark.read.parquet(f"{path}/t.parquet")

    assert landed(spark, path, ["t"], "m", build).count() == 3 and landed(spark, path, ["t"], "m", build).count() == 3
    assert len(built) == 1
    spark.range(2).write.mode("append").parquet(f"{path}/t.parquet")
    assert landed(spark, path, ["t"], "m", build).count() == 5 and len(built) == 2


def test_warehouse_layers(spark, scratch, wards):
    w = Warehouse(spark, scratch)
    rows = _complaints(spark, random.Random(5), 60).withColumn("city", F.lit("Bengaluru")).withColumn("scraped_at", F.lit(1).cast("long"))
    for c in ("description", "latitude", "longitude"):
        rows = rows.withColumn(c, F.lit(None).cast("string"))
    w.load("complaints", rows)
    w.build_staging({"complaints": lambda: S.stg_complaints(w.read("raw", "complaints"), wards, LO, HI)})
    mart = w.build_mart(wards, LO, HI)
    assert mart.count() == 32 and mart.agg(F.sum("total_complaints")).first()[0] == 60
