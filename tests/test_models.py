"""Hand-computed cases for the staging models' reference semantics."""

from decimal import Decimal

from wardpulse.plans.staging import stg_crime


def test_stg_crime_single_city(spark):
    wards = spark.createDataFrame([(1, "Alpha"), (2, "Beta")], "ward_id int, ward_name string")
    crime = spark.createDataFrame([("B", 2020, "murder", 3), ("B", 2020, "theft", 5), ("M", 2020, "theft", 99),
                                   ("B", 2017, "theft", 7)],
                                  "city string, year int, offense_category string, count int")
    census = spark.createDataFrame([(" alpha", 2020, 100), ("BETA ", 2020, 300)],
                                   "ward_name string, year int, population int")
    rows = {r.ward_id: r for r in stg_crime(crime, census, wards, city="B", year_lo=2018, year_hi=2024).collect()}
    # shares 1/4 and 3/4 of the city's 8 offences; half away from zero on the exact value
    assert (rows[1].total_ipc_offenses, rows[1].murder_count, rows[1].theft_count) == (2, 1, 1)
    assert (rows[2].total_ipc_offenses, rows[2].murder_count, rows[2].theft_count) == (6, 2, 4)
    assert rows[1].crime_rate_per_1000 == Decimal("20.0000") and rows[1].source_pdf == "B_ncrb"
    assert {r.year for r in rows.values()} == {2020}


def test_transit_score_null_rules(spark):
    from pyspark.sql import functions as F

    from wardpulse.plans.staging import transit_score
    df = spark.createDataFrame([(10, 2.5, Decimal("40.00")), (60, None, None), (0, 0.0, Decimal("150.00"))],
                               "stops long, km double, freq decimal(8,2)")
    got = [r[0] for r in df.select(transit_score(F.col("stops"), F.col("km"), F.col("freq"))).collect()]
    # 8 + 30 + 8; 40 + 0 (no metro) + 20 (LEAST skips NULL); 0 + 40 + 20
    assert got == [Decimal("46.00"), Decimal("60.00"), Decimal("60.00")]


def test_scores_edge_rules(spark):
    from wardpulse.plans.mart import scores
    mart = spark.createDataFrame(
        [(1, "a", "C", 2020, 10.0, 5.0, 0.5, 40.0, 0.2, 1000.0),
         (2, "b", "C", 2020, 20.0, 5.0, 1.0, 80.0, 0.4, None)],
        "ward_id int, ward_name string, city string, year int, crime_rate_per_1000 double, avg_aqi double, "
        "resolution_rate double, transit_score double, avg_ndvi double, median_price_sqft double")
    r = {x.ward_id: x for x in scores(mart).collect()}
    assert (r[1].safety_score, r[2].safety_score) == (Decimal("100.00"), Decimal("0.00"))   # inverted
    assert r[1].aqi_score == Decimal("100.00") == r[2].aqi_score      # zero range -> 0, inverted -> 100
    assert r[2].affordability_score is None and r[2].composite_score is None   # D-10
    assert r[1].composite_score == Decimal("50.00")   # 20 + 20 + 0 + 0 + 0 + 10 (affordability 100 x .1)
    no_ndvi = scores(mart.drop("avg_ndvi")).collect()
    assert all(x.green_score == Decimal("0.00") for x in no_ndvi)   # missing column scores 0


def test_stg_complaints_rules(spark):
    import datetime as dt

    from wardpulse.plans.staging import stg_complaints
    wards = spark.createDataFrame([(7, "Koramangala")], "ward_id int, ward_name string")
    d = dt.date(2020, 5, 1)
    c = spark.createDataFrame([(" koramangala ", "Roads", d, "OPEN"), (" koramangala ", "Water", d, "Closed"),
                               (" koramangala ", "Water", d, "resolved"), (" koramangala ", "Roads", d, "Cancelled"),
                               (" koramangala ", None, d, "weird"), (" koramangala ", "Roads", None, "open")],
                              "ward_name string, category string, date_filed date, status string")
    r = stg_complaints(c, wards, 2018, 2024).collect()[0]
    assert (r.ward_id, r.ward_name, r.year) == (7, "Koramangala", 2020)
    assert (r.total_complaints, r.pending_complaints, r.resolved_complaints, r.rejected_complaints) == (5, 1, 2, 1)
    assert r.resolution_rate == Decimal("0.4000")
    assert r.top_category == "Roads"      # Roads 2, Water 2: tie to the lowest; NULL ignored


def test_latest_readings_matches_brute_force(spark):
    import datetime as dt
    import random

    from wardpulse.plans.mart import latest_readings
    rnd = random.Random(2)
    rows = [(c, s, dt.date(2024, 1, rnd.randint(1, 6))) for c in ("A", "B", "C") for s in range(40)
            if not (c == "C" and s > 4)]
    rows = list({(c, s, d) for c, s, d in rows})
    df = spark.createDataFrame(rows, "city string, station_id int, date date")
    got = sorted((r.city, r.station_id, r.date) for r in latest_readings(df, k=10).collect())
    want = []
    for c in ("A", "B", "C"):
        mine = sorted((r for r in rows if r[0] == c), key=lambda r: (-r[2].toordinal(), r[1]))
        want += mine[:10]
    assert got == sorted(want)


def test_aqi_coverage_and_computed_upsert(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from wardpulse.operators.sinks import upsert
    from wardpulse.plans.feeds import aqi_coverage
    d = lambda i: dt.date(2024, 1, i)
    r = spark.createDataFrame([(1, d(1)), (1, d(1)), (1, d(4)), (2, d(2))], "station_id int, date date")
    cov = {x.station_id: (x.days_expected, x.days_with_reading, x.days_missing)
           for x in aqi_coverage(r, F.lit(d(1)), F.lit(d(4))).collect()}
    assert cov == {1: (4, 2, 2), 2: (4, 1, 3)}
    t = spark.createDataFrame([("c1", "Open", 1)], "complaint_id string, status string, ingested_at int")
    b = spark.createDataFrame([("c1", "Closed", 0), ("c2", "Open", 0)], "complaint_id string, status string, ingested_at int")
    out = {x.complaint_id: (x.status, x.ingested_at)
           for x in upsert(t, b, ["complaint_id"], ["status"], set_exprs={"ingested_at": F.lit(9)}).collect()}
    assert out == {"c1": ("Closed", 9), "c2": ("Open", 9)}
