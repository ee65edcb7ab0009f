"""AQI payloads (F-2), crime tables (F-1), GTFS and census loaders."""

from decimal import Decimal

from pyspark.sql import functions as F

from wardpulse.plans.feeds import enrich_stops, parse_aqi_payloads, parse_gtfs_stops, route_frequency
from wardpulse.sources.crime_tables import parse_crime_tables, report_year


def payloads(spark, texts):
    return parse_aqi_payloads(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, payload string"))


def test_payload_records(spark):
    p = '{"records":[{"pm25":"45.2","pm10":"80.1","no2":"20","so2":"5","co":"1.1","o3":"30","aqi":"120","prominent_pollutant":"PM2.5"}]}'
    r = payloads(spark, [p]).collect()[0]
    assert r.pm25 == Decimal("45.20") and r.aqi == 120 and r.prominent_pollutant == "PM2.5"


def test_payload_empty_and_alternate(spark):
    assert payloads(spark, ['{"records":[]}']).count() == 0
    p = '{"data":[{"PM2.5":"50.0","PM10":"90","NO2":"1","SO2":"2","CO":"0.5","Ozone":"30.0","AQI":"150.7"}]}'
    r = payloads(spark, [p]).collect()[0]
    assert r.pm25 == Decimal("50.00") and r.o3 == Decimal("30.00") and r.aqi == 150
    assert r.prominent_pollutant == ""


def test_payload_present_null_wins(spark):
    r = payloads(spark, ['{"records":[{"pm25":null,"PM2.5":"9"}]}']).collect()[0]
    assert r.pm25 is None


def test_crime_unpivot(spark):
    t = [["Sl.No", "City", "Murder", "Theft"], ["1", "Bengaluru", "120", "5,432"], ["2", "Delhi", "250", "8,901"]]
    df = spark.createDataFrame([(t, "x.pdf", 3, 2022), ([], "y.pdf", 1, 2022), ([t[0]], "z.pdf", 1, 2022)],
                               "cells array<array<string>>, source_pdf string, page_number int, year int")
    rows = sorted((r.city, r.offense_category, r["count"], r.state)
                  for r in parse_crime_tables(df, target_city=None).collect())
    assert rows == [("Bengaluru", "murder", 120, "Karnataka"), ("Bengaluru", "theft", 5432, "Karnataka"),
                    ("Delhi", "murder", 250, "Karnataka"), ("Delhi", "theft", 8901, "Karnataka")]
    assert parse_crime_tables(df).count() == 2          # default target city


def test_report_year(spark):
    df = spark.createDataFrame([("Crime_in_India_2021.pdf",), ("report.pdf",)], "f string")
    assert [r[0] for r in df.select(report_year(F.col("f"))).collect()] == [2021, 2022]


def test_gtfs_stops_and_frequency(spark):
    raw = spark.createDataFrame([(" 001 ", "Majestic ", "12.9767", "77.5713"), ("002", "Far", "19.0", "72.8"),
                                 ("003", "Bad", "x", "77.6")],
                                "Stop_ID string, stop_name string, stop_lat string, stop_lon string")
    st = parse_gtfs_stops(raw, "BMTC").collect()
    assert [(r.stop_id, r.stop_name, r.stop_desc, r.zone_id) for r in st] == [("001", "Majestic", "", "")]
    times = spark.createDataFrame([("t1", "001"), ("t2", "001"), ("t3", "001"), ("t1", "002")], "trip_id string, stop_id string")
    trips = spark.createDataFrame([("t1", "r1"), ("t2", "r1"), ("t3", "r2")], "trip_id string, route_id string")
    f = {r.stop_id: (r.route_count, r.avg_frequency) for r in route_frequency(times, trips).collect()}
    assert f == {"001": (2, 3), "002": (1, 1)}
    f2 = {r.stop_id: r.route_count for r in route_frequency(times, None).collect()}
    assert f2 == {"001": 3, "002": 1}
    e = enrich_stops(spark.createDataFrame([("001",), ("009",)], "stop_id string"), route_frequency(times, trips))
    assert sorted((r.stop_id, r.route_count) for r in e.collect()) == [("001", 2), ("009", 0)]


def test_census_loader(spark):
    from wardpulse.sources.files import load_census
    df = spark.createDataFrame([("  b.t.m layout ", "1", "1000", "2.0", None, "80", "4.1", "2011"),
                                (None, "2", "50", "1", None, "70", "4", "2011"),
                                ("x", "3", None, "1", None, "70", "4", "2011")],
                               "Name string, ward_no string, pop string, area string, density string, "
                               "literacy string, hh_size string, year string")
    rows = load_census(df).collect()
    assert len(rows) == 1 and rows[0].ward_name == "B.T.M Layout"
    assert rows[0].density == Decimal("500.00")       # filled: every density was NULL


def test_ndvi_composite_fallback_and_mask(spark):
    from wardpulse.plans.feeds import ndvi_composite
    rows = []
    # Jan: two clear scenes, one masked pixel class (SCL 8) that must be ignored
    rows += [(1, 1, 2024, 1, 1, 10, 4, 10.0, 30.0), (1, 1, 2024, 1, 2, 20, 4, 10.0, 50.0),
             (1, 1, 2024, 1, 3, 10, 8, 10.0, 1000.0)]
    # Feb..May: cloudy months (mean scene cloud over 80)
    for m in (2, 3, 4, 5):
        rows.append((1, 1, 2024, m, 1, 95, 4, 10.0, 20.0))
    df = spark.createDataFrame(rows, "x int, y int, year int, month int, scene int, cloud int, scl int, "
                                     "b4 double, b8 double")
    # July: clear again; June has no scene at all
    rows.append((1, 1, 2024, 7, 1, 10, 4, 10.0, 10.0))
    df = df.unionByName(spark.createDataFrame(rows[-1:], df.schema))
    months = lambda c: {(r.month): (round(r.ndvi, 9), r.is_fallback) for r in c.collect()}
    jan = round((0.5 + (40.0 / 60.0)) / 2, 9)         # median of (30-10)/40 and (50-10)/60
    got = months(ndvi_composite(df))
    assert got == {1: (jan, False), 7: (0.0, False), **{m: (jan, True) for m in (2, 3, 4, 5, 6)}}
    # with a limit of three months May and June have nothing
    got = months(ndvi_composite(df, fallback_months=3))
    assert got == {1: (jan, False), 7: (0.0, False), **{m: (jan, True) for m in (2, 3, 4)}}


def test_ndvi_composite_of_several_cities(spark):
    """A clouded city falls back by itself; scenes with one number and cloud percent stay two."""
    from wardpulse.plans.feeds import ndvi_composite
    rows = [("A", 1, 1, 2024, m, 1, 10, 4, 10.0, 30.0) for m in (1, 2)]
    rows += [("B", 1, 1, 2024, 1, 1, 10, 4, 10.0, 50.0)]
    rows += [("B", 1, 1, 2024, 2, s, 95, 4, 10.0, 20.0) for s in range(2, 12)] + [("B", 1, 1, 2024, 2, 1, 10, 4, 10.0, 10.0)]
    rows += [("C", 1, 1, 2024, 3, 1, 10, 4, 10.0, 10.0), (None, 1, 1, 2024, 1, 1, 10, 4, 10.0, 10.0)]
    df = spark.createDataFrame(rows, "city string, x int, y int, year int, month int, scene int, cloud int, scl int, "
                                     "b4 double, b8 double")
    got = {(r.city, r.month): (round(r.ndvi, 9), r.is_fallback) for r in ndvi_composite(df).collect()}
    b = round(40.0 / 60.0, 9)
    assert got == {("A", 1): (0.5, False), ("A", 2): (0.5, False), ("A", 3): (0.5, True),
                   ("B", 1): (b, False), ("B", 2): (b, True), ("B", 3): (b, True), ("C", 3): (0.0, False)}
