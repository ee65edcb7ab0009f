"""Load modes: pure DataFrame semantics and the partition-rewrite writers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wardpulse.operators.sinks import (insert_ignore, replace_where, run_state, upsert, write_insert_ignore,
                                       write_replace_where, write_upsert)

SCHEMA = "station_id string, date date, pm25 double, co double, ts int"
D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_upsert_updates_listed_columns_only(spark):
    t = spark.createDataFrame([("a", D1, 1.0, 9.0, 1), ("b", D1, 2.0, 8.0, 1)], SCHEMA)
    b = spark.createDataFrame([("a", D1, 5.0, 0.0, 2), ("c", D2, 7.0, 7.0, 2)], SCHEMA)
    out = upsert(t, b, ["station_id", "date"], ["pm25"])
    assert rows(out, "station_id", "pm25", "co") == [("a", 5.0, 9.0), ("b", 2.0, 8.0), ("c", 7.0, 7.0)]


def test_upsert_batch_duplicates_last_wins(spark):
    t = spark.createDataFrame([], SCHEMA)
    b = spark.createDataFrame([("a", D1, 1.0, 1.0, 1), ("a", D1, 3.0, 3.0, 5), ("a", D1, 2.0, 2.0, 3)], SCHEMA)
    assert rows(upsert(t, b, ["station_id", "date"], ["pm25"], order=["ts"]), "pm25") == [(3.0,)]


def test_insert_ignore_and_replace_where(spark):
    t = spark.createDataFrame([("a", D1, 1.0, 1.0, 1), ("n", None, 4.0, 4.0, 1)], SCHEMA)
    b = spark.createDataFrame([("a", D1, 9.0, 9.0, 2), ("b", D1, 2.0, 2.0, 2)], SCHEMA)
    assert rows(insert_ignore(t, b, ["station_id", "date"]), "station_id", "pm25") == [("a", 1.0), ("b", 2.0), ("n", 4.0)]
    # NULL predicate keeps the row
    out = replace_where(t, b, F.col("date") == F.lit(D1))
    assert rows(out, "station_id", "pm25") == [("a", 9.0), ("b", 2.0), ("n", 4.0)]


def test_write_upsert_is_idempotent_and_keeps_partitions(spark, scratch):
    path = f"{scratch}/aqi"
    b1 = spark.createDataFrame([("a", D1, 1.0, 9.0, 1), ("b", D2, 2.0, 8.0, 1)], SCHEMA)
    write_upsert(spark, path, b1, ["station_id", "date"], ["pm25"], ["date"])
    b2 = spark.createDataFrame([("a", D1, 5.0, 0.0, 2)], SCHEMA)
    write_upsert(spark, path, b2, ["station_id", "date"], ["pm25"], ["date"])
    write_upsert(spark, path, b2, ["station_id", "date"], ["pm25"], ["date"])     # replay
    got = rows(spark.read.parquet(path), "station_id", "pm25", "co")
    assert got == [("a", 5.0, 9.0), ("b", 2.0, 8.0)]


def test_write_upsert_rejects_unordered_duplicates(spark, scratch):
    b = spark.createDataFrame([("a", D1, 1.0, 1.0, 1), ("a", D1, 2.0, 2.0, 2)], SCHEMA)
    with pytest.raises(ValueError):
        write_upsert(spark, f"{scratch}/x", b, ["station_id", "date"], ["pm25"], ["date"])


def test_write_insert_ignore_and_replace(spark, scratch):
    path = f"{scratch}/t"
    b1 = spark.createDataFrame([("a", D1, 1.0, 1.0, 1), ("b", D2, 2.0, 2.0, 1)], SCHEMA)
    write_insert_ignore(spark, path, b1, ["station_id", "date"], ["date"])
    write_insert_ignore(spark, path, spark.createDataFrame([("a", D1, 7.0, 7.0, 2)], SCHEMA),
                        ["station_id", "date"], ["date"])
    assert rows(spark.read.parquet(path), "station_id", "pm25") == [("a", 1.0), ("b", 2.0)]
    # replace everything of D2 with nothing: the emptied partition is dropped
    write_replace_where(spark, path, spark.createDataFrame([], SCHEMA), F.col("date") == F.lit(D2), ["date"])
    assert rows(spark.read.parquet(path), "station_id") == [("a",)]


def test_run_state(spark):
    ev = spark.createDataFrame([("r1", "running", None, None, 1), ("r1", "success", 10, None, 2),
                                ("r2", "running", None, None, 1), ("r2", "failed", None, "boom", 3)],
                               "run_id string, status string, records_loaded int, error_message string, ts int")
    got = {r.run_id: (r.status, r.records_loaded, r.error_message, r.started_at, r.finished_at)
           for r in run_state(ev).collect()}
    assert got == {"r1": ("success", 10, None, 1, 2), "r2": ("failed", None, "boom", 1, 3)}


def test_append_rebuild_and_first_stop(spark, scratch):
    from wardpulse.operators.sinks import append, rebuild
    from wardpulse.sources.files import first_stop_per_id
    p = f"{scratch}/t"
    b = spark.createDataFrame([("a", D1, 1.0, 1.0, 1)], SCHEMA)
    append(b, p, ["date"])
    append(b.limit(0), p, ["date"])            # an empty batch adds nothing
    append(b, p, ["date"])
    assert spark.read.parquet(p).count() == 2
    rebuild(b, f"{scratch}/v2", ["date"])
    assert spark.read.parquet(f"{scratch}/v2").count() == 1
    stops = spark.createDataFrame([("001", "A", "12.9", "77.6"), ("001", "B", "13.0", "77.7"), ("002", "C", "x", "77.5")],
                                  "stop_id string, stop_name string, latitude string, longitude string").coalesce(1)
    got = {r.stop_id: (r.stop_name, r.geom) for r in first_stop_per_id(stops).collect()}
    assert got["001"][0] == "A" and got["001"][1].lon == 77.6 and got["002"][1].lat is None


def test_save_scores_upsert(spark, scratch):
    from decimal import Decimal
    from wardpulse.plans.mart import save_scores
    cols = ("ward_id int, ward_name string, city string, year int, month int, composite_score decimal(5,2), "
            "safety_score decimal(5,2), aqi_score decimal(5,2), civic_score decimal(5,2), transit_score decimal(5,2), "
            "green_score decimal(5,2), affordability_score decimal(5,2)")
    s1 = spark.createDataFrame([(1, "W", "C", 2024, 3) + (Decimal("10.00"),) * 7], cols)
    s2 = spark.createDataFrame([(1, "Renamed", "C", 2024, 3) + (Decimal("20.00"),) * 7], cols)
    path = f"{scratch}/scores"
    save_scores(spark, path, s1)
    save_scores(spark, path, s2)
    rows = spark.read.parquet(path).collect()
    assert [(r.ward_name, r.composite_score) for r in rows] == [("W", Decimal("20.00"))]
