"""Structured Streaming: availableNow ingest is an idempotent upsert."""

import json
import os

from wardpulse.streaming.ingest import start_aqi_ingest

SCHEMA = "station_id string, date string, pm25 double, pm10 double, no2 double, so2 double, aqi int, ts long"


def land(folder, name, recs):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        for r in recs:
            f.write(json.dumps(r) + "\n")


def test_stream_upsert(spark, scratch):
    landing, table = f"{scratch}/landing", f"{scratch}/aqi"
    base = {"pm10": 1.0, "no2": 1.0, "so2": 1.0, "aqi": 10}
    land(landing, "a.json", [dict(base, station_id="s1", date="2024-01-01", pm25=1.0, ts=1),
                             dict(base, station_id="s1", date="2024-01-01", pm25=2.0, ts=2),
                             dict(base, station_id="s2", date="2024-01-02", pm25=5.0, ts=1)])
    q = start_aqi_ingest(spark, landing, table, SCHEMA, trigger_once=True, name=f"t{os.getpid()}a")
    q.awaitTermination(120)
    land(landing, "b.json", [dict(base, station_id="s1", date="2024-01-01", pm25=7.0, ts=3)])
    q = start_aqi_ingest(spark, landing, table, SCHEMA, trigger_once=True, name=f"t{os.getpid()}a")
    q.awaitTermination(120)
    got = sorted((r.station_id, str(r.date), r.pm25) for r in spark.read.parquet(table).collect())
    assert got == [("s1", "2024-01-01", 7.0), ("s2", "2024-01-02", 5.0)]


def test_daily_means_stream_with_watermark(spark, scratch):
    from decimal import Decimal

    from wardpulse.streaming.ingest import daily_city_means
    landing = f"{scratch}/readings"
    land(landing, "a.json", [{"station_id": 1, "ts": "2024-01-01T05:00:00", "pm25": "10.00"},
                             {"station_id": 1, "ts": "2024-01-01T09:00:00", "pm25": "11.01"},
                             {"station_id": 2, "ts": "2024-01-02T09:00:00", "pm25": "30.00"},
                             {"station_id": 2, "ts": "2024-01-05T09:00:00", "pm25": "1.00"}])
    src = spark.readStream.schema("station_id long, ts timestamp, pm25 decimal(8,2)").json(landing)
    cities = spark.createDataFrame([(1, "A"), (2, "B")], "station_id long, city string")
    name = f"daily_{os.getpid()}"
    q = (daily_city_means(src, cities, watermark="1 day").writeStream.outputMode("append")
         .format("memory").queryName(name).start())
    q.processAllAvailable()
    q.processAllAvailable()
    q.stop()
    got = sorted((r.city, str(r.day), r.avg_pm25, r.n_readings) for r in spark.table(name).collect())
    # the 2024-01-05 window is still open (watermark 2024-01-04 09:00)
    assert got == [("A", "2024-01-01", Decimal("10.51"), 2), ("B", "2024-01-02", Decimal("30.00"), 1)]


def test_complaint_stream_keeps_first_seen_date(spark, scratch):
    from wardpulse.streaming.ingest import start_complaint_ingest
    landing, table = f"{scratch}/complaints", f"{scratch}/civic"
    schema = ("city string, complaint_id string, category string, status string, description string, "
              "latitude double, longitude double, date_filed date, scraped_at long")
    land(landing, "a.json", [{"city": "Bengaluru", "complaint_id": "c1", "category": "Roads", "status": "Open",
                              "description": "pothole", "latitude": 12.9, "longitude": 77.6,
                              "date_filed": "2024-01-01", "scraped_at": 1}])
    q = start_complaint_ingest(spark, landing, table, schema, trigger_once=True, name=f"c{os.getpid()}")
    q.awaitTermination(120)
    land(landing, "b.json", [{"city": "Bengaluru", "complaint_id": "c1", "category": "Roads", "status": "Closed",
                              "description": "fixed", "latitude": 12.9, "longitude": 77.6,
                              "date_filed": "2024-02-01", "scraped_at": 2}])
    q = start_complaint_ingest(spark, landing, table, schema, trigger_once=True, name=f"c{os.getpid()}")
    q.awaitTermination(120)
    rows = spark.read.parquet(table).collect()
    assert [(r.status, r.description, str(r.date_filed)) for r in rows] == [("Closed", "fixed", "2024-01-01")]


def _complaints(spark, scratch, name, table, **options):
    from wardpulse.streaming.ingest import start_complaint_ingest
    schema = ("city string, complaint_id string, category string, status string, description string, "
              "latitude double, longitude double, date_filed date, scraped_at long")
    q = start_complaint_ingest(spark, f"{scratch}/complaints", table, schema, trigger_once=True, name=name,
                               versioned=True, **options)
    q.awaitTermination(120)
    assert q.exception() is None


def _complaint(i, status, at, **more):
    return {"city": "Bengaluru", "complaint_id": f"c{i}", "category": "Roads", "status": status, "description": "d",
            "latitude": 12.9, "longitude": 77.6, "date_filed": f"2024-01-{at:02d}", "scraped_at": at, **more}


def test_versioned_complaint_stream_rewrites_only_changed_buckets(spark, scratch):
    """Stale, repeated and unchanged records reach no bucket; a change rewrites its own."""
    from wardpulse.operators.versioned import VersionedTable
    landing, path, name = f"{scratch}/complaints", f"{scratch}/civic", f"v{os.getpid()}"
    table = VersionedTable(spark, path)
    land(landing, "a.json", [_complaint(i, "Open", 1) for i in range(60)])
    _complaints(spark, scratch, name, path, buckets=32)
    first = table.state()
    assert len(first["folders"]) > 20 and table.read().count() == 60
    land(landing, "b.json", [_complaint(7, "Closed", 3), _complaint(7, "Pending", 2), _complaint(8, "Closed", 0),
                             *[_complaint(i, "Open", 5) for i in range(20, 60)]])
    _complaints(spark, scratch, name, path, buckets=32)
    now = table.state()
    changed = [f for f in now["folders"] if now["folders"][f] != first["folders"].get(f)]
    assert len(changed) == 1                       # complaint 7's bucket, of more than twenty
    rows = {r.complaint_id: (r.status, str(r.date_filed)) for r in table.read().collect()}
    assert len(rows) == 60 and rows["c7"] == ("Closed", "2024-01-01") and rows["c8"] == ("Open", "2024-01-01")


def test_replayed_micro_batch_gives_the_same_table(spark, scratch):
    """The stream's own progress is lost after the commit: the batch runs again."""
    from wardpulse.operators.versioned import VersionedTable
    from wardpulse.streaming.ingest import COMPLAINT_UPDATE, commit_batch
    path = f"{scratch}/civic"
    body = commit_batch(spark, path, "s", ["city", "complaint_id"], COMPLAINT_UPDATE, ["city"], ["scraped_at"])
    frame = lambda *rows: spark.createDataFrame(list(rows))
    table = VersionedTable(spark, path)
    body(frame(_complaint(1, "Open", 1), _complaint(2, "Open", 1)), 0)
    body(frame(_complaint(1, "Closed", 2)), 1)
    before, version = sorted(map(str, table.read().collect())), table.state()["version"]
    body(frame(_complaint(1, "Closed", 2)), 1)
    body(frame(_complaint(1, "Open", 1), _complaint(2, "Open", 1)), 0)      # would set complaint 1 back
    assert sorted(map(str, table.read().collect())) == before and table.state()["version"] == version


def test_versioned_aqi_stream(spark, scratch):
    from wardpulse.operators.versioned import VersionedTable
    landing, path = f"{scratch}/landing", f"{scratch}/aqi"
    base = {"pm10": 1.0, "no2": 1.0, "so2": 1.0, "aqi": 10}
    for n, recs in (("a", [("s1", "2024-01-01", 1.0, 1), ("s1", "2024-01-01", 2.0, 2), ("s2", "2024-01-02", 5.0, 1)]),
                    ("b", [("s1", "2024-01-01", 7.0, 3)])):
        land(landing, f"{n}.json", [dict(base, station_id=s, date=d, pm25=v, ts=t) for s, d, v, t in recs])
        q = start_aqi_ingest(spark, landing, path, SCHEMA, trigger_once=True, name=f"va{os.getpid()}", versioned=True)
        q.awaitTermination(120)
    got = sorted((r.station_id, str(r.date), r.pm25) for r in VersionedTable(spark, path).read().collect())
    assert got == [("s1", "2024-01-01", 7.0), ("s2", "2024-01-02", 5.0)]
