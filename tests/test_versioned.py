"""Versioned tables: atomic commits, stored types, replays, conflicts, vacuum; the
feeds' load policies and the run audit on top of them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wardpulse.operators.audit import RunAudit
from wardpulse.operators.versioned import ConflictError, VersionedTable
from wardpulse.plans.loads import load, raw

SCHEMA = "id int, p string, v int"


def _rows(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def _all(table, version=None):
    return sorted(map(tuple, table.read(version).collect()), key=repr)


def _key(rows):
    return sorted(rows, key=repr)


def test_modes_keep_types_nulls_and_untouched_folders(spark, scratch):
    t = VersionedTable(spark, f"{scratch}/t")
    assert t.state() is None and not t.exists()
    t.upsert(_rows(spark, [(1, "01", 1), (2, "1", 2), (3, None, 3), (4, "a/b=c", 4)]), ["p", "id"], ["v"], ["p"])
    first = t.state()["folders"]
    t.upsert(_rows(spark, [(1, "01", 9), (5, "01", 5)]), ["p", "id"], ["v"], ["p"])
    assert _all(t) == _key([(1, "01", 9), (5, "01", 5), (2, "1", 2), (3, None, 3), (4, "a/b=c", 4)])
    now = t.state()["folders"]
    assert [f for f in now if now[f] != first[f]] == ["p=01"]          # a share of the table
    t.insert_ignore(_rows(spark, [(2, "1", 7), (6, None, 6)]), ["p", "id"], ["p"])
    t.replace_where(_rows(spark, [], SCHEMA), F.col("p") == "a/b=c", ["p"])
    assert _all(t) == _key([(1, "01", 9), (5, "01", 5), (2, "1", 2), (3, None, 3), (6, None, 6)])
    t.replace_keys(_rows(spark, [(8, "01", 8)]), ["p"], ["p"])
    assert _all(t) == _key([(8, "01", 8), (2, "1", 2), (3, None, 3), (6, None, 6)])
    t.append(_rows(spark, [(9, "1", 9)]), ["p"])
    t.append(_rows(spark, []), ["p"])
    assert _all(t) == _key([(8, "01", 8), (2, "1", 2), (9, "1", 9), (3, None, 3), (6, None, 6)])
    t.rebuild(_rows(spark, [(1, "z", 1)]), ["p"])
    assert _all(t) == [(1, "z", 1)] and t.read().schema.simpleString() == "struct<id:int,p:string,v:int>"
    assert _all(t, 1) == _key([(1, "01", 1), (2, "1", 2), (3, None, 3), (4, "a/b=c", 4)])     # old versions stay
    t.vacuum()
    assert _all(t) == [(1, "z", 1)] and t.versions() == [t.state()["version"]]


def test_table_without_partitions_and_emptied_table(spark, scratch):
    t = VersionedTable(spark, f"{scratch}/t")
    t.rebuild(_rows(spark, [(1, "a", 1)]))
    t.append(_rows(spark, [(2, "b", 2)]))
    assert _all(t) == [(1, "a", 1), (2, "b", 2)]
    t.rebuild(_rows(spark, []))
    assert _all(t) == [] and t.read().columns == ["id", "p", "v"]
    with pytest.raises(FileNotFoundError):
        VersionedTable(spark, f"{scratch}/none").read()


def test_a_reader_never_sees_half_a_rewrite(spark, scratch, monkeypatch):
    """The writer dies after its files are written and before the switch."""
    t = VersionedTable(spark, f"{scratch}/t")
    before = [(i, p, 0) for i in range(5) for p in ("a", "b", "c")]
    t.upsert(_rows(spark, before), ["p", "id"], ["v"], ["p"])
    reader = t.read()                     # opened before the failing commit
    batch = _rows(spark, [(i, p, 1) for i in range(5) for p in ("a", "c")])

    def dies(self, state):
        raise RuntimeError("lost")
    monkeypatch.setattr(VersionedTable, "_switch", dies)
    with pytest.raises(RuntimeError):
        t.upsert(batch, ["p", "id"], ["v"], ["p"])
    monkeypatch.undo()
    assert _all(t) == sorted(before) == sorted(map(tuple, reader.collect()))
    t.upsert(batch, ["p", "id"], ["v"], ["p"])          # the retry
    assert sorted(map(tuple, reader.collect())) == sorted(before)       # still its own version
    assert _all(t) == sorted([(i, p, 0 if p == "b" else 1) for i in range(5) for p in ("a", "b", "c")])
    t.vacuum()
    assert len(t._names(f"{scratch}/t/data")) == 2      # the failed attempt's folder is gone
    assert _all(t) == sorted([(i, p, 0 if p == "b" else 1) for i in range(5) for p in ("a", "b", "c")])


def test_replayed_batches_and_conflicting_writers(spark, scratch, monkeypatch):
    t = VersionedTable(spark, f"{scratch}/t")
    t.append(_rows(spark, [(1, "a", 1)]), ["p"], ("s", 0))
    t.append(_rows(spark, [(1, "a", 1)]), ["p"], ("s", 0))              # replayed: an append must not double
    t.append(_rows(spark, [(2, "a", 2)]), ["p"], ("s", 1))
    t.append(_rows(spark, [(2, "a", 2)]), ["p"], ("other", 1))
    assert _all(t) == [(1, "a", 1), (2, "a", 2), (2, "a", 2)]
    stale = t.state()
    t.append(_rows(spark, [(3, "a", 3)]), ["p"])
    monkeypatch.setattr(VersionedTable, "state", lambda self, version=None: stale)
    with pytest.raises(ConflictError):
        t.append(_rows(spark, [(4, "a", 4)]), ["p"])
    monkeypatch.undo()
    assert _all(t) == [(1, "a", 1), (2, "a", 2), (2, "a", 2), (3, "a", 3)]


def test_load_policies(spark, scratch):
    crime = "city string, year int, offense_category string, count int"
    load(spark, scratch, "crime", _rows(spark, [("B", 2020, "theft", 1), ("B", 2021, "theft", 2), ("M", 2020, "theft", 3)], crime))
    load(spark, scratch, "crime", _rows(spark, [("B", 2020, "murder", 9)], crime))
    load(spark, scratch, "crime", _rows(spark, [], crime))              # a parse without rows empties nothing
    assert sorted(map(tuple, raw(spark, scratch, "crime").collect())) == [
        ("B", 2020, "murder", 9), ("B", 2021, "theft", 2), ("M", 2020, "theft", 3)]
    aqi = "station_id string, date date, pm25 double, pm10 double, no2 double, so2 double, aqi int, co double, ts long"
    d = dt.date(2024, 1, 1)
    load(spark, scratch, "aqi", _rows(spark, [("s", d, 1.0, 1.0, 1.0, 1.0, 1, 5.0, 1), ("s", d, 2.0, 1.0, 1.0, 1.0, 2, 6.0, 2)], aqi))
    load(spark, scratch, "aqi", _rows(spark, [("s", d, 3.0, 1.0, 1.0, 1.0, 3, 7.0, 3)], aqi))
    row = raw(spark, scratch, "aqi").first()
    assert (row.pm25, row.aqi, row.co) == (3.0, 3, 6.0)                # co keeps its first value
    load(spark, scratch, "aqi_manual", _rows(spark, [("s", d, 1.0, 1.0, 1.0, 1.0, 1, 5.0, 1)], aqi))
    load(spark, scratch, "aqi_manual", _rows(spark, [("s", d, 9.0, 1.0, 1.0, 1.0, 9, 9.0, 9)], aqi))
    assert raw(spark, scratch, "aqi_manual").first().pm25 == 1.0
    comp = "city string, complaint_id string, status string, description string, latitude double, longitude double, date_filed string, scraped_at long"
    load(spark, scratch, "complaints", _rows(spark, [("B", "c1", "Open", "x", 1.0, 1.0, "2024-01-01", 1)], comp))
    load(spark, scratch, "complaints", _rows(spark, [("B", "c1", "Closed", "y", 1.0, 1.0, "2024-02-01", 2)], comp))
    row = raw(spark, scratch, "complaints").first()
    assert (row.status, row.description, row.date_filed) == ("Closed", "y", "2024-01-01")
    for feed, key, schema in (("transit", "source", "source string, stop_id int"), ("property", "source", "source string, price int")):
        load(spark, scratch, feed, _rows(spark, [("a", 1), ("a", 2), ("b", 3)], schema))
        load(spark, scratch, feed, _rows(spark, [("a", 7)], schema))
        assert sorted(map(tuple, raw(spark, scratch, feed).collect())) == [("a", 7), ("b", 3)]
    ndvi = "ward_id int, city string, year int, month int, mean_ndvi double"
    load(spark, scratch, "ndvi", _rows(spark, [(1, "B", 2024, 1, 0.1), (2, "B", 2024, 1, 0.2), (3, "M", 2024, 1, 0.3)], ndvi))
    load(spark, scratch, "ndvi", _rows(spark, [(1, "B", 2024, 1, 0.9)], ndvi))
    assert sorted((r.ward_id, r.mean_ndvi) for r in raw(spark, scratch, "ndvi").collect()) == [(1, 0.9), (3, 0.3)]
    runs = RunAudit(spark, f"{scratch}/audit").state().collect()
    assert {r.status for r in runs} == {"success"} and len(runs) == 15 and all(r.finished_at >= r.started_at for r in runs)


def test_audit_records_a_failure(spark, scratch):
    bad = _rows(spark, [("B", "c1")], "city string, complaint_id string")
    with pytest.raises(Exception):
        load(spark, scratch, "complaints", bad)
    (run,) = RunAudit(spark, f"{scratch}/audit").state().collect()
    assert run.status == "failed" and run.error_message and run.started_at <= run.finished_at
    assert not VersionedTable(spark, f"{scratch}/raw/complaints").exists()
