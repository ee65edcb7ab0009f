"""The partition-rewriting writers on existing tables: NULL and escaped
partition values, emptied partitions, rebuilds with fewer partitions."""

import pytest
from pyspark.sql import functions as F

from wardpulse.operators.sinks import rebuild, write_insert_ignore, write_replace_where, write_upsert

SCHEMA = "id int, p string, v int"


def _table(spark, path, rows):
    rebuild(spark.createDataFrame(rows, SCHEMA), path, ["p"])


def _read(spark, path):
    return sorted([(r.id, r.p, r.v) for r in spark.read.schema(SCHEMA).parquet(path).collect()], key=repr)


def _sorted(rows):
    return sorted(rows, key=repr)


def test_replace_rows_within_one_partition(spark, scratch):
    path = f"{scratch}/t"
    _table(spark, path, [(1, "a", 1), (2, "a", 1), (3, "b", 1)])
    write_replace_where(spark, path, spark.createDataFrame([(9, "a", 9)], SCHEMA), F.col("id") == 1, ["p"])
    assert _read(spark, path) == _sorted([(9, "a", 9), (2, "a", 1), (3, "b", 1)])


@pytest.mark.parametrize("value", ["x:y/z", "50%", "a=b", "plain", None])
def test_replace_keeps_and_empties_odd_partitions(spark, scratch, value):
    path = f"{scratch}/t"
    _table(spark, path, [(1, value, 1), (2, value, 2), (3, "b", 3)])
    empty = spark.createDataFrame([], SCHEMA)
    write_replace_where(spark, path, empty, F.col("id") == 1, ["p"])
    assert _read(spark, path) == _sorted([(2, value, 2), (3, "b", 3)])
    write_replace_where(spark, path, empty, F.col("id") == 2, ["p"])
    assert _read(spark, path) == [(3, "b", 3)]


def test_replace_on_partition_predicate(spark, scratch):
    path = f"{scratch}/t"
    _table(spark, path, [(1, "a", 1), (2, "b", 1), (3, None, 1)])
    write_replace_where(spark, path, spark.createDataFrame([(7, None, 7)], SCHEMA), F.col("p") == "a", ["p"])
    assert _read(spark, path) == _sorted([(2, "b", 1), (3, None, 1), (7, None, 7)])


def test_upsert_keeps_null_partition_rows(spark, scratch):
    path = f"{scratch}/t"
    _table(spark, path, [(1, "a", 1), (2, None, 1), (3, None, 1)])
    write_upsert(spark, path, spark.createDataFrame([(1, "a", 5), (4, None, 4)], SCHEMA), ["p", "id"], ["v"], ["p"])
    assert _read(spark, path) == _sorted([(1, "a", 5), (2, None, 1), (3, None, 1), (4, None, 4)])


def test_rebuild_drops_old_partitions_under_dynamic_default(spark, scratch):
    path = f"{scratch}/t"
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        _table(spark, path, [(1, "a", 1), (2, "b", 2)])
        _table(spark, path, [(9, "b", 9)])
        assert _read(spark, path) == [(9, "b", 9)]
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_insert_ignore_reads_touched_partitions_only(spark, scratch):
    path = f"{scratch}/t"
    _table(spark, path, [(1, "a", 1), (2, "b", 2)])
    write_insert_ignore(spark, path, spark.createDataFrame([(1, "a", 7), (2, "a", 8)], SCHEMA), ["p", "id"], ["p"])
    assert _read(spark, path) == _sorted([(1, "a", 1), (2, "b", 2), (2, "a", 8)])


def test_partition_values_that_look_like_numbers_or_dates_stay_strings(spark, scratch):
    """"01" is not 1, in each of the three writers."""
    rows = [(1, "01", 1), (2, "01", 2), (3, "2", 3), (4, "2024-01-05", 4)]
    for name, write, want in (
            ("upsert", lambda p, b: write_upsert(spark, p, b, ["p", "id"], ["v"], ["p"]),
             [(1, "01", 9), (2, "01", 2), (3, "2", 3), (4, "2024-01-05", 4), (5, "1", 5)]),
            ("ignore", lambda p, b: write_insert_ignore(spark, p, b, ["p", "id"], ["p"]),
             [(1, "01", 1), (2, "01", 2), (3, "2", 3), (4, "2024-01-05", 4), (5, "1", 5)]),
            ("replace", lambda p, b: write_replace_where(spark, p, b, F.col("p").isin("01", "1"), ["p"]),
             [(1, "01", 9), (3, "2", 3), (4, "2024-01-05", 4), (5, "1", 5)])):
        path = f"{scratch}/{name}"
        write_upsert(spark, path, spark.createDataFrame(rows, SCHEMA), ["p", "id"], ["v"], ["p"])
        batch = spark.createDataFrame([(1, "01", 9), (5, "1", 5)], SCHEMA)
        write(path, batch)
        assert _read(spark, path) == _sorted(want), name
        write(path, batch)          # a replay changes nothing
        assert _read(spark, path) == _sorted(want), name
