"""The checked keys exercise their operators: their oracle results are not empty,
not unfiltered and not all NULL (sf0.01, DuckDB only)."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def ask():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sql = E.oracle_sql()
    return lambda key, what: con.execute(f"SELECT {what} FROM ({sql[key]})").fetchone()


def test_stops_are_kept_and_dropped(ask):
    kept, sources = ask("q_gtfs_stops", "count(*), count(DISTINCT source)")
    assert 0 < kept < 2000 and sources == 6
    assert ask("q_bbox_filter", "count(DISTINCT city), count(*) FILTER (WHERE inside) > 0, count(*) FILTER (WHERE NOT inside) > 0") \
        == (3, True, True)


def test_composites_fall_back(ask):
    n, back = ask("q_ndvi_composite", "count(*), count(*) FILTER (WHERE is_fallback)")
    assert 0 < back < n


def test_one_mart_row_per_ward_year(ask):
    n, keys, aqi = ask("q_mart", "count(*), count(DISTINCT (ward_id, year)), count(avg_aqi)")
    assert n == keys and 0 < aqi
    n, keys, whole = ask("q_scores", "count(*), count(DISTINCT (ward_id, year, month)), count(composite_score)")
    assert n == keys and 0 < whole


def test_semi_join_and_census_drop_rows(ask):
    kept, = ask("q_semi_join", "count(*)")
    assert 0 < kept < 60000
    rows, filled, empty = ask("q_census_clean", "count(*), count(density), count(*) FILTER (WHERE density IS NULL)")
    assert 0 < rows < 700 and filled > 0 and empty > 0


def test_every_kind_of_rule_fails_somewhere(ask):
    kinds, = ask("q_dq_report", "list_sort(list(DISTINCT check_name) FILTER (WHERE failures > 0))")
    assert kinds == ["accepted_values", "check", "not_null", "relationships", "unique"]
    assert ask("q_dq_report", "count(*)") == (21,)


def test_orders_are_part_of_the_values(ask):
    assert ask("q_city_scores", "max(place_in_city) > 7, count(*) = count(place_in_city)") == (True, True)
    assert ask("q_ward_history", "max(place_in_ward)") == (7,)
