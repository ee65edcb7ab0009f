"""Spark query vs DuckDB oracle on sf0.001 for a fast subset (the full gate
runs at sf0.01 via tools/check_oracle.py)."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tools.check_oracle import TABLES, digest

FAST = ["q_stg_complaints", "q_stg_crime", "q_stg_census", "q_or_join", "q_mode", "q_median",
        "q_point_in_ward", "q_ward_lookup", "q_nearest_metro", "q_upsert", "q_aqi_parse",
        "q_parse_price", "q_parse_date", "q_clean_text", "q_dq_report", "q_route_frequency",
        "q_stg_property", "q_fuzzy_ward", "q_ward_metro"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", FAST)
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert digest(df.columns, srows)[0] == digest(ocols, orows)[0]
