"""SRC-5/F-1 crime report tables to long rows, and the long <-> wide pivots.

Input: one row per extracted table, ``cells: array<array<string>>`` (row 0 is
the header) with ``source_pdf``, ``page_number`` and ``year``. The header is
searched with higher-order functions (city column, state column, first header
matching each category's keywords), rows are exploded with their position,
and (category, column index) pairs are exploded once more: an unpivot that
stays JVM-side and parallel over tables and rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardpulse import config as C
from wardpulse.functions.text import clean_text, is_target_city, normalize_city, parse_count


def _first_index(headers: Column, terms: Sequence[str]) -> Column:
    """0-based index of the first header containing any term, else NULL."""
    idx = F.array_position(
        F.transform(headers, lambda h: F.exists(F.array(*[F.lit(t) for t in terms]),
                                                lambda t: F.contains(h, t))),
        F.lit(True))
    return F.when(idx > 0, (idx - 1).cast("int"))


def parse_crime_tables(tables: DataFrame, target_city: str | None = "bengaluru",
                       offenses: Mapping[str, Sequence[str]] = C.TARGET_OFFENSES) -> DataFrame:
    """Long rows: state, city, year, offense_category, offense_type, count,
    source_pdf, page_number. Tables with fewer than 2 rows, no city column or
    no offense column give none; rows whose count does not parse are skipped."""
    hdr = F.transform(F.col("cells")[0], lambda h: F.lower(clean_text(h)))
    t = (tables.where(F.size("cells") >= 2)
         .withColumn("_h", hdr)
         .withColumn("_city_ix", _first_index(F.col("_h"), ["city", "cities", "name of city"]))
         .withColumn("_state_ix", _first_index(F.col("_h"), ["state", "state/ut"]))
         .withColumn("_cats", F.filter(F.array(*[
             F.struct(F.lit(cat).alias("cat"), _first_index(F.col("_h"), kws).alias("ix"))
             for cat, kws in offenses.items()]), lambda s: s["ix"].isNotNull()))
         .where(F.col("_city_ix").isNotNull() & (F.size("_cats") > 0)))
    rows = (t.select("*", F.posexplode(F.slice(F.col("cells"), 2, F.size("cells"))).alias("_rn", "_row"))
            .where(F.col("_row").isNotNull() & (F.size("_row") > F.col("_city_ix"))))
    rows = rows.withColumn("_city", clean_text(F.col("_row")[F.col("_city_ix")]))
    rows = rows.where((F.col("_city") != "") & is_target_city(F.col("_city")))
    state = F.when(F.col("_state_ix").isNotNull() & (F.col("_state_ix") < F.size("_row")),
                   F.nullif(clean_text(F.col("_row")[F.col("_state_ix")]), F.lit("")))
    cells = rows.select("*", state.alias("_state"), F.explode("_cats").alias("_c"))
    cells = cells.where(F.col("_c.ix") < F.size("_row")) \
                 .withColumn("_cnt", parse_count(F.col("_row")[F.col("_c.ix")])) \
                 .where(F.col("_cnt").isNotNull())
    out = cells.select(F.coalesce(F.col("_state"), F.lit(C.DEFAULT_STATE)).alias("state"),
                       normalize_city(F.col("_city")).alias("city"),
                       F.col("year").cast("int").alias("year"),
                       F.col("_c.cat").alias("offense_category"), F.col("_c.cat").alias("offense_type"),
                       F.col("_cnt").alias("count"), "source_pdf", "page_number")
    if target_city:
        out = out.where(F.lower(F.col("city")).contains(target_city.lower()))
    return out


def report_year(file_name: Column, default: int = C.DEFAULT_CRIME_YEAR) -> Column:
    """SRC-6 year from ``(20\\d{2})`` in a report's file name, else the default."""
    y = F.regexp_extract(file_name, "(20\\d{2})", 1)
    return F.when(y != "", y.cast("int")).otherwise(F.lit(default))


def unpivot_counts(wide: DataFrame, keys: Sequence[str], columns: Mapping[str, str],
                   name: str = "offense_category", value: str = "count") -> DataFrame:
    """Wide per-category columns back to long rows (one per key and category)."""
    pairs = F.array(*[F.struct(F.lit(cat).alias("k"), F.col(col).cast("bigint").alias("v"))
                      for cat, col in columns.items()])
    return (wide.select(*keys, F.explode(pairs).alias("_p"))
            .select(*keys, F.col("_p.k").alias(name), F.col("_p.v").alias(value)))
