"""File sources: ward GeoJSON (SRC-1, G-6), GTFS text files (SRC-2/3/14),
census CSV (SRC-4). Header work happens on the schema in the driver; rows
are only ever touched by executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardpulse import config as C
from wardpulse.functions.numeric import round_ratio
from wardpulse.functions.text import normalize_header, title_case
from wardpulse.operators.quality import required_columns

# ----------------------------------------------------------------- SRC-4 census
CENSUS_TYPES = {
    "ward_name": "string", "ward_number": "bigint", "population": "bigint",
    "male_population": "bigint", "female_population": "bigint", "area_sqkm": "decimal(10,4)",
    "density": "decimal(10,2)", "literacy_rate": "decimal(5,2)", "male_literacy": "decimal(5,2)",
    "female_literacy": "decimal(5,2)", "household_size": "decimal(5,2)",
    "total_households": "bigint", "year": "bigint",
}


def normalize_census_columns(df: DataFrame) -> DataFrame:
    """S-27 lower/trim, space and hyphen to underscore, then the 12 aliases."""
    names = [normalize_header(c) for c in df.columns]
    names = [C.CENSUS_ALIASES.get(n, n) for n in names]
    return df.toDF(*names)


def load_census(df: DataFrame, year_override: int | None = None) -> DataFrame:
    """SRC-4 rules on a census frame: aliases, required-column check (Q-8),
    optional columns as NULL, casts (bad values -> NULL), density from
    population / area only when every density is NULL (S-36), names stripped
    and title-cased, rows without a name or a population dropped (P-8)."""
    df = normalize_census_columns(df)
    required_columns(df.columns, C.CENSUS_REQUIRED, year_override)
    if year_override:
        df = df.withColumn("year", F.lit(year_override))
    for c in C.CENSUS_OPTIONAL:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None))
    df = df.select(*[F.col(c).cast("string").try_cast(t).alias(c) if c != "ward_name"
                     else F.col(c).cast("string").alias(c)
                     for c, t in CENSUS_TYPES.items()])
    no_density = df.select(F.count("density")).scalar() == 0
    fill = F.when(no_density & F.col("area_sqkm").isNotNull() & (F.col("area_sqkm") > 0),
                  round_ratio(F.col("population"), F.col("area_sqkm"), 2, 0, precision=10, den_scale=4))
    df = df.withColumn("density", F.coalesce(fill, F.col("density")))
    df = df.withColumn("ward_name", title_case(F.trim(F.col("ward_name"))))
    return df.where(F.col("ward_name").isNotNull() & F.col("population").isNotNull())


def read_census_csv(spark: SparkSession, path: str, year_override: int | None = None) -> DataFrame:
    raw = (spark.read.option("header", True).option("encoding", "UTF-8")
           .csv(path))
    raw = raw.toDF(*[c.lstrip("﻿") for c in raw.columns])      # BOM
    return load_census(raw, year_override)


# ----------------------------------------------------------------- SRC-2/3 GTFS
def read_gtfs_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A GTFS text file, every column a string (no type inference: '001' stays '001')."""
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    df = df.toDF(*[c.lower().strip() for c in df.columns])
    return df.select(*columns) if columns else df


def read_stop_times(spark: SparkSession, gtfs_dir: str) -> DataFrame | None:
    """SRC-3 stop_times with only the columns used; None when the file is missing."""
    from wardpulse.operators.sinks import _exists
    path = f"{gtfs_dir}/stop_times.txt"
    if not _exists(spark, path):
        return None
    return read_gtfs_table(spark, path, ["trip_id", "stop_id"])


def read_trips(spark: SparkSession, gtfs_dir: str) -> DataFrame | None:
    from wardpulse.operators.sinks import _exists
    path = f"{gtfs_dir}/trips.txt"
    if not _exists(spark, path):
        return None
    return read_gtfs_table(spark, path, ["trip_id", "route_id"])


def first_stop_per_id(stops: DataFrame, order: str = "_line") -> DataFrame:
    """SRC-14 keep the first row per stop_id (first in file order) with a point."""
    from wardpulse.operators.sinks import dedup_first
    from wardpulse.functions.geo import point
    s = stops.withColumn("_line", F.monotonically_increasing_id()) if order == "_line" else stops
    first = dedup_first(s, ["stop_id"], [order]).drop("_line")
    return first.withColumn("geom", point(F.col("longitude").try_cast("double"),
                                          F.col("latitude").try_cast("double")))


# ----------------------------------------------------------------- SRC-1 / G-6 wards
_COORDS = "array<array<array<array<double>>>>"


# The ward file's properties, in order of preference.
WARD_NAME_PROPERTIES = ("proposed_ward_name_en", "name_en")
WARD_NUMBER_PROPERTY, WARD_AREA_PROPERTY = "id", "ward_area"


def wards_from_features(features: DataFrame, city: str | None = None) -> DataFrame:
    """SRC-1 one row per GeoJSON Feature (``properties`` map, ``geometry`` as JSON
    text) -> wards of ``city`` with rings and bbox. The name is the first
    non-empty of the name properties, else 'unknown'; the number is the whole
    part of the id, else 0; an area that is no number is 0; zone 'unknown'.
    A Polygon is wrapped as a one-part MultiPolygon."""
    props = F.col("properties")
    name = F.coalesce(*[F.nullif(props[p], F.lit("")) for p in WARD_NAME_PROPERTIES], F.lit("unknown"))
    num = F.coalesce(props[WARD_NUMBER_PROPERTY].try_cast("double").try_cast("int"), F.lit(0))
    area = F.coalesce(props[WARD_AREA_PROPERTY].try_cast("double"), F.lit(0.0))
    gtype = F.get_json_object(F.col("geometry"), "$.type")
    coords = F.get_json_object(F.col("geometry"), "$.coordinates")
    multi = F.when(gtype == "Polygon", F.from_json(F.concat(F.lit("["), coords, F.lit("]")), _COORDS)) \
             .otherwise(F.from_json(coords, _COORDS))
    rings = F.flatten(F.transform(multi, lambda poly: F.transform(
        poly, lambda ring: F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))))
    out = features.select(name.alias("ward_name"), num.alias("ward_number"), area.alias("area_sqkm"),
                          F.lit(city).cast("string").alias("city"), F.lit("unknown").alias("zone_name"), rings.alias("rings"))
    pts = F.flatten(F.col("rings"))
    return out.select("*", F.array_min(F.transform(pts, lambda p: p["x"])).alias("min_x"),
                      F.array_min(F.transform(pts, lambda p: p["y"])).alias("min_y"),
                      F.array_max(F.transform(pts, lambda p: p["x"])).alias("max_x"),
                      F.array_max(F.transform(pts, lambda p: p["y"])).alias("max_y"))


def read_ward_geojson(spark: SparkSession, path: str, newline_delimited: bool = False,
                      city: str | None = None) -> DataFrame:
    """A FeatureCollection file (multiLine JSON, one file per task) or
    newline-delimited Features (splittable, for large inputs)."""
    schema = "type string, properties map<string,string>, geometry string"
    if newline_delimited:
        feats = spark.read.schema(schema).json(path)
    else:
        fc = spark.read.option("multiLine", True).schema(
            f"features array<struct<{schema.replace(' string', ':string').replace(' map', ':map')}>>").json(path)
        feats = fc.select(F.explode("features").alias("f")).select("f.*")
    return wards_from_features(feats, city)


def ward_key(city: Column, ward_number: Column, ward_name: Column) -> Column:
    """D-12 upsert key of a ward: (city, ward_number), number 0 falls back to the name."""
    return F.struct(city.alias("city"),
                    F.when(ward_number != 0, ward_number.cast("string"))
                     .otherwise(F.lower(F.trim(ward_name))).alias("k"))


def upsert_wards(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """SNK-9 ward upsert keyed by (city, ward_number), a number of 0 keyed by the
    name instead (D-12); name, zone, area and geometry follow the batch. The
    ward_id of a matched ward is kept; new wards get xxhash64 of their key
    (stable across runs, unlike a sequence or monotonically_increasing_id)."""
    from wardpulse.operators.sinks import upsert
    k = lambda df: df.withColumn("_wkey", ward_key(F.col("city"), F.col("ward_number"), F.col("ward_name")))
    b = k(batch)
    b = b.withColumn("ward_id", F.xxhash64("_wkey.city", "_wkey.k")) if "ward_id" not in batch.columns else b
    e = k(existing)
    cols = [c for c in e.columns]
    upd = [c for c in ("ward_name", "zone_name", "area_sqkm", "rings", "min_x", "min_y", "max_x", "max_y")
           if c in cols]
    out = upsert(e, b.select(*cols), ["_wkey"], upd)
    return out.drop("_wkey")
