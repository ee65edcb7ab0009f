"""Feed normalisation jobs (F-2, F-5, F-7, F-8, SRC-2, SRC-3) over DataFrames.

The reference runs these per record in Python (HTTP payloads, pandas frames,
Earth Engine); here each is a Spark job over a table of landed inputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardpulse import config as C
from wardpulse.functions import geo
from wardpulse.functions.text import safe_float, safe_int, source_city

# ------------------------------------------------------------ F-2 AQI payloads
# fixed values: primary key -> alternate key of the station payloads
AQI_FIELDS = [("pm25", "PM2.5"), ("pm10", "PM10"), ("no2", "NO2"), ("so2", "SO2"),
              ("co", "CO"), ("o3", "Ozone"), ("aqi", "AQI")]


def _get(m: Column, key: str, alt: str) -> Column:
    """Python's ``record.get(key, record.get(alt))``: a key that is present wins,
    even when its value is null."""
    return F.when(F.map_contains_key(m, F.lit(key)), m[key]).otherwise(m[alt])


def parse_aqi_payloads(df: DataFrame, payload: str = "payload") -> DataFrame:
    """One reading per payload: ``records`` if that key is present, else ``data``;
    a list gives its first element (an object, else an empty record), an object
    gives itself, anything else (or an empty list) no row."""
    top = F.from_json(F.col(payload), "map<string,string>")
    df = df.withColumn("_top", top)
    rd = F.when(F.map_contains_key(F.col("_top"), F.lit("records")), F.col("_top")["records"]) \
          .otherwise(F.coalesce(F.col("_top")["data"], F.lit("[]")))
    df = df.withColumn("_rd", F.trim(rd))
    arr = F.from_json(F.col("_rd"), "array<string>")
    first = arr[0]
    is_list = F.col("_rd").startswith("[")
    rec_text = (F.when(is_list & (F.size(arr) > 0),
                       F.when(F.trim(first).startswith("{"), first).otherwise(F.lit("{}")))
                .when(F.col("_rd").startswith("{"), F.col("_rd")))
    df = df.withColumn("_rec", F.from_json(rec_text, "map<string,string>")).where(F.col("_rec").isNotNull())
    vals = {k: _get(F.col("_rec"), k, alt) for k, alt in AQI_FIELDS}
    pol = F.when(F.map_contains_key(F.col("_rec"), F.lit("prominent_pollutant")),
                 F.col("_rec")["prominent_pollutant"]) \
           .otherwise(F.coalesce(F.col("_rec")["predominant"], F.lit("")))
    keep = [c for c in df.columns if c not in ("_top", "_rd", "_rec")]
    return df.select(*keep,
                     *[safe_float(vals[k]).alias(k) for k, _ in AQI_FIELDS if k != "aqi"],
                     safe_int(vals["aqi"]).alias("aqi"), pol.alias("prominent_pollutant"))


def stations_frame(spark) -> DataFrame:
    """SRC-11 station master (14 fixed stations, three cities)."""
    return spark.createDataFrame(C.STATIONS, "station_id string, station_name string, "
                                             "latitude double, longitude double, city string")


# ------------------------------------------------------------ F-8 coverage
def aqi_coverage(readings: DataFrame, start: Column, end: Column,
                 station_col: str = "station_id", date_col: str = "date") -> DataFrame:
    """Station x day spine over [start, end] left-joined to the readings:
    days expected, days with a reading, days missing, per station."""
    days = readings.select(station_col, F.col(date_col).alias("_d")).distinct()
    spine = (readings.select(station_col).distinct()
             .select(station_col, F.explode(F.sequence(start, end)).alias("_d")))
    j = spine.join(days.withColumn("_has", F.lit(1)), [station_col, "_d"], "left")
    return (j.groupBy(station_col)
            .agg(F.count(F.lit(1)).alias("days_expected"),
                 F.count("_has").alias("days_with_reading"))
            .withColumn("days_missing", F.col("days_expected") - F.col("days_with_reading")))


# ------------------------------------------------------------ SRC-2 / F-7 GTFS
def parse_gtfs_stops(raw: DataFrame, source: str | Column = "BMTC", bbox_filter: bool = True) -> DataFrame:
    """SRC-2 stops.txt rows (all strings) -> stops: lower/trim headers, lat/lon
    renamed and coerced (bad -> NULL), inside the source city's box, defaults
    for stop_desc and zone_id. ``source`` may be a column (many feeds at once)."""
    df = raw.toDF(*[c.lower().strip() for c in raw.columns])
    df = df.withColumnRenamed("stop_lat", "latitude").withColumnRenamed("stop_lon", "longitude")
    missing = [c for c in ("stop_id", "stop_name", "latitude", "longitude") if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required GTFS columns: {missing}")
    src = F.lit(source) if isinstance(source, str) else source
    df = (df.withColumn("stop_id", F.trim(F.col("stop_id").cast("string")))
            .withColumn("stop_name", F.trim("stop_name"))
            .withColumn("latitude", F.col("latitude").cast("string").try_cast("double"))
            .withColumn("longitude", F.col("longitude").cast("string").try_cast("double"))
            .withColumn("source", src))
    if bbox_filter:
        df = df.withColumn("_city", source_city(F.col("source")))
        boxes = df.sparkSession.createDataFrame(
            [(c, b["west"], b["south"], b["east"], b["north"]) for c, b in C.CITY_BBOXES.items()],
            "_city string, west double, south double, east double, north double")
        df = (df.join(F.broadcast(boxes), "_city", "left")      # 3-row constant table
              .where(F.coalesce(geo.in_bbox(F.col("longitude"), F.col("latitude"), F.col("west"),
                                            F.col("south"), F.col("east"), F.col("north")), F.lit(False)))
              .drop("_city", "west", "south", "east", "north"))
    desc = F.coalesce(F.col("stop_desc"), F.lit("")) if "stop_desc" in df.columns else F.lit("")
    zone = F.col("zone_id").cast("string") if "zone_id" in df.columns else F.lit("")
    return df.withColumn("stop_desc", desc).withColumn("zone_id", zone)


def route_frequency(stop_times: DataFrame, trips: DataFrame | None) -> DataFrame:
    """F-7 per stop: distinct routes (distinct trips when there is no trips
    table) and the count of stop_times rows (the reference's avg_frequency)."""
    st = stop_times.select("trip_id", "stop_id").where(F.col("stop_id").isNotNull())
    if trips is not None:
        st = st.join(trips.select("trip_id", "route_id"), "trip_id", "left")
        unit = "route_id"
    else:
        st = st.withColumn("route_id", F.col("trip_id"))
        unit = "route_id"
    # two stages: per (stop, route) then per stop -- distinct count without Expand
    s1 = st.groupBy("stop_id", unit).agg(F.count("trip_id").alias("_n"))
    return (s1.groupBy("stop_id")
            .agg(F.count(unit).alias("route_count"), F.sum("_n").alias("avg_frequency"))
            .withColumn("stop_id", F.col("stop_id").cast("string")))


def enrich_stops(stops: DataFrame, freq: DataFrame | None) -> DataFrame:
    """J-12 stops LEFT JOIN frequency, missing -> 0 (S-35)."""
    if freq is None:
        return stops.withColumn("route_count", F.lit(0)).withColumn("avg_frequency", F.lit(0).cast("decimal(8,2)"))
    s = stops.withColumn("_sid", F.col("stop_id").cast("string"))
    f = freq.withColumnRenamed("stop_id", "_sid")
    return (s.join(f, "_sid", "left").drop("_sid")
            .withColumn("route_count", F.coalesce(F.col("route_count"), F.lit(0)).cast("int"))
            .withColumn("avg_frequency", F.coalesce(F.col("avg_frequency"), F.lit(0)).cast("decimal(8,2)")))


# ------------------------------------------------------------ F-5 NDVI composite
def normalized_difference(b8: Column, b4: Column) -> Column:
    """S-37 (B8 - B4) / (B8 + B4), NULL when the sum is 0."""
    return F.try_divide(b8 - b4, b8 + b4)


def ndvi_composite(obs: DataFrame, pixel=("x", "y"), fallback_months: int | None = None) -> DataFrame:
    """Monthly per-pixel median NDVI composite.

    ``obs``: one row per (scene, pixel): pixel columns, year, month, scene,
    cloud (scene cloud percent), scl (class), b4, b8. Mask P-7 (SCL not in
    3/8/9/10; scene cloud < 30); a month whose mean scene cloud is over 80 or
    has no scene takes the newest usable month before it (S-39), at most
    ``fallback_months`` back if that is given, else no composite (D-11). The
    months asked for are all from the first observed to the last.

    With a ``city`` column every city has scenes, month means, usable months and
    a fallback of its own; all are asked for the same months. Rows without a city
    are in no city's box and so in no composite.
    """
    pixel = list(pixel)
    by = ["city"] if "city" in obs.columns else []
    if by:
        obs = obs.where("city is not null")
    mi = (F.col("year") * 12 + F.col("month") - 1).alias("_mi")
    scenes = obs.select(*by, "year", "month", "scene", "cloud").distinct()
    month_cloud = scenes.groupBy(*by, mi).agg(F.avg("cloud").alias("_mean_cloud"))   # A-19
    usable = month_cloud.where(F.col("_mean_cloud") <= C.MONTH_CLOUD_MAX).select(*by, "_mi")
    kept = (obs.where(~F.col("scl").isin(*C.SCL_MASKED) & (F.col("cloud") < C.SCENE_CLOUD_MAX))
            .withColumn("_mi", (F.col("year") * 12 + F.col("month") - 1))
            .join(usable, [*by, "_mi"], "left_semi")
            .withColumn("ndvi", normalized_difference(F.col("b8").cast("double"), F.col("b4").cast("double"))))
    # a pixel's group is its scenes of one month: a plain aggregate
    comp = kept.groupBy(*by, *pixel, "_mi").agg(F.percentile("ndvi", 0.5).alias("ndvi")).where("ndvi is not null")
    # every calendar month -> newest usable month <= it, within the window
    span = (obs.select(*by, mi).agg(F.min("_mi").alias("a"), F.max("_mi").alias("b"),
                                    *[F.collect_set(c).alias(c) for c in by]).where("a is not null"))
    for c in by:    # one row for each city
        span = span.withColumn(c, F.explode(c))
    months = span.select(*by, F.explode(F.sequence("a", "b")).alias("_mi"))
    have = usable.withColumn("_src", F.col("_mi"))
    far = Window.unboundedPreceding if fallback_months is None else -fallback_months
    w = (Window.partitionBy(*by).orderBy("_mi") if by else Window.orderBy("_mi")).rangeBetween(far, 0)
    src = (months.join(have, [*by, "_mi"], "left")
           .withColumn("_src", F.last("_src", ignorenulls=True).over(w)))
    # the month table is tiny (one row per calendar month), the global window is fine
    res = comp.withColumnRenamed("_mi", "_src").join(F.broadcast(src), [*by, "_src"])
    return res.select(*by, *pixel, (F.floor(F.col("_mi") / 12)).cast("int").alias("year"),
                      ((F.col("_mi") % 12) + 1).cast("int").alias("month"),
                      "ndvi", (F.col("_src") != F.col("_mi")).alias("is_fallback"))


def ndvi_by_ward(composite: DataFrame, wards: DataFrame, x: str = "longitude", y: str = "latitude") -> DataFrame:
    """F-6 a composite's pixels placed in the wards, then statistics per ward and
    month; a pixel in no ward counts nowhere."""
    from wardpulse.operators.spatial import points_in_polygons
    from wardpulse.plans.staging import zonal_stats
    pixels = composite.withColumn("ndvi", F.col("ndvi").cast("decimal(12,6)").cast("decimal(6,4)"))
    return zonal_stats(points_in_polygons(pixels, wards, x, y, how="inner"))
