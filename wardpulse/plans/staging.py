"""Staging models M-1..M-7: one row per (ward, year) per feed.

Each model is a lazy function of reference-shaped DataFrames. Aggregates run
before joins (a feed is reduced to ward-year size before it meets the ward
dimension), windows are partitioned by ward, and every average or ratio is
rounded exactly from integers (:mod:`wardpulse.functions.numeric`).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardpulse import config as C
from wardpulse.functions.numeric import round_ratio
from wardpulse.functions.text import norm_name
from wardpulse.operators.aggregates import merged_ranks, mode_pick, near_targets, percentile_cont, pivot_sum
from wardpulse.operators.spatial import DEFAULT_CELL_DEG, nearest_point, points_in_polygons
from wardpulse.session import checkpoint_dir, written


def in_years(date_col: str, year_lo: int, year_hi: int) -> Column:
    """year(d) BETWEEN lo AND hi, plus the same range on the raw column so the
    parquet scan can skip row groups by their min/max statistics."""
    d = F.col(date_col)
    return (d >= F.lit(f"{year_lo}-01-01").cast("date")) & (d < F.lit(f"{year_hi + 1}-01-01").cast("date")) \
        & F.year(d).between(year_lo, year_hi)


def year_spine(wards: DataFrame, year_lo: int, year_hi: int, *cols: str) -> DataFrame:
    """U-1/J-1 wards x generate_series(lo, hi), as a generator (no join)."""
    return wards.select(*cols, F.explode(F.sequence(F.lit(year_lo), F.lit(year_hi))).alias("year"))


# ---------------------------------------------------------------- M-1 crime
def stg_crime(crime: DataFrame, census: DataFrame, wards: DataFrame, city: str | None = "Bengaluru",
              year_lo: int = C.YEAR_LO, year_hi: int = C.YEAR_HI, by_city: bool = False,
              count_col: str = "count") -> DataFrame:
    """City crime spread over wards by population share.

    ``city`` filters the crime feed (the reference's one-city model);
    ``by_city=True`` runs every city at once, each ward taking its own city's
    totals (the reference's per-city loop as one job, D-3 option).
    """
    cr = crime.where(F.col("year").between(year_lo, year_hi))
    if city is not None:
        cr = cr.where(F.col("city") == city)
    cy = pivot_sum(cr, ["city", "year"], "offense_category", count_col, C.CRIME_PIVOT,
                   total="total_ipc_offenses")
    part = ["city", "year"] if by_city else ["year"]
    wcols = ["ward_id", "ward_name"] + (["city"] if by_city else [])
    spine = year_spine(wards, year_lo, year_hi, *wcols)
    base = spine.join(cy, part)          # wards x city-years present in the feed
    pop = census.select(norm_name(F.col("ward_name")).alias("_nm"), F.col("year"),
                        F.col("population"))
    base = base.join(pop, (norm_name(base.ward_name) == pop._nm) & (base.year == pop.year), "left") \
               .drop(pop.year).drop("_nm")
    # W-1 SUM(population) OVER (PARTITION BY year): a grouped sum joined back
    tot = base.groupBy(*part).agg(F.sum("population").alias("_pop_total"))
    base = base.join(tot, part)
    share_cols = ["total_ipc_offenses"] + [f"{c}_count" for c in C.CRIME_PIVOT]
    spread = [F.coalesce(round_ratio(F.col(c) * F.col("population"), F.col("_pop_total"), 0),
                         F.lit(0)).cast("int").alias(c) for c in share_cols]
    rate = (F.when(F.col("population") > 0,
                   round_ratio(F.col("total_ipc_offenses") * 1000, F.col("_pop_total"), 4))
            .otherwise(F.lit(0)).cast("decimal(18,4)"))
    return base.select("ward_id", "ward_name", "year", *spread, rate.alias("crime_rate_per_1000"),
                       F.concat(F.col("city"), F.lit(C.CRIME_SOURCE_SUFFIX)).alias("source_pdf"))


# ----------------------------------------------------------- M-2 complaints
def stg_complaints(complaints: DataFrame, wards: DataFrame, year_lo: int = C.YEAR_LO,
                   year_hi: int = C.YEAR_HI) -> DataFrame:
    st = F.lower(F.col("status"))
    yr = F.year("date_filed").cast("int")
    # stage 1: per (normalised ward name, year, category) -- feeds the counts and the
    # mode; spellings that join the same ward are one group, so a ward-year is one row
    s1 = (complaints.where(F.col("date_filed").isNotNull() & in_years("date_filed", year_lo, year_hi))
          .groupBy(norm_name(F.col("ward_name")).alias("ward_name"), yr.alias("year"), "category")
          .agg(F.count(F.lit(1)).alias("_n"),
               F.count_if(st.isin(*C.PENDING_STATUSES)).alias("_p"),
               F.count_if(st.isin(*C.RESOLVED_STATUSES)).alias("_r"),
               F.count_if(st.isin(*C.REJECTED_STATUSES)).alias("_j")))
    agg = (s1.groupBy("ward_name", "year")
           .agg(F.sum("_n").alias("total_complaints"), F.sum("_p").alias("pending_complaints"),
                F.sum("_r").alias("resolved_complaints"), F.sum("_j").alias("rejected_complaints"),
                mode_pick("category", "_n").alias("top_category")))
    rate = F.when(F.col("total_complaints") > 0,
                  round_ratio(F.col("resolved_complaints"), F.col("total_complaints"), 4, precision=5)) \
        .otherwise(F.lit(0)).cast("decimal(5,4)")
    w = wards.select("ward_id", F.col("ward_name").alias("_wn"))
    j = w.join(agg, norm_name(w._wn) == agg.ward_name)
    return j.select("ward_id", F.col("_wn").alias("ward_name"), "year",
                    *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in
                      ("total_complaints", "pending_complaints", "resolved_complaints", "rejected_complaints")],
                    rate.alias("resolution_rate"),
                    F.lit(None).cast("decimal(8,2)").alias("avg_resolution_days"), "top_category")


# ------------------------------------------------------------------ M-3 AQI
POLLUTANTS = ("pm25", "pm10", "no2", "so2", "co", "o3")


def stg_aqi(readings: DataFrame, wards_geo: DataFrame, year_lo: int = C.YEAR_LO,
            year_hi: int = C.YEAR_HI, cell: float = DEFAULT_CELL_DEG) -> DataFrame:
    """Stations placed in wards by containment, annual means per ward.

    ``readings``: station_id, station_name, latitude, longitude (decimal(10,7)),
    date, pm25..o3 (decimal(8,2)), aqi (int).
    """
    stations = (readings.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
                .select("station_id", "station_name", "latitude", "longitude").distinct())
    pts = stations.withColumn("_x", F.col("longitude").cast("double")) \
                  .withColumn("_y", F.col("latitude").cast("double"))
    swm = (points_in_polygons(pts, wards_geo, x="_x", y="_y", cell=cell, how="left")
           .where(F.col("ward_id").isNotNull()).select("station_id", "ward_id", "ward_name"))
    yr = F.year("date").cast("int")
    r = readings.where(F.col("date").isNotNull() & in_years("date", year_lo, year_hi)) \
                .withColumn("year", yr)
    j = r.join(swm, "station_id")
    # stage 1 per station, stage 2 per ward: COUNT(DISTINCT station) without Expand
    s1 = j.groupBy("ward_id", "ward_name", "year", "station_id").agg(
        *[F.sum(p).alias(f"_s_{p}") for p in POLLUTANTS + ("aqi",)],
        *[F.count(p).alias(f"_c_{p}") for p in POLLUTANTS + ("aqi",)],
        F.count_if(F.col("aqi") <= C.AQI_GOOD_MAX).alias("_good"),
        F.count(F.lit(1)).alias("_n"),
        F.sum("longitude").alias("_slon"), F.count("longitude").alias("_clon"),
        F.sum("latitude").alias("_slat"), F.count("latitude").alias("_clat"))
    s2 = s1.groupBy("ward_id", "ward_name", "year").agg(
        *[F.sum(c).alias(c) for c in s1.columns if c.startswith("_")],
        F.count(F.lit(1)).alias("station_count"))
    avgs = [round_ratio(F.col(f"_s_{p}"), F.col(f"_c_{p}"), 2, 2, precision=8).alias(f"avg_{p}")
            for p in POLLUTANTS]
    return s2.select(
        "ward_id", "ward_name", "year", *avgs,
        round_ratio(F.col("_s_aqi"), F.col("_c_aqi"), 2, 0, precision=8).alias("avg_aqi"),
        round_ratio(F.col("_good") * 100, F.col("_n"), 2, precision=5).alias("aqi_good_days_pct"),
        F.col("station_count"),
        round_ratio(F.col("_slon"), F.col("_clon"), 7, 7, precision=10).alias("centroid_lon"),
        round_ratio(F.col("_slat"), F.col("_clat"), 7, 7, precision=10).alias("centroid_lat"))


# --------------------------------------------------------------- M-4 census
def census_clean(census: DataFrame) -> DataFrame:
    dens = F.when(F.col("area_sqkm") > 0,
                  round_ratio(F.col("population"), F.col("area_sqkm"), 2, 0, precision=12, den_scale=4)) \
        .otherwise(F.col("density").cast("decimal(12,2)"))
    sex = F.when(F.col("male_population") > 0,
                 round_ratio(F.col("female_population") * 1000, F.col("male_population"), 2, precision=12))
    return (census.where(F.col("population").isNotNull() & (F.col("population") > 0))
            .select("ward_name", "ward_number", "year", "population",
                    dens.alias("population_density"), "literacy_rate", "male_literacy",
                    "female_literacy", F.col("household_size").alias("avg_household_size"),
                    "total_households", sex.alias("sex_ratio")))


def or_join(left: DataFrame, right: DataFrame, eq_a: tuple[Column, Column],
            eq_b: tuple[Column, Column]) -> DataFrame:
    """J-5 ``left JOIN right ON (a_l = a_r) OR (b_l = b_r)`` as two hash joins.

    The arms are disjoint -- arm two keeps only pairs that arm one did not
    produce -- so their UNION ALL is the OR join's exact multiset, with no
    row ids and no nested-loop join."""
    a_l, a_r = eq_a
    b_l, b_r = eq_b
    arm1 = left.join(right, a_l == a_r)
    arm2 = left.join(right, (b_l == b_r) & ~F.coalesce(a_l == a_r, F.lit(False)))
    return arm1.unionByName(arm2)


def stg_census(census: DataFrame, wards: DataFrame) -> DataFrame:
    c = census_clean(census).withColumnRenamed("ward_name", "_cname") \
                            .withColumnRenamed("ward_number", "_cnum")
    w = wards.select("ward_id", "ward_name", F.col("ward_number").alias("_wnum"))
    j = or_join(c, w, (F.col("_wnum"), F.col("_cnum")),
                (norm_name(F.col("ward_name")), norm_name(F.col("_cname"))))
    return j.select("ward_id", "ward_name", "year", "population", "population_density",
                    "literacy_rate", "male_literacy", "female_literacy", "avg_household_size",
                    "total_households", "sex_ratio")


# -------------------------------------------------------------- M-5 transit
def transit_score(stops: Column, metro_km: Column, freq: Column) -> Column:
    """S-13, LEAST/GREATEST skipping NULL as in the reference (D-19)."""
    stop_pts = F.least(stops, F.lit(C.TRANSIT_STOP_CAP)).cast("double") / C.TRANSIT_STOP_CAP * C.TRANSIT_W_STOPS
    metro_pts = F.greatest(F.lit(0.0), 1 - metro_km / C.TRANSIT_KM_SCALE) * C.TRANSIT_W_METRO
    freq_pts = F.least(freq.cast("double"), F.lit(float(C.TRANSIT_FREQ_CAP))) / C.TRANSIT_FREQ_CAP * C.TRANSIT_W_FREQ
    total = F.least(F.lit(100.0), stop_pts + metro_pts + freq_pts)
    return F.round(total.cast("decimal(20,10)"), 2).cast("decimal(5,2)")


def stop_metro_distance(stops: DataFrame, metro_source: str = C.METRO_SOURCE,
                        key: str = "stop_id") -> DataFrame:
    """J-13 each stop's distance (km) to the nearest metro stop, exact."""
    metros = stops.where(F.col("source") == metro_source)
    return nearest_point(stops, metros, key, out="metro_distance_km")


def ward_transit(stops: DataFrame, wards_geo: DataFrame, metro_source: str = C.METRO_SOURCE,
                 cell: float = DEFAULT_CELL_DEG, freq: DataFrame | None = None) -> DataFrame:
    """Per ward: stops inside it, nearest-metro km (min over its stops), mean
    frequency, summed routes and the S-13 score.

    ``stops``: stop_id, longitude, latitude (double), source, and route_count /
    avg_frequency -- or pass the per-stop ``freq`` table (F-7) and it is joined
    once, after the distance search, which only needs coordinates."""
    s = stops.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    placed = points_in_polygons(s, wards_geo, cell=cell, how="inner")
    metros = stops.where(F.col("source") == metro_source)
    with_km = nearest_point(placed.select("stop_id", "longitude", "latitude").distinct(), metros,
                            "stop_id", out="metro_distance_km")
    if freq is not None:
        from wardpulse.plans.feeds import enrich_stops
        placed = enrich_stops(placed, freq)
    wt = (placed.join(with_km.select("stop_id", "metro_distance_km"), "stop_id", "left")
          .groupBy("ward_id", "ward_name")
          .agg(F.count(F.lit(1)).alias("bus_stops_count"),
               F.min("metro_distance_km").alias("_km"),
               round_ratio(F.sum("avg_frequency"), F.count("avg_frequency"), 2, 2,
                           precision=8).alias("avg_route_frequency"),
               F.sum("route_count").alias("total_routes")))
    km = F.round(F.coalesce(F.col("_km"), F.lit(C.NO_METRO_KM)).cast("decimal(20,10)"), 3).cast("decimal(8,3)")
    return wt.select("ward_id", "ward_name", "bus_stops_count", km.alias("metro_proximity_km"),
                     "avg_route_frequency", "total_routes",
                     transit_score(F.col("bus_stops_count"), F.col("_km"),
                                   F.col("avg_route_frequency")).alias("transit_score"))


def stg_transit(stops: DataFrame, wards_geo: DataFrame, year_lo: int = C.YEAR_LO,
                year_hi: int = C.YEAR_HI, metro_source: str = C.METRO_SOURCE,
                cell: float = DEFAULT_CELL_DEG, freq: DataFrame | None = None) -> DataFrame:
    """M-5: the (static) ward transit figures repeated for every year."""
    wt = ward_transit(stops, wards_geo, metro_source, cell, freq)
    out = year_spine(wt, year_lo, year_hi, *wt.columns)
    return out.select("ward_id", "ward_name", "year", "bus_stops_count", "metro_proximity_km",
                      "avg_route_frequency", "total_routes", "transit_score")


# ----------------------------------------------------------------- M-6 NDVI
def zonal_stats(pixels: DataFrame, keys=("ward_id", "year", "month"), value: str = "ndvi",
                value_scale: int = 4) -> DataFrame:
    """A-15 mean, median, min, max, std, count per zone (P-10: zones with pixels only).

    One pass over the pixels builds the (zone, value) histogram -- partial
    aggregation shrinks it before the shuffle, and a decimal(6,4) index has at
    most 20001 values per zone -- and every statistic comes from it, the median by
    ranks within the zone. The
    population std uses exact sums: var = (n*sum(v^2) - sum(v)^2) / n^2."""
    keys = list(keys)
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, value]])
    hist = pixels.where(known).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
    v = F.col(value)
    # ranks inside the zone: its values are few, and the statistics follow without another shuffle
    w = Window.partitionBy(*keys).orderBy(value)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    hist = (hist.withColumn("_end", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("_all", F.sum("_c").over(whole)))
    v = F.col(value)
    # values at the two middle ranks
    at = lambda k: F.max(F.when((F.col("_end") - F.col("_c") <= k) & (k < F.col("_end")), v))
    low, high = F.floor((F.col("_all") - 1) / 2).cast("bigint"), F.floor(F.col("_all") / 2).cast("bigint")
    stats = hist.groupBy(*keys).agg(
        F.sum(v * F.col("_c")).alias("_s"), F.sum("_c").alias("_n"),
        F.sum(v * v * F.col("_c")).alias("_ss"), F.min(v).alias("_mn"), F.max(v).alias("_mx"),
        at(low).alias("_vlo"), at(high).alias("_vhi"))
    # narrow enough that the products keep all eight digits
    n, total = F.col("_n").cast("decimal(12,0)"), F.col("_s").cast("decimal(18,4)")
    num = F.col("_ss").cast("decimal(24,8)") * n - total * total
    var = num.cast("double") / (F.col("_n").cast("double") * F.col("_n").cast("double"))
    half = F.lit("0.5").cast("decimal(2,1)")
    stats = stats.withColumn("_med", F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * half)
    return (stats.where(F.col("_n") > 0)
            .select(*keys,
                    round_ratio(F.col("_s"), F.col("_n"), 4, value_scale, precision=6).alias("mean_ndvi"),
                    F.round("_med", 4).cast("decimal(6,4)").alias("median_ndvi"),
                    F.round("_mn", 4).cast("decimal(6,4)").alias("min_ndvi"),
                    F.round("_mx", 4).cast("decimal(6,4)").alias("max_ndvi"),
                    F.sqrt(F.greatest(var, F.lit(0.0))).cast("decimal(6,4)").alias("std_ndvi"),
                    F.col("_n").cast("int").alias("pixel_count")))


def green_cover(avg: Column) -> Column:
    expr = None
    for thr, pct in C.GREEN_STEPS:
        expr = (F.when(avg > thr, F.lit(pct)) if expr is None else expr.when(avg > thr, F.lit(pct)))
    return expr.otherwise(F.lit(C.GREEN_ELSE)).cast("decimal(5,2)")


def stg_ndvi(ndvi: DataFrame, year_lo: int = C.YEAR_LO, year_hi: int = C.YEAR_HI) -> DataFrame:
    """``ndvi``: ward_id, ward_name, year, month, mean/median/min/max_ndvi decimal(6,4), pixel_count."""
    keys = ["ward_id", "ward_name", "year"]
    base = ndvi.where(F.col("ward_id").isNotNull() & F.col("year").between(year_lo, year_hi))
    # a ward's year is its months: their medians are ranked where they are summed up
    w = Window.partitionBy(*keys).orderBy(F.col("median_ndvi").asc_nulls_last())
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    base = base.withColumn("_at", F.row_number().over(w)).withColumn("_all", F.count("median_ndvi").over(whole))
    at = lambda k: F.max(F.when(F.col("_at") == k, F.col("median_ndvi")))
    j = base.groupBy(*keys).agg(
        round_ratio(F.sum("mean_ndvi"), F.count("mean_ndvi"), 4, 4, precision=6).alias("avg_ndvi"),
        F.round(F.min("min_ndvi"), 4).alias("min_ndvi"), F.round(F.max("max_ndvi"), 4).alias("max_ndvi"),
        F.sum("pixel_count").alias("total_pixels"),
        at(F.floor((F.col("_all") + 1) / 2)).alias("_vlo"), at(F.floor(F.col("_all") / 2) + 1).alias("_vhi"))
    half = F.lit("0.5").cast("decimal(2,1)")
    j = j.withColumn("_med", F.when(F.col("ward_name").isNotNull(), F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * half))
    w = Window.partitionBy("ward_id").orderBy("year")
    chg = F.col("avg_ndvi") - F.lag("avg_ndvi").over(w)
    return j.select("ward_id", "ward_name", "year", "avg_ndvi",
                    F.round(F.col("_med"), 4).cast("decimal(6,4)").alias("median_ndvi"),
                    F.col("min_ndvi").cast("decimal(6,4)").alias("min_ndvi"),
                    F.col("max_ndvi").cast("decimal(6,4)").alias("max_ndvi"),
                    F.coalesce(chg, F.lit(0)).cast("decimal(6,4)").alias("ndvi_change_yoy"),
                    green_cover(F.col("avg_ndvi")).alias("green_cover_pct"))


# ------------------------------------------------------------- M-7 property
def map_listings_to_wards(listings: DataFrame, wards: DataFrame, mode: str = "strict") -> DataFrame:
    """J-4/J-7 listing -> ward by normalised ward name. ``strict``: unnamed
    listings get no ward; ``locality``: they fall back to their locality
    matched to a ward name. (``exact`` -- the reference's rule that an unnamed
    listing belongs to every ward -- is handled by :func:`stg_property`
    without pairing listings with wards.)"""
    w = wards.select(F.col("ward_id").alias("_wid"), F.col("ward_name").alias("_wname"))
    key = norm_name(F.col("ward_name"))
    if mode == "locality":
        key = F.coalesce(key, norm_name(F.col("locality")))
    elif mode != "strict":
        raise ValueError(f"unknown mode {mode!r}")
    j = listings.withColumn("_key", key).join(w, F.col("_key") == norm_name(F.col("_wname")), "left")
    return j.withColumn("ward_id", F.col("_wid")) \
            .withColumn("ward_name", F.coalesce(F.col("_wname"), F.col("ward_name"))) \
            .drop("_key", "_wid", "_wname")


def _property_exact(base: DataFrame, wards: DataFrame, year_lo: int, year_hi: int) -> DataFrame:
    """Aggregates per (ward, year) over the ward's named listings plus every
    unnamed listing of the year (J-7 as the reference joins them), computed
    from per-ward and per-year parts -- no listing x ward pairs."""
    spark = base.sparkSession
    checkpoint_dir(spark)
    band = (base.where(F.col("year").between(year_lo, year_hi))
            .groupBy(norm_name(F.col("ward_name")).alias("_nm"), "year", "price_sqft", "property_type")
            .agg(F.count(F.lit(1)).alias("_c")))
    # the listings are counted by ward name before they meet the wards. Written in the order
    # of names and prices, so that what is grouped by them afterwards shrinks before its
    # shuffle; unnamed ones need no ranks here and go to many tasks
    part = Window.partitionBy("_nm", "year", F.when(F.col("_nm").isNull(), F.pmod(F.hash("price_sqft"), F.lit(64))))
    w = part.orderBy("price_sqft", "property_type")
    band = written(band.select("*", F.coalesce(F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_ltN"),
                               F.lead("price_sqft").over(w).alias("_nx"),
                               F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_n")),
                   "listings")
    N, U = band.where("_nm is not null"), band.where("_nm is null")
    # a ward that is there _d times has each of its named listings as often
    same = Window.partitionBy("ward_id", "ward_name")
    wn = written(wards.select("ward_id", "ward_name").select("*", F.count(F.lit(1)).over(same).alias("_d"),
                 F.when(F.col("ward_id").isNotNull(), norm_name(F.col("ward_name"))).alias("_nm")), "wards")
    often = F.broadcast(wn.where("_d > 1 and _nm is not null").select("_nm", "_d").distinct())

    def times(rows: DataFrame, *counts: str) -> DataFrame:
        more = rows.join(often, "_nm").select(*[(F.col(c) * F.col("_d")).alias(c) if c in counts else F.col(c) for c in rows.columns], "_d")
        return rows.withColumn("_d", F.lit(1).cast("bigint")).unionByName(more)

    total = F.sum(F.col("price_sqft") * F.col("_c"))
    if dict(base.dtypes)["price_sqft"].startswith("decimal"):
        total = total.cast("decimal(20,2)")
    NA = N.groupBy("_nm", "year").agg(F.sum("_c").alias("_nN"), total.alias("_sN"),
                                      F.min("price_sqft").alias("_mnN"), F.max("price_sqft").alias("_mxN"))
    NA = written(NA, "names")
    UA = U.groupBy("year").agg(F.sum("_c").alias("_nU"), total.alias("_sU"),
                               F.min("price_sqft").alias("_mnU"), F.max("price_sqft").alias("_mxU"))
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    spine = year_spine(wn, year_lo, year_hi, "ward_id", "ward_name", "_nm", "_d")
    agg = (spine.join(NA, ["_nm", "year"], "left").join(UA, "year", "left")
           .withColumn("listing_count", z("_nN") * F.col("_d") + z("_nU"))
           .where(F.col("listing_count") > 0)
           .withColumn("_s", F.coalesce((F.col("_sN") * F.col("_d")).cast(dict(NA.dtypes)["_sN"]), F.lit(0)) + F.coalesce(F.col("_sU"), F.lit(0)))
           .withColumn("min_price_sqft", F.least("_mnN", "_mnU"))
           .withColumn("max_price_sqft", F.greatest("_mxN", "_mxU")))
    keys = ["_nm", "_d", "year"]
    groups = agg.where("_nm is not null").select(*keys).distinct()
    # mode: the best named type (named + unnamed count), or the best unnamed type absent
    # from the ward's named types
    NT = written(N.where(F.col("property_type").isNotNull()).groupBy("_nm", "year", "property_type").agg(F.sum("_c").alias("_cN")), "types")
    UT = U.where(F.col("property_type").isNotNull()).groupBy("year", "property_type") \
          .agg(F.sum("_c").alias("_cU"))
    UT = UT.withColumn("_rk", F.row_number().over(
        Window.partitionBy("year").orderBy(F.col("_cU").desc(), F.col("property_type"))))
    best_a = (times(NT, "_cN").join(UT.select("year", "property_type", "_cU"), ["year", "property_type"], "left")
              .withColumn("_tot", F.col("_cN") + F.coalesce(F.col("_cU"), F.lit(0)))
              .groupBy(*keys).agg(F.min(F.struct((-F.col("_tot")).alias("n"),
                                                 F.col("property_type").alias("t"))).alias("_a")))
    # ranks 1, 2, .. without a gap: the next one is the best absent
    place = F.row_number().over(Window.partitionBy("_nm", "year").orderBy("_rk"))
    absent = (NT.join(UT.select("year", "property_type", "_rk"), ["year", "property_type"])
              .select("_nm", "year", "_rk", place.alias("_place")).where("_rk = _place")
              .groupBy("_nm", "year").agg(F.count(F.lit(1)).alias("_k")))
    best_b = UT.select("year", "_rk", F.struct((-F.col("_cU")).alias("n"), F.col("property_type").alias("t")).alias("_b"))
    UH = U.groupBy("year", "price_sqft").agg(F.sum("_c").alias("_cu")).checkpoint()
    ranked = times(N.select("_nm", "year", "price_sqft", "_c", "_ltN", "_nx", "_n"), "_c", "_ltN", "_n")
    ranked = near_targets(ranked, UH, "year", "price_sqft", 0.5).select(*keys, "price_sqft", "_c", "_ltN").checkpoint()
    totals = times(NA.select("_nm", "year", "_nN"), "_nN")
    med = merged_ranks(ranked, totals, UH, keys, "year", "price_sqft", groups, 0.5, "_med")
    rows = (agg.join(best_a, keys, "left").join(absent, ["_nm", "year"], "left").withColumn("_rk", (z("_k") + 1).cast("int"))
            .join(best_b, ["year", "_rk"], "left").join(med, keys, "left"))
    best = F.when(F.col("_nm").isNotNull(), F.least("_a", "_b"))
    return (rows.withColumn("dominant_property_type", best["t"])
            .select("ward_id", "ward_name", "year", "listing_count", "_s", "min_price_sqft", "max_price_sqft",
                    "dominant_property_type", "_med"))


def stg_property(listings: DataFrame, wards: DataFrame, year_lo: int = C.YEAR_LO,
                 year_hi: int = C.YEAR_HI, mode: str = "exact") -> DataFrame:
    """M-7. ``mode``: ``exact`` (the reference: an unnamed listing counts in
    every ward), ``strict`` (unnamed listings dropped) or ``locality``."""
    yr = F.coalesce(F.year("listing_date"), F.year("scraped_at")).cast("int")
    base = (listings.where(F.col("price_sqft").isNotNull()
                           & F.col("price_sqft").between(C.PRICE_SQFT_LO, C.PRICE_SQFT_HI))
            .withColumn("year", yr))
    keys = ["ward_id", "ward_name", "year"]
    if mode == "exact":
        j = _property_exact(base, wards, year_lo, year_hi)
    else:
        mapped = map_listings_to_wards(base, wards, mode)
        m = mapped.where(F.col("ward_id").isNotNull() & F.col("year").between(year_lo, year_hi))
        s1 = m.groupBy(*keys, "property_type").agg(
            F.count(F.lit(1)).alias("_n"), F.sum("price_sqft").alias("_s"),
            F.min("price_sqft").alias("_mn"), F.max("price_sqft").alias("_mx"))
        agg = s1.groupBy(*keys).agg(
            F.sum("_n").alias("listing_count"), F.sum("_s").alias("_s"),
            F.min("_mn").alias("min_price_sqft"), F.max("_mx").alias("max_price_sqft"),
            mode_pick("property_type", "_n").alias("dominant_property_type"))
        med = percentile_cont(m, keys, "price_sqft", 0.5, out="_med")
        j = agg.join(med, keys)
    j = j.withColumn("median_price_sqft", F.round("_med", 2).cast("decimal(10,2)"))
    w = Window.partitionBy("ward_id").orderBy("year")
    prev = F.lag("median_price_sqft").over(w)
    chg = F.when(prev > 0, round_ratio(F.col("median_price_sqft") - prev, prev, 4, 2,
                                       precision=12, den_scale=2))
    return j.select("ward_id", "ward_name", "year", "median_price_sqft",
                    round_ratio(F.col("_s"), F.col("listing_count"), 2, 2, precision=10).alias("avg_price_sqft"),
                    F.round("min_price_sqft", 2).cast("decimal(10,2)").alias("min_price_sqft"),
                    F.round("max_price_sqft", 2).cast("decimal(10,2)").alias("max_price_sqft"),
                    "listing_count",
                    F.coalesce(chg, F.lit(0)).cast("decimal(8,4)").alias("price_change_yoy"),
                    "dominant_property_type")
