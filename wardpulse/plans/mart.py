"""M-8 ward-year mart, M-11 latest-year snapshot, M-9 quick features,
M-10 scores and V-1..V-3 serving queries."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardpulse import config as C
from wardpulse.functions.numeric import round_ratio
from wardpulse.functions.text import norm_name, title_case
from wardpulse.plans.staging import year_spine

# fixed values: mart feature columns taken from each staging model, in output order
MART_FEATURES = {
    "crime": ["total_ipc_offenses", "murder_count", "theft_count", "robbery_count",
              "assault_count", "kidnapping_count", "burglary_count", "crime_rate_per_1000"],
    "complaints": ["total_complaints", "pending_complaints", "resolved_complaints",
                   "resolution_rate", "avg_resolution_days"],
    "aqi": ["avg_pm25", "avg_pm10", "avg_no2", "avg_so2", "avg_aqi", "aqi_good_days_pct"],
    "census": ["population", "population_density", "literacy_rate", "avg_household_size",
               "total_households"],
    "transit": ["bus_stops_count", "metro_proximity_km", "avg_route_frequency", "total_routes",
                "transit_score"],
    "ndvi": ["avg_ndvi", "ndvi_change_yoy", "green_cover_pct"],
    "property": ["median_price_sqft", "price_change_yoy"],
}
# fixed values: coalesce defaults of the mart (all other features stay NULL)
MART_DEFAULTS = {c: 0 for c in ("total_ipc_offenses", "murder_count", "theft_count", "robbery_count",
                                "assault_count", "kidnapping_count", "burglary_count",
                                "total_complaints", "pending_complaints", "resolved_complaints",
                                "bus_stops_count", "total_routes")}
MART_DEFAULTS["metro_proximity_km"] = C.NO_METRO_KM


def ward_year_spine(wards: DataFrame, year_lo: int = C.YEAR_LO, year_hi: int = C.YEAR_HI) -> DataFrame:
    return year_spine(wards, year_lo, year_hi, "ward_id", "ward_name", "ward_number", "zone_name", "city")


def mart_ward_features(wards: DataFrame, staged: Mapping[str, DataFrame], year_lo: int = C.YEAR_LO,
                       year_hi: int = C.YEAR_HI) -> DataFrame:
    """Spine LEFT JOIN each staging result on (ward_id, year). Every input is
    already ward-year sized, so the joins move little data. They are merge joins on the
    one key: a landed input is judged by its files, in which a ward-year takes a few
    bytes, and seven broadcasts of all ward-years would meet in the driver."""
    out = ward_year_spine(wards, year_lo, year_hi)
    for feed, cols in MART_FEATURES.items():
        if feed not in staged:
            continue
        s = staged[feed].select("ward_id", "year", *cols)
        out = out.join(s.hint("merge"), ["ward_id", "year"], "left")
    sel = ["ward_id", "ward_name", "ward_number", "zone_name", "city", "year"]
    for feed, cols in MART_FEATURES.items():
        for c in cols:
            if feed not in staged:
                sel.append(F.lit(None).alias(c))
            elif c in MART_DEFAULTS:
                d = MART_DEFAULTS[c]
                sel.append(F.coalesce(F.col(c), F.lit(d).cast(dict(out.dtypes)[c])).alias(c))
            else:
                sel.append(F.col(c))
    return out.select(*sel)


def latest_year(mart: DataFrame) -> DataFrame:
    """M-11 rows of the newest year (scalar subquery, no join)."""
    return mart.where(F.col("year") == mart.select(F.max("year")).scalar())


# ------------------------------------------------------------------ M-10 scores
def scores(mart: DataFrame, weights: Mapping[str, float] = C.WEIGHTS,
           dimensions: Mapping[str, list[str]] = C.DIMENSIONS, inverted=C.INVERTED,
           month: int | None = C.SCORE_MONTH) -> DataFrame:
    """Min-max each dimension to 0..100 over the whole frame (scikit-learn's
    rule: x * scale + min_, scale = 100 / range, a zero range counts as 1),
    invert safety / aqi / affordability, weighted composite. A missing
    dimension column scores 0; a NULL feature keeps a NULL score and a NULL
    composite (D-10). The min/max values are scalar subqueries over one
    aggregate (Catalyst merges them into a single pass), so no join is needed."""
    dims = {}
    for d, cols in dimensions.items():
        if all(c in mart.columns for c in cols):
            vals = [F.col(c).cast("double") for c in cols]
            if len(vals) == 1:
                dims[d] = vals[0]
            else:   # S-38 row mean skipping NULL
                s = sum((F.coalesce(v, F.lit(0.0)) for v in vals), F.lit(0.0))
                n = sum((F.when(v.isNotNull(), 1).otherwise(0) for v in vals), F.lit(0))
                dims[d] = F.when(n > 0, s / n)
    base = mart.select("ward_id", "ward_name", "city", "year",
                       *[v.alias(f"_v_{d}") for d, v in dims.items()])
    stats = base.agg(*[F.min(f"_v_{d}").alias(f"_mn_{d}") for d in dims],
                     *[F.max(f"_v_{d}").alias(f"_mx_{d}") for d in dims])
    j = base
    sc = {}
    for d in dimensions:
        if d not in dims:
            sc[d] = F.lit(0.0)
            continue
        lo, hi = stats.select(f"_mn_{d}").scalar(), stats.select(f"_mx_{d}").scalar()
        rng = hi - lo
        scale = F.lit(100.0) / F.when(rng == 0, F.lit(1.0)).otherwise(rng)
        mn = F.lit(0.0) - lo * scale
        v = F.col(f"_v_{d}") * scale + mn
        sc[d] = (F.lit(100.0) - v) if d in inverted else v
    comp = None
    for d in dimensions:
        term = sc[d] * F.lit(weights[d])
        comp = term if comp is None else comp + term
    cols = ["ward_id", "ward_name", "city", "year"]
    if month is not None:
        cols.append(F.lit(month).alias("month"))
    return j.select(*cols, F.round(comp.cast("decimal(20,10)"), 2).cast("decimal(5,2)").alias("composite_score"),
                    *[F.round(sc[d].cast("decimal(20,10)"), 2).cast("decimal(5,2)").alias(f"{d}_score")
                      for d in dimensions])


# ------------------------------------------------------------------ serving
def _placed(df: DataFrame, group: str, order: list, place: str | None) -> DataFrame:
    if place:
        df = df.withColumn(place, F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return df.orderBy(group, *order)


def city_scores(scored: DataFrame, city: str | None = None, place: str | None = None) -> DataFrame:
    """V-1 wards of a city best first (city title-cased as the API does);
    ``city=None`` serves every city, each ordered by its own composite. ``place`` names
    a column for each row's place in its city."""
    df = scored
    if city is not None:
        df = df.where(title_case(F.col("city")) == title_case(F.lit(city)))
    # a ward has a score for each year: ties of one ward go by year
    order = [F.col("composite_score").desc_nulls_last(), F.col("ward_id"), F.col("year")]
    return _placed(df, "city", order, place)


def ward_history(scored: DataFrame, ward_id: int | None = None, place: str | None = None) -> DataFrame:
    """V-2 one ward's scores by year and month (every ward when ``ward_id`` is None).
    ``place`` names a column for each row's place in its ward."""
    df = scored if ward_id is None else scored.where(F.col("ward_id") == ward_id)
    return _placed(df, "ward_id", [F.col("year"), F.col("month")], place)


def latest_readings(readings: DataFrame, k: int = 10, group: str = "city",
                    order_desc: str = "date", tie: str = "station_id") -> DataFrame:
    """V-3 newest ``k`` readings per ``group`` (date DESC, tie by station).

    Two phases so no group is sorted whole: per (group, date) counts find each
    group's cutoff date (a small table), then only readings at or after the
    cutoff are ranked."""
    per_day = readings.groupBy(group, order_desc).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(group).orderBy(F.col(order_desc).desc()).rowsBetween(Window.unboundedPreceding, -1)
    cut = (per_day.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)))
           .where(F.col("_before") < k)
           .groupBy(group).agg(F.min(order_desc).alias("_cut")))
    near = readings.join(cut, group).where(F.col(order_desc) >= F.col("_cut")).drop("_cut")
    rk = Window.partitionBy(group).orderBy(F.col(order_desc).desc(), F.col(tie))
    return near.withColumn("_rk", F.row_number().over(rk)).where(F.col("_rk") <= k).drop("_rk")


# ------------------------------------------------------------------ M-9
def quick_features(wards: DataFrame, crime: DataFrame, complaints: DataFrame, aqi_by_city: DataFrame,
                   census: DataFrame, ndvi: DataFrame, listings: DataFrame, year: int,
                   count_col: str = "count") -> DataFrame:
    """Features straight from raw for one output year, each feed aggregated
    before its join and joined on its right key (D-6): crime and AQI by city,
    complaints, listings and census (newest row) by normalised ward name and
    city, so equal names in two cities do not mix, NDVI by ward id. 13 columns
    as the reference writes; its last one is named a median and holds the mean."""
    w = wards.select("ward_id", "ward_name", "city", norm_name(F.col("ward_name")).alias("_nm"))
    cr = crime.groupBy("city").agg(F.sum(count_col).alias("_cr_sum"), F.count(count_col).alias("_cr_n"))
    co = (complaints.groupBy(norm_name(F.col("ward_name")).alias("_nm"), "city")
          .agg(F.count("complaint_id").alias("_co_n"),
               F.count_if(F.col("status") == "Resolved").alias("_co_r")))
    aq = aqi_by_city.groupBy("city").agg(F.sum("aqi").alias("_aq_s"), F.count("aqi").alias("_aq_n"))
    newest = F.max_by(F.struct("population", "density"), F.col("year"))
    ce = (census.groupBy(norm_name(F.col("ward_name")).alias("_nm"), "city").agg(newest.alias("_c"))
          .select("_nm", "city", F.col("_c.population").alias("_pop"), F.col("_c.density").alias("_dens")))
    nd = ndvi.groupBy("ward_id").agg(F.sum("mean_ndvi").alias("_nd_s"), F.count("mean_ndvi").alias("_nd_n"))
    pr = (listings.groupBy(norm_name(F.col("ward_name")).alias("_nm"), "city")
          .agg(F.sum("price_sqft").alias("_pr_s"), F.count("price_sqft").alias("_pr_n")))
    j = (w.join(cr, "city", "left").join(co, ["_nm", "city"], "left").join(aq, "city", "left")
         .join(ce, ["_nm", "city"], "left").join(nd, "ward_id", "left").join(pr, ["_nm", "city"], "left"))
    z = lambda c: F.coalesce(c, F.lit(0))
    return j.select(
        "ward_id", "ward_name", "city", F.lit(year).alias("year"),
        z(F.col("_cr_sum")).cast("bigint").alias("total_ipc_offenses"),
        z(round_ratio(F.col("_cr_sum") * 1000, F.col("_cr_n") * F.col("_pop"), 4)).cast("decimal(12,4)")
        .alias("crime_rate_per_1000"),
        z(F.col("_co_n")).cast("bigint").alias("total_complaints"),
        z(round_ratio(F.col("_co_r"), F.col("_co_n"), 4)).cast("decimal(5,4)").alias("resolution_rate"),
        z(round_ratio(F.col("_aq_s"), F.col("_aq_n"), 2)).cast("decimal(8,2)").alias("avg_aqi"),
        z(F.col("_pop")).cast("bigint").alias("population"),
        z(F.col("_dens")).cast("decimal(10,2)").alias("population_density"),
        z(round_ratio(F.col("_nd_s"), F.col("_nd_n"), 4, 4)).cast("decimal(6,4)").alias("avg_ndvi"),
        z(round_ratio(F.col("_pr_s"), F.col("_pr_n"), 2, 2)).cast("decimal(10,2)").alias("median_price_sqft"))


QUICK_COLUMNS = ["total_ipc_offenses", "crime_rate_per_1000", "total_complaints", "resolution_rate", "avg_aqi",
                 "avg_ndvi", "median_price_sqft"]


def save_quick_features(spark, path: str, features: DataFrame) -> None:
    """Upsert on (ward_id, year): the seven measured columns follow the batch,
    others keep their first value. Partitioned by year."""
    from wardpulse.operators.sinks import write_upsert
    write_upsert(spark, path, features, ["ward_id", "year"], QUICK_COLUMNS, ["year"])


SCORE_COLUMNS = ["composite_score", "safety_score", "aqi_score", "civic_score", "transit_score",
                 "green_score", "affordability_score"]


def save_scores(spark, path: str, scored: DataFrame) -> None:
    """SNK-10 upsert on (ward_id, year, month): the seven score columns are
    updated, other columns keep their first value. Partitioned by year, a
    column of the key, so a key never spans two partitions."""
    from wardpulse.operators.sinks import write_upsert
    write_upsert(spark, path, scored, ["ward_id", "year", "month"], SCORE_COLUMNS, ["year"])
