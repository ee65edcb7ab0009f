"""Reference feeds expressed as views over the driver's parquet tables.

The driver tables hold no ward data, so each feed the reference loads
(wards, complaints, crime, census, air quality, stops, NDVI pixels,
listings) is derived from them (FIXTURES.md part B). All of it is lazy:
nothing is read until an operator's result is.

Coordinates are integers in 1e-4 degree; ``lon``/``lat`` are the same
points in degrees for the distance operators.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")

# Fixture year range (order and ship dates cover 1995..2001).
FIX_YEAR_LO, FIX_YEAR_HI = 1995, 2001
DEG = 10000.0  # coordinate units per degree


def _grid_x(key: Column, n: Column) -> Column:
    slot = (key * 7) % (n + 1 + F.floor(n / 10.0).cast("bigint"))
    return 770000 + (slot % 32) * 200 + 10 * (key % 19) + 5


def _grid_y(key: Column, n: Column) -> Column:
    slot = (key * 7) % (n + 1 + F.floor(n / 10.0).cast("bigint"))
    return 120000 + F.floor(slot / 32.0).cast("bigint") * 200 + 10 * (key % 17) + 5


class DriverViews:
    """Lazy views over ``{sf_dir}/{table}.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # number of wards as a scalar subquery (one value, no join)
    @property
    def n_wards(self) -> Column:
        return self.table("supplier").select(F.count(F.lit(1))).scalar()

    def ward_boundaries(self) -> DataFrame:
        s, n, r = self.table("supplier"), self.table("nation"), self.table("region")
        return (s.join(n, s.s_nationkey == n.n_nationkey)
                .join(r, n.n_regionkey == r.r_regionkey)
                .select(s.s_suppkey.alias("ward_id"), s.s_name.alias("ward_name"),
                        s.s_suppkey.alias("ward_number"), r.r_name.alias("city"),
                        n.n_name.alias("zone_name"),
                        (770000 + (s.s_suppkey % 32) * 200).alias("x0"),
                        (120000 + F.floor(s.s_suppkey / 32.0).cast("bigint") * 200).alias("y0")))

    def ward_polygons(self) -> DataFrame:
        """Wards with a geometry: ``rings`` (array of rings of (x, y) degree points)
        and the bounding box. Each ward is a five-corner polygon with one corner
        cut along dx + dy = 305."""
        w = self.ward_boundaries()
        corners = [(0, 0), (200, 0), (200, 105), (105, 200), (0, 200)]
        ring = F.array(*[F.struct(((F.col("x0") + dx) / DEG).alias("x"),
                                  ((F.col("y0") + dy) / DEG).alias("y"))
                         for dx, dy in corners])
        return w.select("ward_id", "ward_name", "ward_number", "city", "zone_name",
                        F.array(ring).alias("rings"),
                        (F.col("x0") / DEG).alias("min_x"), (F.col("y0") / DEG).alias("min_y"),
                        ((F.col("x0") + 200) / DEG).alias("max_x"),
                        ((F.col("y0") + 200) / DEG).alias("max_y"))

    def complaints(self) -> DataFrame:
        o, s = self.table("orders"), self.table("supplier")
        k = o.o_orderkey
        return (o.join(s, s.s_suppkey == o.o_custkey % self.n_wards)
                .select(k.alias("complaint_id"), o.o_orderpriority.alias("category"),
                        F.when(k % 3 == 0, F.upper(s.s_name))
                         .when(k % 3 == 1, F.concat(F.lit("  "), s.s_name, F.lit(" ")))
                         .otherwise(s.s_name).alias("ward_name"),
                        o.o_orderdate.cast("date").alias("date_filed"),
                        F.when(o.o_orderstatus == "F", "Resolved")
                         .when(o.o_orderstatus == "O", "In Progress")
                         .otherwise("Rejected").alias("status")))

    def crime(self) -> DataFrame:
        l, s, n, r = (self.table(t) for t in ("lineitem", "supplier", "nation", "region"))
        cat = (F.when(l.l_linenumber == 1, "theft").when(l.l_linenumber == 2, "murder")
               .when(l.l_linenumber == 3, "robbery").when(l.l_linenumber == 4, "assault")
               .when(l.l_linenumber == 5, "kidnapping").when(l.l_linenumber == 6, "burglary")
               .otherwise("cyber crimes"))
        return (l.join(s, l.l_suppkey == s.s_suppkey)
                .join(n, s.s_nationkey == n.n_nationkey)
                .join(r, n.n_regionkey == r.r_regionkey)
                .select(r.r_name.alias("city"), F.year(l.l_shipdate).cast("int").alias("year"),
                        cat.alias("offense_category"), l.l_quantity.cast("int").alias("cnt")))

    def census(self) -> DataFrame:
        l, s = self.table("lineitem"), self.table("supplier")
        g = (l.groupBy(l.l_suppkey, F.year(l.l_shipdate).cast("int").alias("yr"))
             .agg(F.count(F.lit(1)).alias("c")))
        k = s.s_suppkey
        return (g.join(s, g.l_suppkey == k)
                .select(F.when(k % 4 == 1, F.concat(F.lit("?"), s.s_name))
                         .otherwise(F.lower(s.s_name)).alias("ward_name"),
                        F.when(k % 4 == 0, F.lit(None)).otherwise(k).alias("ward_number"),
                        F.col("yr").alias("year"), (100 * F.col("c")).alias("population"),
                        (52 * F.col("c") + k % 5).alias("male_population"),
                        (48 * F.col("c") - k % 5).alias("female_population"),
                        (k % 7).cast("decimal(10,4)").alias("area_sqkm"),
                        F.lit(123.45).cast("decimal(10,2)").alias("density"),
                        (70 + k % 30).cast("decimal(5,2)").alias("literacy_rate")))

    def aqi_feed(self) -> DataFrame:
        e = self.table("events")
        n = self.n_wards
        return e.select("event_id", "ts", F.col("user_id").alias("station_id"),
                        F.col("ts").cast("date").alias("date"),
                        F.col("value").cast("decimal(8,2)").alias("pm25"),
                        F.floor("value").cast("int").alias("aqi"), "props",
                        _grid_x(F.col("user_id"), n).alias("px"),
                        _grid_y(F.col("user_id"), n).alias("py"))

    def stops(self) -> DataFrame:
        p = self.table("part")
        n = self.n_wards
        return p.select(p.p_partkey.alias("stop_id"), p.p_name.alias("stop_name"),
                        F.when(p.p_partkey % 50 == 0, "BMRCL").otherwise("BMTC").alias("source"),
                        _grid_x(p.p_partkey, n).alias("px"), _grid_y(p.p_partkey, n).alias("py"))

    def city_stops(self) -> DataFrame:
        """Stops of six sources in three cities, partly outside their city's box."""
        p = self.table("part")
        k = p.p_partkey
        pick = lambda values: F.element_at(F.array(*[F.lit(x) for x in values]), (k % len(values) + 1).cast("int"))
        return p.select(k.alias("stop_id"), p.p_name.alias("stop_name"),
                        pick(["BMTC", "BEST", "DTC", "BMRCL", "MMRDA", "DMRC"]).alias("source"),
                        (pick([773000, 727000, 768000]) + (k * 53) % 600 * 10 + 5).alias("px"),
                        (pick([127000, 188700, 284000]) + (k * 37) % 600 * 10 + 5).alias("py"))

    def stop_times(self) -> DataFrame:
        return self.table("lineitem").select(F.col("l_orderkey").alias("trip_id"),
                                             F.col("l_partkey").alias("stop_id"))

    def trips(self) -> DataFrame:
        return self.table("orders").select(F.col("o_orderkey").alias("trip_id"),
                                           F.col("o_custkey").alias("route_id"))

    def ndvi_pixels(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_suppkey").alias("ward_id"), F.year("l_shipdate").cast("int").alias("year"),
            F.month("l_shipdate").cast("int").alias("month"),
            (F.col("l_discount") * 8).cast("decimal(6,4)").alias("ndvi"))

    def property(self) -> DataFrame:
        l, p, s, n = (self.table(t) for t in ("lineitem", "part", "supplier", "nation"))
        price = (F.floor(l.l_extendedprice * 100 / l.l_quantity).cast("decimal(12,0)")
                 * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(10,2)")
        return (l.join(p, l.l_partkey == p.p_partkey)
                .join(s, l.l_suppkey == s.s_suppkey)
                .join(n, s.s_nationkey == n.n_nationkey)
                .select(l.l_orderkey, l.l_linenumber, n.n_name.alias("locality"),
                        F.when(l.l_orderkey % 97 == 0, F.lit(None))
                         .otherwise(F.upper(s.s_name)).alias("ward_name"),
                        price.alias("price_sqft"), p.p_type.alias("property_type"),
                        F.when(l.l_orderkey % 11 == 0, F.lit(None))
                         .otherwise(l.l_shipdate.cast("date")).alias("listing_date"),
                        l.l_shipdate.alias("scraped_at")))

    # ---- reference-shaped feeds built from the views -------------------

    def stops_geo(self) -> DataFrame:
        """Stops as the reference's gtfs_stops rows (degrees)."""
        return self.stops().select("stop_id", "stop_name", "source",
                                   (F.col("px") / DEG).alias("longitude"),
                                   (F.col("py") / DEG).alias("latitude"))

    @cached_property
    def years(self) -> DataFrame:
        return self.spark.range(FIX_YEAR_LO, FIX_YEAR_HI + 1).select(F.col("id").cast("int").alias("year"))
