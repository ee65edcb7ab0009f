"""Independent DuckDB SQL for every checked query.

Written from the reference's SQL semantics, not from the Spark code: the
fixture views of FIXTURES.md part B, the OR join as written, edges unnested
for containment, row_number for MODE, correlated MIN for the nearest metro.
Ratios use the same exact-rounding rule (``sql_round_ratio``) because
DuckDB's DECIMAL division and AVG return DOUBLE.
"""

from __future__ import annotations

from wardpulse.functions.numeric import sql_round_ratio as rr

Y_LO, Y_HI = 1995, 2001

VIEWS: dict[str, str] = {
    "d_n": "SELECT CAST(count(*) AS BIGINT) AS n FROM supplier",
    "d_ward_boundaries": """
SELECT s_suppkey AS ward_id, s_name AS ward_name, s_suppkey AS ward_number,
       r_name AS city, n_name AS zone_name,
       770000 + (s_suppkey % 32) * 200 AS x0,
       120000 + CAST(floor(s_suppkey / 32.0) AS BIGINT) * 200 AS y0
FROM supplier JOIN nation ON s_nationkey = n_nationkey
              JOIN region ON n_regionkey = r_regionkey""",
    "d_ward_edges": """
SELECT ward_id, x0 AS ax, y0 AS ay, x0 + 200 AS bx, y0 AS by_ FROM d_ward_boundaries
UNION ALL SELECT ward_id, x0 + 200, y0, x0 + 200, y0 + 105 FROM d_ward_boundaries
UNION ALL SELECT ward_id, x0 + 200, y0 + 105, x0 + 105, y0 + 200 FROM d_ward_boundaries
UNION ALL SELECT ward_id, x0 + 105, y0 + 200, x0, y0 + 200 FROM d_ward_boundaries
UNION ALL SELECT ward_id, x0, y0 + 200, x0, y0 FROM d_ward_boundaries""",
    "d_complaints": """
SELECT o_orderkey AS complaint_id, o_orderpriority AS category,
       CASE WHEN o_orderkey % 3 = 0 THEN upper(s_name)
            WHEN o_orderkey % 3 = 1 THEN concat('  ', s_name, ' ')
            ELSE s_name END AS ward_name,
       CAST(o_orderdate AS DATE) AS date_filed,
       CASE o_orderstatus WHEN 'F' THEN 'Resolved' WHEN 'O' THEN 'In Progress'
                          ELSE 'Rejected' END AS status
FROM orders CROSS JOIN d_n JOIN supplier ON s_suppkey = o_custkey % n""",
    "d_crime": """
SELECT r_name AS city, CAST(year(l_shipdate) AS INTEGER) AS year,
       CASE l_linenumber WHEN 1 THEN 'theft' WHEN 2 THEN 'murder' WHEN 3 THEN 'robbery'
            WHEN 4 THEN 'assault' WHEN 5 THEN 'kidnapping' WHEN 6 THEN 'burglary'
            ELSE 'cyber crimes' END AS offense_category,
       CAST(l_quantity AS INTEGER) AS cnt
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
              JOIN nation ON s_nationkey = n_nationkey
              JOIN region ON n_regionkey = r_regionkey""",
    "d_census": """
SELECT CASE WHEN s_suppkey % 4 = 1 THEN concat('?', s_name) ELSE lower(s_name) END AS ward_name,
       CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE s_suppkey END AS ward_number,
       yr AS year, 100 * c AS population, 52 * c + s_suppkey % 5 AS male_population,
       48 * c - s_suppkey % 5 AS female_population,
       CAST(s_suppkey % 7 AS DECIMAL(10,4)) AS area_sqkm,
       CAST(123.45 AS DECIMAL(10,2)) AS density,
       CAST(70 + s_suppkey % 30 AS DECIMAL(5,2)) AS literacy_rate
FROM (SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS yr, count(*) AS c
      FROM lineitem GROUP BY l_suppkey, CAST(year(l_shipdate) AS INTEGER)) g
JOIN supplier ON l_suppkey = s_suppkey""",
    "d_aqi_feed": """
SELECT event_id, ts, user_id AS station_id, CAST(ts AS DATE) AS date,
       CAST(value AS DECIMAL(8,2)) AS pm25, CAST(floor(value) AS INTEGER) AS aqi, props,
       770000 + (((user_id * 7) % (n + 1 + CAST(floor(n / 10.0) AS BIGINT))) % 32) * 200
              + 10 * (user_id % 19) + 5 AS px,
       120000 + CAST(floor(((user_id * 7) % (n + 1 + CAST(floor(n / 10.0) AS BIGINT))) / 32.0) AS BIGINT) * 200
              + 10 * (user_id % 17) + 5 AS py
FROM events CROSS JOIN d_n""",
    "d_stops": """
SELECT p_partkey AS stop_id, p_name AS stop_name,
       CASE WHEN p_partkey % 50 = 0 THEN 'BMRCL' ELSE 'BMTC' END AS source,
       770000 + (((p_partkey * 7) % (n + 1 + CAST(floor(n / 10.0) AS BIGINT))) % 32) * 200
              + 10 * (p_partkey % 19) + 5 AS px,
       120000 + CAST(floor(((p_partkey * 7) % (n + 1 + CAST(floor(n / 10.0) AS BIGINT))) / 32.0) AS BIGINT) * 200
              + 10 * (p_partkey % 17) + 5 AS py
FROM part CROSS JOIN d_n""",
    "d_city_stops": """
SELECT p_partkey AS stop_id, p_name AS stop_name,
       ['BMTC', 'BEST', 'DTC', 'BMRCL', 'MMRDA', 'DMRC'][p_partkey % 6 + 1] AS source,
       [773000, 727000, 768000][p_partkey % 3 + 1] + (p_partkey * 53) % 600 * 10 + 5 AS px,
       [127000, 188700, 284000][p_partkey % 3 + 1] + (p_partkey * 37) % 600 * 10 + 5 AS py
FROM part""",
    "d_stop_times": "SELECT l_orderkey AS trip_id, l_partkey AS stop_id FROM lineitem",
    "d_trips": "SELECT o_orderkey AS trip_id, o_custkey AS route_id FROM orders",
    "d_ndvi_pixels": """
SELECT l_suppkey AS ward_id, CAST(year(l_shipdate) AS INTEGER) AS year,
       CAST(month(l_shipdate) AS INTEGER) AS month,
       CAST(l_discount * 8 AS DECIMAL(6,4)) AS ndvi
FROM lineitem""",
    "d_property": """
SELECT l_orderkey, l_linenumber, n_name AS locality,
       CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE upper(s_name) END AS ward_name,
       CAST(CAST(floor(l_extendedprice * 100 / l_quantity) AS DECIMAL(12,0))
            * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS price_sqft,
       p_type AS property_type,
       CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS listing_date,
       l_shipdate AS scraped_at
FROM lineitem JOIN part ON l_partkey = p_partkey
              JOIN supplier ON l_suppkey = s_suppkey
              JOIN nation ON s_nationkey = n_nationkey""",
}

DEPS = {
    "d_ward_boundaries": [], "d_ward_edges": ["d_ward_boundaries"], "d_complaints": ["d_n"],
    "d_aqi_feed": ["d_n"], "d_stops": ["d_n"],
}


def with_views(*names: str) -> str:
    order: list[str] = []

    def add(n: str) -> None:
        for d in DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)
    for n in names:
        add(n)
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in order)


def q(views: tuple[str, ...], body: str) -> str:
    """``body`` may start with more CTEs (", x AS (...)") or with SELECT."""
    body = body.strip()
    if not views:
        return "WITH " + body[1:].strip() if body.startswith(",") else body
    return with_views(*views) + "\n" + body


ORACLES: dict[str, str] = {}
ORACLE_BODY: dict[str, str] = {}


def oracle(name: str, views: tuple[str, ...]):
    def deco(fn):
        body = fn()
        ORACLE_BODY[name] = body
        ORACLES[name] = q(views, body)
        return fn
    return deco


# ------------------------------------------------------------------ models

@oracle("q_stg_complaints", ("d_complaints", "d_ward_boundaries"))
def _():
    return f"""
, agg AS (
  SELECT lower(trim(ward_name)) AS ward_name, CAST(year(date_filed) AS INTEGER) AS year, count(*) AS total_complaints,
         count(*) FILTER (WHERE lower(status) IN ('pending','open','in progress','assigned')) AS pending_complaints,
         count(*) FILTER (WHERE lower(status) IN ('resolved','closed','completed')) AS resolved_complaints,
         count(*) FILTER (WHERE lower(status) IN ('rejected','cancelled')) AS rejected_complaints
  FROM d_complaints
  WHERE date_filed IS NOT NULL AND year(date_filed) BETWEEN {Y_LO} AND {Y_HI}
  GROUP BY lower(trim(ward_name)), CAST(year(date_filed) AS INTEGER)),
cat AS (
  SELECT lower(trim(ward_name)) AS ward_name, CAST(year(date_filed) AS INTEGER) AS year, category,
         row_number() OVER (PARTITION BY lower(trim(ward_name)), CAST(year(date_filed) AS INTEGER)
                            ORDER BY count(*) DESC, category) AS rn
  FROM d_complaints
  WHERE date_filed IS NOT NULL AND year(date_filed) BETWEEN {Y_LO} AND {Y_HI} AND category IS NOT NULL
  GROUP BY lower(trim(ward_name)), CAST(year(date_filed) AS INTEGER), category)
SELECT w.ward_id, w.ward_name, c.year,
       CAST(c.total_complaints AS BIGINT) AS total_complaints,
       CAST(c.pending_complaints AS BIGINT) AS pending_complaints,
       CAST(c.resolved_complaints AS BIGINT) AS resolved_complaints,
       CAST(c.rejected_complaints AS BIGINT) AS rejected_complaints,
       CAST(CASE WHEN c.total_complaints > 0
                 THEN {rr('c.resolved_complaints', 'c.total_complaints', 4, 0, 5)} ELSE 0 END AS DECIMAL(5,4)) AS resolution_rate,
       CAST(NULL AS DECIMAL(8,2)) AS avg_resolution_days,
       m.category AS top_category
FROM d_ward_boundaries w
JOIN agg c ON lower(trim(w.ward_name)) = c.ward_name
LEFT JOIN cat m ON m.ward_name = c.ward_name AND m.year = c.year AND m.rn = 1"""


@oracle("q_mode", ("d_property",))
def _():
    return """
, y AS (SELECT ward_name, CAST(coalesce(year(listing_date), year(scraped_at)) AS INTEGER) AS year,
               property_type FROM d_property WHERE property_type IS NOT NULL),
c AS (SELECT ward_name, year, property_type, row_number() OVER (
        PARTITION BY ward_name, year ORDER BY count(*) DESC, property_type) AS rn
      FROM y GROUP BY ward_name, year, property_type)
SELECT ward_name, year, property_type AS mode_property_type FROM c WHERE rn = 1"""


@oracle("q_median", ("d_property",))
def _():
    return """
, y AS (SELECT ward_name, CAST(coalesce(year(listing_date), year(scraped_at)) AS INTEGER) AS year,
               price_sqft FROM d_property WHERE price_sqft IS NOT NULL),
r AS (SELECT ward_name, year, price_sqft,
             row_number() OVER (PARTITION BY ward_name, year ORDER BY price_sqft) - 1 AS rk,
             count(*) OVER (PARTITION BY ward_name, year) AS n FROM y)
SELECT ward_name, year,
       CAST((max(price_sqft) FILTER (WHERE rk = (n - 1) // 2)
             + max(price_sqft) FILTER (WHERE rk = n // 2)) * CAST(0.5 AS DECIMAL(2,1)) AS DECIMAL(12,3)) AS median_price_sqft
FROM r GROUP BY ward_name, year"""


def _crime_cy(where_city: str = "") -> str:
    cats = ["murder", "theft", "robbery", "assault", "kidnapping", "burglary"]
    sums = ",\n  ".join(f"SUM(CASE WHEN offense_category = '{c}' THEN cnt ELSE 0 END) AS {c}_count" for c in cats)
    return f"""cy AS (SELECT city, year, {sums}, SUM(cnt) AS total_ipc_offenses
  FROM d_crime WHERE year BETWEEN {Y_LO} AND {Y_HI} {where_city} GROUP BY city, year)"""


@oracle("q_crime_pivot", ("d_crime",))
def _():
    return f""", {_crime_cy()}
SELECT city, year, CAST(murder_count AS BIGINT) AS murder_count, CAST(theft_count AS BIGINT) AS theft_count,
       CAST(robbery_count AS BIGINT) AS robbery_count, CAST(assault_count AS BIGINT) AS assault_count,
       CAST(kidnapping_count AS BIGINT) AS kidnapping_count, CAST(burglary_count AS BIGINT) AS burglary_count,
       CAST(total_ipc_offenses AS BIGINT) AS total_ipc_offenses FROM cy"""


@oracle("q_crime_unpivot", ("d_crime",))
def _():
    cats = ["murder", "theft", "robbery", "assault", "kidnapping", "burglary"]
    arms = "\nUNION ALL ".join(
        f"SELECT city, year, '{c}' AS offense_category, CAST({c}_count AS BIGINT) AS count FROM cy" for c in cats)
    return f""", {_crime_cy()}
{arms}"""


@oracle("q_stg_crime", ("d_crime", "d_census", "d_ward_boundaries"))
def _():
    cats = ["total_ipc_offenses"] + [f"{c}_count" for c in
                                     ["murder", "theft", "robbery", "assault", "kidnapping", "burglary"]]
    spread = ",\n  ".join(
        f"CAST(coalesce({rr(f'{c} * population', 'pop_total', 0)}, 0) AS INTEGER) AS {c}" for c in cats)
    return f""", {_crime_cy()},
base AS (SELECT w.ward_id, w.ward_name, c.*, cp.population
         FROM d_ward_boundaries w JOIN cy c ON c.city = w.city
         LEFT JOIN d_census cp ON lower(trim(w.ward_name)) = lower(trim(cp.ward_name)) AND c.year = cp.year),
t AS (SELECT *, sum(population) OVER (PARTITION BY city, year) AS pop_total FROM base)
SELECT ward_id, ward_name, year,
  {spread},
  CAST(CASE WHEN population > 0 THEN {rr('total_ipc_offenses * 1000', 'pop_total', 4)} ELSE 0 END
       AS DECIMAL(18,4)) AS crime_rate_per_1000,
  city || '_ncrb' AS source_pdf
FROM t"""


def _census_clean() -> str:
    return f"""cc AS (
  SELECT ward_name, ward_number, year, population,
         CASE WHEN area_sqkm > 0 THEN {rr('population', 'area_sqkm', 2, 0, 12, den_scale=4)}
              ELSE CAST(density AS DECIMAL(12,2)) END AS population_density,
         literacy_rate,
         CASE WHEN male_population > 0 THEN {rr('female_population * 1000', 'male_population', 2, 0, 12)}
         END AS sex_ratio
  FROM d_census WHERE population IS NOT NULL AND population > 0)"""


@oracle("q_or_join", ("d_census", "d_ward_boundaries"))
def _():
    return """
SELECT w.ward_id, c.ward_name AS census_name, c.ward_number AS census_number, c.year
FROM d_census c JOIN d_ward_boundaries w
  ON (w.ward_number = c.ward_number OR lower(trim(w.ward_name)) = lower(trim(c.ward_name)))"""


@oracle("q_stg_census", ("d_census", "d_ward_boundaries"))
def _():
    return f""", {_census_clean()}
SELECT w.ward_id, w.ward_name, c.year, c.population, c.population_density, c.literacy_rate,
       CAST(NULL AS DECIMAL(5,2)) AS male_literacy, CAST(NULL AS DECIMAL(5,2)) AS female_literacy,
       CAST(NULL AS DECIMAL(5,2)) AS avg_household_size, CAST(NULL AS INTEGER) AS total_households,
       c.sex_ratio
FROM cc c JOIN d_ward_boundaries w
  ON (w.ward_number = c.ward_number OR lower(trim(w.ward_name)) = lower(trim(c.ward_name)))"""


@oracle("q_census_clean", ("d_census",))
def _():
    return f""", {_census_clean()}
SELECT ward_name, ward_number, year, population, population_density, literacy_rate, sex_ratio FROM cc"""


def _zonal() -> str:
    return f"""zr AS (SELECT ward_id, year, month, ndvi,
        row_number() OVER (PARTITION BY ward_id, year, month ORDER BY ndvi) - 1 AS rk,
        count(*) OVER (PARTITION BY ward_id, year, month) AS n
      FROM d_ndvi_pixels WHERE ndvi IS NOT NULL),
zonal AS (SELECT z.ward_id, w.ward_name, z.year, z.month,
        {rr('sum(ndvi)', 'count(ndvi)', 4, 4, 6)} AS mean_ndvi,
        CAST(round((max(ndvi) FILTER (WHERE rk = (n - 1) // 2) + max(ndvi) FILTER (WHERE rk = n // 2))
                   * CAST(0.5 AS DECIMAL(2,1)), 4) AS DECIMAL(6,4)) AS median_ndvi,
        CAST(min(ndvi) AS DECIMAL(6,4)) AS min_ndvi, CAST(max(ndvi) AS DECIMAL(6,4)) AS max_ndvi,
        CAST(stddev_pop(CAST(ndvi AS DOUBLE)) AS DECIMAL(6,4)) AS std_ndvi,
        CAST(count(*) AS INTEGER) AS pixel_count
      FROM zr z JOIN d_ward_boundaries w ON w.ward_id = z.ward_id
      GROUP BY z.ward_id, w.ward_name, z.year, z.month)"""


@oracle("q_ndvi_zonal", ("d_ndvi_pixels", "d_ward_boundaries"))
def _():
    return f""", {_zonal()}
SELECT * FROM zonal"""


@oracle("q_stg_ndvi", ("d_ndvi_pixels", "d_ward_boundaries"))
def _():
    return f""", {_zonal()},
mr AS (SELECT ward_id, ward_name, year, median_ndvi,
         row_number() OVER (PARTITION BY ward_id, ward_name, year ORDER BY median_ndvi) - 1 AS rk,
         count(*) OVER (PARTITION BY ward_id, ward_name, year) AS n FROM zonal
       WHERE year BETWEEN {Y_LO} AND {Y_HI}),
med AS (SELECT ward_id, ward_name, year,
         (max(median_ndvi) FILTER (WHERE rk = (n - 1) // 2) + max(median_ndvi) FILTER (WHERE rk = n // 2))
           * CAST(0.5 AS DECIMAL(2,1)) AS m FROM mr GROUP BY ward_id, ward_name, year),
yr AS (SELECT ward_id, ward_name, year, {rr('sum(mean_ndvi)', 'count(mean_ndvi)', 4, 4, 6)} AS avg_ndvi,
         min(min_ndvi) AS min_ndvi, max(max_ndvi) AS max_ndvi
       FROM zonal WHERE year BETWEEN {Y_LO} AND {Y_HI} GROUP BY ward_id, ward_name, year)
SELECT y.ward_id, y.ward_name, y.year, y.avg_ndvi,
       CAST(round(m.m, 4) AS DECIMAL(6,4)) AS median_ndvi,
       CAST(y.min_ndvi AS DECIMAL(6,4)) AS min_ndvi, CAST(y.max_ndvi AS DECIMAL(6,4)) AS max_ndvi,
       CAST(coalesce(y.avg_ndvi - lag(y.avg_ndvi) OVER (PARTITION BY y.ward_id ORDER BY y.year), 0) AS DECIMAL(6,4)) AS ndvi_change_yoy,
       CAST(CASE WHEN y.avg_ndvi > 0.6 THEN 80.0 WHEN y.avg_ndvi > 0.4 THEN 60.0
                 WHEN y.avg_ndvi > 0.3 THEN 40.0 WHEN y.avg_ndvi > 0.2 THEN 20.0 ELSE 10.0 END AS DECIMAL(5,2)) AS green_cover_pct
FROM yr y LEFT JOIN med m ON m.ward_id = y.ward_id AND m.ward_name = y.ward_name AND m.year = y.year"""


@oracle("q_stg_property", ("d_property", "d_ward_boundaries"))
def _():
    return f"""
, mapped AS (
  SELECT coalesce(wn.ward_id, wg.ward_id) AS ward_id, coalesce(wn.ward_name, wg.ward_name, p.ward_name) AS ward_name,
         CAST(coalesce(year(p.listing_date), year(p.scraped_at)) AS INTEGER) AS year,
         p.price_sqft, p.property_type
  FROM d_property p
  LEFT JOIN d_ward_boundaries wn ON lower(trim(p.ward_name)) = lower(trim(wn.ward_name))
  LEFT JOIN d_ward_boundaries wg ON p.ward_name IS NULL
  WHERE p.price_sqft IS NOT NULL AND p.price_sqft BETWEEN 1000 AND 100000),
m AS (SELECT * FROM mapped WHERE ward_id IS NOT NULL AND year BETWEEN {Y_LO} AND {Y_HI}),
r AS (SELECT ward_id, ward_name, year, price_sqft,
        row_number() OVER (PARTITION BY ward_id, ward_name, year ORDER BY price_sqft) - 1 AS rk,
        count(*) OVER (PARTITION BY ward_id, ward_name, year) AS n FROM m),
med AS (SELECT ward_id, ward_name, year,
        CAST(round((max(price_sqft) FILTER (WHERE rk = (n - 1) // 2) + max(price_sqft) FILTER (WHERE rk = n // 2))
                   * CAST(0.5 AS DECIMAL(2,1)), 2) AS DECIMAL(10,2)) AS median_price_sqft
      FROM r GROUP BY ward_id, ward_name, year),
md AS (SELECT ward_id, ward_name, year, property_type, row_number() OVER (
        PARTITION BY ward_id, ward_name, year ORDER BY count(*) DESC, property_type) AS rn
      FROM m WHERE property_type IS NOT NULL GROUP BY ward_id, ward_name, year, property_type),
agg AS (SELECT ward_id, ward_name, year, {rr('sum(price_sqft)', 'count(*)', 2, 2, 10)} AS avg_price_sqft,
        CAST(min(price_sqft) AS DECIMAL(10,2)) AS min_price_sqft, CAST(max(price_sqft) AS DECIMAL(10,2)) AS max_price_sqft,
        count(*) AS listing_count FROM m GROUP BY ward_id, ward_name, year),
j AS (SELECT a.*, d.median_price_sqft, md.property_type AS dominant_property_type,
        lag(d.median_price_sqft) OVER (PARTITION BY a.ward_id ORDER BY a.year) AS prev
      FROM agg a JOIN med d USING (ward_id, ward_name, year)
      LEFT JOIN md ON md.ward_id = a.ward_id AND md.ward_name = a.ward_name AND md.year = a.year AND md.rn = 1)
SELECT ward_id, ward_name, year, median_price_sqft, avg_price_sqft, min_price_sqft, max_price_sqft,
       listing_count,
       CAST(coalesce(CASE WHEN prev > 0 THEN {rr('median_price_sqft - prev', 'prev', 4, 2, 12, den_scale=2)} END, 0)
            AS DECIMAL(8,4)) AS price_change_yoy,
       dominant_property_type
FROM j"""


# ====================================================================
# second batch: geo, air quality, sinks, GTFS, NDVI composite, mart,
# scores, text functions, data quality
# ====================================================================

KM_PER_DEG = repr(6371.0088 * 3.141592653589793 / 180.0)
TWO_R = repr(2 * 6371.0088)

TITLE_RUN = r"[\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+"


def title(x: str) -> str:
    return (f"CASE WHEN {x} IS NOT NULL THEN array_to_string(list_transform(regexp_extract_all({x}, "
            f"'{TITLE_RUN}'), lambda s: upper(s[1]) || lower(s[2:])), '') END")


def hav(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    return (f"({TWO_R} * asin(sqrt(least(1.0, pow(sin((radians({lat2}) - radians({lat1})) / 2), 2)"
            f" + cos(radians({lat1})) * cos(radians({lat2}))"
            f" * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2)))))")


def inward(pts: str, idc: str) -> str:
    """Even-odd containment of integer points (px, py) over d_ward_edges."""
    return f"""SELECT p.{idc} AS id, e.ward_id FROM {pts} p JOIN d_ward_edges e
  ON (e.ay > p.py) <> (e.by_ > p.py)
 AND ((p.px - e.ax) * (e.by_ - e.ay) - (e.bx - e.ax) * (p.py - e.ay)) * sign(e.by_ - e.ay) < 0
GROUP BY p.{idc}, e.ward_id HAVING count(*) % 2 = 1"""


def cte_of(body: str) -> str:
    """Turn an oracle body (', a AS (...) SELECT' or 'SELECT') into a subquery text."""
    b = body.strip()
    return "WITH " + b[1:].strip() if b.startswith(",") else b


@oracle("q_point_in_ward", ("d_stops", "d_ward_edges"))
def _():
    return f"""
, pin AS ({inward('d_stops', 'stop_id')})
SELECT id AS stop_id, ward_id FROM pin"""


def _seg_dist() -> str:
    kx = f"(cos(radians(p.y)) * {KM_PER_DEG})"
    ky = KM_PER_DEG
    ux, uy = f"((e.bx - e.ax) * {kx})", f"((e.by_ - e.ay) * {ky})"
    wx, wy = f"((p.x - e.ax) * {kx})", f"((p.y - e.ay) * {ky})"
    len2 = f"({ux} * {ux} + {uy} * {uy})"
    t = f"(CASE WHEN {len2} > 0 THEN greatest(0.0, least(1.0, ({wx} * {ux} + {wy} * {uy}) / {len2})) ELSE 0.0 END)"
    dx, dy = f"({wx} - {t} * {ux})", f"({wy} - {t} * {uy})"
    return f"sqrt({dx} * {dx} + {dy} * {dy})"


@oracle("q_ward_lookup", ("d_stops", "d_ward_edges"))
def _():
    return f"""
, pin AS ({inward('d_stops', 'stop_id')}),
inside AS (SELECT id AS stop_id, min(ward_id) AS ward_id FROM pin GROUP BY id),
p AS (SELECT stop_id, px / 10000.0 AS x, py / 10000.0 AS y FROM d_stops),
e AS (SELECT ward_id, ax / 10000.0 AS ax, ay / 10000.0 AS ay, bx / 10000.0 AS bx, by_ / 10000.0 AS by_
      FROM d_ward_edges),
dist AS (SELECT p.stop_id, e.ward_id, min({_seg_dist()}) AS d FROM p, e GROUP BY p.stop_id, e.ward_id),
near AS (SELECT stop_id, ward_id, row_number() OVER (PARTITION BY stop_id ORDER BY d, ward_id) AS rn
         FROM dist WHERE d <= 0.5)
SELECT s.stop_id, coalesce(i.ward_id, n.ward_id) AS ward_id,
       CASE WHEN i.ward_id IS NOT NULL THEN 'contains' WHEN n.ward_id IS NOT NULL THEN 'nearest' END AS match
FROM d_stops s LEFT JOIN inside i ON i.stop_id = s.stop_id
LEFT JOIN near n ON n.stop_id = s.stop_id AND n.rn = 1 AND i.ward_id IS NULL"""


@oracle("q_nearest_metro", ("d_stops",))
def _():
    return f"""
, m AS (SELECT px / 10000.0 AS mx, py / 10000.0 AS my FROM d_stops WHERE source = 'BMRCL')
SELECT s.stop_id, CAST(min({hav('s.px / 10000.0', 's.py / 10000.0', 'm.mx', 'm.my')}) AS DECIMAL(12,6)) AS metro_distance_km
FROM d_stops s, m GROUP BY s.stop_id"""


# ------------------------------------------------------------ air quality
def _readings(day: str = "date") -> str:
    return f"""rd AS (
  SELECT station_id, 'station_' || station_id AS station_name,
         CAST(CAST(py AS DECIMAL(12,0)) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(10,7)) AS latitude,
         CAST(CAST(px AS DECIMAL(12,0)) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(10,7)) AS longitude,
         {day} AS date, pm25, aqi, px, py, ts, event_id
  FROM (SELECT *, row_number() OVER (PARTITION BY station_id, date ORDER BY ts DESC, event_id DESC) AS rn
        FROM d_aqi_feed) WHERE rn = 1)"""


def _station_city() -> str:
    return f"""sp AS (SELECT DISTINCT station_id, px, py FROM d_aqi_feed),
spin AS ({inward('sp', 'station_id')}),
scity AS (SELECT s.id AS station_id, s.ward_id, w.ward_name, w.city FROM spin s
          JOIN d_ward_boundaries w ON w.ward_id = s.ward_id)"""


# the mart's readings: the days of 2024 spread over the fixture's seven years
MART_DAY = "CAST(date - to_years(CAST(23 + day(date) % 7 AS INTEGER)) AS DATE)"


def stg_aqi_body(lo: int, hi: int, day: str = "date") -> str:
    nulls = ", ".join(f"CAST(NULL AS DECIMAL(8,2)) AS avg_{p}" for p in ("pm10", "no2", "so2", "co", "o3"))
    return f""", {_readings(day)}, {_station_city()},
j AS (SELECT c.ward_id, c.ward_name, CAST(year(r.date) AS INTEGER) AS year, r.*
      FROM rd r JOIN scity c ON c.station_id = r.station_id
      WHERE r.date IS NOT NULL AND year(r.date) BETWEEN {lo} AND {hi})
SELECT ward_id, ward_name, year,
  {rr('sum(pm25)', 'count(pm25)', 2, 2, 8)} AS avg_pm25, {nulls},
  {rr('sum(aqi)', 'count(aqi)', 2, 0, 8)} AS avg_aqi,
  {rr('count(*) FILTER (WHERE aqi <= 50) * 100', 'count(*)', 2, 0, 5)} AS aqi_good_days_pct,
  count(DISTINCT station_id) AS station_count,
  {rr('sum(longitude)', 'count(longitude)', 7, 7, 10)} AS centroid_lon,
  {rr('sum(latitude)', 'count(latitude)', 7, 7, 10)} AS centroid_lat
FROM j GROUP BY ward_id, ward_name, year"""


ORACLES["q_stg_aqi"] = q(("d_aqi_feed", "d_ward_boundaries", "d_ward_edges"), stg_aqi_body(2018, 2024))


def _payload() -> str:
    pm, aq = "CAST(pm25 AS VARCHAR)", "CAST(aqi AS VARCHAR)"
    return f"""CASE event_id % 6
  WHEN 0 THEN '{{"records":[{{"pm25":"' || {pm} || '","pm10":"NA","aqi":"' || {aq} || '","prominent_pollutant":"PM2.5","meta":' || props || '}}]}}'
  WHEN 1 THEN '{{"data":[{{"PM2.5":"' || {pm} || '","PM10":"","AQI":"' || {aq} || '.7","predominant":"PM10"}}]}}'
  WHEN 2 THEN '{{"data":{{"pm25":' || {pm} || ',"aqi":' || {aq} || '}}}}'
  WHEN 3 THEN '{{"records":[]}}'
  WHEN 4 THEN '{{"records":[{{"pm25":null,"PM2.5":"' || {pm} || '","aqi":"' || {aq} || '"}}]}}'
  ELSE '{{"other":1}}' END"""


def _jget(k: str, alt: str) -> str:
    return (f"CASE WHEN json_exists(rec, '$.\"{k}\"') THEN json_extract_string(rec, '$.\"{k}\"') "
            f"ELSE json_extract_string(rec, '$.\"{alt}\"') END")


def _sf(x: str) -> str:
    return f"CAST(round(TRY_CAST(NULLIF(NULLIF({x}, ''), 'NA') AS DECIMAL(30,10)), 2) AS DECIMAL(20,2))"


@oracle("q_aqi_parse", ("d_aqi_feed",))
def _():
    fields = [("pm25", "PM2.5"), ("pm10", "PM10"), ("no2", "NO2"), ("so2", "SO2"), ("co", "CO"), ("o3", "Ozone")]
    cols = ",\n  ".join(f"{_sf(_jget(k, a))} AS {k}" for k, a in fields)
    return f"""
, p AS (SELECT event_id, {_payload()} AS payload FROM d_aqi_feed),
r AS (SELECT event_id, CASE WHEN json_exists(payload, '$.records') THEN json_extract(payload, '$.records')
                          ELSE coalesce(json_extract(payload, '$.data'), '[]'::JSON) END AS rd FROM p),
x AS (SELECT event_id, CASE WHEN json_type(rd) = 'ARRAY' AND json_array_length(rd) > 0
                            THEN (CASE WHEN json_type(rd -> 0) = 'OBJECT' THEN rd -> 0 ELSE '{{}}'::JSON END)
                            WHEN json_type(rd) = 'OBJECT' THEN rd END AS rec FROM r)
SELECT event_id,
  {cols},
  TRY_CAST(trunc(TRY_CAST(NULLIF(NULLIF({_jget('aqi', 'AQI')}, ''), 'NA') AS DOUBLE)) AS INTEGER) AS aqi,
  CASE WHEN json_exists(rec, '$.prominent_pollutant') THEN json_extract_string(rec, '$.prominent_pollutant')
       ELSE coalesce(json_extract_string(rec, '$.predominant'), '') END AS prominent_pollutant
FROM x WHERE rec IS NOT NULL"""


@oracle("q_aqi_coverage", ("d_aqi_feed",))
def _():
    return """
, b AS (SELECT min(date) AS lo, max(date) AS hi FROM d_aqi_feed),
st AS (SELECT DISTINCT station_id FROM d_aqi_feed),
sp AS (SELECT st.station_id, CAST(g.d AS DATE) AS d
       FROM st, b, LATERAL unnest(generate_series(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP), INTERVAL 1 DAY)) AS g(d)),
dd AS (SELECT DISTINCT station_id, date AS d FROM d_aqi_feed)
SELECT sp.station_id, count(*) AS days_expected, count(dd.d) AS days_with_reading,
       count(*) - count(dd.d) AS days_missing
FROM sp LEFT JOIN dd ON dd.station_id = sp.station_id AND dd.d = sp.d GROUP BY sp.station_id"""


@oracle("q_daily_aqi", ("d_aqi_feed", "d_ward_boundaries", "d_ward_edges"))
def _():
    return f""", {_station_city()}
SELECT c.city, CAST(a.ts AS DATE) AS day, {rr('sum(a.pm25)', 'count(a.pm25)', 2, 2, 8)} AS avg_pm25,
       count(*) AS n_readings
FROM d_aqi_feed a JOIN scity c ON c.station_id = a.station_id
GROUP BY c.city, CAST(a.ts AS DATE)"""


@oracle("q_latest_aqi", ("d_aqi_feed", "d_ward_boundaries", "d_ward_edges"))
def _():
    return f""", {_readings()}, {_station_city()},
k AS (SELECT c.city, r.station_id, r.date, r.pm25, r.aqi,
             row_number() OVER (PARTITION BY c.city ORDER BY r.date DESC, r.station_id) AS rk
      FROM rd r JOIN scity c ON c.station_id = r.station_id)
SELECT city, station_id, date, pm25, aqi FROM k WHERE rk <= 10"""


# ------------------------------------------------------------ sinks
def _tb() -> str:
    return """tg AS (SELECT station_id, date, event_id, ts, pm25, aqi, props FROM (
        SELECT *, row_number() OVER (PARTITION BY station_id, date ORDER BY ts DESC, event_id DESC) AS rn
        FROM d_aqi_feed WHERE date <= DATE '2024-01-20') WHERE rn = 1),
bt AS (SELECT station_id, date, event_id, ts, pm25, aqi, props FROM (
        SELECT *, row_number() OVER (PARTITION BY station_id, date ORDER BY ts, event_id) AS rn
        FROM d_aqi_feed WHERE date >= DATE '2024-01-15') WHERE rn = 1)"""


@oracle("q_upsert", ("d_aqi_feed",))
def _():
    return f""", {_tb()}
SELECT coalesce(t.station_id, b.station_id) AS station_id, coalesce(t.date, b.date) AS date,
       CASE WHEN t.station_id IS NOT NULL THEN t.event_id ELSE b.event_id END AS event_id,
       CASE WHEN t.station_id IS NOT NULL THEN t.ts ELSE b.ts END AS ts,
       CASE WHEN b.station_id IS NOT NULL THEN b.pm25 ELSE t.pm25 END AS pm25,
       CASE WHEN b.station_id IS NOT NULL THEN b.aqi ELSE t.aqi END AS aqi,
       CASE WHEN t.station_id IS NOT NULL THEN t.props ELSE b.props END AS props
FROM tg t FULL OUTER JOIN bt b ON t.station_id = b.station_id AND t.date = b.date"""


@oracle("q_insert_ignore", ("d_aqi_feed",))
def _():
    return f""", {_tb()}
SELECT * FROM tg
UNION ALL
SELECT * FROM bt b WHERE NOT EXISTS (SELECT 1 FROM tg t WHERE t.station_id = b.station_id AND t.date = b.date)"""


@oracle("q_replace_where", ("d_aqi_feed",))
def _():
    return f""", {_tb()}
SELECT * FROM tg WHERE NOT coalesce(date >= DATE '2024-01-15', false)
UNION ALL SELECT * FROM bt"""


@oracle("q_audit_state", ())
def _():
    return """
, ev AS (SELECT 'run-' || user_id AS run_id,
                CASE WHEN event_type = 'purchase' THEN 'success' WHEN event_type = 'error' THEN 'failed'
                     ELSE 'running' END AS status,
                CAST(floor(value) AS INTEGER) AS records_loaded,
                CASE WHEN event_type = 'error' THEN 'error at ' || event_id END AS error_message,
                ts, event_id FROM events),
lst AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY ts DESC, event_id DESC) AS rn
                       FROM ev) WHERE rn = 1)
SELECT l.run_id, l.status, l.records_loaded, l.error_message,
       (SELECT min(ts) FROM ev e WHERE e.run_id = l.run_id AND e.status = 'running') AS started_at,
       (SELECT max(ts) FROM ev e WHERE e.run_id = l.run_id AND e.status IN ('success', 'failed')) AS finished_at,
       (SELECT count(*) FROM ev e WHERE e.run_id = l.run_id) AS n_events
FROM lst l"""


# ------------------------------------------------------------ GTFS
def _freq() -> str:
    return """fq AS (SELECT CAST(st.stop_id AS VARCHAR) AS stop_id, count(DISTINCT t.route_id) AS route_count,
                  count(st.trip_id) AS avg_frequency
       FROM d_stop_times st LEFT JOIN d_trips t ON t.trip_id = st.trip_id
       WHERE st.stop_id IS NOT NULL GROUP BY st.stop_id)"""


def _enriched() -> str:
    return f"""{_freq()},
en AS (SELECT s.stop_id, s.stop_name, s.source, s.px, s.py,
              CAST(coalesce(f.route_count, 0) AS INTEGER) AS route_count,
              CAST(coalesce(f.avg_frequency, 0) AS DECIMAL(8,2)) AS avg_frequency
       FROM d_stops s LEFT JOIN fq f ON f.stop_id = CAST(s.stop_id AS VARCHAR))"""


@oracle("q_gtfs_stops", ("d_city_stops",))
def _():
    return """
, raw AS (SELECT trim(CAST(stop_id AS VARCHAR)) AS stop_id, trim(stop_name || ' ') AS stop_name,
                 TRY_CAST(CAST(CAST(CAST(py AS DECIMAL(12,0)) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(10,4)) AS VARCHAR) AS DOUBLE) AS latitude,
                 TRY_CAST(CAST(CAST(CAST(px AS DECIMAL(12,0)) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(10,4)) AS VARCHAR) AS DOUBLE) AS longitude,
                 source FROM d_city_stops)
SELECT stop_id, stop_name, latitude, longitude, source, '' AS stop_desc, '' AS zone_id FROM raw
WHERE CASE WHEN source LIKE '%BMTC%' OR source LIKE '%BMRCL%' OR NOT (source LIKE '%BEST%' OR source LIKE '%MMRDA%' OR source LIKE '%DTC%' OR source LIKE '%DMRC%')
           THEN latitude BETWEEN 12.73 AND 13.18 AND longitude BETWEEN 77.35 AND 77.85
           WHEN source LIKE '%BEST%' OR source LIKE '%MMRDA%'
           THEN latitude BETWEEN 18.89 AND 19.27 AND longitude BETWEEN 72.77 AND 72.98
           ELSE latitude BETWEEN 28.41 AND 28.88 AND longitude BETWEEN 76.84 AND 77.35 END"""


@oracle("q_bbox_filter", ("d_city_stops",))
def _():
    return """
, s AS (SELECT stop_id, px / 10000.0 AS x, py / 10000.0 AS y,
               CASE WHEN source LIKE '%BMTC%' OR source LIKE '%BMRCL%' THEN 'Bengaluru'
                    WHEN source LIKE '%BEST%' OR source LIKE '%MMRDA%' THEN 'Mumbai'
                    WHEN source LIKE '%DTC%' OR source LIKE '%DMRC%' THEN 'Delhi' ELSE 'Bengaluru' END AS city
        FROM d_city_stops)
SELECT stop_id, city,
       coalesce((city = 'Bengaluru' AND y BETWEEN 12.73 AND 13.18 AND x BETWEEN 77.35 AND 77.85)
             OR (city = 'Mumbai' AND y BETWEEN 18.89 AND 19.27 AND x BETWEEN 72.77 AND 72.98)
             OR (city = 'Delhi' AND y BETWEEN 28.41 AND 28.88 AND x BETWEEN 76.84 AND 77.35), false) AS inside
FROM s"""


@oracle("q_route_frequency", ("d_stop_times", "d_trips"))
def _():
    return f""", {_freq()}
SELECT stop_id, route_count, avg_frequency FROM fq"""


@oracle("q_gtfs_enriched", ("d_stops", "d_stop_times", "d_trips"))
def _():
    return f""", {_enriched()}
SELECT stop_id, stop_name, source, route_count, avg_frequency FROM en"""


def _ward_transit() -> str:
    score = ("least(100.0, CAST(least(bus_stops_count, 50) AS DOUBLE) / 50 * 40"
             " + greatest(0.0, 1 - km / 10.0) * 40"
             " + least(CAST(avg_route_frequency AS DOUBLE), 100.0) / 100 * 20)")
    return f"""{_enriched()},
pin AS ({inward('en', 'stop_id')}),
m AS (SELECT px / 10000.0 AS mx, py / 10000.0 AS my FROM d_stops WHERE source = 'BMRCL'),
md AS (SELECT p.id AS stop_id, min({hav('e.px / 10000.0', 'e.py / 10000.0', 'm.mx', 'm.my')}) AS km
       FROM (SELECT DISTINCT id FROM pin) p JOIN en e ON e.stop_id = p.id, m GROUP BY p.id),
wt0 AS (SELECT w.ward_id, w.ward_name, count(*) AS bus_stops_count, min(md.km) AS km,
               {rr('sum(e.avg_frequency)', 'count(e.avg_frequency)', 2, 2, 8)} AS avg_route_frequency,
               sum(e.route_count) AS total_routes
        FROM pin p JOIN en e ON e.stop_id = p.id JOIN d_ward_boundaries w ON w.ward_id = p.ward_id
        LEFT JOIN md ON md.stop_id = p.id
        GROUP BY w.ward_id, w.ward_name),
wt AS (SELECT ward_id, ward_name, bus_stops_count,
              CAST(round(CAST(coalesce(km, 99.0) AS DECIMAL(20,10)), 3) AS DECIMAL(8,3)) AS metro_proximity_km,
              avg_route_frequency, total_routes,
              CAST(round(CAST({score} AS DECIMAL(20,10)), 2) AS DECIMAL(5,2)) AS transit_score
       FROM wt0)"""


@oracle("q_transit_score", ("d_stops", "d_stop_times", "d_trips", "d_ward_boundaries", "d_ward_edges"))
def _():
    return f""", {_ward_transit()}
SELECT * FROM wt"""


def stg_transit_body(lo: int, hi: int) -> str:
    return f""", {_ward_transit()}
SELECT ward_id, ward_name, CAST(y.year AS INTEGER) AS year, bus_stops_count, metro_proximity_km,
       avg_route_frequency, total_routes, transit_score
FROM wt, range({lo}, {hi + 1}) y(year)"""


ORACLES["q_stg_transit"] = q(("d_stops", "d_stop_times", "d_trips", "d_ward_boundaries", "d_ward_edges"),
                             stg_transit_body(Y_LO, Y_HI))


# ------------------------------------------------------------ NDVI composite, semi join
@oracle("q_ndvi_composite", ())
def _():
    return """
, o AS (SELECT l_suppkey AS x, l_partkey AS y, CAST(year(l_shipdate) AS INTEGER) AS year,
               CAST(month(l_shipdate) AS INTEGER) AS month, l_linenumber AS scene,
               CASE WHEN (year(l_shipdate) * 12 + month(l_shipdate)) % 5 < 2 THEN 90
                    ELSE (l_linenumber * 11) % 40 END AS cloud, CAST(l_quantity AS INTEGER) % 12 AS scl,
               l_quantity AS b4, l_extendedprice / 1000.0 AS b8 FROM lineitem),
sc AS (SELECT DISTINCT year, month, scene, cloud FROM o),
mc AS (SELECT year * 12 + month - 1 AS mi, avg(cloud) AS mcl FROM sc GROUP BY 1),
us AS (SELECT mi FROM mc WHERE mcl <= 80),
k AS (SELECT x, y, year * 12 + month - 1 AS mi, (b8 - b4) / nullif(b8 + b4, 0) AS ndvi FROM o
      WHERE scl NOT IN (3, 8, 9, 10) AND cloud < 30 AND year * 12 + month - 1 IN (SELECT mi FROM us)),
r AS (SELECT x, y, mi, ndvi, row_number() OVER (PARTITION BY x, y, mi ORDER BY ndvi) - 1 AS rk,
             count(*) OVER (PARTITION BY x, y, mi) AS n FROM k WHERE ndvi IS NOT NULL),
c AS (SELECT x, y, mi, max(ndvi) FILTER (WHERE rk = (n - 1) // 2) AS lo,
             max(ndvi) FILTER (WHERE rk = n // 2) AS hi, max(n) AS n FROM r GROUP BY x, y, mi),
ms AS (SELECT unnest(range(min(year * 12 + month - 1), max(year * 12 + month - 1) + 1)) AS mi FROM o),
src AS (SELECT ms.mi, (SELECT max(u.mi) FROM us u WHERE u.mi <= ms.mi) AS src FROM ms)
SELECT c.x, c.y, CAST(src.mi // 12 AS INTEGER) AS year, CAST(src.mi % 12 + 1 AS INTEGER) AS month,
       CAST(c.lo + (c.hi - c.lo) * (CASE WHEN c.n % 2 = 0 THEN 0.5 ELSE 0.0 END) AS DECIMAL(12,6)) AS ndvi,
       src.src <> src.mi AS is_fallback
FROM c JOIN src ON c.mi = src.src"""


@oracle("q_ndvi_wards", ("d_stops", "d_ward_edges"))
def _():
    return f"""
, o AS (SELECT ['Bengaluru', 'Mumbai', 'Delhi'][stop_id % 3 + 1] AS city, px, py,
               year(l_shipdate) * 12 + month(l_shipdate) - 1 AS mi, l_linenumber AS scene,
               CASE WHEN (year(l_shipdate) * 12 + month(l_shipdate) + stop_id % 3) % 5 < 2 THEN 90
                    ELSE (l_linenumber * 11) % 40 END AS cloud, CAST(l_quantity AS INTEGER) % 12 AS scl,
               l_quantity AS b4, l_extendedprice / 1000.0 AS b8 FROM lineitem JOIN d_stops ON l_partkey = stop_id),
us AS (SELECT city, mi FROM (SELECT DISTINCT city, mi, scene, cloud FROM o) GROUP BY 1, 2 HAVING avg(cloud) <= 80),
k AS (SELECT city, px, py, mi, (b8 - b4) / nullif(b8 + b4, 0) AS ndvi FROM o SEMI JOIN us USING (city, mi)
      WHERE scl NOT IN (3, 8, 9, 10) AND cloud < 30),
c AS (SELECT city, px, py, mi, quantile_cont(CAST(ndvi AS DOUBLE), 0.5) AS ndvi FROM k
      WHERE ndvi IS NOT NULL GROUP BY ALL),
ms AS (SELECT unnest(range(min(mi), max(mi) + 1)) AS mi FROM o),
src AS (SELECT ms.mi, us.city, max(us.mi) AS src FROM ms JOIN us ON us.mi <= ms.mi GROUP BY 1, 2),
pts AS (SELECT DISTINCT px, py, px * 10000000 + py AS id FROM o),
pin AS ({inward('pts', 'id')}),
px AS (SELECT pin.ward_id, CAST(src.mi // 12 AS INTEGER) AS year, CAST(src.mi % 12 + 1 AS INTEGER) AS month,
              CAST(CAST(c.ndvi AS DECIMAL(12,6)) AS DECIMAL(6,4)) AS ndvi
       FROM c JOIN src ON c.city = src.city AND c.mi = src.src JOIN pin ON pin.id = c.px * 10000000 + c.py),
zr AS (SELECT *, row_number() OVER (PARTITION BY ward_id, year, month ORDER BY ndvi) - 1 AS rk,
              count(*) OVER (PARTITION BY ward_id, year, month) AS n FROM px)
SELECT ward_id, year, month, {rr('sum(ndvi)', 'count(ndvi)', 4, 4, 6)} AS mean_ndvi,
       CAST(round((max(ndvi) FILTER (WHERE rk = (n - 1) // 2) + max(ndvi) FILTER (WHERE rk = n // 2))
                  * CAST(0.5 AS DECIMAL(2,1)), 4) AS DECIMAL(6,4)) AS median_ndvi,
       CAST(min(ndvi) AS DECIMAL(6,4)) AS min_ndvi, CAST(max(ndvi) AS DECIMAL(6,4)) AS max_ndvi,
       -- through text: of two pixels the std is often a tie, rounded by its shortest digits
       CAST(CAST(sqrt(CAST(sum(ndvi * ndvi) * count(*) - sum(ndvi) * sum(ndvi) AS DOUBLE)
                      / (CAST(count(*) AS DOUBLE) * count(*))) AS VARCHAR) AS DECIMAL(6,4)) AS std_ndvi, CAST(count(*) AS INTEGER) AS pixel_count
FROM zr GROUP BY ward_id, year, month"""


@oracle("q_semi_join", ("d_ndvi_pixels", "d_ward_boundaries"))
def _():
    return """
SELECT * FROM d_ndvi_pixels WHERE ward_id IN (SELECT ward_id FROM d_ward_boundaries WHERE city IS NOT NULL)"""


# ------------------------------------------------------------ census loader
def _census_loaded() -> str:
    return f"""cl AS (SELECT {title('trim(ward_name)')} AS ward_name, CAST(ward_number AS BIGINT) AS ward_number,
              CAST(year AS BIGINT) AS year, CAST(population AS BIGINT) AS population,
              CAST(male_population AS BIGINT) AS male_population,
              CAST(female_population AS BIGINT) AS female_population,
              CAST(area_sqkm AS DECIMAL(10,4)) AS area_sqkm, CAST(density AS DECIMAL(10,2)) AS density,
              CAST(literacy_rate AS DECIMAL(5,2)) AS literacy_rate
       FROM d_census WHERE ward_name IS NOT NULL AND population IS NOT NULL)"""


ORACLES["q_census_clean"] = q(("d_census",), f""", gaps AS (
  SELECT * REPLACE (CASE WHEN (population + year) % 11 <> 0 THEN ward_name END AS ward_name,
                    CASE WHEN (population + year) % 13 <> 0 THEN population END AS population)
  FROM d_census),
cl AS (SELECT {title('trim(ward_name)')} AS ward_name, CAST(ward_number AS BIGINT) AS ward_number,
              CAST(year AS BIGINT) AS year, CAST(population AS BIGINT) AS population,
              CAST(male_population AS BIGINT) AS male_population,
              CAST(female_population AS BIGINT) AS female_population,
              CAST(area_sqkm AS DECIMAL(10,4)) AS area_sqkm,
              CASE WHEN area_sqkm > 0 THEN {rr('population', 'area_sqkm', 2, 0, 10, den_scale=4)} END AS density,
              CAST(literacy_rate AS DECIMAL(5,2)) AS literacy_rate
       FROM gaps WHERE ward_name IS NOT NULL AND population IS NOT NULL)
SELECT * FROM cl""")


@oracle("q_census_validate", ("d_census",))
def _():
    return f""", {_census_loaded()},
d AS (SELECT count(*) AS n FROM (SELECT ward_name, year FROM cl GROUP BY 1, 2 HAVING count(*) > 1))
SELECT count(*) AS total_rows, count(DISTINCT ward_name) AS unique_wards,
       list_sort(list(DISTINCT year)) AS year_range,
       CAST(max(d.n) AS BIGINT) AS duplicate_ward_years,
       list_filter([CASE WHEN max(d.n) > 0 THEN 'Duplicate ward-year entries: ' || max(d.n) END,
                    CASE WHEN min(population) < 0 THEN 'Negative population values found' END,
                    CASE WHEN max(literacy_rate) > 100 THEN 'Literacy rate > 100% found' END,
                    CASE WHEN count(DISTINCT ward_name) < 150
                         THEN 'Low ward coverage: ' || count(DISTINCT ward_name) || '/198' END],
                   lambda x: x IS NOT NULL) AS warnings
FROM cl, d"""


# ------------------------------------------------------------ mart and scores
_ALL_VIEWS = ("d_ward_boundaries", "d_ward_edges", "d_complaints", "d_crime", "d_census", "d_aqi_feed",
              "d_stops", "d_stop_times", "d_trips", "d_ndvi_pixels", "d_property")


def _mart_sql() -> str:
    stg = {
        "s_crime": ORACLE_BODY["q_stg_crime"], "s_comp": ORACLE_BODY["q_stg_complaints"],
        "s_aqi": stg_aqi_body(Y_LO, Y_HI, MART_DAY), "s_census": ORACLE_BODY["q_stg_census"],
        "s_transit": stg_transit_body(Y_LO, Y_HI), "s_ndvi": ORACLE_BODY["q_stg_ndvi"],
        "s_prop": ORACLE_BODY["q_stg_property"],
    }
    ctes = ",\n".join(f"{k} AS ({cte_of(v)})" for k, v in stg.items())
    return f""", {ctes},
spine AS (SELECT ward_id, ward_name, ward_number, zone_name, city, CAST(y.year AS INTEGER) AS year
          FROM d_ward_boundaries, range({Y_LO}, {Y_HI + 1}) y(year)),
mart AS (
SELECT sp.ward_id, sp.ward_name, sp.ward_number, sp.zone_name, sp.city, sp.year,
  CAST(coalesce(cr.total_ipc_offenses, 0) AS INTEGER) AS total_ipc_offenses,
  CAST(coalesce(cr.murder_count, 0) AS INTEGER) AS murder_count,
  CAST(coalesce(cr.theft_count, 0) AS INTEGER) AS theft_count,
  CAST(coalesce(cr.robbery_count, 0) AS INTEGER) AS robbery_count,
  CAST(coalesce(cr.assault_count, 0) AS INTEGER) AS assault_count,
  CAST(coalesce(cr.kidnapping_count, 0) AS INTEGER) AS kidnapping_count,
  CAST(coalesce(cr.burglary_count, 0) AS INTEGER) AS burglary_count,
  cr.crime_rate_per_1000,
  CAST(coalesce(co.total_complaints, 0) AS BIGINT) AS total_complaints,
  CAST(coalesce(co.pending_complaints, 0) AS BIGINT) AS pending_complaints,
  CAST(coalesce(co.resolved_complaints, 0) AS BIGINT) AS resolved_complaints,
  co.resolution_rate, co.avg_resolution_days,
  aq.avg_pm25, aq.avg_pm10, aq.avg_no2, aq.avg_so2, aq.avg_aqi, aq.aqi_good_days_pct,
  ce.population, ce.population_density, ce.literacy_rate, ce.avg_household_size, ce.total_households,
  CAST(coalesce(tr.bus_stops_count, 0) AS BIGINT) AS bus_stops_count,
  CAST(coalesce(tr.metro_proximity_km, 99.0) AS DECIMAL(8,3)) AS metro_proximity_km,
  tr.avg_route_frequency,
  CAST(coalesce(tr.total_routes, 0) AS BIGINT) AS total_routes,
  tr.transit_score,
  nd.avg_ndvi, nd.ndvi_change_yoy, nd.green_cover_pct,
  pr.median_price_sqft, pr.price_change_yoy
FROM spine sp
LEFT JOIN s_crime cr ON cr.ward_id = sp.ward_id AND cr.year = sp.year
LEFT JOIN s_comp co ON co.ward_id = sp.ward_id AND co.year = sp.year
LEFT JOIN s_aqi aq ON aq.ward_id = sp.ward_id AND aq.year = sp.year
LEFT JOIN s_census ce ON ce.ward_id = sp.ward_id AND ce.year = sp.year
LEFT JOIN s_transit tr ON tr.ward_id = sp.ward_id AND tr.year = sp.year
LEFT JOIN s_ndvi nd ON nd.ward_id = sp.ward_id AND nd.year = sp.year
LEFT JOIN s_prop pr ON pr.ward_id = sp.ward_id AND pr.year = sp.year)"""


def _scores_sql() -> str:
    dims = [("safety", "crime_rate_per_1000", True), ("aqi", "avg_aqi", True),
            ("civic", "resolution_rate", False), ("transit", "transit_score", False),
            ("green", "avg_ndvi", False), ("affordability", "median_price_sqft", True)]
    weights = {"safety": "0.2", "aqi": "0.2", "civic": "0.15", "transit": "0.2", "green": "0.15",
               "affordability": "0.1"}
    vals = ", ".join(f"CAST({c} AS DOUBLE) AS v_{d}" for d, c, _ in dims)
    stats = ", ".join(f"min(v_{d}) AS mn_{d}, max(v_{d}) AS mx_{d}" for d, _, _ in dims)
    sc = []
    for d, _, inv in dims:
        scale = f"(100.0 / CASE WHEN mx_{d} - mn_{d} = 0 THEN 1.0 ELSE mx_{d} - mn_{d} END)"
        v = f"(v_{d} * {scale} + (0.0 - mn_{d} * {scale}))"
        sc.append(f"{'(100.0 - ' + v + ')' if inv else v} AS s_{d}")
    comp = " + ".join(f"s_{d} * {weights[d]}" for d, _, _ in dims)
    outs = ", ".join(f"CAST(round(CAST(s_{d} AS DECIMAL(20,10)), 2) AS DECIMAL(5,2)) AS {d}_score"
                     for d, _, _ in dims)
    return f"""{_mart_sql()},
vb AS (SELECT ward_id, ward_name, city, year, {vals} FROM mart),
st AS (SELECT {stats} FROM vb),
sc AS (SELECT vb.ward_id, vb.ward_name, vb.city, vb.year, {", ".join(sc)} FROM vb, st),
scores AS (SELECT ward_id, ward_name, city, year, 3 AS month,
                  CAST(round(CAST(({comp}) AS DECIMAL(20,10)), 2) AS DECIMAL(5,2)) AS composite_score, {outs}
           FROM sc)"""


@oracle("q_ward_metro", ("d_stops", "d_ward_edges"))
def _():
    return f"""
, mp AS (SELECT stop_id, px, py FROM d_stops WHERE source = 'BMRCL'),
inside AS ({inward('mp', 'stop_id')}),
p AS (SELECT stop_id, px / 10000.0 AS x, py / 10000.0 AS y FROM mp),
e AS (SELECT ward_id, ax / 10000.0 AS ax, ay / 10000.0 AS ay, bx / 10000.0 AS bx, by_ / 10000.0 AS by_
      FROM d_ward_edges),
d AS (SELECT e.ward_id, p.stop_id, min({_seg_dist()}) AS km FROM p, e GROUP BY e.ward_id, p.stop_id),
d0 AS (SELECT d.ward_id, CASE WHEN i.id IS NOT NULL THEN 0.0 ELSE d.km END AS km
       FROM d LEFT JOIN inside i ON i.id = d.stop_id AND i.ward_id = d.ward_id)
SELECT w.ward_id, CAST(round(CAST(min(d0.km) AS DECIMAL(20,10)), 3) AS DECIMAL(10,3)) AS metro_km
FROM (SELECT DISTINCT ward_id FROM d_ward_edges) w LEFT JOIN d0 ON d0.ward_id = w.ward_id
GROUP BY w.ward_id"""


def _trigram_sets(src: str, col: str, keycol: str) -> str:
    return f"""(SELECT {keycol} AS k, list(DISTINCT substr('  ' || w || ' ', i, 3)) AS g
  FROM (SELECT {keycol}, unnest(regexp_split_to_array(lower({col}), '[^\\p{{L}}\\p{{N}}]+')) AS w FROM {src}) ws,
       LATERAL generate_series(1, length(w) + 1) AS s(i)
  WHERE w <> '' GROUP BY {keycol})"""


@oracle("q_fuzzy_ward", ("d_census", "d_ward_boundaries"))
def _():
    return f"""
, nm AS (SELECT DISTINCT ward_name AS nm FROM d_census WHERE ward_name IS NOT NULL),
ga AS {_trigram_sets('nm', 'nm', 'nm')},
gb AS {_trigram_sets('d_ward_boundaries', 'ward_name', 'ward_id')},
pr AS (SELECT ga.k AS nm, gb.k AS ward_id, len(list_intersect(ga.g, gb.g)) AS sh,
              len(list_distinct(list_concat(ga.g, gb.g))) AS un FROM ga, gb),
ok AS (SELECT *, row_number() OVER (PARTITION BY nm ORDER BY CAST(sh AS DOUBLE) / CAST(un AS DOUBLE) DESC, ward_id) AS rk
       FROM pr WHERE CAST(sh AS DOUBLE) / CAST(un AS DOUBLE) > 0.3)
SELECT nm AS ward_name, ward_id, {rr('sh', 'un', 4, 0, 6)} AS similarity FROM ok WHERE rk = 1"""


def _register_late() -> None:
    ORACLES["q_ward_year_spine"] = q(("d_ward_boundaries",), f"""
SELECT ward_id, ward_name, ward_number, zone_name, city, CAST(y.year AS INTEGER) AS year
FROM d_ward_boundaries, range({Y_LO}, {Y_HI + 1}) y(year)""")
    ORACLES["q_mart"] = q(_ALL_VIEWS, _mart_sql() + "\nSELECT * FROM mart")
    ORACLES["q_mart_incremental"] = ORACLES["q_mart"]
    ORACLES["q_latest_year"] = q(_ALL_VIEWS, _mart_sql() + "\nSELECT * FROM mart WHERE year = (SELECT max(year) FROM mart)")
    ORACLES["q_scores"] = q(_ALL_VIEWS, _scores_sql() + "\nSELECT * FROM scores")
    ORACLES["q_city_scores"] = q(_ALL_VIEWS, _scores_sql() + """
SELECT *, CAST(row_number() OVER (PARTITION BY city ORDER BY composite_score DESC NULLS LAST, ward_id, year) AS INTEGER)
       AS place_in_city
FROM scores ORDER BY city, place_in_city""")
    ORACLES["q_ward_history"] = q(_ALL_VIEWS, _scores_sql() + """
SELECT *, CAST(row_number() OVER (PARTITION BY ward_id ORDER BY year, month) AS INTEGER) AS place_in_ward
FROM scores ORDER BY ward_id, place_in_ward""")


# ------------------------------------------------------------ M-9 quick features
@oracle("q_quick_features", ("d_ward_boundaries", "d_ward_edges", "d_crime", "d_complaints", "d_aqi_feed",
                             "d_census", "d_ndvi_pixels", "d_property"))
def _():
    return f""", {_station_city()}, {_zonal()},
w AS (SELECT ward_id, ward_name, city, lower(trim(ward_name)) AS nm FROM d_ward_boundaries),
cr AS (SELECT city, sum(cnt) AS s, count(cnt) AS n FROM d_crime GROUP BY city),
co AS (SELECT w.nm, CASE WHEN complaint_id % 5 = 0 THEN 'ASIA' ELSE w.city END AS city, count(complaint_id) AS n,
              count(*) FILTER (WHERE status = 'Resolved') AS r
       FROM d_complaints f JOIN w ON w.nm = lower(trim(f.ward_name)) GROUP BY 1, 2),
aq AS (SELECT c.city, sum(a.aqi) AS s, count(a.aqi) AS n FROM d_aqi_feed a
       JOIN scity c ON c.station_id = a.station_id GROUP BY c.city),
ce AS (SELECT nm, city, population, density FROM (
         SELECT *, row_number() OVER (PARTITION BY nm, city ORDER BY year DESC) AS rk
         FROM (SELECT w.nm, CASE WHEN population % 500 = 0 THEN 'ASIA' ELSE w.city END AS city, population, density, year
               FROM d_census f JOIN w ON w.nm = lower(trim(f.ward_name)))) WHERE rk = 1),
nd AS (SELECT ward_id, sum(mean_ndvi) AS s, count(mean_ndvi) AS n FROM zonal GROUP BY ward_id),
pr AS (SELECT w.nm, CASE WHEN l_orderkey % 5 = 0 THEN 'ASIA' ELSE w.city END AS city, sum(price_sqft) AS s,
              count(price_sqft) AS n
       FROM d_property f JOIN w ON w.nm = lower(trim(f.ward_name)) GROUP BY 1, 2)
SELECT w.ward_id, w.ward_name, w.city, CAST({Y_HI} AS INTEGER) AS year,
  CAST(coalesce(cr.s, 0) AS BIGINT) AS total_ipc_offenses,
  CAST(coalesce({rr('cr.s * 1000', 'cr.n * ce.population', 4)}, 0) AS DECIMAL(12,4)) AS crime_rate_per_1000,
  CAST(coalesce(co.n, 0) AS BIGINT) AS total_complaints,
  CAST(coalesce({rr('co.r', 'co.n', 4)}, 0) AS DECIMAL(5,4)) AS resolution_rate,
  CAST(coalesce({rr('aq.s', 'aq.n', 2)}, 0) AS DECIMAL(8,2)) AS avg_aqi,
  CAST(coalesce(ce.population, 0) AS BIGINT) AS population,
  CAST(coalesce(ce.density, 0) AS DECIMAL(10,2)) AS population_density,
  CAST(coalesce({rr('nd.s', 'nd.n', 4, 4)}, 0) AS DECIMAL(6,4)) AS avg_ndvi,
  CAST(coalesce({rr('pr.s', 'pr.n', 2, 2)}, 0) AS DECIMAL(10,2)) AS median_price_sqft
FROM w LEFT JOIN cr ON cr.city = w.city LEFT JOIN co ON co.nm = w.nm AND co.city = w.city LEFT JOIN aq ON aq.city = w.city
LEFT JOIN ce ON ce.nm = w.nm AND ce.city = w.city LEFT JOIN nd ON nd.ward_id = w.ward_id LEFT JOIN pr ON pr.nm = w.nm AND pr.city = w.city"""


# ------------------------------------------------------------ text functions
WS = (r"\t\n\x0b\x0c\r\x1c-\x1f \x85\xa0\x{1680}\x{2000}-\x{200a}"
      r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")


@oracle("q_clean_text", ())
def _():
    return f"""
SELECT doc_id, coalesce(regexp_replace(trim(regexp_replace(text, '[{WS}]+', ' ', 'g')),
                                       '[^\\p{{L}}\\p{{N}}_{WS}\\-.,]', '', 'g'), '') AS clean_text
FROM documents"""


@oracle("q_title_case", ())
def _():
    return f"""
SELECT p_partkey, {title('p_name')} AS title, {title("replace(replace(p_name, ' ', '-'), '-', ' ')")} AS label
FROM part"""


@oracle("q_first_nonempty", ())
def _():
    return """
, c AS (SELECT o_orderkey,
               CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 4 = 1 THEN '   ' ELSE o_orderstatus END AS a,
               CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderpriority END AS b,
               CAST(o_custkey AS VARCHAR) AS c FROM orders)
SELECT o_orderkey, coalesce(CASE WHEN trim(a) <> '' THEN trim(a) END, CASE WHEN trim(b) <> '' THEN trim(b) END,
                            CASE WHEN trim(c) <> '' THEN trim(c) END) AS value FROM c"""


@oracle("q_parse_date", ())
def _():
    return """
, t AS (SELECT o_orderkey, CASE o_orderkey % 7
          WHEN 0 THEN strftime(o_orderdate, '%d/%m/%Y') WHEN 1 THEN strftime(o_orderdate, '%d-%m-%Y')
          WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 3 THEN strftime(o_orderdate, '%d %b %Y')
          WHEN 4 THEN strftime(o_orderdate, '%d %B %Y') WHEN 5 THEN strftime(o_orderdate, '%d/%m/%Y %H:%M')
          ELSE 'day ' || o_orderkey END AS date_text FROM orders)
SELECT o_orderkey, date_text,
       CAST(try_strptime(trim(date_text), ['%d/%m/%Y', '%d-%m-%Y', '%Y-%m-%d', '%d %b %Y', '%d %B %Y',
                                           '%d/%m/%Y %H:%M']) AS DATE) AS date_filed
FROM t"""


@oracle("q_parse_price", ())
def _():
    return f"""
, l AS (SELECT l_orderkey, l_linenumber, CAST(floor(l_extendedprice) AS BIGINT) AS p, l_quantity FROM lineitem),
t AS (SELECT l_orderkey, l_linenumber,
        CASE l_linenumber
          WHEN 1 THEN '₹ ' || CAST(p // 100000 AS VARCHAR) || '.' || lpad(CAST(p % 100 AS VARCHAR), 2, '0') || ' Cr'
          WHEN 2 THEN CAST(p // 1000 AS VARCHAR) || ' Lac'
          WHEN 3 THEN '₹' || CAST(p // 1000 AS VARCHAR) || ' Lakh'
          WHEN 4 THEN CAST(p // 1000 AS VARCHAR) || ',' || lpad(CAST(p % 1000 AS VARCHAR), 3, '0')
          WHEN 5 THEN 'Rs ' || CAST(p AS VARCHAR) || ' lakh'
          WHEN 6 THEN 'Price on Request'
          ELSE CAST(p // 10 AS VARCHAR) || '.' || CAST(p % 10 AS VARCHAR) || ' cr' END AS price_text,
        CASE WHEN l_linenumber = 6 THEN ''
             ELSE CAST(CAST(l_quantity AS INTEGER) * 37 AS VARCHAR)
                  || CASE l_linenumber % 3 WHEN 0 THEN ' sq ft' WHEN 1 THEN ' sqft' ELSE ' Sq.Ft' END END AS area_text,
        CAST(l_linenumber % 4 + 1 AS VARCHAR) || ' BHK Apartment' AS config_text
      FROM l),
x AS (SELECT *, trim(replace(replace(price_text, ',', ''), '₹', '')) AS pt FROM t),
y AS (SELECT l_orderkey, l_linenumber,
        CAST(CASE WHEN price_text IS NULL OR price_text = '' THEN NULL
             WHEN regexp_extract(pt, '(?i)([0-9.]+)\\s*cr', 1) <> ''
               THEN TRY_CAST(regexp_extract(pt, '(?i)([0-9.]+)\\s*cr', 1) AS DECIMAL(20,4)) * 10000000
             WHEN regexp_extract(pt, '(?i)([0-9.]+)\\s*(?:lac|lakh)', 1) <> ''
               THEN TRY_CAST(regexp_extract(pt, '(?i)([0-9.]+)\\s*(?:lac|lakh)', 1) AS DECIMAL(20,4)) * 100000
             WHEN regexp_extract(pt, '([0-9.]+)', 1) <> ''
               THEN TRY_CAST(regexp_extract(pt, '([0-9.]+)', 1) AS DECIMAL(20,4)) END AS DECIMAL(24,4)) AS price_total,
        CASE WHEN regexp_extract(area_text, '(?i)([0-9,]+\\.?[0-9]*)\\s*(?:sq\\.?\\s*ft|sqft)', 1) <> ''
             THEN TRY_CAST(replace(regexp_extract(area_text, '(?i)([0-9,]+\\.?[0-9]*)\\s*(?:sq\\.?\\s*ft|sqft)', 1), ',', '')
                           AS DECIMAL(20,4)) END AS area_sqft,
        CASE WHEN regexp_extract(config_text, '(?i)([0-9]+)\\s*BHK', 1) <> ''
             THEN TRY_CAST(regexp_extract(config_text, '(?i)([0-9]+)\\s*BHK', 1) AS INTEGER) END AS bedrooms
      FROM x),
z AS (SELECT *, CAST(CASE WHEN price_total > 0 AND area_sqft > 0
                          THEN {rr('price_total', 'area_sqft', 2, 4, 14, den_scale=4)} END AS DECIMAL(14,2)) AS price_sqft
      FROM y)
SELECT * FROM z WHERE NOT ((price_total IS NULL OR price_total = 0) AND (price_sqft IS NULL OR price_sqft = 0))"""


@oracle("q_ndvi_sketch", ("d_ndvi_pixels", "d_ward_boundaries"))
def _():
    return """
SELECT city, year, count(ndvi) AS n, CAST(sum(ndvi) AS DECIMAL(20,4)) AS total, min(ndvi) AS least, max(ndvi) AS most,
       count(DISTINCT ward_id) AS n_wards
FROM d_ndvi_pixels JOIN d_ward_boundaries USING (ward_id) GROUP BY city, year"""


# ------------------------------------------------------------ page and table parsers
@oracle("q_listing_cards", ())
def _():
    return f""", x AS (
  SELECT 'Order ' || l_orderkey AS locality,
         CASE l_orderkey % 3 WHEN 0 THEN 'Mumbai' WHEN 1 THEN 'Delhi' ELSE 'Bengaluru' END AS city,
         CAST((floor(l_extendedprice / 1000) + 1) * 100000 AS DECIMAL(24,4)) AS price_total,
         CAST(CAST(l_quantity AS INTEGER) * 37 AS DECIMAL(20,4)) AS area_sqft,
         CAST(l_linenumber % 4 + 1 AS INTEGER) AS bedrooms, 'Kind ' || l_linenumber AS property_type
  FROM lineitem)
SELECT *, CASE WHEN area_sqft > 0 THEN {rr('price_total', 'area_sqft', 2, 4, 14, den_scale=4)} END AS price_sqft FROM x"""


@oracle("q_complaint_pages", ())
def _():
    return """
SELECT CASE o_custkey % 3 WHEN 0 THEN 'Bengaluru' WHEN 1 THEN 'Mumbai' ELSE 'Delhi' END AS city,
       CAST(o_orderkey AS VARCHAR) AS complaint_id, o_orderpriority AS category, 'W' || o_custkey AS ward_name,
       o_orderstatus AS status, CAST(DATE '2024-01-01' + CAST(o_custkey % 28 AS INTEGER) AS DATE) AS date_filed
FROM orders"""


@oracle("q_crime_tables", ())
def _():
    return """, g AS (
  SELECT l_suppkey AS k, CAST(year(l_shipdate) AS INTEGER) AS yr, count(*) AS c FROM lineitem GROUP BY 1, 2),
r AS (
  SELECT 'S' || (k % 9) AS state, CASE k % 4 WHEN 0 THEN 'Bengaluru' WHEN 1 THEN 'Delhi' ELSE 'Mumbai' END AS city,
         CASE WHEN yr BETWEEN 2000 AND 2099 THEN yr ELSE 2022 END AS year, yr, k, c
  FROM g WHERE k % 4 <> 3)
SELECT state, city, year, 'murder' AS offense_category,
       CAST(CASE WHEN c % 5 = 0 THEN (c + 1) * 1000 + k % 1000 WHEN c % 5 = 1 THEN 0 ELSE c END AS INTEGER) AS "count",
       'report_' || yr || '.pdf' AS source_pdf, CAST(k % 10 AS INTEGER) AS page_number
FROM r WHERE c % 5 <> 2
UNION ALL
SELECT state, city, year, 'theft', CAST(c * 2 AS INTEGER), 'report_' || yr || '.pdf', CAST(k % 10 AS INTEGER) FROM r"""


# ------------------------------------------------------------ data quality
@oracle("q_dq_report", ("d_complaints", "d_census", "d_aqi_feed", "d_ndvi_pixels", "d_ward_boundaries"))
def _():
    def nn(t, v, cols):
        return [f"SELECT '{t}' AS table_name, 'not_null' AS check_name, '{c}' AS column_name, "
                f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failures FROM {v}" for c in cols]

    def uq(t, v, keys):
        k = ", ".join(keys)
        return [f"SELECT '{t}', 'unique', '{','.join(keys)}', CAST(count(*) AS BIGINT) FROM "
                f"(SELECT {k} FROM {v} GROUP BY {k} HAVING count(*) > 1)"]

    def pf(t, v, check, col, ok):
        return [f"SELECT '{t}', '{check}', '{col}', CAST(count(*) FILTER (WHERE NOT coalesce({ok}, true)) AS BIGINT) FROM {v}"]
    statuses = "'pending','open','in progress','assigned','resolved','closed','completed','rejected','cancelled'"
    faulty = """, f_complaints AS (
  SELECT * REPLACE (CASE WHEN complaint_id % 211 = 0 THEN 'Lost' ELSE status END AS status,
                    CASE WHEN complaint_id % 401 <> 0 THEN category END AS category,
                    CASE WHEN complaint_id % 307 = 0 THEN 'Nowhere' ELSE ward_name END AS ward_name)
  FROM d_complaints),
f_census AS (
  SELECT * REPLACE (CAST(CASE WHEN population % 700 = 0 THEN literacy_rate + 40 ELSE literacy_rate END AS DECIMAL(6,2)) AS literacy_rate,
                    CASE WHEN population % 900 = 0 THEN year + 30 ELSE year END AS year)
  FROM d_census),
f_pixels AS (
  SELECT * REPLACE (CASE WHEN CAST(ndvi * 10000 AS BIGINT) % 1600 = 0 THEN month + 12 ELSE month END AS month,
                    CASE WHEN CAST(ndvi * 10000 AS BIGINT) % 2400 = 0 THEN ward_id + 1000000 ELSE ward_id END AS ward_id)
  FROM d_ndvi_pixels)"""
    parts = (nn("complaints", "f_complaints", ["complaint_id", "category", "ward_name", "date_filed", "status"])
             + uq("complaints", "f_complaints", ["complaint_id"])
             + pf("complaints", "f_complaints", "accepted_values", "status", f"lower(status) IN ({statuses})")
             + ["SELECT 'complaints', 'relationships', 'ward_name', CAST(count(*) AS BIGINT) FROM f_complaints c "
                "WHERE lower(trim(c.ward_name)) IS NOT NULL AND NOT EXISTS (SELECT 1 FROM d_ward_boundaries w "
                "WHERE lower(trim(w.ward_name)) = lower(trim(c.ward_name)))"]
             + nn("census", "f_census", ["ward_name", "ward_number", "population", "year"])
             + uq("census", "f_census", ["ward_name", "year"])
             + pf("census", "f_census", "accepted_values", "year", f"year BETWEEN {Y_LO} AND {Y_HI}")
             + pf("census", "f_census", "check", "literacy_rate", "literacy_rate <= 100")
             + nn("aqi", "d_aqi_feed", ["station_id", "date", "pm25"])
             + uq("aqi", "d_aqi_feed", ["station_id", "date"])
             + pf("ndvi", "f_pixels", "check", "month", "month BETWEEN 1 AND 12")
             + ["SELECT 'ndvi', 'relationships', 'ward_id', CAST(count(*) AS BIGINT) FROM f_pixels p "
                "WHERE ward_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM d_ward_boundaries w WHERE w.ward_id = p.ward_id)"])
    return faulty + "\n" + "\nUNION ALL\n".join(parts)


_register_late()
