"""Saved HTML pages to rows (SRC-8/F-3 listing cards, SRC-9/F-4 complaint
pages, F-9 page scans), with column expressions on the executors.

Input is a table of landed pages (source, locality, url, html) -- one row per
page, so pages spread over tasks. Cards, list entries and their fields are elements
found by one pass over a page's tags (:mod:`wardpulse.sources.tagstack`), so they
may be nested to any depth; the fields of detail pages are text nodes found by
patterns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardpulse.functions.text import (first_nonempty, parse_area, parse_bedrooms, parse_date, parse_price,
                                      price_per_sqft, slug_label)
from wardpulse.sources import tagstack as T

_TAGS = "<[^>]+>"


def strip_tags(c: Column) -> Column:
    """Text of a fragment: tags removed, white space collapsed, trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, _TAGS, " "), "\\s+", " "))


# fixed values: the two listing-site layouts (card class, field classes)
LAYOUTS = {
    "magicbricks": {"card": "mb-srp__card", "price": "mb-srp__card__price",
                    "area": "mb-srp__card__summary--value", "config": "mb-srp__card__summary",
                    "type": "mb-srp__card__property--type"},
    "99acres": {"card": "srp__card", "price": "list_header_semiBold"},
}


def parse_listing_pages(pages: DataFrame, city: str | Column = "Bengaluru") -> DataFrame:
    """F-3 one row per listing card: price, area, bedrooms, type, price per
    sq ft; a card with neither price is dropped (S-25). ``pages``: source,
    locality (slug), html, scraped_at, and ``city`` where a page tells its own;
    pages without one are of ``city``."""
    if "city" in pages.columns:
        city = F.coalesce(F.col("city"), F.lit(city) if isinstance(city, str) else city)
    elif isinstance(city, str):
        city = F.lit(city)
    outs = []
    for source, lay in LAYOUTS.items():
        # what a page says is worked out once, not for each of its cards
        p = pages.where(F.col("source") == source).select(slug_label(F.col("locality")).alias("locality"), city.alias("_city"),
                                                          F.col("scraped_at"), F.col("html"))
        parts = {c: T.opening(lay[k], part=True) for k, c in
                 (("price", "_price"), ("area", "_area"), ("config", "_beds"), ("type", "_type")) if k in lay}
        card = T.opening(lay["card"], "div")
        if source == "magicbricks":
            cards = T.element_texts(p, F.col("html"), card, **parts)
            area = parse_area(F.col("_area"))
        else:
            # the text node holding "sq ft", read from its parent element
            cards = T.element_texts(p, F.col("html"), card, whole="_beds", **parts).withColumn("_type", F.lit(""))
            area = parse_area(F.regexp_extract(F.col("_beds"), "(?i)([0-9,]+\\.?[0-9]*\\s*sq\\.?\\s*ft)", 1))
        cards = T.once(cards.drop("html"), price_total=parse_price(F.col("_price")), area_sqft=area)
        rows = cards.select(F.lit(None).cast("string").alias("listing_id"), F.lit(source).alias("source"),
                            "locality", F.lit(None).cast("string").alias("ward_name"), F.col("_city").alias("city"),
                            "price_total", "area_sqft", parse_bedrooms(F.col("_beds")).alias("bedrooms"),
                            F.col("_type").alias("property_type"), F.to_date("scraped_at").alias("listing_date"),
                            F.col("scraped_at"))
        rows = rows.withColumn("price_sqft", price_per_sqft(F.col("price_total"), F.col("area_sqft")))
        # Python's "not price_total and not price_sqft": a zero or missing price drops the card
        outs.append(rows.where(F.coalesce(F.col("price_total"), F.lit(0)) != 0))
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    return out


# ---------------------------------------------------------------- F-4 complaints
# fixed values: candidate class/id names per complaint field, tried in order
COMPLAINT_FIELDS = {
    "complaint_id": ["complaint-id", "ref-number", "tracking-id"],
    "category": ["category", "complaint-type", "department"],
    "subcategory": ["subcategory", "sub-category", "complaint-subtype"],
    "ward_name": ["ward-name", "ward", "location-ward"],
    "ward_number": ["ward-number", "ward-no"],
    "date_text": ["date-filed", "complaint-date", "created-date"],
    "status": ["status", "complaint-status", "current-status"],
    "description": ["description", "complaint-details", "details"],
    "latitude": ["latitude", "lat"],
    "longitude": ["longitude", "lng", "lon"],
}


def _field(html: Column, pattern: str) -> Column:
    direct = F.regexp_extract(html, f'(?is)<\\w+[^>]*(?:class|id)="[^"]*{pattern}[^"]*"[^>]*>\\s*([^<]*)', 1)
    span = F.regexp_extract(html, f'(?is)<\\w+[^>]*class="[^"]*{pattern}[^"]*"[^>]*>\\s*<span[^>]*>([^<]*)', 1)
    label = F.regexp_extract(html, f'(?is)<label[^>]*>[^<]*{pattern.replace("-", " ")}[^<]*</label>\\s*'
                                   '<\\w+[^>]*>([^<]*)', 1)
    return first_nonempty(direct, span, label)


def extract_field(html: Column, patterns: Sequence[str]) -> Column:
    """First non-empty text over the candidate names (S-32), else ''."""
    return F.coalesce(first_nonempty(*[_field(html, p) for p in patterns]), F.lit(""))


def parse_complaint_pages(pages: DataFrame, summary: DataFrame | None = None) -> DataFrame:
    """F-4 detail pages -> complaint rows; gaps filled from the listing-table
    summary row of the same url (S-32); pages without an id are skipped (P-11)."""
    cols = {k: extract_field(F.col("html"), v) for k, v in COMPLAINT_FIELDS.items()}
    d = pages.select("url", *[c.alias(k) for k, c in cols.items()])
    if summary is not None:
        s = summary.select("url", *[F.col(c).alias(f"_s_{c}") for c in summary.columns if c != "url"])
        d = d.join(s, "url", "left")
        for c in COMPLAINT_FIELDS:
            if f"_s_{c}" in d.columns:
                d = d.withColumn(c, F.coalesce(F.when(F.col(c) != "", F.col(c)), F.col(f"_s_{c}")))
        d = d.drop(*[c for c in d.columns if c.startswith("_s_")])
    return (d.where(F.col("complaint_id").isNotNull() & (F.col("complaint_id") != ""))
            .select("complaint_id", "category", "subcategory", "ward_name",
                    F.when(F.col("ward_number").rlike("^[0-9]+$"), F.col("ward_number").cast("int")).alias("ward_number"),
                    parse_date(F.col("date_text")).alias("date_filed"), "status", "description",
                    F.nullif(F.col("latitude"), F.lit("")).try_cast("double").alias("latitude"),
                    F.nullif(F.col("longitude"), F.lit("")).try_cast("double").alias("longitude")))


# fixed values: the rows of a complaint list (element, class), else any whose class holds "complaint"
LISTING_CARDS = ["complaint-card", "list-item"]
# fixed values: the city portals' layouts, rows of a table or elements of a class, and the class of each field
CITY_LISTINGS = {
    "Bengaluru": {"table": "complaint-list", "complaint_id": "id", "category": "cat", "ward_name": "ward", "status": "status"},
    "Mumbai": {"row": "complaint-row", "complaint_id": "id", "category": "cat", "ward_name": "ward", "status": "status"},
    "Delhi": {"row": "complaint-item", "complaint_id": "ref", "category": "type", "ward_name": "zone", "status": "status"},
}
_COMPLAINT = ("complaint_id string, category string, subcategory string, ward_name string, ward_number int, "
              "date_filed date, status string, description string, latitude double, longitude double")


#: Entries that are cards come after a page's table rows.
CARDS_AFTER = 1_000_000


def _own_rows(seen: DataFrame, table: tuple[str, str], body: bool) -> DataFrame:
    """A row for each ``<tr>`` of the tables that match (inside their ``<tbody>`` if
    ``body``), without those of tables nested in a cell."""
    tables = T.explode_elements(seen, table, pos="_table")
    toks, tagged = F.col("_toks"), F.col("_tags")
    # once for each table: in a filter's lambda they would be looked for again for each row
    rows = T.once(tables, _trs=T.element_slices(toks, tagged, T.opening(name="tr")),
                  _deep=F.filter(T.element_slices(toks, tagged, T.opening(name="table")), lambda x: x["at"] > 1),
                  _body=T.element_slices(toks, tagged, T.opening(name="tbody")) if body else F.lit(None))
    within = lambda x, o: (x["at"] > o["at"]) & (x["at"] < o["at"] + o["n"])
    own = F.filter("_trs", lambda x: ~F.exists(F.col("_deep"), lambda o: within(x, o))
                   & (F.exists(F.col("_body"), lambda o: within(x, o)) if body else F.lit(True)))
    rows = rows.withColumn("_own", own).select("*", F.posexplode_outer("_own").alias("_row", "_span")).where("_span is not null")
    cut = lambda c: F.slice(c, F.col("_span.at"), F.col("_span.n"))
    return (rows.withColumn("pos", F.col("_table") * 1000 + F.col("_row")).withColumn("_tags", cut(F.col("_tags")))
            .withColumn("_toks", cut(F.col("_toks"))).drop("_trs", "_deep", "_body", "_own", "_row", "_span", "_table"))


def _first_texts() -> Column:
    """The first text of each cell of an entry, without cells inside cells."""
    toks, tagged = F.col("_toks"), F.col("_tags")
    own = T.outermost(T.element_slices(toks, tagged, T.opening(name="td")))

    def first(x: Column) -> Column:
        inside = F.slice(toks, x["at"], x["n"])
        text = F.get(F.filter(inside, lambda t: ~(t.startswith("<") & (F.length(t) > 1)) & (F.trim(F.regexp_replace(t, "\\s+", " ")) != "")), F.lit(0))
        return F.coalesce(F.trim(F.regexp_replace(text, "\\s+", " ")), F.lit(""))

    return F.transform(own, first)


def _absolute(base: Column, href: Column) -> Column:
    """A link as seen from a page, as urljoin gives it."""
    host = F.regexp_extract(base, "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    page = F.regexp_replace(base, "[?#].*$", "")
    folder = F.regexp_extract(F.substring(page, F.length(host) + 1, F.length(page)), "^(.*/)", 1)
    path = F.when(href.startswith("/"), href).otherwise(F.concat(F.when(folder == "", "/").otherwise(folder), href))
    tail = F.regexp_extract(path, "([?#].*)$", 1)
    steps = F.split(F.regexp_replace(path, "[?#].*$", ""), "/")
    up = lambda acc: F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(1)))
    done = F.aggregate(steps, F.array().cast("array<string>"),
                       lambda acc, x: F.when(x == "..", up(acc)).when(x == ".", acc).otherwise(F.concat(acc, F.array(x))))
    last = F.when(F.element_at(steps, -1).isin(".", ".."), "/").otherwise("")
    return (F.when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), href)
            .when(href.startswith("//"), F.concat(F.regexp_extract(base, "^([A-Za-z][A-Za-z0-9+.-]*:)", 1), href))
            .when(href.startswith("?"), F.concat(page, href))
            .when(href.startswith("#"), F.concat(F.regexp_replace(base, "#.*$", ""), href))
            .otherwise(F.concat(host, F.array_join(done, "/"), last, tail)))


def complaint_list_rows(pages: DataFrame) -> DataFrame:
    """SRC-9 one row per entry of saved list pages (url, html): ``url`` of the
    page, ``pos`` of the entry, ``detail_url`` (NULL without a link) and the
    first text of each table cell. Entries are the body rows of
    ``table.complaint-list`` and the cards; a page with neither gives its divs
    and table rows whose class holds "complaint"."""
    seen = T.with_tokens(pages.select("url", "html"), F.col("html"))
    table = T.opening("complaint-list", "table")
    toks = F.col("_toks")
    # body rows of the list's own table, not of tables in its cells
    body = F.exists(toks, lambda t: T.opens(t, table))
    cards = F.exists(toks, lambda t: T.opens(t, T.opening("(?:" + "|".join(LISTING_CARDS) + ")", "div")))
    usual = seen.where(body | cards)
    rows = _own_rows(usual.drop("html"), table, True).unionByName(T.explode_elements(
        usual.drop("html"), *[T.opening(c, "div") for c in LISTING_CARDS], pos="pos").withColumn("pos", F.col("pos") + CARDS_AFTER))
    other = T.explode_elements(seen.where(~(body | cards)).drop("html"), T.opening("complaint", "(?:div|tr)", part=True), pos="pos")
    rows = rows.unionByName(other)
    link = F.get(F.filter(toks, lambda t: t.rlike("(?is)^<a\\b[^>]*\\bhref\\s*=")), F.lit(0))
    href = F.trim(F.regexp_extract(link, "(?is)\\bhref\\s*=\\s*[\"']([^\"']*)[\"']", 1))
    rows = T.once(rows, _href=href, cells=_first_texts())
    return T.once(rows, detail_url=F.when(F.col("_href") != "", _absolute(F.col("url"), F.col("_href")))).select(
        "url", "pos", "detail_url", "cells")


def complaint_summary(pages: DataFrame) -> DataFrame:
    """The summary of each detail page that list pages link to (the first of
    several), as ``parse_complaint_pages`` takes it."""
    rows = complaint_list_rows(pages).where("detail_url is not null")
    first = rows.groupBy(F.col("detail_url").alias("url")).agg(F.min_by("cells", F.struct("url", "pos")).alias("cells"))
    field = lambda k: F.when(F.size("cells") >= 4, F.element_at("cells", k))
    return first.select("url", field(1).alias("complaint_id"), field(2).alias("category"),
                        field(3).alias("ward_name"), field(-1).alias("status"))


def _complaints(rows: DataFrame, *more: str) -> DataFrame:
    fill = {"subcategory": "''", "description": "''"}
    cols = [x.strip().split(" ") for x in _COMPLAINT.split(",")]
    return rows.select(*more, *[(F.col(c) if c in rows.columns else F.expr(fill.get(c, "NULL"))).cast(t).alias(c) for c, t in cols])


def parse_complaint_lists(pages: DataFrame) -> DataFrame:
    """F-4 the entries of list pages that link to no detail page: complaints by
    themselves, if they have three cells and an id."""
    at = lambda k: F.coalesce(F.get("cells", F.lit(k)), F.lit(""))
    rows = complaint_list_rows(pages).where(F.col("detail_url").isNull() & (F.size("cells") >= 3) & (at(0) != ""))
    return _complaints(rows.select(at(0).alias("complaint_id"), at(1).alias("category"), at(2).alias("ward_name"),
                                   parse_date(at(3)).alias("date_filed"), at(4).alias("status")))


def parse_city_lists(pages: DataFrame, layouts: dict | None = None) -> DataFrame:
    """The list pages of the city portals (city, html, scraped_at): one complaint
    with its city for each row that has an id; the date is the day of the scrape."""
    outs = None
    for city, lay in (layouts or CITY_LISTINGS).items():
        seen = T.with_tokens(pages.where(F.col("city") == city).select("city", "html", F.to_date("scraped_at").alias("date_filed")),
                             F.col("html")).drop("html")
        if "table" in lay:
            rows = _own_rows(seen, T.opening(lay["table"], "table"), False).drop("pos")
        else:
            rows = T.explode_elements(seen, T.opening(lay["row"]))
        tag = "td" if "table" in lay else "\\w+"
        fields = ("complaint_id", "category", "ward_name", "status")
        rows = T.once(rows, **{c: T.field(T.opening(lay[c], tag)) for c in fields}).select("city", "date_filed", *fields)
        got = _complaints(rows.where("complaint_id != ''"), "city")
        outs = got if outs is None else outs.unionByName(got)
    return outs


def read_saved_pages(spark: SparkSession, root: str) -> DataFrame:
    """F-9 pages saved as ``root/source=<s>/locality=<l>/*.html``: a partitioned
    whole-file scan, one row per page; unreadable pages simply yield no cards."""
    df = (spark.read.format("binaryFile").option("pathGlobFilter", "*.html")
          .option("recursiveFileLookup", False).load(root))
    return df.select(F.col("path").alias("url"), "source", "locality",
                     F.decode(F.col("content"), "UTF-8").alias("html"),
                     F.col("modificationTime").alias("scraped_at"))
