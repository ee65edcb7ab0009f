"""Listing cards (F-3), complaint pages (F-4), GeoJSON wards (SRC-1), limits (Q-9)."""

import datetime as dt
import json
from decimal import Decimal

from pyspark.sql import functions as F

from wardpulse.operators.quality import limit_violations
from wardpulse.sources.files import read_ward_geojson, upsert_wards
from wardpulse.sources.markup import (complaint_summary, parse_city_lists, parse_complaint_lists, parse_complaint_pages,
                                      parse_listing_pages)

MB = """<html><body>
<div class="mb-srp__card"><div class="mb-srp__card__price">₹ 1.25 Cr</div>
 <div class="mb-srp__card__summary"><span class="mb-srp__card__summary--value">1,250 sqft</span> 3 BHK</div>
 <div class="mb-srp__card__property--type">Apartment</div></div>
<div class="mb-srp__card"><div class="mb-srp__card__price">Price on Request</div></div>
<div class="mb-srp__card"><div class="mb-srp__card__price">85 Lac</div>
 <div class="mb-srp__card__summary">2 BHK</div></div>
</body></html>"""

AC = """<div class="srp__card"><td class="list_header_semiBold">₹ 90 Lakh</td><span>1,000 sq.ft</span>
 2 BHK Flat</div>"""


def test_listing_cards(spark):
    pages = spark.createDataFrame([("magicbricks", "hsr-layout", MB, dt.datetime(2024, 5, 1)),
                                   ("99acres", "btm-layout", AC, dt.datetime(2024, 5, 2))],
                                  "source string, locality string, html string, scraped_at timestamp")
    rows = sorted(parse_listing_pages(pages).collect(), key=lambda r: (r.source, r.price_total))
    got = [(r.source, r.locality, r.price_total, r.area_sqft, r.bedrooms, r.property_type, r.price_sqft)
           for r in rows]
    assert got == [
        ("99acres", "Btm Layout", Decimal("9000000.0000"), Decimal("1000.0000"), 2, "", Decimal("9000.00")),
        ("magicbricks", "Hsr Layout", Decimal("8500000.0000"), None, 2, "", None),
        ("magicbricks", "Hsr Layout", Decimal("12500000.0000"), Decimal("1250.0000"), 3, "Apartment",
         Decimal("10000.00")),
    ]


def test_element_texts_are_those_of_the_tokens(spark):
    from wardpulse.sources import tagstack as T
    deep = "".join(f'<div class="x card"><p class="price">{i}</p><div class="sum">' for i in range(20)) + "end" + "</div>" * 33
    htmls = [None, "", "no tags", deep, '<DIV class="card"><b CLASS=\'a price b\'>1</b></Div> after <b class="price">2</b>',
             '<div class="card"/><div class="card">in<div class="card">deep<i class="price">3<div>x</i>y</div></div>out',
             '<div class="card"><br class="price">4<div class="sum">5</div><p class="price">6<p>7</div>8</div>',
             '<div class="card"><!-- <b class="price">9</b> --><script>"</div>"</script><b class="price" t="a > b">10 < 11</b></div>',
             '<div class="card"><b t="a > b" class="price">12</b><div-x class="sum">13<div>14</div-x>15</div></div>',
             '<div class="card">\x01\x02\x04 \t\n16<a href="x>17<b class="price">18</b></div>', '<div:a class="card">19</div>20</div:a><1x class="price">21',
             '<div class="card"><div class="card price">22</div><div class="sum"><div class="sum">23</div>24</div></div>',
             '<div class="card"><div class="card"><b class="price">25</b></div>26<u class="sum"/>27</div><div class="cards">28',
             '<div class="card"><i class="price sum">29<div class="card">30</div></i></div>', '<div class="card"><b class="price">31<\x85u>\u00a032</b></div>']
    pages = spark.createDataFrame(list(enumerate(htmls)), "page int, html string")
    card, price, total = T.opening("card", "div"), T.opening("price", part=True), T.opening("sum", part=True)
    by_tokens = T.once(T.explode_elements(T.with_tokens(pages, F.col("html")), card), price=T.field(price), total=T.field(total),
                       whole=T.plain(F.col("_toks"))).select("page", "price", "total", "whole")
    for whole in ("whole", None):
        got = T.element_texts(pages, F.col("html"), card, whole=whole, price=price, total=total).drop("html")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, by_tokens.select(*got.columns).collect()))


def test_a_page_of_many_cards_is_read_once(spark):
    """Each card used to be ended by the whole rest of its page: minutes."""
    import time
    n = 8000
    card = '<div class="mb-srp__card"><div class="mb-srp__card__price">85 Lac</div>' + "<p><b>x</b></p>" * 8 + "</div>"
    pages = spark.createDataFrame([("magicbricks", "hsr", card * n, dt.datetime(2024, 5, 1))],
                                  "source string, locality string, html string, scraped_at timestamp")
    began = time.monotonic()
    (r,) = parse_listing_pages(pages).groupBy("price_total").count().collect()
    assert (r.price_total, r["count"]) == (Decimal("8500000.0000"), n)
    assert time.monotonic() - began < 60


def test_complaint_pages(spark):
    page = """<div class="complaint-id">BB-101</div><span class="category">Roads</span>
    <div id="ward-name-x"> Koramangala </div><div class="ward-no">151</div>
    <label>Date Filed</label><p>05/03/2024</p><div class="status"><span>Open</span></div>
    <div class="latitude">12.93</div>"""
    pages = spark.createDataFrame([("u1", page), ("u2", "<p>no id</p>")], "url string, html string")
    summary = spark.createDataFrame([("u1", "Potholes", "desc from table")], "url string, subcategory string, description string")
    r = parse_complaint_pages(pages, summary).collect()
    assert len(r) == 1
    r = r[0]
    assert (r.complaint_id, r.category, r.ward_name, r.ward_number, r.status) == ("BB-101", "Roads", "Koramangala", 151, "Open")
    assert r.date_filed == dt.date(2024, 3, 5) and r.latitude == 12.93 and r.longitude is None
    assert (r.subcategory, r.description) == ("Potholes", "desc from table")


def test_complaint_lists(spark):
    table = """<table class="wide complaint-list"><thead><tr><th>Id</th></tr></thead><tbody>
    <tr><td><a href="/c/1?x=2">BB-1</a></td><td>Roads</td><td>Hebbal</td><td>01/02/2024</td><td>Open</td></tr>
    <tr><td>BB-2</td><td>Water</td><td> Varthur </td><td>05/03/2024</td><td>Closed</td></tr>
    <tr><td></td><td>Water</td><td>Varthur</td></tr><tr><td>BB-9</td><td>two cells</td></tr>
    <tr><td>BB-3</td><td>Trees</td><td>Hebbal</td></tr></tbody></table>
    <div class="complaint-card big"><div>text</div><a href="../d/7">more</a></div>
    <div class="complaint-card"><div>no link</div></div><a class="next-page" href="/list?page=2">next</a>"""
    other = """<div class="my-complaints"><table><tr><td>BB-4</td><td>Noise</td><td>Hebbal</td></tr></table></div>"""
    pages = spark.createDataFrame([("https://s.in/complaints/list", table), ("https://s.in/x", other), ("https://s.in/y", None)],
                                  "url string, html string")
    got = {r.complaint_id: (r.category, r.ward_name, r.date_filed, r.status) for r in parse_complaint_lists(pages).collect()}
    assert got == {"BB-2": ("Water", "Varthur", dt.date(2024, 3, 5), "Closed"), "BB-3": ("Trees", "Hebbal", None, ""),
                   "BB-4": ("Noise", "Hebbal", None, "")}
    summary = complaint_summary(pages.unionAll(pages))
    assert {r.url: (r.complaint_id, r.category, r.ward_name, r.status) for r in summary.collect()} == {
        "https://s.in/c/1?x=2": ("BB-1", "Roads", "Hebbal", "Open"), "https://s.in/d/7": (None, None, None, None)}
    detail = spark.createDataFrame([("https://s.in/c/1?x=2", '<p class="description">a hole</p>')], "url string, html string")
    (r,) = parse_complaint_pages(detail, summary).collect()
    assert (r.complaint_id, r.ward_name, r.status, r.description) == ("BB-1", "Hebbal", "Open", "a hole")


def test_city_lists(spark):
    rows = [("Bengaluru", '<table class="complaint-list"><tr><th>Id</th></tr><tr><td class="id">B1</td><td class="cat">Roads</td>'
                          '<td class="ward">Hebbal</td><td class="status">Open</td></tr></table>'),
            ("Mumbai", '<div class="complaint-row"><div class="id">M1</div><b class="cat">Water</b><i class="ward">A</i>'
                       '<i class="status">Closed</i></div><div class="complaint-row"><b class="cat">x</b></div><p class="id">no</p>'),
            ("Delhi", '<li class="complaint-item"><b class="ref">D1</b><b class="type">Trees</b><b class="zone">Z</b></li>')]
    pages = spark.createDataFrame([(*r, dt.datetime(2024, 5, 1)) for r in rows], "city string, html string, scraped_at timestamp")
    got = sorted((r.city, r.complaint_id, r.category, r.ward_name, r.status) for r in parse_city_lists(pages).collect())
    assert got == [("Bengaluru", "B1", "Roads", "Hebbal", "Open"), ("Delhi", "D1", "Trees", "Z", ""), ("Mumbai", "M1", "Water", "A", "Closed")]


def test_geojson_wards(spark, scratch):
    fc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"proposed_ward_name_en": "", "name_en": "Shantala Nagar", "id": "111.0",
                                           "ward_area": "2.5"},
         "geometry": {"type": "Polygon", "coordinates": [[[77.6, 12.9], [77.61, 12.9], [77.61, 12.91], [77.6, 12.9]]]}},
        {"type": "Feature", "properties": {"id": "x"},
         "geometry": {"type": "MultiPolygon", "coordinates": [[[[77.0, 12.0], [77.1, 12.0], [77.1, 12.1]]],
                                                             [[[78.0, 13.0], [78.1, 13.0], [78.1, 13.1]]]]}}]}
    path = f"{scratch}/wards.geojson"
    with open(path, "w") as f:
        json.dump(fc, f)
    wards = read_ward_geojson(spark, path, city="Bengaluru")
    w = sorted(wards.collect(), key=lambda r: r.ward_number)
    assert {r.city for r in w} == {"Bengaluru"}
    known = spark.createDataFrame([(7, "Old name", 111, "Bengaluru", "z")],
                                  "ward_id long, ward_name string, ward_number int, city string, zone_name string")
    both = {r.ward_number: (r.ward_id, r.ward_name) for r in upsert_wards(known, wards).collect()}
    assert both[111] == (7, "Shantala Nagar") and set(both) == {0, 111}
    assert [(r.ward_name, r.ward_number, r.area_sqkm, len(r.rings)) for r in w] == \
        [("unknown", 0, 0.0, 2), ("Shantala Nagar", 111, 2.5, 1)]
    assert (w[0].min_x, w[0].max_y) == (77.0, 13.1)
    ex = spark.createDataFrame([(1, "Old", 111, "Bengaluru", "z")], "ward_id long, ward_name string, ward_number int, city string, zone_name string")
    b = spark.createDataFrame([("New", 111, "Bengaluru", "z2"), ("Other", 5, "Mumbai", "z")],
                              "ward_name string, ward_number int, city string, zone_name string")
    up = {r.ward_number: (r.ward_id, r.ward_name) for r in upsert_wards(ex, b).collect()}
    assert up[111] == (1, "New") and up[5][1] == "Other"


def test_limit_violations(spark):
    df = spark.createDataFrame([("abcdef", Decimal("123.456")), ("ab", Decimal("1.5"))], "s string, n decimal(10,3)")
    got = {r.column_name: r.failures for r in limit_violations(df, "t", {"s": ("varchar", 3), "n": ("numeric", 5, 2)}).collect()}
    assert got == {"s": 1, "n": 1}


def test_saved_pages_scan(spark, scratch):
    import os
    from wardpulse.sources.markup import read_saved_pages
    d = f"{scratch}/pages/source=magicbricks/locality=hsr-layout"
    os.makedirs(d)
    with open(f"{d}/p1.html", "w") as f:
        f.write(MB)
    pages = read_saved_pages(spark, f"{scratch}/pages")
    rows = parse_listing_pages(pages).collect()
    assert len(rows) == 2 and {r.locality for r in rows} == {"Hsr Layout"}


def test_observed_counts(spark):
    from pyspark.sql import Observation
    from wardpulse.operators.quality import observed_counts
    df = spark.createDataFrame([(1,), (None,), (3,)], "v int")
    obs = Observation("rows_in")
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("v").isNull()).alias("dropped"))
    assert out.where(F.col("v").isNotNull()).count() == 2
    assert obs.get == {"rows": 3, "dropped": 1}
    assert observed_counts(df, "x", nulls=F.col("v").isNull()).count() == 3


def test_nested_cards_and_fields(spark):
    """A card inside a card, fields wrapped several levels deep, open and void
    elements, comments, scripts and quoted brackets; a page that tells its city."""
    html = """<body><script>var x = "<div class='mb-srp__card'>";</script><!-- <div class="mb-srp__card"> -->
    <div class='outer mb-srp__card' data-x="a>b"><div><div class="mb-srp__card__price"><div><span>₹</span><b>45</b><br>Lac</div></div></div>
      <ul><li>one<li>two</ul><img src="x"><div class="mb-srp__card__summary"><div><p>2 BHK<div class="mb-srp__card__summary--value">
      <span>1,000</span> sqft</div></div></div>
      <div class="mb-srp__card"><div class="mb-srp__card__price">1 Cr</div><div class="mb-srp__card__summary">4 BHK</div></div>
      <div class="mb-srp__card__property--type"><i><b>Villa</b></i></div></div>
    <div class="mb-srp__card__price">9 Cr</div><div class="mb-srp__card"><div class="mb-srp__card__price">7 Lac</div>"""
    pages = spark.createDataFrame([("magicbricks", "x-y", html, "Mumbai", dt.datetime(2024, 5, 1)),
                                   ("magicbricks", "x-y", None, "Delhi", dt.datetime(2024, 5, 1)),
                                   ("magicbricks", "z", '<div class="mb-srp__card"><p class="mb-srp__card__price">3 Lac</p></div>', None,
                                    dt.datetime(2024, 5, 1))],
                                  "source string, locality string, html string, city string, scraped_at timestamp")
    got = sorted((int(r.price_total), r.area_sqft and int(r.area_sqft), r.bedrooms, r.property_type, r.city)
                 for r in parse_listing_pages(pages, "Bengaluru").collect())
    assert got == [(300000, None, None, "", "Bengaluru"), (700000, None, None, "", "Mumbai"),
                   (4500000, 1000, 2, "Villa", "Mumbai"), (10000000, None, 4, "", "Mumbai")]


def test_entries_inside_entries(spark):
    """A table inside a cell gives no entries of its own; an inner card is an entry and the outer one is whole."""
    table = """<table class="complaint-list"><tbody><tr><td>BB-1</td><td>Roads</td><td><table><tr><td>Hebbal</td><td>x</td></tr>
    <tr><td>BB-7</td><td>no</td><td>no</td></tr></table></td><td>01/02/2024</td><td>Open</td></tr></tbody></table>"""
    rows = parse_complaint_lists(spark.createDataFrame([("https://s.in/l", table)], "url string, html string")).collect()
    assert [(r.complaint_id, r.category, r.ward_name, r.status) for r in rows] == [("BB-1", "Roads", "Hebbal", "Open")]
    city = """<div class="complaint-row"><div class="wrap"><div class="id"><b>M1</b></div></div><div class="more">
    <div class="complaint-row"><div class="id">M2</div><i class="cat">Water</i></div></div><i class="cat">Roads</i><i class="status">Open</i></div>"""
    pages = spark.createDataFrame([("Mumbai", city, dt.datetime(2024, 5, 1))], "city string, html string, scraped_at timestamp")
    got = sorted((r.complaint_id, r.status) for r in parse_city_lists(pages).collect())
    assert got == [("M1", "Open"), ("M2", "")]


def test_fields_are_read_once_and_long_elements_whole(spark):
    """Elements longer than the first look, deep ones and unclosed ones; no field is
    looked for in more than one place of the plan, also not by the filter on it."""
    from wardpulse.sources import tagstack as T
    deep = '<div class="mb-srp__card">' + "<div>" * 60 + '<p class="mb-srp__card__price">3 Lac</p>' + "</div>" * 60 \
        + '<i class="mb-srp__card__property--type">' + "<b>x</b> " * 40 + '</i></div><div class="mb-srp__card">open <b class="mb-srp__card__price">4 Lac'
    pages = spark.createDataFrame([("magicbricks", "x", deep, dt.datetime(2024, 5, 1))],
                                  "source string, locality string, html string, scraped_at timestamp")
    found = parse_listing_pages(pages)
    got = sorted((int(r.price_total), r.property_type) for r in found.collect())
    assert got == [(300000, " ".join(["x"] * 40)), (400000, "")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("mb-srp__card__price") <= 2      # what its opening tag holds, and the pattern
    toks = spark.createDataFrame([(deep,)], "html string")
    spans = T.with_tokens(toks, F.col("html")).select(T.element_slices(F.col("_toks"), F.col("_tags"), T.opening("mb-srp__card", "div")).alias("s")).first().s
    assert [x.n for x in spans] == [1 + 60 + 3 + 60 + 1 + 40 * 4 + 1 + 1, 4]
