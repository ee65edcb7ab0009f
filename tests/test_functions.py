"""FIXTURES part A rows for the record-cleaning functions, and Python-rule checks."""

from decimal import Decimal

from pyspark.sql import functions as F

from wardpulse.functions import text as T


def one_col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_safe_float(spark):
    assert one_col(spark, ["42.5", None, "NA", "", "abc", "1.239"], T.safe_float) == \
        [Decimal("42.50"), None, None, None, None, Decimal("1.24")]


def test_safe_int(spark):
    assert one_col(spark, ["150", "150.7", None, "NA", ""], T.safe_int) == [150, 150, None, None, None]


def test_clean_text(spark):
    got = one_col(spark, ["  hello  ", "a   b\t\nc", None, "", "x#y! z-1.2,3", "crime  rate"], T.clean_text)
    assert got == ["hello", "a b c", "", "", "xy z-1.2,3", "crime rate"]


def test_parse_count(spark):
    got = one_col(spark, ["42", "1,234", "1 234", "-", None, "0", "abc", ""], T.parse_count)
    assert got == [42, 1234, 1234, 0, None, 0, None, 0]


def test_normalize_and_target_city(spark):
    assert one_col(spark, ["Bangalore City", "mumbai", "new delhi", "lucknow"], T.normalize_city) == \
        ["Bengaluru", "Mumbai", "Delhi", "Lucknow"]
    assert one_col(spark, ["Bengaluru", "Bangalore", "Lucknow", None], T.is_target_city) == \
        [True, True, False, False]


def test_title_case_matches_python(spark):
    samples = ["b.t.m layout", "o'neil jp-nagar 2nd", "HSR LAYOUT", "élan école", "x1y", "", "a_b"]
    assert one_col(spark, samples, T.title_case) == [s.title() for s in samples]
    assert one_col(spark, ["hsr-layout"], T.slug_label) == ["Hsr Layout"]


def test_price_area_bedrooms(spark):
    assert one_col(spark, ["₹ 1.25 Cr", "85 Lac", "90 Lakh", "4,500,000", "lakh", None], T.parse_price) == \
        [Decimal("12500000.0000"), Decimal("8500000.0000"), Decimal("9000000.0000"),
         Decimal("4500000.0000"), None, None]
    assert one_col(spark, ["1,200 sq ft", "950 sqft", "800 Sq.Ft", "big"], T.parse_area) == \
        [Decimal("1200.0000"), Decimal("950.0000"), Decimal("800.0000"), None]
    assert one_col(spark, ["3 BHK Apartment", "2bhk", "studio"], T.parse_bedrooms) == [3, 2, None]


def test_parse_date(spark):
    got = one_col(spark, ["05/03/2024", "5-3-2024", "2024-03-05", "05 Mar 2024", "5 March 2024",
                          "05/03/2024 10:30", "05/03/24", "nope", None], T.parse_date)
    d = __import__("datetime").date(2024, 3, 5)
    assert got == [d, d, d, d, d, d, None, None, None]


def test_first_nonempty(spark):
    df = spark.createDataFrame([(None, "  ", "x"), ("", "y", "z"), (None, None, None)], "a string, b string, c string")
    got = [r[0] for r in df.select(T.first_nonempty(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert got == ["x", "y", None]
