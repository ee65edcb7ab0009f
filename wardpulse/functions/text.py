"""Record-cleaning functions (S-1, S-15..S-36) as column expressions.

All JVM-side: regexes, try_cast, try_to_date and higher-order functions; no
Python UDF. Where Python's string semantics differ from Spark's built-ins
(str.title, Unicode \\w and \\s, first-truthy), the Python rule is spelled out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardpulse import config as C

# Python's Unicode whitespace (str.isspace) and word characters (\w).
_WS_CHARS = ("\\t\\n\\x0b\\x0c\\r\\x1c-\\x1f \\x85\\xa0\\x{1680}\\x{2000}-\\x{200a}"
             "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}")
PY_SPACE = f"[{_WS_CHARS}]"
PY_WORD = "\\p{L}\\p{N}_"
CASED_RUN = "[\\p{Lu}\\p{Ll}\\p{Lt}]+|[^\\p{Lu}\\p{Ll}\\p{Lt}]+"


def norm_name(c: Column) -> Column:
    """S-1 LOWER(TRIM(x))."""
    return F.lower(F.trim(c))


def blank_to_null(c: Column) -> Column:
    return F.when(F.trim(c) == "", F.lit(None)).otherwise(c)


def safe_float(c: Column, scale: int = 2) -> Column:
    """S-15 NULL, '', 'NA', non-numeric -> NULL; else rounded to ``scale`` places."""
    s = F.nullif(F.nullif(c.cast("string"), F.lit("")), F.lit("NA"))
    return F.round(s.try_cast("decimal(30,10)"), scale).cast(f"decimal(20,{scale})")


def safe_int(c: Column) -> Column:
    """S-16 as safe_float, truncating: '150.7' -> 150."""
    s = F.nullif(F.nullif(c.cast("string"), F.lit("")), F.lit("NA"))
    return s.try_cast("double").try_cast("int")


def clean_text(c: Column) -> Column:
    """S-17 strip, collapse white space, drop all but word, space, - . ,
    NULL or empty -> ''."""
    collapsed = F.trim(F.regexp_replace(c, PY_SPACE + "+", " "))
    kept = F.regexp_replace(collapsed, f"[^{PY_WORD}{_WS_CHARS}\\-.,]", "")
    return F.coalesce(kept, F.lit(""))


def parse_count(c: Column) -> Column:
    """S-18 '1,234' -> 1234, '1 234' -> 1234, '' or '-' -> 0, NULL -> NULL.
    Text with a letter and no digit -> NULL (D-14)."""
    s = F.trim(c.cast("string"))
    digits = F.regexp_replace(F.regexp_replace(s, "[, ]", ""), "[^0-9\\-]", "")
    no_digit_letters = s.rlike("\\p{L}") & ~s.rlike("[0-9]")
    return (F.when(c.isNull(), F.lit(None))
            .when(no_digit_letters, F.lit(None))
            .when((digits == "") | (digits == "-"), F.lit(0))
            .otherwise(digits.try_cast("int")))


def is_target_city(c: Column, cities: Sequence[str] = C.TARGET_CITIES) -> Column:
    """S-19 lower(trim(city)) contains any target name."""
    low = norm_name(c)
    return F.coalesce(F.exists(F.array(*[F.lit(t) for t in cities]), lambda t: F.contains(low, t)),
                      F.lit(False))


def title_case(c: Column) -> Column:
    """S-21 Python str.title(): upper-case the first cased letter after any
    non-cased character, lower-case the rest ('b.t.m o'neil 2nd' -> 'B.T.M O'Neil 2Nd')."""
    runs = F.regexp_extract_all(c, F.lit(f"({CASED_RUN})"), 1)
    return F.when(c.isNotNull(), F.array_join(F.transform(runs, lambda r: F.initcap(r)), ""))


def normalize_city(c: Column) -> Column:
    """S-20 three canonical names, else title case."""
    low = norm_name(c)
    return (F.when(low.contains("bengaluru") | low.contains("bangalore"), F.lit("Bengaluru"))
            .when(low.contains("delhi"), F.lit("Delhi"))
            .when(low.contains("mumbai"), F.lit("Mumbai"))
            .otherwise(title_case(F.trim(c))))


def slug_label(c: Column) -> Column:
    """S-31 'hsr-layout' -> 'Hsr Layout'."""
    return title_case(F.replace(c, F.lit("-"), F.lit(" ")))


_PRICE_NUM = "([0-9.]+)"


def parse_price(c: Column) -> Column:
    """S-22 '1.25 Cr' x 1e7, '85 Lac'/'85 Lakh' x 1e5 (D-15), else the first number."""
    t = F.trim(F.replace(F.replace(c, F.lit(","), F.lit("")), F.lit("₹"), F.lit("")))
    cr = F.regexp_extract(t, "(?i)([0-9.]+)\\s*cr", 1)
    lac = F.regexp_extract(t, "(?i)([0-9.]+)\\s*(?:lac|lakh)", 1)
    num = F.regexp_extract(t, _PRICE_NUM, 1)
    dec = lambda s: s.try_cast("decimal(20,4)")
    return (F.when(c.isNull() | (c == ""), F.lit(None))
            .when(cr != "", dec(cr) * 10000000)
            .when(lac != "", dec(lac) * 100000)
            .when(num != "", dec(num))
            .cast("decimal(24,4)"))


def parse_area(c: Column) -> Column:
    """S-23 number before 'sq ft' / 'sqft' / 'sq.ft', commas dropped."""
    m = F.regexp_extract(c, "(?i)([0-9,]+\\.?[0-9]*)\\s*(?:sq\\.?\\s*ft|sqft)", 1)
    return F.when(m != "", F.replace(m, F.lit(","), F.lit("")).try_cast("decimal(20,4)"))


def parse_bedrooms(c: Column) -> Column:
    """S-24 integer before BHK."""
    m = F.regexp_extract(c, "(?i)([0-9]+)\\s*BHK", 1)
    return F.when(m != "", m.try_cast("int"))


def price_per_sqft(total: Column, area: Column) -> Column:
    """S-25 round(total / area, 2) when both are positive."""
    from wardpulse.functions.numeric import round_ratio
    ok = (total > 0) & (area > 0)
    return F.when(ok, round_ratio(total, area, 2, 4, precision=14, den_scale=4))


DATE_FORMATS = ("d/M/yyyy", "d-M-yyyy", "yyyy-M-d", "d MMM yyyy", "d MMMM yyyy", "d/M/yyyy H:m")


def parse_date(c: Column) -> Column:
    """S-26 first format that parses wins; none -> NULL."""
    s = F.trim(c)
    return F.coalesce(*[F.try_to_date(s, f) for f in DATE_FORMATS])


def first_nonempty(*cols: Column) -> Column:
    """S-32 first value whose trimmed text is not empty (Python's first truthy)."""
    return F.coalesce(*[F.when(F.trim(x) != "", F.trim(x)) for x in cols])


def digits_int(c: Column) -> Column:
    """S-33 integer only when the text is all digits."""
    return F.when(c.rlike("^[0-9]+$"), c.try_cast("bigint"))


def source_city(source: Column) -> Column:
    """S-30 transit source code -> city."""
    expr = None
    for codes, city in C.SOURCE_CITY_RULES:
        cond = None
        for code in codes:
            cond = source.contains(code) if cond is None else cond | source.contains(code)
        expr = F.when(cond, F.lit(city)) if expr is None else expr.when(cond, F.lit(city))
    return expr.otherwise(F.lit("Bengaluru"))


def normalize_header(name: str) -> str:
    """S-27 header normalisation (on the schema, not the data)."""
    return name.lower().strip().replace(" ", "_").replace("-", "_")
