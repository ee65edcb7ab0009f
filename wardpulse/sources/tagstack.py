"""Elements of HTML pages by one pass over their tags, as column expressions.

A page is cut into tokens (tags, comments, scripts and styles whole, text between);
each tag token says whether it opens or closes an element and which. An element
runs from its opening tag to the tag that closes it: elements of its own name inside
are counted, so a card inside a card, or a table inside a cell, ends where it ends.
Other elements left open inside (a ``<p>`` or ``<li>`` without an end) do not matter.
Void elements and ``<x/>`` hold nothing; an element that is never closed runs to the
end of what it lies in.

Two ways lead there. :func:`with_tokens` makes an array of the tokens, for layouts that
ask for more than an element's text. :func:`element_texts` keeps the page one text with
marks at its tags, in which one pattern finds an element with its inside: the pattern
knows elements of the same name up to ``NESTED`` deep, and the few that are nested
deeper or never closed go by their tokens.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the elements that HTML defines as void
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"]
DEEP, SHORT = 1 << 31, 24
# possessive: a tag is read without a step back, and without a call for each of its characters
_TOKEN = (r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>|<(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^<]++|<")
#: The mark at the tags of a page, and what stands for it and for its sign in the page's own text.
MARK, _OWN_MARK, _OWN_SIGN, _SIGN = "\x01", "\x02\x04", "\x02\x03", "\x02"
_TAG = _TOKEN.replace("(?is)", "(?is)<(?:").replace("|<", "|").replace("(?:<!--", "(?:!--").replace("|[^<]++", "") + ")"
#: Elements of one name inside each other that a pattern follows.
NESTED = 16


def tokens(html: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(_TOKEN), F.lit(0))


def tags(toks: Column) -> Column:
    """For each token its step (1 opens, -1 closes, 0 neither) and element name."""
    def one(t: Column) -> Column:
        def of(name: Column) -> Column:
            alone = (name == "") | t.endswith("/>") | name.isin(*VOID) | name.isin("script", "style")
            return F.struct(F.when(alone, 0).when(t.startswith("</"), -1).otherwise(1).alias("step"), name.alias("name"))
        return _bound(F.lower(F.regexp_extract(t, r"^</?([A-Za-z][\w:-]*)", 1)), of)
    return F.transform(toks, one)


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are computed once for each row, however often they are used
    later; a plain select would be written into every use of them, and into filters."""
    one = F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))
    return df.select("*", F.explode_outer(one).alias("_one")).select(*[c for c in df.columns if c not in columns], "_one.*")


def _length(tagged: Column, at: Column) -> Column:
    """Tokens of the element whose opening tag is token ``at`` (from 1)."""
    def of(name: Column) -> Column:
        # tokens seen, and the elements of the name that are open times DEEP: one number, as a
        # struct would be made anew for each token; at its end none is open
        def add(acc: Column, t: Column) -> Column:
            step = F.when(t["name"] == name, t["step"]).otherwise(0)
            return F.when((acc > 0) & (acc < DEEP), acc).otherwise(acc + step * F.lit(DEEP) + F.lit(1).cast("bigint"))

        def run(n: Column) -> Column:
            return F.aggregate(F.slice(tagged, at, n), F.lit(0).cast("bigint"), add)

        # most elements are short: the rest of the page only for those that are not
        whole = _bound(run(F.lit(SHORT)), lambda acc: F.when((acc > 0) & (acc < DEEP), acc).otherwise(run(F.size(tagged))))
        return (whole % DEEP).cast("int")

    return _bound(F.element_at(tagged, at)["name"], of)


def element_slices(toks: Column, tagged: Column, start: tuple[str, str]) -> Column:
    """(at, n) of every element whose opening tag matches, nested ones too."""
    places = F.filter(F.sequence(F.lit(1), F.size(toks)), lambda i: opens(F.element_at(toks, i), start))
    found = F.transform(places, lambda i: F.struct(i.alias("at"), _length(tagged, i).alias("n")))
    return F.when(F.size(toks) > 0, found).otherwise(F.slice(F.array(F.struct(F.lit(0).alias("at"), F.lit(0).alias("n"))), 1, 0))


def opening(cls: str | None = None, name: str = r"\w+", part: bool = False) -> tuple[str, str]:
    """An opening tag with a class token (or a part of the class): its pattern, and a
    text that every match holds, which is looked for first."""
    if cls is None:
        return f"(?is)^<{name}\\b", f"<{name}"
    inner = f"[^\"']*{cls}[^\"']*" if part else f"(?:[^\"']*\\s)?{cls}(?:\\s[^\"']*)?"
    return f"(?is)^<{name}\\b[^>]*\\bclass\\s*=\\s*[\"']{inner}[\"']", "class" if "(" in cls else cls.lower()


def opens(t: Column, start: tuple[str, str]) -> Column:
    return t.startswith("<") & ~t.startswith("</") & F.contains(F.lower(t), F.lit(start[1])) & t.rlike(start[0])


def with_tokens(df: DataFrame, html: Column) -> DataFrame:
    """Adds ``_toks`` and ``_tags`` of a page."""
    return df.withColumn("_toks", tokens(html)).withColumn("_tags", tags(F.col("_toks")))


def explode_elements(df: DataFrame, *starts: tuple[str, str], inside: tuple[str, str] | None = None, pos: str | None = None) -> DataFrame:
    """A row for each element that matches one of ``starts`` (those of the first
    pattern first), with its own ``_toks`` and ``_tags``; ``inside`` keeps only the
    elements within elements of another pattern. The explode is an outer one, as a
    plain one would first test the page once more for the number of its elements."""
    toks, tagged = F.col("_toks"), F.col("_tags")
    found = F.concat(*[element_slices(toks, tagged, s) for s in starts])
    if inside:
        within = lambda outer: F.filter(found, lambda x: F.exists(outer, lambda o: (x["at"] > o["at"]) & (x["at"] < o["at"] + o["n"])))
        found = _bound(element_slices(toks, tagged, inside), within)
    df = df.withColumn("_spans", found)
    if pos:
        df = df.select("*", F.posexplode_outer("_spans").alias(pos, "_span"))
    else:
        df = df.withColumn("_span", F.explode_outer("_spans"))
    df = df.where("_span is not null").drop("_spans")
    cut = lambda c: F.slice(c, F.col("_span.at"), F.col("_span.n"))
    return df.withColumn("_tags", cut(F.col("_tags"))).withColumn("_toks", cut(F.col("_toks"))).drop("_span")


def plain(toks: Column) -> Column:
    """The text of tokens: tags out, white space collapsed, trimmed."""
    shown = F.filter(toks, lambda t: ~(t.startswith("<") & (F.length(t) > 1)))
    return F.trim(F.regexp_replace(F.array_join(shown, " "), r"\s+", " "))


def field(start: tuple[str, str], toks: Column | str = "_toks", tagged: Column | str = "_tags") -> Column:
    """The whole text of the first matching element, however its inside is nested;
    '' without one."""
    toks = F.col(toks) if isinstance(toks, str) else toks
    tagged = F.col(tagged) if isinstance(tagged, str) else tagged
    first = F.array_position(F.transform(toks, lambda t: opens(t, start)), True).cast("int")
    return _bound(first, lambda at: F.when(at > 0, plain(F.slice(toks, at, _length(tagged, at)))).otherwise(F.lit("")))


def outermost(spans: Column) -> Column:
    """The spans that lie in no other one."""
    return _bound(spans, lambda all_: F.filter(all_, lambda x: ~F.exists(all_, lambda o: (x["at"] > o["at"]) & (x["at"] < o["at"] + o["n"]))))


def texts(start: tuple[str, str], depth_one: bool = False) -> Column:
    """The texts of all matching elements of ``_toks``; with ``depth_one`` only of
    those that lie in no other one."""
    toks, tagged = F.col("_toks"), F.col("_tags")
    spans = element_slices(toks, tagged, start)
    if depth_one:
        spans = outermost(spans)
    return F.transform(spans, lambda x: plain(F.slice(toks, x["at"], x["n"])))


# ------------------------------------------------------------------ pages with marks
def marked(html: Column) -> Column:
    """A page as one text with a ``MARK`` before and after each tag (and each comment,
    script, style and lone ``<``), and at both ends."""
    own = F.replace(F.replace(F.coalesce(html, F.lit("")), F.lit(_SIGN), F.lit(_OWN_SIGN)), F.lit(MARK), F.lit(_OWN_MARK))
    return F.concat(F.lit(MARK), F.regexp_replace(own, _TAG, f"{MARK}$0{MARK}"), F.lit(MARK))


def _opening_at(start: tuple[str, str]) -> str:
    """The pattern of :func:`opening` after a mark of a page. The word's border is looked
    at where its first letter is, not at every place of the tag."""
    return (start[0].replace("(?is)^", "").replace("[^>]*", f"[^>{MARK}]*").replace("[^\"']*", f"[^\"'{MARK}]*")
            .replace(r"\bclass", r"c(?<=\bc)lass"))


def _element_at(start: tuple[str, str]) -> str:
    """A pattern for the first element that matches, with its inside; where that is not
    found it takes everything up to the last mark. It begins with a plain character, as
    anything else would be tried at every place of the text."""
    whole, rest = r"(?![\w:-])", rf"[^{MARK}]*+"
    void = "|".join([*VOID, "script", "style"])
    opens_, closes = (rf"{MARK}<{c}\1{whole}{rest}(?<!/>)" for c in ("", "/"))
    others = rf"(?:{MARK}(?!</?\1{whole}){rest})*+"
    inner = ""
    for _ in range(NESTED - 1):
        inner = f"(?:{opens_}{others}{inner}{closes}{others})*+"
    first = rf"<(?!(?:{void}){whole})([A-Za-z][\w:-]*+){rest}(?<!/>)"
    return f"(?is){MARK}(?={_opening_at(start)})(?:{first}{others}{inner}{closes}|.*)"


def _by_tokens(found: Column) -> Column:
    """The element that a marked text begins with, whatever is inside it."""
    def of(toks: Column) -> Column:
        cut = F.slice(toks, F.lit(1), _length(tags(toks), F.lit(1)))
        return F.concat(F.lit(MARK), F.array_join(cut, MARK))

    return _bound(F.slice(F.split(found, MARK), F.lit(2), F.length(found)), of)


def shown(marks: Column) -> Column:
    """:func:`plain` of a marked text."""
    text = F.trim(F.regexp_replace(F.regexp_replace(marks, f"{MARK}<[^{MARK}]+", ""), rf"[\s{MARK}]+", " "))
    return F.replace(F.replace(text, F.lit(_OWN_MARK), F.lit(MARK)), F.lit(_OWN_SIGN), F.lit(_SIGN))


def element_texts(df: DataFrame, html: Column, start: tuple[str, str], whole: str | None = None,
                  **fields: tuple[str, str]) -> DataFrame:
    """A row for each element of a page that matches ``start``, nested ones too, with the
    :func:`field` of each of ``fields`` in it; ``whole`` names a column for all its text.

    A page is cut where such an element begins. What an element holds before the next one
    begins is mostly enough: the elements inside it are read with it only where a field is
    not found there, or has not ended."""
    ended = lambda c: F.when(c.endswith(MARK), _by_tokens(c)).otherwise(c)
    found = lambda c, s: F.regexp_extract(c, _element_at(s), 0)
    here = lambda c: F.concat(F.lit(MARK), c, F.lit(MARK))
    page = once(df, _page=marked(html))
    page = once(page, _pieces=F.split("_page", f"(?is){MARK}(?={_opening_at(start)})")).drop("_page")
    # the first piece is what stands before all elements
    last = F.size("_pieces")
    # by an array that is made by a lambda: its rows come one by one, where those of a plain one
    # would be held at once, each with the whole page
    places = F.transform(F.sequence(F.lit(2), last), lambda i: i)
    rows = page.select("*", F.explode_outer(F.when(last > 1, places)).alias("_at")).where("_at is not null")
    rows = once(rows, _here=found(here(F.element_at("_pieces", F.col("_at"))), start))
    open_, more = F.col("_here").endswith(MARK), F.col("_at") < last
    rows = once(rows, _own=F.concat(F.when(open_ & ~more, _by_tokens(F.col("_here"))).otherwise(F.col("_here")), F.lit(MARK)),
                _on=F.when(open_ & more, F.array_join(F.slice("_pieces", F.col("_at"), last), MARK))).drop("_here", "_pieces", "_at")
    rows = once(rows, **{f"_in{k}": found(F.col("_own"), s) for k, s in fields.items()})
    lacks = {k: (F.col(f"_in{k}") == "") | F.col(f"_in{k}").endswith(MARK) for k in fields}
    needed = F.col("_on").isNotNull() & (F.lit(True) if whole else reduce(lambda a, b: a | b, lacks.values()))
    rows = once(rows, _rest=F.when(needed, found(here(F.col("_on")), start))).drop("_on")
    rows = once(rows, _own=F.coalesce(F.concat(ended(F.col("_rest")), F.lit(MARK)), F.col("_own"))).drop("_rest")
    rows = once(rows, **{f"_in{k}": F.when(lacks[k], found(F.col("_own"), s)).otherwise(F.col(f"_in{k}")) for k, s in fields.items()})
    texts = {k: shown(ended(F.col(f"_in{k}"))) for k in fields} | ({whole: shown(F.col("_own"))} if whole else {})
    return once(rows, **texts).drop("_own", *[f"_in{k}" for k in fields])
