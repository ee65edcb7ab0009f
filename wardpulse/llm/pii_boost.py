"""Personal data: high-recall candidates chosen by gradient-boosted trees.

Built-in functions only; no row leaves its place and nothing is shuffled but
the counts for fitting.

Base: four patterns with fixed checks (email; ip with parts to 255; card with
13 to 19 digits passing Luhn; phone with 9 to 15 digits). Their valid spans
always stay.

Method: two wide generators (number-like runs and address-like runs, also with
spelled-out signs) propose spans that overlap the base's and each other. Format
features (digits, groups, separators, brackets, Luhn, octets, labels) and
context features (words of contact, payment or network before, letters beside)
go to boosted trees, one model for each kind. A candidate that overlaps no base
span is added under its most probable kind if the probability reaches that
kind's threshold.

Fitting: candidates of all documents. The label of a candidate is the kind of the valid base span
it overlaps, if any (over spans of two kinds it is no example); a leading plus and country code are no features, so
unprefixed numbers look like prefixed ones. A candidate without a base span has
no label for a kind if it has a format learned from that kind's base spans and
neither its checks nor its context speak against the kind: it may be one that
the base missed. It is a negative if its format is not learned, it fails the
checks (Luhn, octets, a date, too many digits), or only words of other kinds
stand before it or it is joined to its neighbours. A format is learned from at
least ``LEAST`` base spans that are at least ``SHARE`` of the kind's.

Spark counts the distinct feature vectors; only these counts reach the driver,
which boosts depth-two trees. A hash of id and text halves the documents: one
half fits, the other calibrates. The threshold of a kind is the least
probability from which on the labelled calibrating candidates are right to
``precision``; without such evidence the kind adds nothing. The fitted trees are
compiled into column expressions.

Spans are counted in code points, end exclusive. A null text is an empty one:
no spans, the SHA-256 of the empty string. Each row is judged alone, so copies,
ties and repeated ids change nothing; extra columns are left out.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import partial

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ["email", "ip", "card", "phone"]
# The base patterns, written so that matching stays linear (a run
# is entered at its start or where the last match ended, and never given back).
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
WIDE = {
    "number": r"(?<![0-9A-Za-z])[(]?[0-9](?:[\x20().-]{0,2}[0-9])++(?![0-9A-Za-z])",
    "address": r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:@|\[at\]|\(at\))\x20?[A-Za-z0-9-]++"
               r"(?:\x20?(?:\.|\[dot\]|\(dot\))[A-Za-z0-9-]++|\x20?(?:\[dot\]|\(dot\))\x20[A-Za-z0-9-]++)++",
}
CONTEXT = {
    "f_contact": r"(?i)phone|tel|call|mobile|fax|whatsapp|contact|mail|write",
    "f_payment": r"(?i)card|visa|master|amex|credit|debit|pay",
    "f_network": r"(?i)\bip\b|host|server|addr|ping|login",
}
OWN_CONTEXT = {"email": "f_contact", "ip": "f_network", "card": "f_payment", "phone": "f_contact"}
DATE = (r"(?<![0-9])(?:(?:19|20)[0-9]{2}([.\x20-])(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12][0-9]|3[01])"
        r"|(?:0?[1-9]|[12][0-9]|3[01])([.\x20-])(?:0?[1-9]|1[0-2])\2(?:19|20)[0-9]{2})(?![0-9])")
LEAST, SHARE = 5, 0.005
MIXED = "mixed"
BLOCK = 128


def _running(lens: Column) -> Column:
    """Totals before each element. Two levels, so that the copying of a growing
    array stays far below the square of the number of elements."""
    blocks = F.sequence(F.lit(0), F.floor((F.size(lens) - 1) / BLOCK).cast("int"))
    parts = F.transform(blocks, lambda b: F.slice(lens, b * BLOCK + 1, BLOCK))

    def grow(first: Column, values: Column) -> Column:
        """first, first + v0, first + v0 + v1, ... without the last sum."""
        sums = F.aggregate(values, F.array(first), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
        return F.slice(sums, F.lit(1), F.size(values))

    firsts = grow(F.lit(0), F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda a, x: a + x)))
    inner = F.zip_with(parts, firsts, lambda p, first: grow(first, p))
    return F.when(F.size(lens) > 0, F.flatten(inner)).otherwise(F.array().cast("array<int>"))


def _find(df: DataFrame, name: str, pattern: str, when: Column, near: bool = False) -> DataFrame:
    """Add ``name``: the matches as structs of start, end and text, and with
    ``near`` the 24 characters before and the one after. Matches and gaps are
    columns of their own, so each pattern runs twice a text and no more."""
    m, g, at = f"_{name}_m", f"_{name}_g", f"_{name}_at"
    none = F.array().cast("array<string>")
    df = df.withColumn(m, F.when(when, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none))
    df = df.withColumn(g, F.when(F.size(m) > 0, F.split("text", pattern, -1)).otherwise(none))
    df = df.withColumn(at, F.zip_with(F.transform(m, F.length), F.transform(F.slice(g, F.lit(1), F.size(m)), F.length),
                                      lambda a, b: a + b))
    df = df.withColumn(at, _running(F.col(at)))

    def one(i):
        gap, match = F.get(F.col(g), i), F.get(F.col(m), i)
        start = F.get(F.col(at), i) + F.length(gap)
        fields = [start.alias("s"), (start + F.length(match)).alias("e"), match.alias("t")]
        if near:
            fields += [F.right(gap, F.lit(24)).alias("before"), F.left(F.get(F.col(g), i + 1), F.lit(1)).alias("after")]
        return F.struct(*fields)

    spans = F.transform(F.sequence(F.lit(0), F.size(m) - 1), one)
    empty = F.slice(F.transform(F.array(F.lit(0)), one), F.lit(1), F.lit(0))
    return df.withColumn(name, F.when(F.size(m) > 0, spans).otherwise(empty)).drop(m, g, at)


def _digits(t: Column) -> Column:
    return F.regexp_replace(t, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    places = F.split(F.reverse(digits), "")

    def add(acc, d):
        v = d.cast("int") * F.when(acc["odd"], 2).otherwise(1)
        return F.struct((acc["sum"] + v - F.when(v > 9, 9).otherwise(0)).alias("sum"), (~acc["odd"]).alias("odd"))

    zero = F.struct(F.lit(0).alias("sum"), F.lit(False).alias("odd"))
    return F.aggregate(F.filter(places, lambda d: d != ""), zero, add, lambda a: a["sum"] % 10 == 0)


def _valid(kind: str, x: Column) -> Column:
    t = x["t"]
    if kind == "ip":
        return t.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    n = F.length(_digits(t))
    if kind == "card":
        return n.between(13, 19) & _luhn(_digits(t))
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def _numbers(x: Column) -> Column:
    """A candidate's format and context as small whole numbers."""
    # without a country code that a plus announces
    t = F.when(x["before"].endswith("+"), F.regexp_replace(x["t"], r"^[0-9]{1,3}[\x20.-]+(?=[(0-9])", "")).otherwise(x["t"])
    digits = _digits(t)
    groups = F.filter(F.split(t, "[^0-9]+"), lambda g: g != "")
    yes = lambda c: c.cast("int")
    fields = [
        F.least(F.length(digits), F.lit(20)).alias("f_digits"), F.least(F.size(groups), F.lit(8)).alias("f_groups"),
        F.least(F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)), F.lit(20)).alias("f_longest"),
        yes(F.contains(t, F.lit("."))).alias("f_dot"), yes(F.contains(t, F.lit("-"))).alias("f_hyphen"),
        yes(F.contains(t, F.lit("("))).alias("f_bracket"), yes(F.length(digits).between(13, 19) & _luhn(digits)).alias("f_luhn"),
        yes(t.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")).alias("f_octets"),
        F.when(t.rlike(r"(?i)@|\[at\]|\(at\)"), F.least(F.size(F.split(t, r"(?i)\.|\[dot\]|\(dot\)")), F.lit(5)))
        .otherwise(0).alias("f_labels"),
        yes(t.rlike(DATE)).alias("f_date"), yes(t.rlike(r"(?i)\[at\]|\(at\)")).alias("f_spelled"),
        yes(x["after"].rlike(r"[=/_%&#:]")).alias("f_joined"), yes(x["before"].rlike(r"[=/_%&#:]$")).alias("f_joining"),
    ]
    fields += [yes(x["before"].rlike(p)).alias(name) for name, p in CONTEXT.items()]
    return F.struct(*fields)


FEATURES = ["f_digits", "f_groups", "f_longest", "f_dot", "f_hyphen", "f_bracket", "f_luhn", "f_octets", "f_labels",
            "f_date", "f_spelled", "f_joined", "f_joining", *CONTEXT]
#: The features that are a candidate's format, for each kind.
FORMAT = {k: ["f_labels"] if k == "email" else FEATURES[:9] for k in KINDS}


def _may_be(kind: str, x: dict) -> bool:
    """Whether neither checks nor context of a vector speak against the kind."""
    own = x[OWN_CONTEXT[kind]]
    if not own and (x["f_joined"] or x["f_joining"] or any(x[c] for c in CONTEXT)):
        return False
    if kind == "email":
        return x["f_labels"] >= 2 and bool(x["f_spelled"] or own)
    if kind == "ip":
        return bool(x["f_octets"])
    if kind == "card":
        return bool(x["f_luhn"])
    dotted = x["f_dot"] and not x["f_hyphen"] and not x["f_bracket"] and x["f_groups"] == 4 and x["f_longest"] <= 3
    return not (x["f_labels"] or x["f_date"] or x["f_octets"] or dotted or x["f_digits"] > 15)


def _spans(docs: DataFrame) -> DataFrame:
    """The base spans of each kind, and the wide candidates with features."""
    df = docs.withColumn("text", F.coalesce("text", F.lit("")))
    df = df.withColumn("_digit", F.col("text").rlike("[0-9][^0-9]{0,2}[0-9]"))
    mail = F.contains(F.col("text"), F.lit("@"))
    # each guard holds wherever its pattern can match
    guard = {"email": mail, "ip": F.col("_digit"), "card": F.col("_digit"), "phone": F.col("text").rlike(r"\+[0-9]")}
    for kind in KINDS:
        df = _find(df, f"b_{kind}", BASE[kind], guard[kind])
    for kind in KINDS:
        df = df.withColumn(f"b_{kind}", F.filter(f"b_{kind}", partial(_valid, kind)))
    df = _find(df, "w_number", WIDE["number"], F.col("_digit"), near=True)
    df = _find(df, "w_address", WIDE["address"], mail | F.col("text").rlike(r"(?i)[\[(]at[\])]"), near=True)
    wide = F.filter(F.concat("w_number", "w_address"),
                    lambda x: F.contains(x["t"], F.lit("@")) | (F.length(_digits(x["t"])) >= 7) | x["t"].rlike(r"(?i)[\[(]at[\])]"))
    df = df.withColumn("wide", wide)
    return df.withColumn("wide", F.transform("wide", lambda x: F.struct(x["s"], x["e"], _numbers(x).alias("f"))))


def _touches(spans: Column, x: Column) -> Column:
    return F.exists(spans, lambda b: (b["s"] < x["e"]) & (b["e"] > x["s"]))


class Trees:
    """Boosted depth-two trees on weighted feature vectors, logistic loss."""

    def __init__(self, rows: list[tuple[dict, float, float]], rounds: int = 12, rate: float = 0.5):
        """rows: (features, weight of positives, weight of negatives)."""
        self.trees = []
        pos, neg = (np.array([float(r[k]) for r in rows]) for k in (1, 2))
        self.start = math.log((pos.sum() + 0.5) / (neg.sum() + 0.5))
        x = np.array([[int(r[0][f]) for f in FEATURES] for r in rows])
        score = np.full(len(rows), self.start)
        for _ in range(rounds):
            q = 1.0 / (1.0 + np.exp(-score))
            grad, hess = pos * (1 - q) - neg * q, (pos + neg) * q * (1 - q)
            step = np.zeros(len(rows))
            self.trees.append(self._grow(x, grad, hess, np.arange(len(rows)), 2, rate, step))
            score = score + step

    def _grow(self, x, grad, hess, at, depth, rate, step):
        """A tree over the rows ``at``; writes the rows' values to ``step``."""
        g, h = grad[at].sum(), hess[at].sum()
        best = (1e-6, None)
        for k, f in enumerate(FEATURES if depth else []):
            own = x[at, k]
            values, place = np.unique(own, return_inverse=True)
            if len(values) < 2:
                continue
            # for each cut all that is left of it
            gl = np.cumsum(np.bincount(place, grad[at]))[:-1]
            hl = np.cumsum(np.bincount(place, hess[at]))[:-1]
            gain = gl * gl / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g * g / (h + 1)
            for v, gained in zip(values[:-1].tolist(), gain.tolist()):
                if gained > best[0] * (1 + 1e-9):       # equal cuts: the first, whatever the sums' last digits
                    best = (gained, (k, f, v))
        if best[1] is None:
            step[at] = value = float(rate * g / (h + 1))
            return value
        k, f, v = best[1]
        left = x[at, k] <= v
        return (f, v, self._grow(x, grad, hess, at[left], depth - 1, rate, step),
                self._grow(x, grad, hess, at[~left], depth - 1, rate, step))

    def _value(self, tree, x):
        while isinstance(tree, tuple):
            tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
        return tree

    def probability(self, x: dict) -> float:
        return 1.0 / (1.0 + math.exp(-self.start - sum(self._value(t, x) for t in self.trees)))

    def expression(self, x: Column) -> Column:
        def build(t):
            if not isinstance(t, tuple):
                return F.lit(float(t))
            return F.when(x[t[0]] <= t[1], build(t[2])).otherwise(build(t[3]))
        total = F.lit(self.start)
        for t in self.trees:
            if isinstance(t, tuple) or t:
                total = total + build(t)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit(docs: DataFrame, precision: float = 0.98) -> dict[str, tuple[Trees, float]]:
    """For each kind its trees and threshold (above 1: adds nothing)."""
    rows = _spans(docs)
    # a run over base spans of two kinds is no example of either
    touched = F.filter(F.array(*[F.when(_touches(F.col(f"b_{k}"), F.col("x")), k) for k in KINDS]), lambda k: k.isNotNull())
    label = F.when(F.size("touched") > 1, MIXED).otherwise(F.coalesce(F.get("touched", F.lit(0)), F.lit("")))
    half = F.pmod(F.xxhash64("doc_id", "text", F.lit(31)), F.lit(2)).cast("int").alias("half")
    # outer, as a plain explode would first filter rows by the size of the whole expression,
    # computed once more and with all steps before it written into one another
    each = rows.select(*[f"b_{k}" for k in KINDS], half, F.explode_outer("wide").alias("x")).where("x is not null")
    each = each.withColumn("touched", touched)
    counts = (each.select(label.alias("label"), "half", "x.f.*").where(F.col("label") != MIXED).groupBy("label", "half", *FEATURES)
              .agg(F.count(F.lit(1)).alias("n")).collect())    # distinct vectors of small whole numbers
    vectors: dict[tuple, dict[tuple[str, int], int]] = {}
    for r in sorted(counts, key=lambda r: (r["label"], r["half"], *[r[f] for f in FEATURES])):
        vectors.setdefault(tuple(r[f] for f in FEATURES), {})[r["label"], r["half"]] = r["n"]
    named = [(dict(zip(FEATURES, v)), n) for v, n in vectors.items()]
    out = {}
    for kind in KINDS:
        form = lambda x: tuple(x[f] for f in FORMAT[kind])  # noqa: B023, E731
        formats = Counter()
        for x, n in named:
            formats[form(x)] += n.get((kind, 0), 0) + n.get((kind, 1), 0)
        floor = max(LEAST, SHARE * formats.total())
        data = []           # features, then right and wrong of each half
        for x, n in named:
            open_ = formats[form(x)] >= floor and _may_be(kind, x)
            data.append((x, [(n.get((kind, h), 0), sum(c for (of, at), c in n.items()
                                                       if at == h and of != kind and (of or not open_))) for h in (0, 1)]))
        half = [(x, *of[0]) for x, of in data if any(of[0])]
        if not any(p for _, p, _ in half):
            continue
        trees = Trees(half)
        ranked = sorted(((trees.probability(x), *of[1]) for x, of in data if any(of[1])), reverse=True)
        threshold, right, wrong = 2.0, 0, 0
        for k, (prob, p, q) in enumerate(ranked):
            right, wrong = right + p, wrong + q
            last = k + 1 == len(ranked) or ranked[k + 1][0] < prob
            if last and right >= 20 and right >= precision * (right + wrong):
                threshold = prob
        out[kind] = (trees, max(threshold, 0.5))
    return out


def personal_data(docs: DataFrame, models: dict | None = None, id_col: str = "doc_id", text_col: str = "text",
                  carry: bool = False) -> DataFrame:
    """doc_id and text, with arrays of spans (number of the kind in KINDS, s, e):
    each kind's base ones, ``added`` and all ``spans`` by kind and place; with
    ``carry`` also the whole input row as a struct column ``row``."""
    cols = [docs[id_col].alias("doc_id"), docs[text_col].alias("text")]
    if carry:
        cols.append(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    docs = docs.select(*cols)
    if models is None:
        models = fit(docs)
    df = _spans(docs)
    bases = F.concat(*[F.transform(f"b_{k}", lambda x: F.struct(x["s"], x["e"])) for k in KINDS])
    df = df.withColumn("_base", bases)
    df = df.withColumn("wide", F.filter("wide", lambda x: ~_touches(F.col("_base"), x)))
    nothing = F.array().cast("array<struct<k:int,s:int,e:int>>")
    if models:
        scores = {k: m for k, m in models.items() if m[1] <= 1.0}
        judged = F.transform("wide", lambda x: F.struct(
            x["s"], x["e"], *[m[0].expression(x["f"]).alias(k) for k, m in scores.items()]))

        def kind_of(x):
            best = F.greatest(*[x[k] for k in scores]) if len(scores) > 1 else x[list(scores)[0]]
            pick = F.lit(-1)
            for k, m in reversed(scores.items()):
                pick = F.when((x[k] >= m[1]) & (x[k] == best), KINDS.index(k)).otherwise(pick)
            return F.struct(pick.alias("k"), x["s"], x["e"])

        if scores:
            df = df.withColumn("_judged", judged)
            df = df.withColumn("added", F.filter(F.transform("_judged", kind_of), lambda x: x["k"] >= 0))
        else:
            df = df.withColumn("added", nothing)
    else:
        df = df.withColumn("added", nothing)
    for k in KINDS:
        df = df.withColumn(f"b_{k}", F.transform(f"b_{k}", partial(_numbered, k)))
    df = df.withColumn("base", F.concat(*[f"b_{k}" for k in KINDS]))
    return df.withColumn("spans", F.when(F.size("added") > 0, F.array_sort(F.concat("base", "added"))).otherwise(F.col("base")))


def joined(spans) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def _numbered(kind: str, x: Column) -> Column:
    return F.struct(F.lit(KINDS.index(kind)).alias("k"), x["s"], x["e"])


def digest(found: DataFrame) -> DataFrame:
    count = lambda k: F.size(f"b_{k}").cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(joined("base"), 256).alias("base_sha256"),
                        joined("spans").alias("spans"), F.size("added").cast("long").alias("n_added"))


def redacted(spans: Column) -> Column:
    """The column text with each span (overlapping ones as one) replaced by its
    kind's name in brackets."""
    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k"))))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def add(acc, x):
        gap = F.substring(F.col("text"), acc["at"] + 1, x["s"] - acc["at"])
        more = F.struct(F.concat(acc["parts"], F.array(gap, F.element_at(names, x["k"] + 1))).alias("parts"), x["e"].alias("at"))
        covered = F.struct(acc["parts"].alias("parts"), F.greatest(acc["at"], x["e"]).alias("at"))
        return F.when(x["s"] >= acc["at"], more).otherwise(covered)

    zero = F.struct(F.array().cast("array<string>").alias("parts"), F.lit(0).alias("at"))
    whole = F.aggregate(ordered, zero, add, lambda a: F.concat(
        F.array_join(a["parts"], ""), F.substring(F.col("text"), a["at"] + 1, F.length("text"))))
    return F.when(F.size(spans) > 0, whole).otherwise(F.col("text"))
