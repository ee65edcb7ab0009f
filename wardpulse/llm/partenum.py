"""N-gram Jaccard join by PartEnum signatures.

A document's set holds the 64-bit fingerprints of its distinct word n-grams.
Sets that are equal form one class (a 64-bit sum of mixed fingerprints names
it), so copies never meet as pairs. Between different sets:

* Sizes are cut into bands. Sets ``s <= t`` with Jaccard at least g have
  ``t <= s / g`` and differ in at most ``(1 - g) / g * s`` elements. Bands grow
  by more than ``1 / g``, so a pair lies in one band or two neighbouring ones;
  it meets under the *tag* of the smaller one's band, whose upper size gives
  the difference bound k of the tag.
* PartEnum: a tag divides the fingerprint domain into n1 groups of n2 parts.
  With ``n1 * (k2 + 1) > k`` some group has at most k2 differing elements, so
  one of its subsets of ``n2 - k2`` parts holds the same elements on both
  sides. Each such subset is a signature (a sum of its mixed fingerprints).
* An empty subset is no signature. A set has *live* groups, those with over k2
  filled parts; a linked pair that shares no signature needs ``k2 + 1``
  differences in each live group of either side, so both sides have
  ``live * (k2 + 1)`` at most k and their own bound. Such thin sets (rare, as there
  are spare groups) are also filed under each of their elements.

Under each signature every set meets that signature's hub, the set that meets
most others over all signatures; what passes the size test and the odd-sketch test
(differing parities of 512 domain cells never exceed the true difference, so this
drops no link) is verified exactly. The 512 cells of a set of thousands say nothing:
sets of more elements also have a wide sketch, with a cell or two for each element, and
what passes the first test must pass that one too. A second round takes the hub of what the first
hub's component does not hold. What then still lies in different components under
one signature meets pairwise, again behind these tests, and is verified exactly. So
links inside a group of thousands of near copies need not be enumerated, and no
link between components is lost. A class signs about once a task, and shared
signatures are found by counts that combine before the shuffle, so a group of
copies with a third of all rows costs no more than another class.

Null texts and texts without words have an empty set, linked with nothing
(component_id is their own id). Every row is judged by its own text, also where
rows share a doc_id. A null doc_id is carried as it is; its text links like any
other, and components without any id have a null component_id. Extra columns are left out; an empty table gives an empty one.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Words, arrow, fold, land, pieces_of, resident
from .links import components

_MIX = [np.uint64(c) for c in (0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
                               0x85EBCA77C2B2AE63, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x94D049BB133111EB)]
CELLS = 512
#: Classes that a task remembers as signed.
SEEN = 500_000


def shingle_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, fingerprint) of the distinct n-word shingles of each text,
    in that order. A text of fewer words has one: the whole sequence."""
    if n > len(_MIX):
        raise ValueError(f"at most {len(_MIX)} words a shingle")
    words = Words(texts, lower=True)
    h, doc = words.hash(), words.doc
    m = len(h)
    count = np.diff(words.first)
    owner = np.zeros(0, np.int32)
    prints = np.zeros(0, np.uint64)
    if m >= n:
        total = np.zeros(m - n + 1, np.uint64)
        for j in range(n):
            total += h[j:m - n + 1 + j] * _MIX[j]
        whole = doc[:m - n + 1] == doc[n - 1:]
        owner, prints = doc[:m - n + 1][whole], fold(total[whole])
    few = np.flatnonzero((count > 0) & (count < n))
    if len(few):
        total = count[few].astype(np.uint64)
        for j in range(n - 1):
            has = count[few] > j
            total[has] += h[words.first[few[has]] + j] * _MIX[j]
        owner = np.concatenate([owner, few.astype(np.int32)])
        prints = np.concatenate([prints, fold(total)])
    order = np.lexsort((prints, owner))
    owner, prints = owner[order], prints[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (prints[1:] != prints[:-1])
    return owner[new], prints[new]


class Bands:
    """Size bands, and for each the difference bound and division of its tag."""

    def __init__(self, percent: int, growth: float = 1.6, most: int = 1 << 31):
        self.percent = percent
        upper = []
        u = 0
        while u < most:
            u = max(u + 1, int(u * growth), u * 100 // percent)
            upper.append(u)
        self.upper = np.array(upper, np.int64)
        self.k = self.upper * (100 - percent) // percent
        # few differences: all pairs of three parts; else each of two parts
        small = self.k <= 6
        self.n2 = np.where(small, 3, 2)
        self.groups = self.k // 2 + 1 + np.where(small, 1, 1 + self.k // 40)
        self.k2 = 1

    def bound(self, size: np.ndarray) -> np.ndarray:
        """Most elements in which a set of this size and a linked one differ."""
        return size * (100 - self.percent) // self.percent


def signatures(owner: np.ndarray, prints: np.ndarray, n_docs: int, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """(text number, signature) rows of each text's set."""
    size = np.bincount(owner, minlength=n_docs).astype(np.int64)
    band = np.searchsorted(bands.upper, size)
    own = bands.bound(size) > 0                       # others link with equal sets only
    below = own & (band > 0) & (bands.percent * size <= 100 * bands.upper[np.maximum(band - 1, 0)])
    mixed = fold(prints ^ _MIX[7])
    out_doc, out_sig = [], []
    for shift, chosen in ((0, own), (1, below)):
        tag = np.maximum(band - shift, 0)
        for n2 in (2, 3):
            use = chosen & (bands.n2[tag] == n2)
            if not use.any():
                continue
            picked = use[owner]
            o, p, v = owner[picked], prints[picked], mixed[picked]
            ids = np.flatnonzero(use)
            groups = bands.groups[tag[ids]]
            base = np.zeros(n_docs, np.int64)
            base[ids] = np.cumsum(groups) - groups
            t = tag[o].astype(np.uint64)
            where = fold(p + (t + np.uint64(1)) * _MIX[0])
            g = (where >> np.uint64(33)) % bands.groups[tag[o]].astype(np.uint64)
            part = (where & np.uint64(0xFFFF)) % np.uint64(n2)
            cell = (base[o] + g.astype(np.int64)) * n2 + part.astype(np.int64)
            cells = int(groups.sum()) * n2
            sums = np.zeros(cells, np.uint64)
            np.add.at(sums, cell, v)
            filled = np.bincount(cell, minlength=cells).reshape(-1, n2) > 0
            sums = sums.reshape(-1, n2)
            doc_of = np.repeat(ids, groups)
            number = (np.arange(len(doc_of)) - np.repeat(base[ids], groups)).astype(np.uint64)
            tags = tag[doc_of].astype(np.uint64)
            for c, subset in enumerate(combinations(range(n2), n2 - bands.k2)):
                has = filled[:, subset].any(axis=1)
                key = np.zeros(len(doc_of), np.uint64)
                for q in subset:
                    key += sums[:, q] * _MIX[q + 1]
                place = (tags * np.uint64(1 << 32) + number) * np.uint64(4) + np.uint64(c)
                out_doc.append(doc_of[has])
                out_sig.append(fold(key ^ fold(place + _MIX[4]))[has])
            live = np.bincount(doc_of, (filled.sum(axis=1) > bands.k2), minlength=n_docs)
            # a pair under this tag differs in no more than the tag's k either
            thin = use & (live * (bands.k2 + 1) <= np.minimum(bands.bound(size), bands.k[tag]))
            if thin.any():
                of = thin[owner]
                out_doc.append(owner[of])
                out_sig.append(fold(prints[of] + fold(tag[owner[of]].astype(np.uint64) + _MIX[5])))
    if not out_doc:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(out_doc).astype(np.int64), np.concatenate(out_sig)


def _list_of(owner: np.ndarray, values: np.ndarray, n_docs: int) -> pa.ListArray:
    order = np.argsort(owner, kind="stable")
    off = np.zeros(n_docs + 1, np.int32)
    np.cumsum(np.bincount(owner, minlength=n_docs), out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off), pa.array(values[order].view(np.int64)))


def _classes(owner: np.ndarray, prints: np.ndarray, n_docs: int) -> np.ndarray:
    """The name of each text's set: equal sets, equal names."""
    name = np.bincount(owner, minlength=n_docs).astype(np.uint64)
    np.add.at(name, owner, fold(prints ^ _MIX[6]))
    return fold(name).view(np.int64)


def _wide_sketches(owner: np.ndarray, prints: np.ndarray, size: np.ndarray) -> pa.ListArray:
    """The odd sketch of each set of more than CELLS elements in a power of two of cells,
    as many as elements at least; none for the others. Halves of it laid over each other
    are the sketch of half the cells."""
    cells = np.where(size > CELLS, 1 << np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64), 0)
    end = np.cumsum(cells)
    large = cells[owner] > 0
    o = owner[large]
    at = (end - cells)[o] + (prints[large] & (cells[o] - 1).astype(np.uint64)).astype(np.int64)
    odd = np.bincount(at, minlength=int(cells.sum())) & 1
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], end // 64]).astype(np.int32)),
                                    pa.array(np.packbits(odd.astype(bool)).view(np.int64)))


def text_key(text: Column) -> Column:
    """A name of a text: rows with equal texts have equal ones (null counts as empty)."""
    text = F.coalesce(text, F.lit(""))
    return F.concat_ws(":", F.xxhash64(F.lit(1), text), F.xxhash64(F.lit(2), text))


def _describe(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, text key, set size, class and odd sketches of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        resident("partenum", lambda: True)          # a model of an operator before this one goes
        for batch in batches:
            for part in pieces_of(batch, "text", 1 << 20):
                owner, prints = shingle_sets(part.column(1), n)
                m = part.num_rows
                size = np.bincount(owner, minlength=m).astype(np.int64)
                parity = np.bincount(owner.astype(np.int64) * CELLS + (prints % np.uint64(CELLS)).astype(np.int64),
                                     minlength=m * CELLS).reshape(m, CELLS) & 1
                sketch = np.packbits(parity.astype(bool), axis=1).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(size), pa.array(_classes(owner, prints, m)),
                     *[pa.array(np.ascontiguousarray(sketch[:, j])) for j in range(8)], _wide_sketches(owner, prints, size)],
                    names=["doc_id", "text_key", "n_shingles", "class", *[f"o{j}" for j in range(8)], "wide"])

    cells = ", ".join(f"o{j} long" for j in range(8))
    return arrow(docs.select("doc_id", "text", text_key(F.col("text")).alias("text_key")), run,
                 f"doc_id {kind}, text_key string, n_shingles long, class long, {cells}, wide array<long>")


def _signed(docs: DataFrame, n: int, bands: Bands) -> DataFrame:
    """A row (sig, class) for each signature of each class, once a task or a few
    times (copies sign once as long as the task remembers their class). The sets
    are computed anew each time: that costs less than keeping the signatures.

    Signatures keep 48 bits: a chance meeting costs a test and changes nothing."""
    def run(batches):
        resident("partenum", lambda: True)          # a model of an operator before this one goes
        seen: set[int] = set()
        for batch in batches:
            for part in pieces_of(batch, "text", 1 << 20):
                owner, prints = shingle_sets(part.column(0), n)
                name = _classes(owner, prints, part.num_rows)
                if len(seen) > SEEN:
                    seen.clear()
                fresh = np.zeros(part.num_rows, bool)
                for k, c in enumerate(name.tolist()):
                    if c not in seen:
                        seen.add(c)
                        fresh[k] = True
                mine = fresh[owner]
                doc, sig = signatures(owner[mine], prints[mine], part.num_rows, bands)
                yield pa.RecordBatch.from_arrays([pa.array((sig >> np.uint64(16)).view(np.int64)), pa.array(name[doc])],
                                                 names=["sig", "class"])

    return arrow(docs.select("text"), run, "sig long, class long")


def _sets(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(class, elements) of the wanted classes; ``wanted`` has class and doc_id,
    the least id of a row of the class, or null if no row of it has an id."""
    def run(batches):
        resident("partenum", lambda: True)          # a model of an operator before this one goes
        for batch in batches:
            for part in pieces_of(batch, "text", 1 << 20):
                owner, prints = shingle_sets(part.column(1), n)
                name = _classes(owner, prints, part.num_rows)
                given = part.column(0)
                # rows that share an id may hold other texts: only those of the class stay
                same = np.array([c is None or c == x for c, x in zip(given.to_pylist(), name.tolist())], bool)
                yield pa.RecordBatch.from_arrays([pa.array(name), _list_of(owner, prints, part.num_rows)],
                                                 names=["class", "elements"]).filter(pa.array(same))

    shape = "class long, elements array<long>"
    named = arrow(docs.join(wanted.where("doc_id is not null"), "doc_id").select("class", "text"), run, shape)
    bare = docs.where("doc_id is null").select(F.lit(None).cast("long").alias("class"), "text")
    bare = arrow(bare, run, shape).join(wanted.where("doc_id is null").select("class"), "class", "left_semi")
    return named.unionAll(bare).dropDuplicates(["class"])


def _near(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a*, b* columns) that pass the size and odd-sketch tests."""
    apart = sum(F.bit_count(F.col(f"ao{j}").bitwiseXOR(F.col(f"bo{j}"))) for j in range(8))
    small, large = F.least("an", "bn"), F.greatest("an", "bn")
    return pairs.where((large * percent <= small * 100)
                       & (apart * (100 + percent) <= (small + large) * (100 - percent)))


def _near_widely(pairs: DataFrame, kinds: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, an, bn) that pass the test of their wide sketches, laid over each
    other down to the smaller one's cells. Where a set has none they pass."""
    both = (pairs.join(kinds.select(F.col("class").alias("a"), F.col("wide").alias("aw")), "a")
            .join(kinds.select(F.col("class").alias("b"), F.col("wide").alias("bw")), "b"))
    longs = F.least(F.size("aw"), F.size("bw"))

    def laid(wide: str, at: Column) -> Column:
        return F.aggregate(F.sequence(at, F.size(wide), longs), F.lit(0).cast("long"),
                           lambda acc, j: acc.bitwiseXOR(F.element_at(wide, j)))

    apart = F.aggregate(F.sequence(F.lit(1), longs), F.lit(0).cast("long"),
                        lambda acc, i: acc + F.bit_count(laid("aw", i).bitwiseXOR(laid("bw", i))))
    return both.where(F.when(longs > 0, apart * (100 + percent) <= (F.col("an") + F.col("bn")) * (100 - percent))
                      .otherwise(F.lit(True))).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sets truly link."""
    both = (pairs.join(sets.select(F.col("class").alias("a"), F.col("elements").alias("ea")), "a")
            .join(sets.select(F.col("class").alias("b"), F.col("elements").alias("eb")), "b"))
    common = F.size(F.array_intersect("ea", "eb"))
    return both.where(common * 100 >= (F.size("ea") + F.size("eb") - common) * percent).select("a", "b")


def _side(frame: DataFrame, side: str) -> list:
    return [F.col("class").alias(side), F.col("n_shingles").alias(f"{side}n"),
            *[F.col(f"o{j}").alias(f"{side}o{j}") for j in range(8)]]


def ngram_jaccard_components(docs: DataFrame, n: int = 4, percent: int = 85, detail: bool = False,
                             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id for every document: documents link when
    100 * intersection >= percent * union of their n-word shingle sets. With
    ``detail`` also ``text_key`` and ``component``, a name of the component that
    does not need ids (null for empty sets)."""
    docs = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    bands = Bands(percent)
    told = land(_describe(docs, n), "sets")
    filled = told.where("n_shingles > 0")
    kinds = filled.groupBy("class").agg(F.min("doc_id").alias("doc_id"),
                                        *[F.first(c).alias(c) for c in ["n_shingles", *[f"o{j}" for j in range(8)], "wide"]])
    kinds = land(kinds, "classes")

    # signatures under which different sets meet: counted first, as counts combine before
    # the shuffle however many rows share a signature
    shared = (_signed(docs, n, bands).groupBy("sig")
              .agg(F.min("class").alias("lo"), F.max("class").alias("hi"), F.count("*").alias("n"))
              .where("lo <> hi").select("sig", "n"))
    met = land(_signed(docs, n, bands).join(land(shared, "shared"), "sig").distinct(), "met")
    weight = land(met.groupBy("class").agg(F.sum("n").alias("weight")), "weights")

    def sets_of(pairs: DataFrame, name: str) -> DataFrame:
        ends = pairs.select(F.col("a").alias("class")).unionAll(pairs.select(F.col("b").alias("class"))).distinct()
        return land(_sets(docs, ends.join(kinds.select("class", "doc_id"), "class"), n), name)

    def stars(rows: DataFrame, hubs: DataFrame, name: str) -> DataFrame:
        """True links (a, b) between the sets under a signature and its hub."""
        pairs = (rows.join(hubs, "sig").where("class <> hub")
                 .select(F.col("class").alias("a"), F.col("hub").alias("b")).distinct())
        pairs = pairs.join(kinds.select(*_side(kinds, "a")), "a").join(kinds.select(*_side(kinds, "b")), "b")
        pairs = land(_near_widely(_near(pairs, percent).select("a", "b", "an", "bn"), kinds, percent), f"{name}-pairs")
        return land(_verified(pairs, sets_of(pairs, f"{name}-sets"), percent), f"{name}-links")

    def hub_of(rows: DataFrame) -> DataFrame:
        return rows.groupBy("sig").agg(F.max_by("class", F.struct("weight", "class")).alias("hub"))

    def rooted(rows: DataFrame, root: DataFrame) -> DataFrame:
        """Rows with the root of their class."""
        return (rows.join(root.withColumnRenamed("node", "class"), "class", "left")
                .withColumn("root", F.coalesce("root", "class")))

    def still_apart(rows: DataFrame) -> DataFrame:
        """Rows of the signatures that hold more than one root."""
        two = (rows.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
               .select("sig"))
        return rows.join(two, "sig", "left_semi")

    # the set that meets most others is the hub of a signature: of a group of near
    # copies it is the one the others come from, so one round links most of them
    weighed = met.select("sig", "class").join(weight, "class")
    hubs = land(hub_of(weighed), "hubs")
    links = stars(met.select("sig", "class"), hubs, "first")
    root = land(components(links), "roots1")

    # a second round: the hub of those that the first hub's component does not hold
    apart = land(still_apart(rooted(weighed, root)), "apart1")
    own = apart.join(hubs, "sig").join(root.select(F.col("node").alias("hub"), F.col("root").alias("of")), "hub", "left")
    others = own.where(F.col("root") != F.coalesce("of", "hub")).select("sig", "class", "weight")
    links = links.unionAll(stars(apart.select("sig", "class"), hub_of(others), "second"))
    root = land(components(links), "roots2")

    # what still lies apart under one signature meets pairwise
    apart = still_apart(rooted(apart.select("sig", "class"), root))
    apart = land(apart.join(kinds.drop("doc_id", "wide"), "class"), "apart2")
    left = apart.select("sig", F.col("root").alias("ra"), *_side(apart, "a"))
    right = apart.select("sig", F.col("root").alias("rb"), *_side(apart, "b"))
    pairs = _near(left.join(right, "sig").where("ra <> rb and a < b"), percent).select("a", "b", "an", "bn").distinct()
    pairs = land(_near_widely(pairs, kinds, percent), "last-pairs")
    links = links.unionAll(_verified(pairs, sets_of(pairs, "last-sets"), percent))
    root = components(links)

    # components get their least id class by class; only then the rows follow
    of_class = land(rooted(kinds.select("class", "doc_id"), root), "roots")
    least = of_class.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_class = of_class.join(least, "root").select("class", "component_id", F.col("root").alias("component"))
    columns = ["doc_id", "n_shingles", "component_id", *(["text_key", "component"] if detail else [])]
    found = filled.select("doc_id", "text_key", "n_shingles", "class").join(of_class, "class").select(*columns)
    empty = told.where("n_shingles = 0").select("doc_id", "text_key", "n_shingles", F.col("doc_id").alias("component_id"),
                                                F.lit(None).cast("long").alias("component"))
    return found.unionAll(empty.select(*columns))
