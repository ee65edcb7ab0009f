"""Group aggregates that Spark has no skew-proof built-in for.

* :func:`grouped_mode` -- MODE() WITHIN GROUP: most frequent value, ties to
  the lowest, NULLs ignored. Two stages (count per value, then pick), both
  with map-side partial aggregation, so a hot group never sits in one task
  as raw rows.
* :func:`percentile_cont` -- exact PERCENTILE_CONT. The (group, value)
  histogram is range-partitioned on (group, value), so one group spreads
  over many tasks; per-partition counts give each histogram row its global
  rank range; only the rows covering the two target ranks survive.
  ``approx=True`` swaps in ``percentile_approx``.
* :func:`pivot_sum` -- SUM(CASE WHEN category ...) in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardpulse.session import checkpoint_dir


def mode_pick(value: str, count_col: str) -> Column:
    """Aggregate over (value, count) rows: the value with the highest count,
    ties to the lowest value, NULL values never chosen."""
    order = F.when(F.col(value).isNotNull(), F.struct(-F.col(count_col), F.col(value)))
    return F.min_by(F.col(value), order)


def grouped_mode(df: DataFrame, keys: Sequence[str], value: str, out: str | None = None) -> DataFrame:
    counts = (df.where(F.col(value).isNotNull())
              .groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n")))
    return counts.groupBy(*keys).agg(mode_pick(value, "_n").alias(out or f"mode_{value}"))


def _sliced(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` in ascending slices of ``order``, the slice number stored in
    ``_pid``. Range bounds are sampled, so a second plan over the same rows may
    cut them elsewhere: the frame is checkpointed once and every reader of the
    slices reads the stored number."""
    checkpoint_dir(df.sparkSession)
    return df.repartitionByRange(*order).withColumn("_pid", F.spark_partition_id()).checkpoint()


def percentile_cont(df: DataFrame, keys: Sequence[str], value: str, p: float = 0.5,
                    out: str = "median", approx: bool = False,
                    accuracy: int = 10000, weight: str | None = None) -> DataFrame:
    """Exact PERCENTILE_CONT(p) of ``value`` per ``keys`` (NULLs ignored).

    For a DECIMAL input the interpolation stays DECIMAL (exact); other inputs
    are interpolated as DOUBLE. Groups may be of any size: ranks are found over
    range slices. ``weight``: the rows are already a histogram, this column holds the counts.
    """
    if approx:
        return (df.where(F.col(value).isNotNull()).groupBy(*keys)
                .agg(F.percentile_approx(F.col(value), p, accuracy).alias(out)))
    # group keys travel as one struct: struct equality treats NULL fields as equal,
    # so NULL-keyed groups survive the joins below
    g = F.struct(*[F.col(k) for k in keys]).alias("_g") if keys else F.lit(0).alias("_g")
    base = df.where(F.col(value).isNotNull()).select(g, F.col(value))
    # 1. histogram, partially aggregated before the shuffle
    if weight:
        base = df.where(F.col(value).isNotNull()).select(g, F.col(value), F.col(weight).alias("_w"))
        hist = base.groupBy("_g", value).agg(F.sum("_w").alias("_c"))
    else:
        hist = base.groupBy("_g", value).agg(F.count(F.lit(1)).alias("_c"))
    dtype = dict(df.dtypes)[value]
    # 2. range slices over (group, value): ordered, balanced, a hot group spans many
    ranged = _sliced(hist, ["_g", value])
    # 3. running count inside each (partition, group) slice
    wloc = Window.partitionBy("_pid", "_g").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumn("_cum", F.sum("_c").over(wloc))
    # 4. slice totals -> offset of each slice inside its group (small: slices x groups)
    slices = ranged.groupBy("_pid", "_g").agg(F.sum("_c").alias("_slice"))
    wsl = Window.partitionBy("_g").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    wall = Window.partitionBy("_g")
    slices = (slices.withColumn("_off", F.coalesce(F.sum("_slice").over(wsl), F.lit(0)))
              .withColumn("_n", F.sum("_slice").over(wall)))
    # 5. global rank range [start, end) of every histogram row; targets lo, hi
    ranked = (local.join(slices, ["_pid", "_g"])
              .withColumn("_end", F.col("_off") + F.col("_cum"))
              .withColumn("_start", F.col("_end") - F.col("_c")))
    return _pick(ranked, keys, value, p, out, dtype)


def _pick(ranked: DataFrame, keys: Sequence[str], value: str, p: float, out: str, dtype: str) -> DataFrame:
    """Rows whose rank range [_start, _end) covers the target ranks -> interpolated value."""
    pdec = F.lit(str(Decimal(str(p)))).cast("decimal(20,10)")
    pos = (F.col("_n") - 1).cast("decimal(28,0)") * pdec
    ranked = (ranked.withColumn("_lo", F.floor(pos).cast("bigint"))
              .withColumn("_hi", F.ceil(pos).cast("bigint"))
              .withColumn("_frac", pos - F.floor(pos)))
    covers_lo = (F.col("_start") <= F.col("_lo")) & (F.col("_lo") < F.col("_end"))
    covers_hi = (F.col("_start") <= F.col("_hi")) & (F.col("_hi") < F.col("_end"))
    picked = (ranked.where(covers_lo | covers_hi).groupBy("_g")
              .agg(F.max(F.when(covers_lo, F.col(value))).alias("_vlo"),
                   F.max(F.when(covers_hi, F.col(value))).alias("_vhi"),
                   F.first("_frac").alias("_frac")))
    if dtype.startswith("decimal"):
        res = F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * F.col("_frac")
    else:
        lo, hi = F.col("_vlo").cast("double"), F.col("_vhi").cast("double")
        res = lo + (hi - lo) * F.col("_frac").cast("double")
    return picked.select(*[F.col(f"_g.{k}").alias(k) for k in keys], res.alias(out))


def pivot_sum(df: DataFrame, keys: Sequence[str], category: str, amount: str,
              categories: Sequence[str], suffix: str = "_count",
              total: str | None = None) -> DataFrame:
    """SUM(CASE WHEN category = c THEN amount ELSE 0 END) per category, plus an
    optional total over every category; one aggregation pass."""
    aggs = [F.sum(F.when(F.col(category) == c, F.col(amount)).otherwise(F.lit(0)))
            .alias(f"{c.replace(' ', '_')}{suffix}") for c in categories]
    if total:
        aggs.append(F.sum(amount).alias(total))
    return df.groupBy(*keys).agg(*aggs)


# ---------------------------------------------------------------- ordered scans
def running_before(df: DataFrame, part: Sequence[str], order: Sequence[str], weight: str,
                   out: str = "_before") -> DataFrame:
    """Sum of ``weight`` over the rows strictly before each row in ``order``
    within ``part`` -- a running sum that never puts a whole ``part`` group in
    one task. Rows are range-partitioned on (part, order); per-slice totals
    (one row per slice and group) give every slice its offset. Rows that tie
    on the order key must carry weight 0, except one."""
    r = _sliced(df, [*part, *order])
    wl = Window.partitionBy("_pid", *part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = r.withColumn("_lb", F.coalesce(F.sum(weight).over(wl), F.lit(0)))
    sl = r.groupBy("_pid", *part).agg(F.sum(weight).alias("_sw"))
    ws = Window.partitionBy(*part).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    sl = sl.withColumn("_off", F.coalesce(F.sum("_sw").over(ws), F.lit(0))).select("_pid", *part, "_off")
    part_struct = F.struct(*[F.col(c) for c in part]) if part else F.lit(0)
    joined = (local.withColumn("_pk", part_struct)
              .join(sl.withColumn("_pk", part_struct).drop(*part), ["_pid", "_pk"]))
    return joined.withColumn(out, F.col("_off") + F.col("_lb")).drop("_pid", "_pk", "_off", "_lb")


def running_last(df: DataFrame, part: Sequence[str], order: Sequence[str], value: str,
                 out: str = "_last") -> DataFrame:
    """Last non-null ``value`` at or before each row in ``order`` within
    ``part`` (an as-of lookup), distributed like :func:`running_before`: a
    window inside each range slice, plus the last value of the earlier slices
    of the same group (one row per slice and group)."""
    r = _sliced(df, [*part, *order])
    wl = Window.partitionBy("_pid", *part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = r.withColumn("_ll", F.last(value, ignorenulls=True).over(wl))
    part_struct = F.struct(*[F.col(c) for c in part]) if part else F.lit(0)
    order_struct = F.struct(*[F.col(c) for c in order])
    slice_last = (r.groupBy("_pid", *part)
                  .agg(F.max_by(F.col(value), F.when(F.col(value).isNotNull(), order_struct)).alias("_sv"))
                  .withColumn("_pk", part_struct).drop(*part))
    earlier = Window.partitionBy("_pk").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    carry = slice_last.withColumn("_carry", F.last("_sv", ignorenulls=True).over(earlier)).drop("_sv")
    joined = local.withColumn("_pk", part_struct).join(carry, ["_pid", "_pk"], "left")
    return joined.withColumn(out, F.coalesce(F.col("_ll"), F.col("_carry"))) \
                 .drop("_pid", "_pk", "_carry", "_ll")


def merged_percentile(named: DataFrame, shared: DataFrame, gkeys: Sequence[str], skey: str,
                      value: str, groups: DataFrame, p: float = 0.5, out: str = "median") -> DataFrame:
    """Exact PERCENTILE_CONT(p) per group g of N_g + U_s(g): the group's own
    values plus every value of the shared set its key ``skey`` names -- without
    pairing the shared values with the groups.

    ``named``: rows (gkeys..., value) with ``skey`` among gkeys; ``shared``:
    rows (skey, value); ``groups``: (gkeys...) to answer for. A value v of
    N_g sits at merged ranks [ltN(v) + ltU(v), leN(v) + leU(v)). A target rank
    k no N_g value covers falls on a shared-only value: U[k - J], J the N_g
    items before it, found by an as-of scan of the shared order."""
    g = list(gkeys)
    checkpoint_dir(named.sparkSession)
    # the histograms feed three range-partitioned scans (each samples its
    # input first): materialise them once in the cluster's checkpoint folder
    NH = (named.where(F.col(value).isNotNull()).groupBy(*g, value)
          .agg(F.count(F.lit(1)).alias("_c")).checkpoint())
    UH = (shared.where(F.col(value).isNotNull()).groupBy(skey, value)
          .agg(F.count(F.lit(1)).alias("_cu")).checkpoint())
    nN = NH.groupBy(*g).agg(F.sum("_c").alias("_nN"))
    # ranks of N values inside their group
    return merged_ranks(running_before(NH, g, [value], "_c", "_ltN"), nN, UH, g, skey, value, groups, p, out)


def _target_ranks(n: Column, p: float) -> tuple[Column, Column, Column]:
    """The two ranks (from 0) that PERCENTILE_CONT(p) of ``n`` values lies between, and its place between them."""
    pos = (n - 1).cast("decimal(28,0)") * F.lit(str(Decimal(str(p)))).cast("decimal(20,10)")
    return F.floor(pos).cast("bigint"), F.ceil(pos).cast("bigint"), pos - F.floor(pos)


def near_targets(NR: DataFrame, UH: DataFrame, skey: str, value: str, p: float) -> DataFrame:
    """The rows of ``NR`` (value, _c, _ltN, _nx the group's next value, _n the group's
    total) that :func:`merged_ranks` needs, without a shuffle of them.

    Rank k of n own and m shared values is an own value of rank k - m at least and k at
    most, or lies between the shared values of rank k - n and k; of the own values before
    these only the last tells how many there are. The shared values are looked up for
    group sizes up to each power of two: one small row for each of these and ``skey``."""
    UR = running_before(UH, [skey], [value], "_cu", "_ltU")
    sizes = (UH.groupBy(skey).agg(F.sum("_cu").alias("_m"))
             .select(skey, "_m", F.explode(F.sequence(F.lit(1), F.lit(48))).alias("_bits")))
    most = F.expr("shiftleft(1L, _bits)")
    lo, hi, _ = _target_ranks(most + F.col("_m"), p)
    sizes = sizes.withColumn("_from", lo - most).withColumn("_to", hi)
    holds = lambda k: (F.col("_ltU") <= F.col(k)) & (F.col(k) < F.col("_ltU") + F.col("_cu"))
    known = (UR.join(F.broadcast(sizes.where("_from >= 0 or _to < _m")), skey).where(holds("_from") | holds("_to"))
             .groupBy(skey, "_bits").agg(F.max(F.when(holds("_from"), F.col(value))).alias("_a"),
                                         F.max(F.when(holds("_to"), F.col(value))).alias("_b")))
    bounds = sizes.select(skey, "_bits", "_m").join(known, [skey, "_bits"], "left")
    n, m, v = F.col("_n"), F.coalesce(F.col("_m"), F.lit(0)), F.col(value)
    lo, hi, _ = _target_ranks(n + m, p)
    needed = ((F.col("_ltN") + F.col("_c") >= lo - m) & (F.col("_ltN") <= hi)
              & (F.col("_b").isNull() | (v <= F.col("_b")))
              & (F.col("_a").isNull() | (v >= F.col("_a")) | F.col("_nx").isNull() | (F.col("_nx") >= F.col("_a"))))
    return (NR.withColumn("_bits", F.length(F.bin("_n"))).join(F.broadcast(bounds), [skey, "_bits"], "left")
            .where(needed).drop("_bits", "_m", "_a", "_b"))


def merged_ranks(NR: DataFrame, nN: DataFrame, UH: DataFrame, g: list, skey: str, value: str, groups: DataFrame,
                 p: float, out: str) -> DataFrame:
    """:func:`merged_percentile` from ranked own values ``NR`` (g..., value, _c, _ltN),
    the groups' totals ``nN`` (g..., _nN) and the shared histogram ``UH`` (skey, value, _cu)."""
    nU = UH.groupBy(skey).agg(F.sum("_cu").alias("_nU"))
    lo, hi, frac = _target_ranks(F.col("_n"), p)
    tg = (groups.join(nN, g, "left").join(nU, skey, "left")
          .withColumn("_n", F.coalesce(F.col("_nN"), F.lit(0)) + F.coalesce(F.col("_nU"), F.lit(0)))
          .where(F.col("_n") > 0).withColumn("_lo", lo).withColumn("_hi", hi).withColumn("_frac", frac))
    targets = tg.select(*g, "_frac", F.explode(F.array(
        F.struct(F.lit("lo").alias("t"), F.col("_lo").alias("k")),
        F.struct(F.lit("hi").alias("t"), F.col("_hi").alias("k")))).alias("_t")) \
        .select(*g, "_frac", F.col("_t.t").alias("_tn"), F.col("_t.k").alias("_k"))
    # shared values below each N value
    R = (NR.select(*g, value, "_c", "_ltN", F.lit(0).alias("_tag"), F.lit(0).cast("bigint").alias("_w"))
         .unionByName(UH.select(skey, value, F.col("_cu").alias("_w"), F.lit(1).alias("_tag")),
                      allowMissingColumns=True))
    # R feeds both the N-side ranges and the shared-side as-of scan: materialise it
    R = running_before(R, [skey], [value, "_tag"], "_w", "_ltU").checkpoint()
    Nrows = (R.where(F.col("_tag") == 0)
             .join(UH.select(skey, value, "_cu").hint("merge"), [skey, value], "left")   # as many as the shared values
             .withColumn("_s", F.col("_ltN") + F.col("_ltU"))
             .withColumn("_e", F.col("_ltN") + F.col("_c") + F.col("_ltU") + F.coalesce(F.col("_cu"), F.lit(0))))
    # data rows on the left of an inner join: the (small) targets can be
    # broadcast, or a hot group split by AQE; targets without N rows rejoin after
    per = (Nrows.select(*g, value, "_s", "_e", "_ltN", "_c").join(targets.select(*g, "_tn", "_k"), g)
           .groupBy(*g, "_tn")
           .agg(F.max(F.when((F.col("_s") <= F.col("_k")) & (F.col("_k") < F.col("_e")), F.col(value))).alias("_vN"),
                F.max(F.when(F.col("_e") <= F.col("_k"), F.col("_ltN") + F.col("_c"))).alias("_J")))
    hit = (targets.join(per, [*g, "_tn"], "left")
           .withColumn("_J", F.coalesce(F.col("_J"), F.lit(0))))
    # targets on shared-only values: the (k - J)-th shared value, by an as-of scan
    q = hit.where(F.col("_vN").isNull()).withColumn("_j", F.col("_k") - F.col("_J"))
    Urows = R.where(F.col("_tag") == 1).select(skey, F.col("_ltU").alias("_pos"), value,
                                               F.lit(0).alias("_qt"))
    # many groups ask for the same rank
    qrows = q.select(skey, F.col("_j").alias("_pos")).distinct().select(
        skey, "_pos", F.lit(1).alias("_qt"), F.lit(None).cast(dict(UH.dtypes)[value]).alias(value))
    asof = running_last(Urows.unionByName(qrows), [skey], ["_pos", "_qt"], value, "_vU")
    vu = q.join(asof.where(F.col("_qt") == 1).select(skey, F.col("_pos").alias("_j"), "_vU"), [skey, "_j"]).select(*g, "_tn", "_vU")
    res = (hit.join(vu, [*g, "_tn"], "left")
           .withColumn("_v", F.coalesce(F.col("_vN"), F.col("_vU")))
           .groupBy(*g).agg(F.max(F.when(F.col("_tn") == "lo", F.col("_v"))).alias("_vlo"),
                            F.max(F.when(F.col("_tn") == "hi", F.col("_v"))).alias("_vhi"),
                            F.first("_frac").alias("_frac")))
    return res.select(*g, (F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * F.col("_frac")).alias(out))
