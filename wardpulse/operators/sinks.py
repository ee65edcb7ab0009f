"""Load modes (SNK-1..SNK-10) as DataFrame functions plus partition-rewrite writers.

Parquet tables take no MERGE or DELETE, so every mode is computed as a
DataFrame (what the table must hold afterwards, restricted to the touched
partitions) and written with dynamic partition overwrite. Rules followed:
every row of a touched partition is read before the rewrite; the partition
columns are functions of the key; a partition the result empties is removed
explicitly; the result is checkpointed (cluster checkpoint folder) before the
overwrite so the write never reads the files it replaces.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardpulse.session import checkpoint_dir


def dedup_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order`` tuple (D-20: last wins).
    ``max_by`` aggregates partially before the shuffle, so a hot key costs one
    row per map task, never a sort of its whole group."""
    rest = [c for c in df.columns if c not in keys]
    packed = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return packed.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    packed = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return packed.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).count().where(F.col("count") > 1)


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], update: Sequence[str],
           order: Sequence[str] | None = None,
           set_exprs: Mapping[str, Column] | None = None) -> DataFrame:
    """SNK-2 INSERT ... ON CONFLICT (keys) DO UPDATE SET update = EXCLUDED.update.

    Matched rows take only the ``update`` columns from the batch (others keep
    the target's value); unmatched batch rows are inserted; ``set_exprs``
    (SNK-8) overrides columns of every written batch row (e.g. ingested_at).
    Duplicate batch keys: last by ``order`` wins (D-20).
    """
    if order:
        batch = dedup_last(batch, keys, order)
    if set_exprs:
        for c, e in set_exprs.items():
            batch = batch.withColumn(c, e)
    cols = target.columns
    t = target.select(*[F.col(c).alias(c if c in keys else f"_t_{c}") for c in cols],
                      F.lit(True).alias("_in_t"))
    b = batch.select(*[F.col(c).alias(c if c in keys else f"_b_{c}") for c in cols],
                     F.lit(True).alias("_in_b"))
    j = t.join(b, list(keys), "full_outer")
    out = []
    for c in cols:
        if c in keys:
            out.append(F.col(c))
        elif c in update or (set_exprs and c in set_exprs):
            out.append(F.when(F.col("_in_b"), F.col(f"_b_{c}")).otherwise(F.col(f"_t_{c}")).alias(c))
        else:
            out.append(F.when(F.col("_in_t"), F.col(f"_t_{c}")).otherwise(F.col(f"_b_{c}")).alias(c))
    return j.select(*out)


def insert_ignore(target: DataFrame, batch: DataFrame, keys: Sequence[str],
                  order: Sequence[str] | None = None) -> DataFrame:
    """SNK-3 ON CONFLICT DO NOTHING: existing rows win; inside the batch the
    first by ``order`` wins."""
    if order:
        batch = dedup_first(batch, keys, order)
    return target.unionByName(batch.join(target.select(*keys), list(keys), "left_anti"))


def replace_where(target: DataFrame, batch: DataFrame, predicate: Column) -> DataFrame:
    """SNK-4 DELETE WHERE predicate; INSERT batch. A NULL predicate keeps the row."""
    return target.where(~F.coalesce(predicate, F.lit(False))).unionByName(batch)


def run_state(events: DataFrame, run_id: str = "run_id", ts: str = "ts",
              seq: str | None = None) -> DataFrame:
    """SNK-7 current state of each pipeline run from its append-only events:
    the newest event's status, records and message; first start, last finish."""
    order = F.struct(F.col(ts), F.col(seq)) if seq else F.struct(F.col(ts))
    last = F.max_by(F.struct("status", "records_loaded", "error_message"), order)
    return (events.groupBy(run_id)
            .agg(last.alias("_l"),
                 F.min(F.when(F.col("status") == "running", F.col(ts))).alias("started_at"),
                 F.max(F.when(F.col("status").isin("success", "failed"), F.col(ts))).alias("finished_at"),
                 F.count(F.lit(1)).alias("n_events"))
            .select(run_id, F.col("_l.status").alias("status"),
                    F.col("_l.records_loaded").alias("records_loaded"),
                    F.col("_l.error_message").alias("error_message"),
                    "started_at", "finished_at", "n_events"))


# ------------------------------------------------------------------ writers

def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_table(spark: SparkSession, path: str, like: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """The table at ``path`` with its own columns; the partition columns have the
    types of ``like``. Folder names do not tell them: "01" would come back as 1."""
    stored = spark.read.parquet(path).schema
    fields = [like.schema[f.name] if f.name in partition_by else f for f in stored]
    return spark.read.schema(StructType(fields)).parquet(path)


def append(batch: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """SNK-1 bulk append (an empty batch writes nothing new)."""
    w = batch.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def rebuild(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """SNK-5 full rebuild: what the table held before goes, old partitions too."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def _touched(frame: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """The distinct partition values of ``frame`` as rows of the plan itself: the
    files they come from may be replaced before they are used again."""
    cols = frame.select(*partition_by)
    return frame.sparkSession.createDataFrame(cols.distinct().collect(), cols.schema)   # bounded by partitions


def _same(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [left[c].eqNullSafe(right[c]) for c in cols])


def _in_partitions(target: DataFrame, touched: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """The target's rows in the touched partitions, a NULL partition included.
    The value lists prune the scan; the join is exact for several columns."""
    rows = touched.collect()
    for c in partition_by:
        values = {r[c] for r in rows}
        cond = F.col(c).isin([v for v in values if v is not None])
        target = target.where(cond | F.col(c).isNull() if None in values else cond)
    return target.join(F.broadcast(touched), _same(target, touched, partition_by), "left_semi")


def _rewrite(spark: SparkSession, path: str, new_rows: DataFrame, touched: DataFrame,
             partition_by: Sequence[str]) -> None:
    """Replace the touched partitions by ``new_rows``; ``touched`` comes from
    :func:`_touched`, so it does not read the files replaced here."""
    checkpoint_dir(spark)
    result = new_rows.checkpoint()        # cut the lineage to the files being replaced
    (result.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))
    # partitions that were touched but are now empty: dynamic overwrite leaves them
    left = result.select(*partition_by).distinct()
    emptied = touched.join(left, _same(touched, left, partition_by), "left_anti")
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for row in emptied.select(*[F.col(c).cast("string").alias(c) for c in partition_by]).collect():
        sub = "/".join(_folder(c, row[c]) for c in partition_by)
        p = jvm.org.apache.hadoop.fs.Path(f"{path}/{sub}")
        p.getFileSystem(conf).delete(p, True)


# Characters escaped in partition folder names, and the name of NULL.
ESCAPED = "\"#%'*/:=?\\{}[]^\x7f" + "".join(map(chr, range(1, 32)))
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _folder(column: str, value: str | None) -> str:
    """The folder name of a partition value."""
    name = lambda x: "".join(f"%{ord(c):02X}" if c in ESCAPED else c for c in x)
    return f"{name(column)}={name(value) if value else NULL_PARTITION}"


def write_upsert(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str],
                 update: Sequence[str], partition_by: Sequence[str],
                 order: Sequence[str] | None = None,
                 set_exprs: Mapping[str, Column] | None = None) -> None:
    """SNK-2 on a partitioned parquet table. ``partition_by`` must be a
    function of ``keys`` so a key never lives in two partitions."""
    if not set(partition_by) <= set(keys):
        raise ValueError("partition columns must be part of the upsert key")
    if not order and not duplicate_keys(batch, keys).isEmpty():
        raise ValueError("batch holds duplicate keys and no order column")   # D-20
    if not _exists(spark, path):
        out = upsert(batch.limit(0), batch, keys, update, order, set_exprs)
        out.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
        return
    target = read_table(spark, path, batch, partition_by)
    touched = _touched(batch.select(*target.columns), partition_by)
    tgt = _in_partitions(target, touched, partition_by)
    merged = upsert(tgt, batch.select(*target.columns), keys, update, order, set_exprs)
    _rewrite(spark, path, merged, touched, partition_by)


def write_insert_ignore(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str],
                        partition_by: Sequence[str], order: Sequence[str] | None = None) -> None:
    if not _exists(spark, path):
        (dedup_first(batch, keys, order) if order else batch).write.mode("overwrite") \
            .partitionBy(*partition_by).parquet(path)
        return
    target = read_table(spark, path, batch, partition_by)
    new = batch.select(*target.columns)
    if order:
        new = dedup_first(new, keys, order)
    if not set(partition_by) <= set(keys):
        raise ValueError("partition columns must be part of the key")
    old = _in_partitions(target, _touched(new, partition_by), partition_by)
    append(new.join(old.select(*keys), list(keys), "left_anti"), path, partition_by)


def write_replace_where(spark: SparkSession, path: str, batch: DataFrame, predicate: Column,
                        partition_by: Sequence[str]) -> None:
    """SNK-4: the predicate should name partition columns so only those
    partitions are read and rewritten."""
    if not _exists(spark, path):
        batch.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
        return
    target = read_table(spark, path, batch, partition_by)
    hit = target.where(F.coalesce(predicate, F.lit(False))).select(*partition_by)
    touched = _touched(hit.unionByName(batch.select(*target.columns).select(*partition_by)), partition_by)
    tgt = _in_partitions(target, touched, partition_by)
    _rewrite(spark, path, replace_where(tgt, batch.select(*target.columns), predicate),
             touched, partition_by)
