"""Structured Streaming re-aims of the reference's polling jobs.

* T-1 ``start_aqi_ingest``: landed JSON readings -> last reading per
  (station, day) -> idempotent upsert into a partitioned parquet table, one
  ``foreachBatch`` per micro-batch (a replayed batch rewrites the same rows).
* T-2 ``daily_city_means``: readings -> stations' city -> daily means per
  city; the same function serves a batch frame (the checked twin) and a
  stream (with a watermark, append mode).
* T-3 ``start_complaint_ingest``: newest status per complaint wins. With
  ``versioned=True`` (and T-1 alike) the sink is a versioned table that records the
  id of each micro-batch: a replayed batch is left out, readers see a batch whole or
  not at all, and only buckets with a changed complaint are rewritten, as keyed
  state drops what is stale or changes nothing before it reaches the sink.

Checkpoints of the streams live under the cluster's checkpoint folder.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from wardpulse.functions.numeric import round_ratio
from wardpulse.operators.sinks import dedup_last, write_upsert
from wardpulse.operators.versioned import VersionedTable
from wardpulse.session import checkpoint_dir

AQI_UPDATE = ["pm25", "pm10", "no2", "so2", "aqi"]          # co, o3, pollutant keep the first value
COMPLAINT_UPDATE = ["status", "description", "latitude", "longitude"]


def daily_city_means(readings: DataFrame, station_city: DataFrame, ts: str = "ts",
                     watermark: str | None = None) -> DataFrame:
    """Daily mean pm25 and reading count per city. ``station_city`` is a static
    (station_id, city) map: a stream-static join, no state for it."""
    r = readings.join(station_city.select("station_id", "city"), "station_id")
    if watermark:
        r = r.withWatermark(ts, watermark)
    g = (r.groupBy("city", F.window(ts, "1 day").alias("w"))
         .agg(F.sum("pm25").alias("_s"), F.count("pm25").alias("_n"), F.count(F.lit(1)).alias("n_readings")))
    return g.select("city", F.to_date(F.col("w.start")).alias("day"),
                    round_ratio(F.col("_s"), F.col("_n"), 2, 2, precision=8).alias("avg_pm25"),
                    "n_readings")


def _stream_ckpt(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), "streams", name)


def upsert_batch(spark: SparkSession, table_path: str, keys, update, partition_by, order):
    """foreachBatch body: dedupe the micro-batch, then partition-rewrite upsert.
    Re-running the same batch id produces the same table (idempotent)."""
    def run(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        write_upsert(spark, table_path, dedup_last(batch, keys, order), keys, update,
                     partition_by, order=None)
    return run


def commit_batch(spark: SparkSession, table_path: str, stream: str, keys, update, partition_by, order):
    """foreachBatch body for a versioned table: the commit carries the batch id, so
    a batch that is run again after its commit changes nothing."""
    table = VersionedTable(spark, table_path)

    def run(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            table.upsert_newest(batch, keys, update, partition_by, order, (stream, batch_id))
    return run


def newest_changes(rows: DataFrame, keys: list[str], order: str, watched: list[str], forget: str | None = None) -> DataFrame:
    """Keyed state over a stream: of each key the newest row by ``order`` passes, if
    it is newer than the last one that passed and differs from it in the ``watched``
    columns. The state of a key is two numbers (the order value and a hash of the
    watched columns); with ``forget`` (such as "90 days") it is dropped after that
    time without a row of the key, and the key's next row passes."""
    names, fields = rows.columns, rows.schema
    tagged = rows.withColumn("_print", F.xxhash64(*watched)).withColumn("_order", F.col(order).cast("long"))
    timeout = GroupStateTimeout.ProcessingTimeTimeout if forget else GroupStateTimeout.NoTimeout

    def step(key, batches, state):
        if state.hasTimedOut:
            state.remove()
            return
        best = None
        for pdf in batches:
            top = pdf.loc[[pdf["_order"].idxmax()]]
            if best is None or top["_order"].iloc[0] > best["_order"].iloc[0]:
                best = top
        at, print_ = int(best["_order"].iloc[0]), int(best["_print"].iloc[0])
        old = state.get if state.exists else None
        if old is None or at > old[0]:
            state.update((at, print_))
            if old is None or print_ != old[1]:
                yield best[names]
        if forget:
            state.setTimeoutDuration(forget)

    return (tagged.where(F.col(order).isNotNull()).groupBy(*keys)
            .applyInPandasWithState(step, fields, "at long, print long", "append", timeout))


def start_aqi_ingest(spark: SparkSession, landing: str, table_path: str, schema: str,
                     trigger_once: bool = False, name: str = "aqi_ingest", versioned: bool = False):
    """T-1: readStream JSON from ``landing`` -> upsert by (station_id, date),
    partitioned by date (a function of the key)."""
    src = (spark.readStream.schema(schema).json(landing)
           .withColumn("date", F.to_date("date")))
    how = (["station_id", "date"], AQI_UPDATE, ["date"], ["ts"])
    w = (src.writeStream.foreachBatch(commit_batch(spark, table_path, name, *how) if versioned
                                      else upsert_batch(spark, table_path, *how))
         .option("checkpointLocation", _stream_ckpt(spark, name)))
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="1 hour")
    return w.start()


def start_daily_means(spark: SparkSession, landing: str, schema: str, station_city: DataFrame,
                      sink_path: str, watermark: str = "1 day", trigger_once: bool = False,
                      name: str = "aqi_daily"):
    """T-2: windowed daily city means with a watermark, appended to parquet
    once a day's window closes."""
    src = spark.readStream.schema(schema).json(landing)
    means = daily_city_means(src, station_city, watermark=watermark)
    w = (means.writeStream.outputMode("append").format("parquet").option("path", sink_path)
         .option("checkpointLocation", _stream_ckpt(spark, name)))
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="1 hour")
    return w.start()


def start_complaint_ingest(spark: SparkSession, landing: str, table_path: str, schema: str,
                           trigger_once: bool = False, name: str = "complaints_ingest", versioned: bool = False,
                           buckets: int = 64, forget: str | None = None):
    """T-3: upsert by (city, complaint_id) -- status, description and position
    follow the newest record; date_filed keeps the first-seen day (D-23).

    The table is partitioned by city and a hash bucket of the id (D-23: not by
    date). ``versioned``: :func:`newest_changes` passes only complaints that changed,
    and a commit rewrites only their buckets; choose ``buckets`` so that a bucket is
    some 100 MB."""
    src = spark.readStream.schema(schema).json(landing)
    bucket = F.pmod(F.xxhash64("complaint_id"), F.lit(buckets)).cast("int")
    how = (["city", "bucket", "complaint_id"], COMPLAINT_UPDATE, ["city", "bucket"], ["scraped_at"])
    if versioned:
        src = newest_changes(src, ["city", "complaint_id"], "scraped_at", COMPLAINT_UPDATE, forget)
        body = commit_batch(spark, table_path, name, *how)
    else:
        body = upsert_batch(spark, table_path, *how)
    w = (src.withColumn("bucket", bucket).writeStream.foreachBatch(body)
         .option("checkpointLocation", _stream_ckpt(spark, name)))
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="1 hour")
    return w.start()
