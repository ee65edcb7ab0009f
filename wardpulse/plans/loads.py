"""Load jobs: each feed's batch goes into its raw table by the feed's policy
(SURVEY 2.2), in one atomic commit, with an audited run.

A policy is a mode and its columns:

* ``replace``: rows that share the named values with any row of the batch go, the
  batch comes; an empty batch changes nothing (a parse that gave no rows must not
  empty a year).
* ``upsert``: matched rows take the update columns only, others keep their first
  value; the newest batch row of a key wins.
* ``ignore``: rows whose key is there already are left out.

Partition columns are functions of the key, so a key lives in one partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardpulse.operators.audit import RunAudit
from wardpulse.operators.versioned import VersionedTable
from wardpulse.plans.mart import SCORE_COLUMNS


@dataclass(frozen=True)
class Policy:
    mode: str
    keys: Sequence[str]
    partition_by: Sequence[str]
    update: Sequence[str] = ()
    order: Sequence[str] = ()
    #: columns derived before the load
    derive: dict[str, Column] = field(default_factory=dict)


def _bucket(column: str, n: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(n)).cast("int")


def policies(buckets: int = 64) -> dict[str, Policy]:
    # fixed values: the feeds' modes, keys and updated columns
    return {
        "crime": Policy("replace", ["year", "city"], ["year", "city"]),
        "complaints": Policy("upsert", ["city", "bucket", "complaint_id"], ["city", "bucket"],
                             ["status", "description", "latitude", "longitude"], ["scraped_at"],
                             {"bucket": _bucket("complaint_id", buckets)}),
        "complaints_legacy": Policy("upsert", ["bucket", "complaint_id"], ["bucket"],
                                    ["status", "description", "ingested_at"], ["scraped_at"],
                                    {"bucket": _bucket("complaint_id", buckets), "ingested_at": F.current_timestamp()}),
        "aqi": Policy("upsert", ["station_id", "date"], ["date"], ["pm25", "pm10", "no2", "so2", "aqi"], ["ts"]),
        "aqi_manual": Policy("ignore", ["station_id", "date"], ["date"], order=["ts"]),
        "census": Policy("replace", ["year", "city"], ["year", "city"]),
        "transit": Policy("replace", ["source"], ["source"]),
        "ndvi": Policy("replace", ["year", "month", "city"], ["year", "month", "city"]),
        "property": Policy("replace", ["source"], ["source"]),
        "scores": Policy("upsert", ["ward_id", "year", "month"], ["year"], SCORE_COLUMNS, ["scored_at"]),
    }


def load(spark: SparkSession, root: str, feed: str, batch: DataFrame, buckets: int = 64,
         stream: tuple[str, int] | None = None) -> int:
    """Load a batch into ``root/raw/<feed>``; returns the table's version. The run's
    start, row count and end, or its error, are in ``root/audit``. The rows are
    counted while they are read for the commit's own check, not in a pass of their
    own if the batch is landed."""
    policy = policies(buckets)[feed]
    for name, value in policy.derive.items():
        batch = batch.withColumn(name, value)
    table = VersionedTable(spark, f"{root}/raw/{feed}")
    audit = RunAudit(spark, f"{root}/audit")
    with audit.run(feed, {"mode": policy.mode}) as told:
        told["records"] = batch.count()
        if policy.mode == "replace":
            version = table.replace_keys(batch, policy.keys, policy.partition_by, stream)
        elif policy.mode == "ignore":
            version = table.insert_ignore(batch, policy.keys, policy.partition_by, policy.order, stream)
        else:
            version = table.upsert(batch, policy.keys, policy.update, policy.partition_by, policy.order, None, stream)
        told["metadata"] = {"version": version}
    return version


def raw(spark: SparkSession, root: str, feed: str) -> DataFrame:
    """A loaded feed, as its newest version holds it."""
    return VersionedTable(spark, f"{root}/raw/{feed}").read()
