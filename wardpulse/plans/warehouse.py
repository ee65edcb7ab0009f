"""Named tables of a warehouse folder (raw -> staging -> mart), and models that are
landed once for the files they were built from.

``Warehouse`` keeps every layer as versioned tables: raw ones by the feeds' load
policies (:mod:`wardpulse.plans.loads`), staging models and the mart by full rebuilds
that read the tables before them. ``landed`` is the same for a folder of read-only
input files: a model is written once under the session's checkpoint folder and read
again as long as the files stay as they were.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from wardpulse import config as C
from wardpulse.operators.versioned import VersionedTable
from wardpulse.session import checkpoint_dir, sized_by_rows


def _state_of(spark: SparkSession, paths: Sequence[str]) -> str:
    """A name of the files' present state: their names, sizes and times."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    told = []
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            told += [f"{s.getPath()} {s.getLen()} {s.getModificationTime()}" for s in fs.listStatus(p)]
    return hashlib.sha256("\n".join(sorted(told)).encode()).hexdigest()[:24]


def landed(spark: SparkSession, root: str, tables: Sequence[str], name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """``build()`` written once for the present state of the input tables under
    ``root``, and read. A changed, added or removed input file gives a new one. The
    copy belongs to the application that wrote it."""
    state = _state_of(spark, [f"{root}/{t}.parquet" for t in tables])
    app = spark.sparkContext.applicationId
    table = VersionedTable(spark, f"{checkpoint_dir(spark).rstrip('/')}/landed/{app}/{state}/{name}")
    if not table.exists():
        with sized_by_rows(spark):
            table.rebuild(build())
    return table.read()


class Warehouse:
    """Tables under ``root``: ``raw/<feed>``, ``staging/<model>``, ``marts/<name>``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def table(self, layer: str, name: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/{layer}/{name}")

    def read(self, layer: str, name: str) -> DataFrame:
        return self.table(layer, name).read()

    def load(self, feed: str, batch: DataFrame, **options) -> int:
        from wardpulse.plans.loads import load
        return load(self.spark, self.root, feed, batch, **options)

    def build_staging(self, models: Mapping[str, Callable[[], DataFrame]]) -> None:
        """Each model once; what is built later may read what is built before."""
        for name, build in models.items():
            self.table("staging", name).rebuild(build(), ["year"])

    def build_mart(self, wards: DataFrame, year_lo: int = C.YEAR_LO, year_hi: int = C.YEAR_HI) -> DataFrame:
        """The mart from the landed staging models that exist."""
        from wardpulse.plans.mart import MART_FEATURES, mart_ward_features
        staged = {feed: self.read("staging", feed) for feed in MART_FEATURES if self.table("staging", feed).exists()}
        self.table("marts", "ward_features").rebuild(mart_ward_features(wards, staged, year_lo, year_hi), ["year"])
        return self.read("marts", "ward_features")
