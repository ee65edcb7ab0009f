"""Incremental mart (M-8, M-10, SNK-10): a feed's batch changes only the ward-years
it touches, and only these are rewritten.

The mart is a star of independent LEFT JOINs, so the columns of one feed follow from
that feed's staging model alone. A batch is propagated in three steps:

1. its touched ward-years, from its keys: a row of a ward touches that ward and year;
   figures that look back a year touch the next one too; rows that count in every
   ward of a city or year (crime, census population, unnamed listings) touch all of them;
2. the feed's model over those wards and years only;
3. the mart rows of the touched ward-years take the feed's new columns (NULL, or the
   default, where the model has no row any more); all other rows and columns stay.

Scores are min-max scaled over the whole mart. The least and greatest value of each
dimension are kept as a small table, the state: as long as a change leaves them as
they were, only touched ward-years get new scores; if one moves, all scores follow.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardpulse import config as C
from wardpulse.functions.text import norm_name
from wardpulse.operators.versioned import VersionedTable
from wardpulse.plans.mart import MART_DEFAULTS, MART_FEATURES, SCORE_COLUMNS, mart_ward_features, scores
from wardpulse.plans.staging import year_spine

#: Feeds whose figures compare a year with the one before.
LOOKS_BACK = ("ndvi", "property")


def touched_ward_years(feed: str, batch: DataFrame, wards: DataFrame, year, *, ward_name: str = "ward_name",
                       year_lo: int = C.YEAR_LO, year_hi: int = C.YEAR_HI) -> DataFrame:
    """(ward_id, year) that a batch of a feed touches; ``year`` is a column of the
    batch. Rows by ``ward_id`` or by a ward name; rows that name neither, and the feeds
    whose rows count for a whole year, touch every ward of the year."""
    rows = batch.withColumn("_year", year.cast("int")).where(F.col("_year").isNotNull())
    # every ward of a year: the wards' years by a generator, then an equi-join on the year
    spine = year_spine(wards, year_lo, year_hi, "ward_id").distinct()

    def whole(found: DataFrame) -> DataFrame:
        return spine.join(found.select(F.col("_year").alias("year")).distinct(), "year").select("ward_id", F.col("year").alias("_year"))

    if feed in ("crime", "census_population"):
        hit = whole(rows)
    elif "ward_id" in batch.columns:
        hit = rows.select("ward_id", "_year").distinct()
    else:
        names = wards.select("ward_id", norm_name(F.col("ward_name")).alias("_nm"))
        named = rows.where(F.col(ward_name).isNotNull()).select(norm_name(F.col(ward_name)).alias("_nm"), "_year").distinct()
        hit = named.join(names, "_nm").select("ward_id", "_year").unionByName(whole(rows.where(F.col(ward_name).isNull())))
    years = F.array(F.col("_year"), F.col("_year") + 1) if feed in LOOKS_BACK else F.array(F.col("_year"))
    return (hit.select("ward_id", F.explode(years).alias("year")).where(F.col("year").between(year_lo, year_hi)).distinct())


class IncrementalMart:
    """The mart, its scores and their state under ``root/marts``, as versioned tables
    partitioned by year."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.mart = VersionedTable(spark, f"{root}/marts/ward_features")
        self.scores = VersionedTable(spark, f"{root}/marts/livability_scores")
        self.state = VersionedTable(spark, f"{root}/marts/score_state")

    def rebuild(self, wards: DataFrame, staged: dict[str, DataFrame], year_lo: int = C.YEAR_LO, year_hi: int = C.YEAR_HI) -> None:
        self.mart.rebuild(mart_ward_features(wards, staged, year_lo, year_hi), ["year"])
        self.scores.rebuild(scores(self.mart.read()), ["year"])
        self.state.rebuild(self._extremes(self.mart.read()))

    @staticmethod
    def _extremes(mart: DataFrame) -> DataFrame:
        """One row: the least and greatest value of each dimension's columns."""
        columns = sorted({c for cols in C.DIMENSIONS.values() for c in cols if c in mart.columns})
        return mart.agg(*[F.min(F.col(c).cast("double")).alias(f"lo_{c}") for c in columns],
                        *[F.max(F.col(c).cast("double")).alias(f"hi_{c}") for c in columns])

    def apply(self, feed: str, touched: DataFrame, model: Callable[[DataFrame], DataFrame],
              batch: tuple[str, int] | None = None) -> dict:
        """Take a feed's change into the mart. ``model(touched)`` gives the feed's
        staging rows (ward_id, year, its columns) for these ward-years. Returns which
        years were rewritten and whether all scores were."""
        touched = touched.select("ward_id", "year").distinct()
        columns = MART_FEATURES[feed]
        new = model(touched).join(touched, ["ward_id", "year"], "left_semi")
        new = new.select("ward_id", "year", *[F.col(c).alias(f"_n_{c}") for c in columns])
        current = self.mart.read()
        types = dict(current.dtypes)
        hit = current.join(touched, ["ward_id", "year"], "left_semi").join(new, ["ward_id", "year"], "left")
        value = lambda c: F.coalesce(F.col(f"_n_{c}"), F.lit(MART_DEFAULTS[c])) if c in MART_DEFAULTS else F.col(f"_n_{c}")
        rows = hit.select(*[value(c).cast(types[c]).alias(c) if c in columns else F.col(c) for c in current.columns])
        before = self.mart.state()["folders"]
        self.mart.upsert(rows, ["ward_id", "year"], columns, ["year"], batch=batch)
        after = self.mart.state()["folders"]
        years = sorted(int(f.split("=")[1]) for f in after if after[f] != before.get(f))
        whole = self._rescore(touched, years)
        return {"years": years, "all_scores": whole}

    def _rescore(self, touched: DataFrame, years: list[int]) -> bool:
        """New scores for the touched ward-years, or for all if an extreme moved."""
        if not years:
            return False
        mart = self.mart.read()
        now, before = self._extremes(mart).first(), self.state.read().first()
        if now != before:
            self.scores.rebuild(scores(mart), ["year"])
            self.state.rebuild(self._extremes(mart))
            return True
        # the scale is that of the whole mart, the rows are those of the touched ward-years
        part = scores(mart).where(F.col("year").isin(years)).join(touched, ["ward_id", "year"], "left_semi")
        self.scores.upsert(part, ["ward_id", "year", "month"], SCORE_COLUMNS, ["year"])
        return False
