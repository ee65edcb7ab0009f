"""Data-quality checks (Q-1..Q-10) as aggregations: one pass per table.

Each check yields rows (table_name, check_name, column_name, failures); a
report is their union. Constraints the warehouse enforced (NOT NULL, UNIQUE,
CHECK, REFERENCES) become counts here, since parquet enforces none.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from wardpulse import config as C

REPORT_SCHEMA = "table_name string, check_name string, column_name string, failures bigint"


def _rows(table: str, check: str, pairs: Iterable[tuple[str, Column]]) -> list[Column]:
    return [_row(table, check, col, cnt) for col, cnt in pairs]


def _row(table: str, check: str, column: str, failures: Column) -> Column:
    return F.struct(F.lit(table).alias("table_name"), F.lit(check).alias("check_name"),
                    F.lit(column).alias("column_name"), failures.cast("bigint").alias("failures"))


def _explode(df: DataFrame, structs: list[Column]) -> DataFrame:
    return df.select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")


def not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Q-1 NULL count of every column in one aggregation."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _explode(agg, _rows(table, "not_null", [(c, F.col(c)) for c in columns]))


def unique(df: DataFrame, table: str, keys: Sequence[str], name: str | None = None) -> DataFrame:
    """Q-2/Q-4 keys occurring more than once (failures = duplicate key values)."""
    d = df.groupBy(*keys).count().where(F.col("count") > 1).agg(F.count(F.lit(1)).alias("n"))
    return _explode(d, _rows(table, "unique", [(name or ",".join(keys), F.col("n"))]))


def predicate_failures(df: DataFrame, table: str, check: str, column: str, ok: Column) -> DataFrame:
    """Q-3/Q-5/Q-9 rows where ``ok`` is false (NULL counts as passing, as in SQL CHECK)."""
    d = df.agg(F.count_if(~F.coalesce(ok, F.lit(True))).alias("n"))
    return _explode(d, _rows(table, check, [(column, F.col("n"))]))


def orphans(df: DataFrame, dim: DataFrame, table: str, left: Column, right: Column,
            column: str) -> DataFrame:
    """Q-6 rows whose reference finds no dimension row (NULL references pass)."""
    keys = dim.select(right.alias("_k")).distinct()
    d = (df.where(left.isNotNull()).join(keys, left == F.col("_k"), "left_anti")
         .agg(F.count(F.lit(1)).alias("n")))
    return _explode(d, _rows(table, "relationships", [(column, F.col("n"))]))


class Rules:
    """Rules of one table, compiled into few passes: all row rules (not null,
    accepted values, checks, limits) and references are counts of one aggregate, each
    key is one grouped pass. References join the distinct values of their dimension
    first, so that a row without a match is one more condition of the aggregate.

    ``observed`` takes the same counts while the table is written, without a pass of
    their own."""

    def __init__(self, table: str):
        self.table = table
        self.rows: list[tuple[str, str, Column]] = []                  # check, column, failing rows
        self.keys: list[tuple[str, list[str]]] = []
        self.references: list[tuple[str, Column, DataFrame, Column]] = []

    def not_null(self, *columns: str) -> Rules:
        self.rows += [("not_null", c, F.col(c).isNull()) for c in columns]
        return self

    def check(self, column: str, ok: Column, name: str = "check") -> Rules:
        """Q-3/Q-5: rows where ``ok`` is false; NULL passes, as in SQL CHECK."""
        self.rows.append((name, column, ~F.coalesce(ok, F.lit(True))))
        return self

    def limits(self, limits: dict) -> Rules:
        """Q-9, as :func:`limit_violations`."""
        self.rows += [("limits", c, F.coalesce(bad, F.lit(False))) for c, bad in _limit_checks(limits)]
        return self

    def unique(self, *keys: str, name: str | None = None) -> Rules:
        self.keys.append((name or ",".join(keys), list(keys)))
        return self

    def reference(self, column: str, left: Column, dim: DataFrame, right: Column) -> Rules:
        """Q-6: values without a row in ``dim``; NULL passes."""
        self.references.append((column, left, dim, right))
        return self

    def _with_references(self, df: DataFrame) -> tuple[DataFrame, list[tuple[str, str, Column]]]:
        more = []
        for i, (column, left, dim, right) in enumerate(self.references):
            value, key = f"_v{i}", f"_r{i}"
            keys = dim.select(right.alias(key)).where(F.col(key).isNotNull()).distinct()
            df = df.withColumn(value, left).join(keys, F.col(value) == F.col(key), "left")
            more.append(("relationships", column, F.col(value).isNotNull() & F.col(key).isNull()))
        return df, more

    def _unique(self, df: DataFrame) -> list[DataFrame]:
        return [unique(df, self.table, keys, name) for name, keys in self.keys]

    def report(self, df: DataFrame) -> DataFrame:
        """Rows as the other checks give them, one per rule."""
        wide, more = self._with_references(df)
        rules = self.rows + more
        parts = []
        if rules:
            agg = wide.agg(*[F.count_if(bad).alias(f"f{i}") for i, (_, _, bad) in enumerate(rules)])
            parts.append(_explode(agg, [_row(self.table, check, column, F.col(f"f{i}"))
                                        for i, (check, column, _) in enumerate(rules)]))
        return report(*parts, *self._unique(df))

    def observed(self, df: DataFrame) -> tuple[DataFrame, Observation]:
        """The table with its row rules counted as it is written; ``told`` reads them."""
        watch = Observation(f"rules_{self.table}")
        metrics = [F.count_if(bad).alias(f"f{i}") for i, (_, _, bad) in enumerate(self.rows)]
        return df.observe(watch, F.count(F.lit(1)).alias("rows"), *metrics), watch

    def told(self, watch: Observation) -> dict[tuple[str, str], int]:
        """(check, column) -> failures, after the write."""
        got = watch.get
        return {(check, column): got[f"f{i}"] for i, (check, column, _) in enumerate(self.rows)}


def report(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def census_validation(census: DataFrame, min_wards: int = C.CENSUS_MIN_WARDS,
                      expected_wards: int = C.CENSUS_EXPECTED_WARDS) -> DataFrame:
    """Q-7 one-row profile: rows, distinct wards, sorted distinct years,
    duplicate (ward, year) count, and the warning texts."""
    dups = (census.groupBy("ward_name", "year").count().where(F.col("count") > 1)
            .agg(F.count(F.lit(1)).alias("n")).select("n"))
    prof = census.agg(F.count(F.lit(1)).alias("total_rows"),
                      F.count_distinct("ward_name").alias("unique_wards"),
                      F.sort_array(F.collect_set("year")).alias("year_range"),
                      F.min("population").alias("_min_pop"),
                      F.max("literacy_rate").alias("_max_lit"))
    prof = prof.withColumn("_dup", dups.scalar())
    dup_n = F.col("_dup")
    warnings = F.filter(F.array(
        F.when(dup_n > 0, F.concat(F.lit("Duplicate ward-year entries: "), dup_n.cast("string"))),
        F.when(F.col("_min_pop") < 0, F.lit("Negative population values found")),
        F.when(F.col("_max_lit") > 100, F.lit("Literacy rate > 100% found")),
        F.when(F.col("unique_wards") < min_wards,
               F.concat(F.lit("Low ward coverage: "), F.col("unique_wards").cast("string"),
                        F.lit(f"/{expected_wards}")))), lambda x: x.isNotNull())
    return prof.select("total_rows", "unique_wards", "year_range",
                       F.coalesce(dup_n, F.lit(0)).cast("bigint").alias("duplicate_ward_years"),
                       warnings.alias("warnings"))


def required_columns(columns: Sequence[str], required: Sequence[str],
                     year_override: int | None = None) -> list[str]:
    """Q-8 schema check before a job: missing required columns (year may be
    supplied by an override). Raises ValueError like the loaders."""
    missing = [c for c in required if c not in columns]
    if missing == ["year"] and year_override:
        return []
    if missing:
        raise ValueError(f"Missing required columns: {missing}. Available: {list(columns)}")
    return missing


def observed_counts(df: DataFrame, name: str, **conditions: Column) -> DataFrame:
    """Q-10 row counts in/out as DataFrame.observe metrics (no extra pass)."""
    metrics = [F.count(F.lit(1)).alias("rows")] + [F.count_if(c).alias(k) for k, c in conditions.items()]
    return df.observe(name, *metrics)


def _limit_checks(limits: dict) -> list[tuple[str, Column]]:
    checks = []
    for c, spec in limits.items():
        if spec[0] == "varchar":
            bad = F.length(F.col(c)) > spec[1]
        else:
            p, s = spec[1], spec[2]
            v = F.col(c).cast("decimal(38,10)")
            bad = (F.abs(v) >= F.lit(10 ** (p - s))) | (F.round(v, s) != v)
        checks.append((c, bad))
    return checks


def limit_violations(df: DataFrame, table: str, limits: dict) -> DataFrame:
    """Q-9 values that would not fit the warehouse column: ``limits`` maps a
    column to ("varchar", n) or ("numeric", precision, scale). One pass."""
    checks = _limit_checks(limits)
    agg = df.agg(*[F.count_if(b).alias(c) for c, b in checks])
    return _explode(agg, _rows(table, "limits", [(c, F.col(c)) for c, _ in checks]))
