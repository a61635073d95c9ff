"""Declarative data-quality tests and load checks.

A test's meaning is "the failing rows"; zero failing rows is a pass.  Each
test is also available as a function returning its failing rows.  For a
whole suite, `run_suite` folds every row-wise test of a table (not_null,
accepted_range, accepted_values, length) into ONE aggregate pass; only
`unique` needs its own grouped aggregate (partial, map-side).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from barlake.functions.columns import age_minutes
from barlake.operators.layers import read_stored
from barlake.schema import (
    ACCEPTED_SOURCES, FRESHNESS_ERROR_MINUTES, FRESHNESS_HORIZON, FRESHNESS_WARN_MINUTES,
    MIN_ROWS_DAILY, MIN_SYMBOLS, STALE_AFTER_MINUTES,
)


@dataclass(frozen=True)
class Test:
    column: str                     # one name, or several with commas for `unique`
    kind: str                       # not_null | unique | accepted_range | accepted_values | max_length
    params: dict = field(default_factory=dict)
    where: str | None = None        # SQL predicate restricting the tested rows


# ---------------------------------------------------------------------------
# failing-row conditions
# ---------------------------------------------------------------------------
def range_violation(col: Column, min_value=None, max_value=None, inclusive: bool = True) -> Column:
    """NOT (col >= min AND col <= max); strict when not inclusive.  NULL passes."""
    ok = F.lit(True)
    if min_value is not None:
        ok = ok & ((col >= F.lit(min_value)) if inclusive else (col > F.lit(min_value)))
    if max_value is not None:
        ok = ok & ((col <= F.lit(max_value)) if inclusive else (col < F.lit(max_value)))
    return ~ok


def _condition(t: Test) -> Column:
    c = F.col(t.column)
    if t.kind == "not_null":
        return c.isNull()
    if t.kind == "accepted_range":
        return range_violation(c, t.params.get("min_value"), t.params.get("max_value"),
                               t.params.get("inclusive", True))
    if t.kind == "accepted_values":
        return c.isNotNull() & ~c.isin(list(t.params["values"]))
    if t.kind == "max_length":
        return F.length(c) > F.lit(t.params["length"])
    raise ValueError(f"not a row-wise test: {t.kind}")


def _scoped(df: DataFrame, t: Test) -> DataFrame:
    return df if t.where is None else df.filter(F.expr(t.where))


def failing_rows(df: DataFrame, t: Test) -> DataFrame:
    """The test's failing rows."""
    x = _scoped(df, t)
    if t.kind == "unique":
        return unique_violations(x, t.column.split(","))
    if t.kind == "accepted_values":
        return x.filter(_condition(t)).groupBy(t.column).agg(F.count(F.lit(1)).alias("n_records"))
    return x.filter(_condition(t))


def unique_violations(df: DataFrame, cols: list[str]) -> DataFrame:
    """Key values seen more than once (NULL keys ignored)."""
    keyed = df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))
    return (keyed.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1))


# ---------------------------------------------------------------------------
# suites
# ---------------------------------------------------------------------------
def _row_condition(t: Test) -> Column:
    return _condition(t) if t.where is None else F.expr(t.where) & _condition(t)


def _failure_count(t: Test) -> Column:
    cond = _row_condition(t)
    if t.kind == "accepted_values":        # failing rows = distinct bad values
        return F.count_distinct(F.when(cond, F.col(t.column)))
    return F.count_if(F.coalesce(cond, F.lit(False)))


def run_suite(df: DataFrame, suite: list[Test], layer: str) -> DataFrame:
    """One report row per test: layer, column_name, test, failures, status."""
    row_wise = [t for t in suite if t.kind != "unique"]
    parts = []
    if row_wise:
        one = df.agg(*[_failure_count(t).cast("bigint").alias(f"t{i}") for i, t in enumerate(row_wise)])
        tests = F.array(*[F.struct(F.lit(t.column).alias("column_name"), F.lit(t.kind).alias("test"),
                                   F.col(f"t{i}").alias("failures")) for i, t in enumerate(row_wise)])
        parts.append(one.select(F.inline(tests)))
    for t in suite:
        if t.kind == "unique":
            n = unique_violations(_scoped(df, t), t.column.split(",")).agg(F.count(F.lit(1)).alias("failures"))
            parts.append(n.select(F.lit(t.column).alias("column_name"), F.lit("unique").alias("test"),
                                  F.col("failures").cast("bigint").alias("failures")))
    report = reduce(DataFrame.unionByName, parts)
    return report.select(F.lit(layer).alias("layer"), "column_name", "test", "failures",
                         F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit("fail")).alias("status"))


def observe_suite(df: DataFrame, suite: list[Test]) -> tuple[DataFrame, Observation]:
    """`df` that counts the suite's row-wise failures while it is written: the
    tests ride on the writing job instead of scanning its result."""
    seen = Observation()
    counts = [F.count_if(F.coalesce(_row_condition(t), F.lit(False))).alias(f"t{i}")
              for i, t in enumerate(suite) if t.kind != "unique"]
    return (df.observe(seen, *counts) if counts else df), seen


def observed_report(spark: SparkSession, seen: Observation, suite: list[Test], layer: str, written=None) -> DataFrame:
    """The report of `run_suite` after the write.  `written()` reads the result,
    and only for what a running count can't tell: `unique` tests, and how many
    different values broke an accepted_values test that some row failed."""
    counts = seen.get if any(t.kind != "unique" for t in suite) else {}
    rows, later = [], []
    for i, t in enumerate(suite):
        n = counts.get(f"t{i}", 0)
        if t.kind == "unique" or (t.kind == "accepted_values" and n):
            later.append(t)
        else:
            rows.append((layer, t.column, t.kind, int(n or 0), "fail" if n else "pass"))
    report = spark.createDataFrame(rows, "layer string, column_name string, test string, failures long, status string")
    return report.unionByName(run_suite(written(), later, layer)) if later else report


def gate(report: DataFrame) -> DataFrame:
    """Raise when any test of the report failed, naming all of them; else
    return the report.  The suite runs once: its report, one row per test, is
    collected and returned as a local table."""
    rows = report.collect()
    bad = [r for r in rows if r.status != "pass"]
    if bad:
        raise AssertionError("data tests failed: " + ", ".join(f"{r.layer}.{r.column_name}:{r.test}" for r in bad))
    return report.sparkSession.createDataFrame(rows, report.schema)


# Suites of the three layers (T07).  Bronze: 9 tests + source freshness.
BRONZE_SUITE = [
    Test("id", "unique"), Test("id", "not_null"),
    Test("timestamp", "not_null"), Test("symbol", "not_null"),
    Test("close", "not_null"), Test("close", "accepted_range", {"min_value": 0, "inclusive": False}),
    Test("volume", "accepted_range", {"min_value": 0, "inclusive": True}),
    Test("source", "accepted_values", {"values": ACCEPTED_SOURCES}),
    Test("ingestion_timestamp", "not_null"),
]
SILVER_SUITE = [
    Test("timestamp", "not_null"), Test("timestamp", "unique", where="symbol = 'BTC-USD'"),
    Test("symbol", "not_null"),
    Test("close", "not_null"), Test("close", "accepted_range", {"min_value": 0, "inclusive": False}),
    Test("open", "not_null"), Test("high", "not_null"), Test("low", "not_null"),
    Test("volume", "not_null"), Test("volume", "accepted_range", {"min_value": 0, "inclusive": True}),
    Test("simple_return_pct", "accepted_range", {"min_value": -100, "max_value": 100, "inclusive": True}),
    Test("source", "not_null"), Test("updated_at", "not_null"),
]
GOLD_SUITE = [
    Test("date", "not_null"), Test("symbol", "not_null"),
    Test("open", "not_null"), Test("high", "not_null"), Test("low", "not_null"),
    Test("close", "not_null"), Test("close", "accepted_range", {"min_value": 0}),
    Test("volume", "not_null"), Test("volume", "accepted_range", {"min_value": 0, "inclusive": True}),
    Test("daily_return_pct", "accepted_range", {"min_value": -100, "max_value": 1000, "inclusive": True}),
    Test("updated_at", "not_null"),
]
# The bronze table constraints (NOT NULL, UNIQUE key, lengths).
BRONZE_CONSTRAINTS = [
    Test("id", "not_null"), Test("id", "unique"), Test("timestamp,symbol,source", "unique"),
    Test("timestamp", "not_null"), Test("symbol", "not_null"),
    Test("symbol", "max_length", {"length": 20}), Test("source", "max_length", {"length": 50}),
]


# ---------------------------------------------------------------------------
# uniqueness after a load, from the touched days and the log of loads
# ---------------------------------------------------------------------------
def key_violations_in(spark: SparkSession, path: str, days: list, cols: list[str]) -> DataFrame:
    """T02 / T06 on a layer by day, for keys that hold the time (two rows of one
    key lie in one folder): only the folders of the touched days are read."""
    rows = read_stored(spark, path, days)
    return unique_violations(rows, cols)


def overlapping_loads(spark: SparkSession, path: str) -> DataFrame:
    """T02 for `id` over all loads, from their log alone (one row each): loads
    whose ids may collide with an earlier load's.  Ids within a load are unique by
    the way they are made (`writes.with_ids`) or checked by `id_violations_in`."""
    log = read_stored(spark, f"{path.rstrip('/')}_loads")
    before = Window.orderBy("low_id", "high_id", "load").rowsBetween(Window.unboundedPreceding, -1)
    return log.withColumn("_high", F.max("high_id").over(before)).filter("low_id <= _high").select("load", "low_id", "high_id")


def id_violations_in(spark: SparkSession, path: str, days: list) -> DataFrame:
    """T02 for `id` after a load: ids seen twice in the touched days, and, where
    the log says that loads overlap, in the whole layer."""
    whole = not overlapping_loads(spark, path).isEmpty()
    return unique_violations(read_stored(spark, path, None if whole else days), ["id"])


# ---------------------------------------------------------------------------
# freshness and load checks
# ---------------------------------------------------------------------------
def source_freshness(df: DataFrame, as_of, loaded_at: str = "ingestion_timestamp",
                     warn_after: int = FRESHNESS_WARN_MINUTES,
                     error_after: int = FRESHNESS_ERROR_MINUTES) -> DataFrame:
    """Age of the newest load time -> pass / warn / error (one row)."""
    at = F.lit(as_of).cast("timestamp")
    x = df.agg(F.max(loaded_at).alias("max_loaded_at"))
    age = age_minutes(at, F.col("max_loaded_at"))
    return x.select("max_loaded_at", age.alias("age_minutes"),
                    F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
                    .when(age > error_after, F.lit("error"))
                    .when(age > warn_after, F.lit("warn"))
                    .otherwise(F.lit("pass")).alias("status"))


def freshness(bronze: DataFrame, as_of, horizon: str = FRESHNESS_HORIZON,
              stale_after: int = STALE_AFTER_MINUTES) -> DataFrame:
    """A03 + F09 + P23: newest bar, rows and symbols in the horizon before
    `as_of`; status fresh / stale / empty (one row).  In a layer by day only the
    folders the horizon reaches are opened."""
    at = F.lit(as_of).cast("timestamp")
    first = at - F.expr(f"INTERVAL {horizon}")
    recent = bronze.filter(F.col("timestamp") > first)
    if "date" in bronze.columns:
        recent = recent.filter(F.col("date") >= F.to_date(first))
    x = recent.agg(F.max("timestamp").alias("latest_timestamp"),
                   F.count(F.lit(1)).alias("record_count"),
                   F.count_distinct("symbol").alias("symbol_count"))
    age = age_minutes(at, F.col("latest_timestamp"))
    return x.select("latest_timestamp", "record_count", "symbol_count", age.alias("age_minutes"),
                    F.when(F.col("record_count") == 0, F.lit("empty"))
                    .when(age > stale_after, F.lit("stale"))
                    .otherwise(F.lit("fresh")).alias("status"))


def validate_batch(df: DataFrame, min_symbols: int = MIN_SYMBOLS,
                   min_rows: int = MIN_ROWS_DAILY) -> DataFrame:
    """A08 + A15: one-row batch report with a severity (error: too few
    symbols, warn: too few rows)."""
    x = df.agg(F.count(F.lit(1)).alias("total_records"),
               F.count_distinct("symbol").alias("symbols_found"),
               F.min("timestamp").alias("date_range_start"),
               F.max("timestamp").alias("date_range_end"),
               F.count_if(F.col("close").isNull()).alias("null_prices"),
               F.count_if(F.col("close") < 0).alias("negative_prices"))
    return x.withColumn("severity",
                        F.when(F.col("symbols_found") < min_symbols, F.lit("error"))
                        .when(F.col("total_records") < min_rows, F.lit("warn"))
                        .otherwise(F.lit("ok")))


def check_batch(report: DataFrame) -> DataFrame:
    """Raise on severity 'error' (the backfill's hard check); the one-row report
    is evaluated once and returned as a local table."""
    rows = report.collect()
    if rows and rows[0].severity == "error":
        raise ValueError(f"only {rows[0].symbols_found} symbols found")
    return report.sparkSession.createDataFrame(rows, report.schema)


CRITICAL_COLUMNS = ["timestamp", "symbol", "close", "volume"]


def batch_issues(df: DataFrame, critical: list[str] = CRITICAL_COLUMNS) -> DataFrame:
    """A09 + A10: null counts of the critical columns and the count of
    negative closes, one row per check; `is_issue` marks the warnings."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in critical],
                 F.count_if(F.col("close") < 0).alias("negative_close"))
    checks = F.array(*[F.struct(F.lit(f"nulls_{c}").alias("check"), F.col(f"nulls_{c}").alias("value"))
                       for c in critical],
                     F.struct(F.lit("negative_close").alias("check"), F.col("negative_close").alias("value")))
    return one.select(F.inline(checks)).withColumn("is_issue", F.col("value") > 0)


def coverage(bronze: DataFrame, source: str | None = None) -> DataFrame:
    """A04 (+F08): per symbol rows and time range, optionally for one source."""
    x = bronze if source is None else bronze.filter(F.col("source") == source)
    return (x.groupBy("symbol").agg(F.count(F.lit(1)).alias("record_count"),
                                    F.min("timestamp").alias("earliest"),
                                    F.max("timestamp").alias("latest"))
            .orderBy("symbol"))


def count_by(df: DataFrame, col: str, name: str = "total_records") -> DataFrame:
    """Rows per value."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name))


def gold_coverage(gold: DataFrame) -> DataFrame:
    """A06 for gold: daily rows and date range per symbol."""
    return (gold.groupBy("symbol").agg(F.count(F.lit(1)).alias("daily_records"),
                                       F.min("date").alias("earliest_date"),
                                       F.max("date").alias("latest_date"))
            .orderBy("symbol"))


def total_rows(df: DataFrame) -> DataFrame:
    """A07."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"))


def latest_bar_per_symbol(df: DataFrame) -> DataFrame:
    """A14."""
    return df.groupBy("symbol").agg(F.max("timestamp").alias("latest_timestamp"))
