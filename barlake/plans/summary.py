"""Counts kept up to date (A04-A07, A13-A15): a mergeable summary of a layer.

Beside a layer lies one row per (symbol, source, day): rows, first and last time.
Counts and ranges over the whole layer are sums, minima and maxima of that, so
they need no scan of the layer, and a load updates only the days it touched: the
rows of the touched (symbol, day) slices are counted anew and replace theirs, so
late rows, removed rows and emptied days are counted right, which adding up loads
would not do.  Distinct symbols of any set of days and sources come from sketches
(HyperLogLog), one per day and source, which merge; their standard error is
1.04 / sqrt(2^LG_K), and ERROR_BOUND is three of it.

Layout: ``<path>/counts`` and ``<path>/sketches``, both partitioned by day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.operators import writes
from barlake.operators.layers import read_stored
from barlake.session import scratch_path

LG_K = 12
ERROR_BOUND = 3 * 1.04 / 2 ** (LG_K / 2)


def counts_of(rows: DataFrame) -> DataFrame:
    """(symbol, source, day, n, first, last) of a layer's rows."""
    return rows.groupBy("symbol", "source", F.to_date("timestamp").alias("day")).agg(
        F.count("*").alias("n"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))


def sketches_of(counts: DataFrame) -> DataFrame:
    """(source, day, sketch): each day's symbols by source."""
    return counts.groupBy("source", "day").agg(F.hll_sketch_agg("symbol", F.lit(LG_K)).alias("sketch"))


def build(rows: DataFrame, path: str) -> None:
    """The summary of all of a layer's rows."""
    spark = rows.sparkSession
    writes.write_whole(counts_of(rows), f"{path}/counts", "day", ("symbol",))
    writes.write_whole(sketches_of(counts(spark, path)), f"{path}/sketches", "day", ("source",))


def refresh(spark: SparkSession, layer_path: str, path: str, slices: DataFrame) -> None:
    """Count the (symbol, day) `slices` of the layer (a folder by date) anew;
    only the folders of their days are read, in the layer and in the summary."""
    staged = scratch_path(spark, "summary-slices")
    slices.select("symbol", "day").distinct().write.parquet(staged)
    slices = spark.read.schema("symbol string, day date").parquet(staged)
    days = [r[0] for r in slices.select("day").distinct().collect()]          # bounded by the calendar
    if not days:
        return
    rows = read_stored(spark, layer_path, days).join(slices.withColumnRenamed("day", "date"), ["symbol", "date"], "left_semi")
    writes.replace_slices(spark, f"{path}/counts", counts_of(rows), slices, "day", ("symbol",))
    left = read_stored(spark, f"{path}/counts", days, "day")
    writes.replace_days(spark, f"{path}/sketches", sketches_of(left), days, "day", ("source",))


def counts(spark: SparkSession, path: str) -> DataFrame:
    return read_stored(spark, f"{path}/counts")


def coverage(summary: DataFrame, source: str | None = None) -> DataFrame:
    """A04 (+F08): per symbol rows and time range, optionally for one source."""
    x = summary if source is None else summary.filter(F.col("source") == source)
    return x.groupBy("symbol").agg(F.sum("n").alias("record_count"), F.min("first").alias("earliest"), F.max("last").alias("latest"))


def count_by(summary: DataFrame, col: str, name: str = "total_records") -> DataFrame:
    """Rows per symbol or source."""
    return summary.groupBy(col).agg(F.sum("n").alias(name))


def total_rows(summary: DataFrame) -> DataFrame:
    """A07."""
    return summary.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"))


def latest_bar_per_symbol(summary: DataFrame) -> DataFrame:
    """A14; the newest of all is A13."""
    return summary.groupBy("symbol").agg(F.max("last").alias("latest_timestamp"))


def approx_symbols(spark: SparkSession, path: str, by: str | None = None, days=None) -> DataFrame:
    """Estimated distinct symbols, per source with ``by='source'``, from the
    merged sketches of all or some days."""
    x = read_stored(spark, f"{path}/sketches", days, "day")
    grouped = x.groupBy(by) if by else x.groupBy()
    return grouped.agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("symbols_estimate"))
