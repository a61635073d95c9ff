"""OHLCV roll-ups.

First and last prices of a period are `min_by` / `max_by` over the bar time:
one hash aggregate with a partial (map-side) step and no window sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.schema import VOLUME_DECIMAL


def _ohlcv_aggs(ts: str = "timestamp") -> list[Column]:
    t = F.col(ts)
    return [
        F.min_by("open", t).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", t).alias("close"),
        # in the contract's decimal: exact, so the same in any order of addition
        F.sum(F.col("volume").cast(VOLUME_DECIMAL)).cast("double").alias("volume"),
        F.count(F.lit(1)).alias("data_points"),
        F.min(t).alias("first_timestamp"),
        F.max(t).alias("last_timestamp"),
    ]


def daily_bars(bars: DataFrame, ts: str = "timestamp") -> DataFrame:
    """One bar per (UTC date, symbol)."""
    return bars.groupBy(F.to_date(F.col(ts)).alias("date"), "symbol").agg(*_ohlcv_aggs(ts))


def resample(bars: DataFrame, interval: str, ts: str = "timestamp") -> DataFrame:
    """Bars of any fixed interval ('15 minutes', '1 hour', '4 hours', '1 day'),
    aligned to the epoch (UTC).  `bar_start` is the period start."""
    w = F.window(F.col(ts), interval)
    return (bars.groupBy(w.start.alias("bar_start"), "symbol").agg(*_ohlcv_aggs(ts)))


def first_last_by_window(bars: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Daily open and close as window values over the day, kept as a
    cross-check of `daily_bars` (a sort per day; not used in the pipeline)."""
    day = F.to_date(F.col(ts))
    whole = Window.partitionBy("date", "symbol").orderBy(ts).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (bars.withColumn("date", day)
            .select("date", "symbol", F.first_value("open").over(whole).alias("open"),
                    F.last_value("close").over(whole).alias("close"))
            .distinct())
