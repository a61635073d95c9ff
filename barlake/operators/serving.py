"""Serving queries over gold (J01, F05-F11, A11-A13, W06, O02-O06, U02,
P24-P27, C06).

Every function returns a lazy DataFrame; nothing is pulled to the driver.
The clock is an argument (`as_of`), never read implicitly.  Client-side
pandas steps of the original dashboard (normalisation, period statistics,
summary) run inside the plan, so only the final small result leaves the
cluster.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.functions.columns import (
    candle_direction, money, percent_text, round_half_up, short_symbol,
)
from barlake.schema import DEFAULT_TIMEFRAME_DAYS, TIMEFRAME_DAYS

STAT_DIGITS = 8   # rounding of averages / deviations (order-dependent sums)


def filter_symbols(df: DataFrame, selection: Iterable[str] | DataFrame | None) -> DataFrame:
    """restrict to the selected symbols; 'All' (or None) = no restriction.
    A selection DataFrame is applied as a left-semi join."""
    if selection is None:
        return df
    if isinstance(selection, DataFrame):
        return df.join(selection.select("symbol").distinct(), "symbol", "left_semi")
    sel = list(selection)
    if "All" in sel:
        return df
    return df.filter(F.col("symbol").isin(sel))


def lookback_days(timeframe: str | int | None) -> int | None:
    """preset name or day count; 'ALL' is unbounded here (None)."""
    if timeframe is None:
        return DEFAULT_TIMEFRAME_DAYS
    if isinstance(timeframe, int):
        return timeframe
    if timeframe == "ALL":
        return None
    return TIMEFRAME_DAYS[timeframe]


def since_days(df: DataFrame, days: int | None, as_of: date | datetime | str) -> DataFrame:
    """F05 lookback: date >= as_of_date - days (inclusive: days + 1 dates)."""
    if days is None:
        return df
    return df.filter(F.col("date") >= F.date_sub(F.to_date(F.lit(as_of)), days))


def latest_date(gold: DataFrame) -> Column:
    """A13 as a scalar subquery."""
    return gold.agg(F.max("date")).scalar()


def latest_prices(gold: DataFrame) -> DataFrame:
    """J01 + F07 + O03: rows of the newest date over all symbols.  The newest
    date is a scalar subquery (one value), evaluated first and then used as a
    plain filter, so a date-partitioned gold table is pruned to one folder."""
    g = gold.filter(F.col("date") == latest_date(gold))
    return (g.select("date", "symbol", F.col("close").alias("price"), "daily_return_pct",
                     "volume", "open", "high", "low")
            .orderBy("symbol"))


def latest_price_table(latest: DataFrame) -> DataFrame:
    """P24 + P27: the display table of latest prices."""
    return latest.select(
        F.col("symbol").alias("Symbol"),
        money("price").alias("Price"),
        percent_text("daily_return_pct").alias("Daily Return"),
        money("open").alias("Open"), money("high").alias("High"), money("low").alias("Low"),
        money("volume", 0).alias("Volume"))


def price_cards(latest: DataFrame) -> DataFrame:
    """P25 + P26: metric cards: short label, price, delta and its colour."""
    return latest.select(
        short_symbol("symbol").alias("label"),
        money("price").alias("value"),
        percent_text("daily_return_pct").alias("delta"),
        F.when(F.col("daily_return_pct") >= 0, F.lit("normal")).otherwise(F.lit("inverse")).alias("delta_color"))


def price_history(gold: DataFrame, symbol: str, timeframe: str | int | None, as_of) -> DataFrame:
    """F05 + F11 + O03: one symbol's daily rows in the lookback, by date."""
    g = since_days(gold.filter(F.col("symbol") == symbol), lookback_days(timeframe), as_of)
    return (g.select("date", "symbol", "open", "high", "low", "close", "volume",
                     "daily_return_pct", "price_change_pct")
            .orderBy("date"))


def candles(gold: DataFrame, symbol: str, timeframe: str | int | None, as_of) -> DataFrame:
    """C06 + P26: chart-ready candles with their direction."""
    h = price_history(gold, symbol, timeframe, as_of)
    return h.select("date", "open", "high", "low", "close", "volume",
                    candle_direction("open", "close").alias("direction")).orderBy("date")


def compare_symbols(gold: DataFrame, symbols, days: int, as_of) -> DataFrame:
    """F06 + O03: several symbols' closes and returns in the lookback."""
    g = since_days(filter_symbols(gold, symbols), days, as_of)
    return g.select("date", "symbol", "close", "daily_return_pct").orderBy("date", "symbol")


def normalized_performance(compared: DataFrame) -> DataFrame:
    """(close / first close in the window - 1) * 100 per symbol.  The
    window holds one row per symbol and day of the lookback."""
    first = F.first("close").over(Window.partitionBy("symbol").orderBy("date")
                                  .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return compared.select("date", "symbol", "close",
                           ((F.col("close") / first - 1) * 100).alias("pct_change"))


def _period_aggs() -> list[Column]:
    first_close = F.min_by("close", "date")
    last_close = F.max_by("close", "date")
    return [
        first_close.alias("start_price"),
        last_close.alias("end_price"),
        ((last_close / first_close - 1) * 100).alias("total_return_pct"),
        round_half_up(F.avg("daily_return_pct"), STAT_DIGITS).alias("avg_daily_return_pct"),
        round_half_up(F.stddev_samp("daily_return_pct"), STAT_DIGITS).alias("volatility_pct"),
    ]


def period_stats(history: DataFrame) -> DataFrame:
    """Period high / low, mean and sample std of the daily return (NULLs
    skipped; one row gives NULL std), total return - one row."""
    return history.agg(F.max("high").alias("period_high"), F.min("low").alias("period_low"),
                       *_period_aggs())


def performance_summary(compared: DataFrame) -> DataFrame:
    """Per symbol start / end price, total return, average daily return
    and volatility; symbols without rows are absent."""
    return (compared.groupBy("symbol").agg(*_period_aggs())
            .select(short_symbol("symbol").alias("symbol"), "start_price", "end_price",
                    "total_return_pct", "avg_daily_return_pct", "volatility_pct")
            .orderBy("symbol"))


def distinct_symbols(df: DataFrame) -> DataFrame:
    """U02."""
    return df.select("symbol").distinct().orderBy("symbol")


def default_selection(gold: DataFrame, n: int = 3) -> DataFrame:
    """The first n symbols of the latest-prices list."""
    return latest_prices(gold).select("symbol").orderBy("symbol").limit(n)


def latest_rows(gold: DataFrame, n: int = 20) -> DataFrame:
    """Newest n gold rows (date desc, symbol) - a top-k, planned as
    TakeOrderedAndProject (each task keeps n rows)."""
    return (gold.select("date", "symbol", "open", "high", "low", "close", "volume", "daily_return_pct")
            .orderBy(F.col("date").desc(), F.col("symbol").asc()).limit(n))


def head_per_symbol(df: DataFrame, n: int = 3, order: list[str] = ("timestamp", "id")) -> DataFrame:
    """First n rows of every symbol (a per-group top-k: partial
    WindowGroupLimit before the shuffle)."""
    w = Window.partitionBy("symbol").orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def sample_rows(df: DataFrame, n: int = 5, seed: int = 42, key: str = "id") -> DataFrame:
    """N pseudo-random rows, the first by a hash of seed and key - the same
    rows whatever the partitioning (each task keeps its n best)."""
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"))
    return df.orderBy(order, key).limit(n)
