"""Gold: daily bars per symbol with daily metrics.

Plan shape: silver scan (pruned to 8 columns) -> hash aggregate by (date,
symbol) with a partial map-side step -> LAG of close per symbol by date ->
rounded metrics.  The LAG window is per symbol, but its input has one row per
symbol and calendar day, so a group holds at most the number of days in the
data (a calendar bound, not a data-volume bound).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.functions.columns import log_return, pct, round_half_up, simple_return_pct
from barlake.operators.bars import daily_bars
from barlake.operators.sequence import with_previous_plain
from barlake.schema import GOLD_COLUMNS


def daily_metrics(daily: DataFrame, prior_close: DataFrame | None = None) -> DataFrame:
    """P13/P14/P18 + W05 + P16/P17 on daily bars.  `prior_close` (symbol,
    date, close - days that are not in `daily`) seeds the previous close when
    only some days are rebuilt."""
    x = daily.withColumn("_seed", F.lit(False))
    if prior_close is not None:
        x = x.unionByName(prior_close.select("symbol", "date", "close").withColumn("_seed", F.lit(True)),
                          allowMissingColumns=True)
    x = (with_previous_plain(x, ["symbol"], "date", {"close": "_prev_close"})
         .filter(~F.col("_seed")))
    c, o, h, l, p = (F.col(n) for n in ("close", "open", "high", "low", "_prev_close"))
    return x.select(
        "date", "symbol", "open", "high", "low", "close", "volume",
        (c - o).alias("price_change"),
        round_half_up(pct(c - o, o), 2).alias("price_change_pct"),
        (h - l).alias("daily_spread"),
        round_half_up(pct(h - l, l), 2).alias("spread_pct"),
        round_half_up(simple_return_pct(c, p), 2).alias("daily_return_pct"),
        round_half_up(log_return(c, p), 4).alias("log_return"),
        "data_points", "first_timestamp", "last_timestamp",
    )


def build_gold(silver: DataFrame, updated_at: datetime | str | None = None) -> DataFrame:
    stamp = F.current_timestamp() if updated_at is None else F.lit(updated_at).cast("timestamp")
    return daily_metrics(daily_bars(silver)).withColumn("updated_at", stamp).select(*GOLD_COLUMNS)


def last_close_before(gold: DataFrame, since) -> DataFrame:
    """Per symbol, the newest gold day before `since` (one row per symbol)."""
    older = gold.filter(F.col("date") < F.to_date(F.lit(since)))
    return (older.groupBy("symbol")
            .agg(F.max_by(F.struct("date", "close"), F.col("date")).alias("p"))
            .select("symbol", "p.date", "p.close"))


def build_gold_since(silver: DataFrame, gold: DataFrame, since,
                     updated_at: datetime | str | None = None) -> DataFrame:
    """Gold rows for days >= `since` only, equal to the same rows of a full
    build: the aggregate reads only silver days >= `since`, and the daily
    LAG is seeded with each symbol's last earlier close from existing gold."""
    stamp = F.current_timestamp() if updated_at is None else F.lit(updated_at).cast("timestamp")
    first_day = F.to_date(F.lit(since))          # whole days, even for a mid-day `since`
    recent = silver.filter(F.to_date("timestamp") >= first_day)
    if "date" in silver.columns:
        recent = recent.filter(F.col("date") >= first_day)
    return (daily_metrics(daily_bars(recent), last_close_before(gold, since))
            .withColumn("updated_at", stamp).select(*GOLD_COLUMNS))
