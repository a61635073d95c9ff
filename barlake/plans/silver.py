"""Silver: deduplicated, repaired, flagged bars with returns and spreads.

Plan shape (full build): scan -> dedup window on (timestamp, symbol) with a
partial top-1 before the shuffle -> validity filter -> one projection for
repairs and flags -> skew-safe LAG per symbol (`with_previous`, split by UTC
day) -> derived columns -> outlier filter.

Semantics kept on purpose:
* repairs and flags all read the *raw* columns (one `select`);
* only rows with a valid close (NOT NULL, > 0) take part in LAG;
* LAG runs before the outlier filter, so a row after a dropped outlier is
  compared with the outlier's close;
* |simple return| >= 100 % is dropped; the first row per symbol (NULL return)
  is kept.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.functions.columns import (
    flag_if, flag_null, log_return, pct, repaired_price, simple_return_pct,
)
from barlake.operators.dedup import dedup_latest
from barlake.operators.sequence import with_previous
from barlake.schema import OUTLIER_RETURN_PCT, SILVER_COLUMNS

STATE_COLUMNS = ["symbol", "timestamp", "close", "volume"]
# The per-symbol LAG is split by hour within days, so a hot symbol-day spreads over tasks.
LAG_SLICES = ("hour", "day")


def _stamp(updated_at) -> Column:
    return F.current_timestamp() if updated_at is None else F.lit(updated_at).cast("timestamp")


def since_high_water(bronze: DataFrame, high_water) -> DataFrame:
    """rows strictly after the target's global maximum time."""
    if high_water is None:
        return bronze
    hw = F.lit(high_water).cast("timestamp")
    out = bronze.filter(F.col("timestamp") > hw)
    if "date" in bronze.columns:        # date-partitioned bronze: prune folders too
        out = out.filter(F.col("date") >= F.to_date(hw))
    return out


def high_water(target: DataFrame) -> Column:
    """max(timestamp) of the target as a scalar subquery (runs first; its
    value then reaches the bronze scan as a runtime data filter)."""
    return target.agg(F.max("timestamp")).scalar()


def validated(bronze: DataFrame) -> DataFrame:
    """W01 + F02 + F03 + P10-P12: one row per (timestamp, symbol), valid close,
    repaired prices and quality flags - all from the raw values."""
    d = dedup_latest(bronze)
    o, h, l, c, v = (F.col(x) for x in ("open", "high", "low", "close", "volume"))
    return (d.filter(c.isNotNull() & (c > 0))
            .select("timestamp", "symbol",
                    repaired_price(o, c).alias("open"),
                    repaired_price(h, c).alias("high"),
                    repaired_price(l, c).alias("low"),
                    F.coalesce(c, o).alias("close"),
                    F.coalesce(v, F.lit(0.0)).alias("volume"),
                    "source", "ingestion_timestamp",
                    flag_null(o).alias("flag_missing_open"),
                    flag_null(h).alias("flag_missing_high"),
                    flag_null(l).alias("flag_missing_low"),
                    flag_null(c).alias("flag_missing_close"),
                    flag_if(v == 0).alias("flag_zero_volume")))


def with_returns(valid: DataFrame, initial_state: DataFrame | None = None,
                 lag_slices=LAG_SLICES) -> DataFrame:
    """P13-P17 + W03/W04 on validated rows (before the outlier filter).
    `lag_slices`: nested time units the per-symbol LAG is split by (finest
    first), e.g. ``("hour", "day")`` for tick-dense symbols."""
    x = with_previous(valid, ["symbol"], "timestamp",
                      {"close": "_prev_close", "volume": "prev_volume"},
                      initial=initial_state, slices=lag_slices)
    c, o, h, l, p = (F.col(n) for n in ("close", "open", "high", "low", "_prev_close"))
    return x.select(
        "*",
        (c - o).alias("intraperiod_change"),
        pct(c - o, o).alias("intraperiod_change_pct"),
        log_return(c, p).alias("log_return"),
        simple_return_pct(c, p).alias("simple_return_pct"),
        (h - l).alias("spread"),
        pct(h - l, l).alias("spread_pct"),
    ).drop("_prev_close")


def drop_outliers(df: DataFrame) -> DataFrame:
    """F04."""
    return df.filter(F.col("timestamp").isNotNull() & (F.col("close") > 0)
                     & (F.abs(F.coalesce(F.col("simple_return_pct"), F.lit(0.0))) < OUTLIER_RETURN_PCT))


def finish_silver(valid: DataFrame, updated_at: datetime | str | None = None,
                  initial_state: DataFrame | None = None, lag_slices=LAG_SLICES) -> DataFrame:
    """Validated rows -> silver rows (returns, spreads, outlier filter)."""
    out = drop_outliers(with_returns(valid, initial_state, lag_slices))
    return out.withColumn("updated_at", _stamp(updated_at)).select(*SILVER_COLUMNS)


def build_silver(bronze: DataFrame, updated_at: datetime | str | None = None,
                 high_water=None, initial_state: DataFrame | None = None,
                 lag_slices=LAG_SLICES) -> DataFrame:
    """Silver rows in the 22-column contract.

    * full refresh: `build_silver(bronze)`;
    * reference incremental: `high_water=<target max time>` - the boundary row
      per symbol gets NULL returns, as in the original model;
    * carried incremental: also pass `initial_state` (see `silver_state`) and
      the result equals a full refresh."""
    valid = validated(since_high_water(bronze, high_water))
    return finish_silver(valid, updated_at, initial_state, lag_slices)


def _last_by(rows: DataFrame, keys: list, order: str = "timestamp") -> DataFrame:
    """The latest (timestamp, close, volume) per key and the rows' number `n`: one hash aggregate."""
    return rows.groupBy(*keys).agg(F.max_by("timestamp", order).alias("_t"), F.max_by("close", order).alias("close"),
                                   F.max_by("volume", order).alias("volume"),
                                   F.count("*").alias("n")).withColumnRenamed("_t", "timestamp")


def day_summary(valid: DataFrame, counted: bool = False) -> DataFrame:
    """Per (symbol, UTC day): the day's last validated row - the seed any
    later rebuild of the following days needs (one row per symbol-day) - and,
    if `counted`, its number of rows."""
    rows = valid.select("symbol", F.to_date("timestamp").alias("day"), "timestamp", "close", "volume")
    return _last_by(rows, ["symbol", "day"]).select("symbol", "day", "timestamp", "close", "volume", *(["n"] if counted else []))


def seeds_before(days: DataFrame, first_day=None, counted: bool = False) -> DataFrame:
    """Carry seeds from a day summary: per symbol, the last validated row of
    its newest day before `first_day` (of all days when None) and, if `counted`
    (as the summary is), its rows in all (`total`) and on its largest day (`most`)."""
    d = days if first_day is None else days.filter(F.col("day") < F.to_date(F.lit(first_day)))
    sizes = [F.sum("n").alias("total"), F.max("n").alias("most")] if counted else []
    return (d.groupBy("symbol").agg(F.max_by("timestamp", "day").alias("timestamp"), F.max_by("close", "day").alias("close"),
                                    F.max_by("volume", "day").alias("volume"), *sizes))


def affected_slices(days: DataFrame, touched: DataFrame) -> DataFrame:
    """(symbol, day) slices whose silver rows may change with the `touched`
    ones: those themselves and, LAG having offset 1, each symbol's next slice
    in the day summary `days`.  Per symbol the input has one row per calendar
    day."""
    marks = (days.select("symbol", "day", F.lit(True).alias("stored"))
             .unionByName(touched.select("symbol", "day", F.lit(False).alias("stored"))))
    after = marks.withColumn("_n", F.datediff("day", F.lit("1970-01-01").cast("date")))
    after = after.withColumn("next", F.min(F.when(F.col("stored"), F.col("day"))).over(
        Window.partitionBy("symbol").orderBy("_n").rangeBetween(1, Window.unboundedFollowing)))
    nexts = after.filter(~F.col("stored") & F.col("next").isNotNull()).select("symbol", F.col("next").alias("day"))
    return touched.select("symbol", "day").unionByName(nexts).distinct()


def seeds_of_slices(days: DataFrame, slices: DataFrame) -> DataFrame:
    """Older rows the LAG of `slices` needs: for each, the symbol's last
    validated row of the day before it, unless that day is a slice itself."""
    marked = days.join(slices.select("symbol", "day", F.lit(True).alias("_in")), ["symbol", "day"], "left")
    following = F.lead("_in").over(Window.partitionBy("symbol").orderBy("day"))
    return marked.withColumn("_next", following).filter("_next and _in is null").select(*STATE_COLUMNS)


def silver_state(bronze: DataFrame, high_water=None,
                 previous_state: DataFrame | None = None) -> DataFrame:
    """Carry state for the next incremental run: per symbol, the last
    *validated* row (before the outlier filter) - one row per symbol."""
    v = validated(since_high_water(bronze, high_water)).select(*STATE_COLUMNS)
    if previous_state is not None:
        v = v.unionByName(previous_state.select(*STATE_COLUMNS))
    return _last_by(v, ["symbol"]).select(*STATE_COLUMNS)


def upsert_by_key(target: DataFrame, new: DataFrame, keys=("timestamp", "symbol")) -> DataFrame:
    """K05 + K06: delete target rows that share a key with `new`, then append
    `new`; columns missing on either side are NULL."""
    keys = list(keys)
    kept = target.join(new.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def late_rows(bronze: DataFrame, target: DataFrame) -> DataFrame:
    """Incoming rows at or before the target's global high-water mark -
    the rows a reference-mode incremental run silently drops."""
    return bronze.filter(F.col("timestamp") <= high_water(target))
