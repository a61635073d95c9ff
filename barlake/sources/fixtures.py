"""Bronze-shaped bars derived from the `events` test table.

`raw_bars` is the fixture `raw` of FIXTURES.md: one bar per event, with
deterministic faults so every cleaning rule fires.  The same arithmetic is
written in DuckDB SQL for the oracle (`barlake.oracle`); constants are DOUBLE
in both engines so results agree to the bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.schema import SOURCE_DAILY, SOURCE_HOURLY, SOURCE_LIVE


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _unless(cond_values, otherwise):
    """first matching (condition, value) wins, else `otherwise`."""
    expr = None
    for cond, value in cond_values:
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr.otherwise(otherwise)


def raw_columns() -> dict[str, Column]:
    """Bronze columns from those of `events`."""
    eid = F.col("event_id")
    value = F.col("value")
    null = F.lit(None).cast("double")
    open_ = _unless([(eid % 17 == 0, null), (eid % 19 == 0, F.lit(-1.0))],
                    value * (F.lit(1.0) + ((eid % 7) - 3).cast("double") / F.lit(100.0)))
    high = _unless([(eid % 23 == 0, null)], value * F.lit(1.05))
    low = _unless([(eid % 29 == 0, null)], value * F.lit(0.95))
    close = _unless([(eid % 41 == 0, null), (eid % 43 == 0, F.lit(0.0))], value)
    volume = _unless([(eid % 31 == 0, null)], F.col("user_id").cast("double"))
    source = _unless([(eid % 3 == 0, F.lit(SOURCE_LIVE)), (eid % 3 == 1, F.lit(SOURCE_DAILY))],
                     F.lit(SOURCE_HOURLY))
    ts = F.col("ts").cast("timestamp")
    return {"id": eid + 1, "timestamp": F.date_trunc("hour", ts),
            "symbol": F.concat(F.upper("event_type"), F.lit("-USD")),
            "open": open_, "high": high, "low": low, "close": close, "volume": volume, "source": source,
            "ingestion_timestamp": ts}


def raw_bars(events: DataFrame) -> DataFrame:
    """events -> bronze rows (id, timestamp, symbol, open, high, low, close,
    volume, source, ingestion_timestamp)."""
    return events.select(*[c.alias(name) for name, c in raw_columns().items()])


def tick_bars(events: DataFrame) -> DataFrame:
    """events as price ticks: open = high = low = close = value, volume = 1."""
    v = F.col("value")
    return events.select(
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.concat(F.upper("event_type"), F.lit("-USD")).alias("symbol"),
        v.alias("open"), v.alias("high"), v.alias("low"), v.alias("close"),
        F.lit(1.0).alias("volume"),
    )


def raw_from_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_bars(load_table(spark, sf_dir, "events"))


def dirty_bars(raw: DataFrame) -> DataFrame:
    """raw bars, some of which break the bronze contract (long symbols, closes
    beyond the decimal, NaN)."""
    i = F.col("id")
    close = _unless([(i % 13 == 0, F.lit(1e13)), (i % 17 == 3, F.lit(float("nan")))], F.col("close"))
    return raw.withColumns({"symbol": F.when(i % 11 == 0, F.repeat("symbol", 5)).otherwise(F.col("symbol")), "close": close})


def wide_bars(events: DataFrame) -> DataFrame:
    """A fixture whose key space grows with the table: symbols by event type and
    user, bars by the minute, fractional volumes, and a later copy of every third
    bar from another source."""
    e = events.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("copy")).filter("copy = 0 or event_id % 3 = 0")
    bucket = F.col("user_id") % 40
    symbol = F.when((F.col("event_type") == "click") & (bucket == 0), F.lit("BTC-USD")).otherwise(
        F.concat(F.upper("event_type"), bucket.cast("string"), F.lit("-USD")))
    shifted = {
        "id": (F.col("event_id") + 1) * 2 + F.col("copy"), "symbol": symbol,
        "timestamp": F.date_trunc("minute", F.col("ts").cast("timestamp")),
        "source": F.when(F.col("copy") == 0, F.lit(SOURCE_LIVE)).otherwise(F.lit(SOURCE_HOURLY)),
        "ingestion_timestamp": F.col("ts").cast("timestamp") + F.make_dt_interval(hours=F.col("copy")),
    }
    columns = raw_columns()
    volume = columns["volume"] + (F.col("event_id") % 100).cast("double") / F.lit(100.0)
    return e.select(*[{**columns, **shifted, "volume": volume}[c].alias(c) for c in columns])


def upstream_bars(events: DataFrame) -> DataFrame:
    """The fixture bars in the upstream frame's shape (capitalised names,
    wall-clock bar time), as a fetch would land them."""
    r = raw_bars(events)
    return r.select(F.col("timestamp").cast("timestamp_ntz").alias("Datetime"),
                    F.col("open").alias("Open"), F.col("high").alias("High"),
                    F.col("low").alias("Low"), F.col("close").alias("Close"),
                    F.col("volume").alias("Volume"), "symbol")
