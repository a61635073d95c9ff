"""Access by symbol (K10): a layer laid out by symbol bucket and month.

The layers are folders by day: a load touches few of them, but one symbol's
history opens every one.  This copy of a layer serves the other access path, as an
index on (symbol, timestamp) does.  Its folders are ``bucket=<b>/month=<first
day>``: a symbol lies in one bucket (a hash of its name, the number of buckets is
kept in the layer's record), so its history lists and opens the months of one
bucket folder, and a period of it only those of the period.  Inside, files are
sorted by symbol and time, so Parquet statistics skip the bucket's other symbols.
A hot bucket is split into several files by AQE (`writes.clustered`).

A refresh after a load rewrites only the (bucket, month) folders of the touched
(symbol, day) slices.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.operators import writes
from barlake.operators.layers import folder_names, layer_record, read_stored, record_schema
from barlake.session import scratch_path
from barlake.sources.landing import time_range

BUCKETS = 64
KEYS = ("bucket", "month")


def bucket_of(symbol: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(symbol), F.lit(buckets)).cast("int")


def _placed(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.drop("date").withColumns({
        "bucket": bucket_of(F.col("symbol"), buckets), "month": F.to_date(F.date_trunc("month", "timestamp"))})


def _write(rows: DataFrame, path: str) -> None:
    (rows.hint("rebalance", *KEYS).sortWithinPartitions(*KEYS, "symbol", "timestamp").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*KEYS).parquet(path))


def buckets_of(spark: SparkSession, path: str) -> int:
    return layer_record(spark, path)[1]["bucket"].metadata["buckets"]


def build(spark: SparkSession, rows: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Lay out all `rows` (a layer with symbol and timestamp) at a new `path`."""
    placed = _placed(rows, buckets)
    fields = [T.StructField(f.name, f.dataType, True, {"buckets": buckets} if f.name == "bucket" else f.metadata)
              for f in placed.schema.fields]
    record_schema(spark, path, T.StructType(fields), replace=True)
    _write(placed, path)


def _read(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    schema = layer_record(spark, path)[1]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{f}" for f in folders])


def _months(spark: SparkSession, path: str, bucket: int, start=None, end=None) -> list[str]:
    """The bucket's month folders that can hold times in [start, end)."""
    day = lambda t: t.date() if isinstance(t, datetime) else t if isinstance(t, date) else date.fromisoformat(str(t)[:10])
    first = None if start is None else day(start).replace(day=1)
    names = [n for n in folder_names(spark, f"{path}/bucket={bucket}") if n.startswith("month=")]
    keep = lambda m: (first is None or m >= first) and (end is None or m <= day(end))
    return [f"bucket={bucket}/{n}" for n in names if keep(date.fromisoformat(n[6:]))]


def refresh(spark: SparkSession, layer_path: str, path: str, slices: DataFrame) -> None:
    """Bring the copy up to date with the layer (a folder by day) for the
    (symbol, day) `slices` that changed; other folders are neither read nor
    written, and one that ends up empty is dropped."""
    path, n = path.rstrip("/"), buckets_of(spark, path)
    staged = scratch_path(spark, "index-slices")
    (slices.select("symbol", "day").distinct().withColumns({
        "bucket": bucket_of(F.col("symbol"), n), "month": F.to_date(F.date_trunc("month", "day"))}).write.parquet(staged))
    slices = spark.read.schema("symbol string, day date, bucket int, month date").parquet(staged)
    touched = [(r[0], r[1]) for r in slices.select(*KEYS).distinct().collect()]      # buckets x months
    if not touched:
        return
    days = [r[0] for r in slices.select("day").distinct().collect()]                 # calendar-bounded
    fresh = _placed(read_stored(spark, layer_path, days).join(
        slices.select("symbol", F.col("day").alias("date")), ["symbol", "date"], "left_semi"), n)
    there = {b: set(folder_names(spark, f"{path}/bucket={b}")) for b in {b for b, _ in touched}}
    old = _read(spark, path, [f"bucket={b}/month={m}" for b, m in touched if f"month={m}" in there[b]])
    kept = (old.withColumn("day", F.to_date("timestamp")).join(slices.select("symbol", "day"), ["symbol", "day"], "left_anti")
            .drop("day"))
    staged = scratch_path(spark, "index-rows")
    merged = kept.unionByName(fresh, allowMissingColumns=True)
    merged.write.parquet(staged)
    merged = spark.read.schema(merged.schema).parquet(staged)
    record_schema(spark, path, merged.schema)
    left = {(r[0], r[1]) for r in merged.select(*KEYS).distinct().collect()}
    if left:
        _write(merged, path)
    for b, m in touched:
        if (b, m) not in left:
            writes.drop_partitions(spark, f"{path}/bucket={b}", "month", [m])


def read_symbols(spark: SparkSession, path: str, symbols: Iterable[str], start=None, end=None) -> DataFrame:
    """Rows of some symbols, optionally in [start, end): only the folders of their
    buckets and months are listed."""
    path, symbols = path.rstrip("/"), list(symbols)
    names = spark.createDataFrame([(s,) for s in symbols], "symbol string")
    buckets = sorted({r[0] for r in names.select(bucket_of(F.col("symbol"), buckets_of(spark, path))).collect()})
    folders = [f for b in buckets for f in _months(spark, path, b, start, end)]
    rows = _read(spark, path, folders).filter(F.col("symbol").isin(symbols))
    return time_range(rows, start, end).drop(*KEYS)
