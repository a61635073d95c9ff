"""Table writes and contracts.

Plain Parquet folders (no table-format jar is assumed).  Every write is a
single set-based Spark job; no row-at-a-time inserts and no driver loops.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.operators.layers import read_stored, record_schema, storage, stored_days
from barlake.schema import (
    BRONZE_KEY, CORRUPT, PRICE_DECIMAL, SOURCE_MAX_LEN, SYMBOL_MAX_LEN, VOLUME_DECIMAL,
)


def _all_not_null(cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def arrival_order(batch: DataFrame) -> list[Column]:
    """Load time, then the given id if rows have one, then the bar's own values:
    an order that no partitioning changes."""
    cols = ("ingestion_timestamp", "id", "open", "high", "low", "close", "volume")
    return [F.col(c).asc_nulls_last() for c in cols if c in batch.columns]


def first_arrivals(batch: DataFrame, keys: Sequence[str] = BRONZE_KEY,
                   arrival: Sequence[Column] | None = None) -> DataFrame:
    """In-batch part of K01: per key the first row in arrival order wins.  A
    NULL in any key part never conflicts (SQL UNIQUE), so such rows all stay:
    they get a unique extra window key, in the same single pass (a hot group
    of copies is cut to one row per map task by the partial top-1)."""
    keys = list(keys)
    arrival = list(arrival) if arrival is not None else arrival_order(batch)
    lone = F.when(~_all_not_null(keys), F.monotonically_increasing_id())
    w = Window.partitionBy(*keys, "_lone").orderBy(*arrival)
    return (batch.withColumn("_lone", lone).withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") == 1).drop("_rn", "_lone"))


def within_dates_of(target: DataFrame, batch: DataFrame, ts: str = "timestamp",
                    partition_col: str = "date") -> DataFrame:
    """Target rows that can share a key with `batch`: those of the dates the
    batch holds.  The list of dates is bounded by the calendar; it becomes a
    partition filter, so one old bar beside a new one reads two folders, not
    the range between them."""
    dates = [r[0] for r in batch.select(F.to_date(ts)).distinct().collect() if r[0] is not None]
    col = F.col(partition_col) if partition_col in target.columns else F.to_date(ts)
    return target.filter(col.isin(dates)) if dates else target.limit(0)


def insert_if_absent(batch: DataFrame, target: DataFrame | None, keys: Sequence[str] = BRONZE_KEY,
                     arrival: Sequence[Column] | None = None) -> DataFrame:
    """K01 + J02: the rows of `batch` to append - first arrival per key, and
    only keys the target does not hold yet (left-anti join; NULL keys never
    match).  Appending the result is idempotent: a second run adds nothing."""
    new = first_arrivals(batch, keys, arrival)
    if target is None:
        return new
    existing = within_dates_of(target, batch).select(*keys)
    return new.join(existing, list(keys), "left_anti")


def load_stats(total: DataFrame, inserted: DataFrame, bad: DataFrame | None = None) -> DataFrame:
    """One row inserted / duplicates / failed / total (true counts) - one
    aggregate over the tagged union, no join.  `total` is the whole batch,
    `inserted` what was appended of its good rows, `bad` its bad rows, so the
    four numbers add up."""
    tag = F.col("_part")
    parts = total.select(F.lit("total").alias("_part")).unionByName(
        inserted.select(F.lit("inserted").alias("_part")))
    if bad is not None:
        parts = parts.unionByName(bad.select(F.lit("failed").alias("_part")))
    x = parts.agg(*[F.count_if(tag == k).alias(k) for k in ("inserted", "failed", "total")])
    return x.select("inserted", (F.col("total") - F.col("inserted") - F.col("failed")).alias("duplicates"),
                    "failed", "total")


def bad_record_reason(df: DataFrame) -> Column:
    """First violated rule of the bronze contract, or NULL."""
    def overflow(c: str, dt: T.DecimalType) -> Column:
        return F.col(c).isNotNull() & F.col(c).try_cast(dt).isNull()
    corrupt = [(F.col(CORRUPT).isNotNull(), "corrupt record")] if CORRUPT in df.columns else []
    rules = [
        *corrupt,
        (F.col("timestamp").isNull(), "timestamp is null"),
        (F.col("symbol").isNull(), "symbol is null"),
        (F.length("symbol") > SYMBOL_MAX_LEN, "symbol too long"),
        (F.length("source") > SOURCE_MAX_LEN, "source too long"),
        *[(F.isnan(F.col(c)), f"{c} is NaN") for c in ("open", "high", "low", "close", "volume")],
        *[(overflow(c, PRICE_DECIMAL), f"{c} overflows decimal(20,8)") for c in ("open", "high", "low", "close")],
        (overflow("volume", VOLUME_DECIMAL), "volume overflows decimal(20,2)"),
    ]
    expr = None
    for cond, reason in rules:
        expr = F.when(cond, F.lit(reason)) if expr is None else expr.when(cond, F.lit(reason))
    return expr


def split_bad_records(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad) - bad rows carry a `reason` and go to quarantine."""
    tagged = batch.withColumn("reason", bad_record_reason(batch))
    return (tagged.filter(F.col("reason").isNull()).drop("reason"),
            tagged.filter(F.col("reason").isNotNull()))


def cast_bars(df: DataFrame) -> DataFrame:
    """decimal(20,8) prices, decimal(20,2) volume (ANSI cast raises on
    overflow; run `split_bad_records` first)."""
    out = df
    for c in ("open", "high", "low", "close"):
        out = out.withColumn(c, F.col(c).cast(PRICE_DECIMAL))
    return out.withColumn("volume", F.col("volume").cast(VOLUME_DECIMAL))


def with_ids(df: DataFrame, start: int = 1) -> DataFrame:
    """Unique, increasing-by-partition surrogate ids without a shuffle or
    a single-task row_number (gaps allowed, as with a sequence).  Write the
    result before using it twice: a second evaluation may number differently."""
    return df.withColumn("id", F.monotonically_increasing_id() + F.lit(start))


def next_id(spark: SparkSession, path: str) -> int:
    """First id the next load of the bronze folder may use: from the log of
    loads (one row each), or from the table where it has no log."""
    log = read_stored(spark, f"{path.rstrip('/')}_loads")
    source = (log, "high_id") if log is not None else (read_stored(spark, path), "id")
    if source[0] is None or source[1] not in source[0].columns:
        return 1
    return (source[0].agg(F.max(source[1])).first()[0] or 0) + 1


def load_bronze(spark: SparkSession, batch: DataFrame, path: str, keys: Sequence[str] = BRONZE_KEY,
                load_id: str | None = None) -> dict[str, DataFrame]:
    """The one load of bronze, for batches and streams (K01, K02, K03, P09):

    1. the batch is evaluated once, into a staged table with each row's fault;
    2. faulty rows go to ``<path>_quarantine`` (partition ``load``) with their reason;
    3. of the good rows the first arrival of each key that the target does not
       hold is staged with its id, and the ids are booked in ``<path>_loads``;
    4. the staged rows are appended (partitioned by date, sorted by symbol and
       time - K10).

    A repeated load with one `load_id` replaces its quarantine rows and appends
    nothing twice.  Ids of rows that already have one are kept.  Returns the
    stats row, the appended rows, the quarantined rows and the touched
    (symbol, day) pairs."""
    from barlake.session import scratch_path
    path = path.rstrip("/")
    load_id = load_id or uuid.uuid4().hex[:12]
    staged = _stage(spark, batch.withColumn("reason", bad_record_reason(batch)), scratch_path(spark, "load-batch"))
    good = staged.filter(F.col("reason").isNull()).drop("reason", *([CORRUPT] if CORRUPT in staged.columns else []))
    bad = staged.filter(F.col("reason").isNotNull())
    target = read_stored(spark, path)
    rows = insert_if_absent(good, target, keys)
    if "id" not in rows.columns:
        rows = with_ids(rows, next_id(spark, path))
    new = _stage(spark, rows, scratch_path(spark, "load-rows"))
    stats = load_stats(staged, new, bad)
    (new.agg(F.min("id").alias("low_id"), F.max("id").alias("high_id")).filter("high_id is not null")
        .select(F.lit(load_id).alias("load"), "low_id", "high_id")
        .write.mode("append").parquet(f"{path}_loads"))             # booked before any row can be seen
    (bad.withColumn("load", F.lit(load_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("load").parquet(f"{path}_quarantine"))
    write_layer(new.withColumn("date", F.to_date("timestamp")), path, mode="append")
    touched = new.select("symbol", F.to_date("timestamp").alias("day")).distinct()
    return {"stats": stats, "inserted": new, "quarantined": bad, "touched": touched}


def _stage(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)       # schema given: an empty stage reads fine


def append_bronze(spark: SparkSession, batch: DataFrame, path: str,
                  keys: Sequence[str] = BRONZE_KEY) -> DataFrame:
    """`load_bronze`, returning the stats row only."""
    return load_bronze(spark, batch, path, keys)["stats"]


def write_layer(df: DataFrame, path: str, mode: str = "overwrite", partition_by: str = "date",
                sort_by: Sequence[str] = ("symbol", "timestamp")) -> None:
    """Write a layer folder partitioned by date (see `clustered`) and
    advance its record of columns (`layers`).  With mode 'overwrite' only the
    touched date partitions are replaced (dynamic partition overwrite)."""
    record_schema(df.sparkSession, path, df.schema)
    (clustered(df, partition_by, sort_by)
     .write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path))


def write_whole(df: DataFrame, path: str, partition_by: str = "date",
                sort_by: Sequence[str] = ("symbol", "timestamp")) -> None:
    """Replace a layer day by day: each folder is overwritten, then those of days
    that are no more are dropped, so a run that fails leaves every day either old
    or new, and can be repeated.  The days written are observed by the write."""
    spark, seen = df.sparkSession, Observation()
    before = stored_days(spark, path, partition_by)
    record_schema(spark, path, df.schema, replace=True)
    (clustered(df.observe(seen, F.collect_set(partition_by).alias("days")), partition_by, sort_by)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path))
    left = set(seen.get.get("days") or [])          # bounded by the calendar
    drop_partitions(spark, path, partition_by, [d for d in before if d not in left])


def replace_slices(spark: SparkSession, path: str, fresh: DataFrame, slices: DataFrame,
                   partition_col: str = "date", sort_by: Sequence[str] = ("symbol", "timestamp")) -> None:
    """Replace the (symbol, day) `slices` of a folder partitioned by day with
    the rows `fresh`: only the folders of those days are listed, read and written,
    the rest of their rows is kept, and a day that ends up empty loses its folder.
    The number of days is bounded by the calendar."""
    days = [r[0] for r in slices.select("day").distinct().collect()]
    if not days:
        return
    record_schema(spark, path, fresh.schema)
    old = read_stored(spark, path, days, partition_col)
    if old is not None:
        gone = slices.select(F.col("day").alias(partition_col), "symbol")
        fresh = old.join(gone, [partition_col, "symbol"], "left_anti").unionByName(fresh, allowMissingColumns=True)
    replace_days(spark, path, fresh, days, partition_col, sort_by)


def replace_days(spark: SparkSession, path: str, fresh: DataFrame, days: Sequence, partition_col: str = "date",
                 sort_by: Sequence[str] = ("symbol", "timestamp")) -> None:
    """Replace whole `days` of a layer; a day without rows loses its folder.  One
    job, whose rows may come from the folders it replaces: a dynamic overwrite
    writes beside the layer and moves the finished folders in after its last task.
    The days written are observed by the write."""
    seen = Observation()
    write_layer(fresh.observe(seen, F.collect_set(partition_col).alias("days")), path, partition_by=partition_col, sort_by=sort_by)
    left = set(seen.get.get("days") or [])
    drop_partitions(spark, path, partition_col, [d for d in days if d not in left])


def drop_partitions(spark: SparkSession, path: str, partition_col: str, values: Sequence) -> None:
    """Remove partition folders through the storage's own file system."""
    for v in values:
        fs, folder = storage(spark, f"{path.rstrip('/')}/{partition_col}={v}")
        fs.delete(folder, True)


def clustered(df: DataFrame, partition_by: str = "date",
              sort_by: Sequence[str] = ("symbol", "timestamp")) -> DataFrame:
    """Layout for a partitioned write: the REBALANCE hint clusters rows by
    the partition column but lets AQE split a hot partition and merge small
    ones into advisory-sized tasks (a plain repartition by date would send a
    whole day - or a hot third of the data - to one task); rows are then
    sorted by symbol and time for Parquet min/max skipping."""
    sort_cols = [c for c in sort_by if c in df.columns]
    return df.hint("rebalance", partition_by).sortWithinPartitions(partition_by, *sort_cols)


def create_layers(spark: SparkSession, root: str, layers: Sequence[str] = ("bronze", "silver", "gold")) -> list[str]:
    """Make the layer folders under one root, on whatever storage it names;
    those that exist stay as they are."""
    paths = [f"{root.rstrip('/')}/{layer}" for layer in layers]
    for path in paths:
        fs, folder = storage(spark, path)
        fs.mkdirs(folder)
    return paths


def stage_records(df: DataFrame) -> DataFrame:
    """K08 + P05: rows -> JSON records with ISO-8601 timestamps."""
    return df.select(F.to_json(F.struct(*df.columns),
                               {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}).alias("record"))


def unstage_records(records: DataFrame, schema: T.StructType) -> DataFrame:
    """JSON records -> typed rows."""
    return (records.select(F.from_json("record", schema,
                                       {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}).alias("r"))
            .select("r.*"))
