"""Streaming jobs.

The original system polls hourly and loads with conflict-ignoring inserts;
its silver model is an incremental table.  Here:

* R01 `run_bronze_stream`: file stream of landed bars -> `foreachBatch`
  conflict-ignoring append (K01).  Re-running a micro-batch after a failure
  appends nothing twice: the anti-join sees what the first attempt committed.
* R05 `dedup_stream`: first-wins dedup on the bronze key inside a watermark
  (state bounded by the watermark).
* R02 `run_silver_stream`: bronze file stream -> `foreachBatch` running the
  incremental silver job.  LAG is not allowed on a stream, so each batch is
  seeded from the job's per-day state (each symbol's last validated row);
  results equal a full refresh when bars arrive in time order (carry), or
  always (recompute, which also applies late rows).
* R04 change feed: with ``changes_path`` the silver stream also writes, for each
  batch, an epoch of changes - for every (symbol, day) slice whose silver rows may
  have changed a retraction of what was there, and its rows as they are now.
  `run_gold_stream` follows the feed and keeps gold equal to a batch build, late
  rows and emptied days included: of each slice the newest epoch counts, and the
  epoch applied to a slice is kept, so batches may be repeated and old epochs come
  again.
* R03 `run_daily_bars_stream`: silver file stream -> event-time watermark ->
  1-day tumbling window per symbol -> each micro-batch replaces the bars it
  changed, the open day's included.  A file stream sees every rewritten file as new,
  so R03 must read an append-only feed of silver rows, not the merged silver
  layer (whose partitions the batch jobs rewrite); for the layer itself use
  `plans.jobs.refresh_gold_slices`.

All checkpoints and state live under the cluster's shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.operators import writes
from barlake.operators.bars import _ohlcv_aggs, daily_bars
from barlake.operators.layers import folder_names, layer_record, read_stored, record_schema, storage
from barlake.schema import BRONZE_KEY
from barlake.session import scratch_path


def _run(writer, trigger_available_now: bool = True, timeout_s: int | None = None) -> None:
    q = (writer.trigger(availableNow=True) if trigger_available_now else writer).start()
    q.awaitTermination(timeout_s)
    if q.exception() is not None:
        raise q.exception()


# ---------------------------------------------------------------------------
# R01 / R05
# ---------------------------------------------------------------------------
def run_bronze_stream(spark: SparkSession, landing_path: str, schema: T.StructType,
                      target_path: str, checkpoint: str, fmt: str = "parquet",
                      max_files_per_trigger: int | None = None) -> None:
    """Process every landed file once (availableNow) through the same load
    as a batch: faulty rows to quarantine, first arrivals whose (timestamp,
    symbol, source) the target does not hold yet appended."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(landing_path)

    def load(batch: DataFrame, batch_id: int) -> None:
        writes.load_bronze(batch.sparkSession, batch, target_path, BRONZE_KEY, load_id=f"batch-{batch_id}")

    _run(stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint))


def dedup_stream(stream: DataFrame, watermark: str = "2 hours",
                 keys=tuple(BRONZE_KEY), event_time: str = "timestamp") -> DataFrame:
    """Drop repeats of the bronze key that arrive within the watermark
    (first wins); the state holds only keys inside the watermark."""
    return stream.withWatermark(event_time, watermark).dropDuplicatesWithinWatermark(list(keys))


# ---------------------------------------------------------------------------
# R02
# ---------------------------------------------------------------------------
def run_silver_stream(spark: SparkSession, bronze_path: str, schema: T.StructType,
                      silver_path: str, state_path: str, late_path: str, checkpoint: str,
                      updated_at=None, max_files_per_trigger: int | None = None,
                      lag_slices=None, policy: str = "carry", feed_path: str | None = None,
                      first_batch: int = 0, changes_path: str | None = None, table_path: str | None = None) -> None:
    """Each micro-batch of new bronze rows runs the incremental silver
    job (`plans.jobs.refresh_silver`), whose per-day state lives in
    `state_path`.

    * ``carry``     - rows at or before the state's high-water mark are late:
      written to `late_path` (partition `epoch=<batch id>`) and not applied;
    * ``recompute`` - late rows are applied too: the slices they touch are
      rebuilt from the bronze table at `table_path` (by default `bronze_path`).

    A retried micro-batch gives the same: the mark before the batch is stored
    with the batch id before anything else, late report and feed go by it, and
    the job's own state moves after its rows.

    `feed_path` (carry only): each batch's new silver rows are also written to
    an append-only feed (partition ``epoch=<batch id>``) that a downstream
    file stream - the daily bars, R03 - can read.  `changes_path` (any policy):
    each batch's changed slices go to a change feed, see `write_changes`.  `first_batch` is the number
    of the query's first batch in the state's count (a query restarted on a new
    checkpoint goes on, or repeats, where the old one was)."""
    if feed_path is not None and policy != "carry":
        raise ValueError("an append-only feed needs the carry policy (recompute rewrites earlier days): use changes_path")
    from barlake.plans import jobs

    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(bronze_path)

    def by_epoch(rows: DataFrame, batch_id: int, path: str) -> None:
        (rows.withColumn("epoch", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(path))

    def clean(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        batch_id += first_batch
        mark, repeated = mark_of_batch(s, state_path, batch_id)
        late = batch.limit(0) if mark is None else batch.filter(F.col("timestamp") <= F.lit(mark))
        by_epoch(late, batch_id, late_path)
        if policy == "recompute" and mark is not None:
            if repeated and changes_path is not None and has_epoch(s, changes_path, batch_id):
                return                              # its epoch comes last: the batch had finished
            table = s.read.schema(schema).parquet(table_path or bronze_path).select(*schema.names)
            slices = jobs.refresh_silver(s, table, silver_path, mode="recompute", state_path=state_path,
                                         updated_at=updated_at, lag_slices=lag_slices, changed=batch)
            if changes_path is not None:
                write_changes(s, silver_path, slices, batch_id, changes_path)
            return
        if not (repeated and jobs.high_water_mark(s, state_path) != mark):      # else the job had finished
            jobs.refresh_silver(s, batch, silver_path, mode="carry", state_path=state_path,
                                updated_at=updated_at, lag_slices=lag_slices)
        if feed_path is not None:
            fresh = s.read.parquet(silver_path)
            if mark is not None:      # only rows this batch added (later than the old mark)
                fresh = fresh.filter((F.col("date") >= F.to_date(F.lit(mark))) & (F.col("timestamp") > F.lit(mark)))
            by_epoch(fresh.drop("date"), batch_id, feed_path)
        if changes_path is not None:
            new = batch if mark is None else batch.filter(F.col("timestamp") > F.lit(mark))
            write_changes(s, silver_path, new.select("symbol", F.to_date("timestamp").alias("day")), batch_id, changes_path,
                          whole=mark is None)

    _run(stream.writeStream.foreachBatch(clean).option("checkpointLocation", checkpoint))


def mark_of_batch(spark: SparkSession, state_path: str, batch_id: int):
    """The high-water mark before the batch, and whether the batch has been
    begun before: stored at its first attempt, read back at a retry."""
    from barlake.plans import jobs
    path = f"{state_path.rstrip('/')}/batches"
    known = read_stored(spark, path)
    row = None if known is None else known.filter(F.col("batch") == batch_id).select("mark").first()
    if row is not None:
        return row[0], True
    mark = jobs.high_water_mark(spark, state_path)
    (spark.range(1).select(F.lit(mark).cast("timestamp").alias("mark"), F.lit(batch_id).alias("batch"))
        .coalesce(1).write.mode("append").partitionBy("batch").parquet(path))
    return mark, False


# ---------------------------------------------------------------------------
# Change feed
# ---------------------------------------------------------------------------
def has_epoch(spark: SparkSession, changes_path: str, epoch: int) -> bool:
    fs, folder = storage(spark, f"{changes_path.rstrip('/')}/epoch={epoch}")
    return fs.exists(folder)


def write_changes(spark: SparkSession, silver_path: str, slices: DataFrame, epoch: int, changes_path: str, whole: bool = False) -> None:
    """One epoch of the change feed (partition ``epoch``): for each of the
    (symbol, day) `slices` a row with change ``retract`` - all the slice held before
    is void - and its present silver rows with change ``insert``.  `whole`: the
    slices hold all rows of silver (its first build).  An epoch that is
    there stays as it is (its folder appears whole): a reader may have begun it."""
    if has_epoch(spark, changes_path, epoch):
        return
    slices = slices.filter("symbol is not null and day is not null").select("symbol", "day").distinct()
    if whole:
        rows = read_stored(spark, silver_path).withColumnRenamed("date", "day").filter("symbol is not null")
    else:
        path = scratch_path(spark, "changed-slices")
        slices.write.parquet(path)
        slices = spark.read.schema("symbol string, day date").parquet(path)
        days = [r[0] for r in slices.select("day").distinct().collect()]         # bounded by the calendar
        rows = read_stored(spark, silver_path, days).withColumnRenamed("date", "day").join(slices, ["symbol", "day"], "left_semi")
    void = slices.withColumn("change", F.lit("retract"))
    out = rows.withColumn("change", F.lit("insert")).unionByName(void, allowMissingColumns=True).withColumn("epoch", F.lit(epoch))
    record_schema(spark, changes_path, out.schema)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(changes_path))


def expire_changes(spark: SparkSession, changes_path: str, before: int) -> None:
    """Drop the feed's epochs below `before` (those every reader has applied)."""
    epochs = [int(n[6:]) for n in folder_names(spark, changes_path) if n.startswith("epoch=")]
    old = [e for e in epochs if e < before]
    writes.drop_partitions(spark, changes_path, "epoch", old)


def apply_changes(spark: SparkSession, changes_path: str, epochs, gold_path: str, state_path: str, updated_at=None) -> None:
    """Bring gold up to the feed's `epochs`.  Of each slice only the newest of
    them counts, and only if neither it nor a newer one was applied before;
    ``<state>/applied`` (one row per symbol and day) moves after gold, so any
    attempt can be repeated."""
    from barlake.plans import jobs
    epochs, applied_path = sorted(set(epochs)), f"{state_path.rstrip('/')}/applied"
    feed = read_stored(spark, changes_path, epochs, "epoch")
    newest = feed.filter("change = 'retract'").select("symbol", "day", "epoch")
    if len(epochs) > 1:                                 # an epoch has each slice once
        newest = newest.groupBy("symbol", "day").agg(F.max("epoch").alias("epoch"))
    applied = None
    if read_stored(spark, gold_path, []) is not None:
        days = [r[0] for r in feed.filter("change = 'retract'").select("day").distinct().collect()]      # bounded by the calendar
        applied = read_stored(spark, applied_path, days, "day")
    if applied is not None:
        done = applied.select("symbol", "day", F.col("epoch").alias("_done"))
        newest = newest.join(done, ["symbol", "day"], "left").filter("_done is null or epoch > _done").drop("_done")
    path = scratch_path(spark, "feed-slices")
    newest.write.parquet(path)
    newest = spark.read.schema(newest.schema).parquet(path)
    if newest.isEmpty():
        return
    rows = feed.filter("change = 'insert'")
    if applied is not None or len(epochs) > 1:
        rows = rows.join(newest, ["symbol", "day", "epoch"], "left_semi")
    path = scratch_path(spark, "feed-bars")
    bars = daily_bars(rows)
    bars.write.parquet(path)
    slices = newest.select("symbol", "day")
    jobs.apply_bars(spark, spark.read.schema(bars.schema).parquet(path), slices, gold_path, updated_at)
    writes.replace_slices(spark, applied_path, newest, slices, "day", ("symbol",))


def run_gold_stream(spark: SparkSession, changes_path: str, gold_path: str, state_path: str, checkpoint: str,
                    updated_at=None, max_files_per_trigger: int | None = None) -> None:
    """Gold from the change feed.  The stream tells which epochs are new;
    their rows are read from the feed's folders, which are whole whatever files a
    micro-batch was given."""
    reader = spark.readStream.schema(layer_record(spark, changes_path)[1])
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(changes_path).select("epoch")

    def follow(batch: DataFrame, batch_id: int) -> None:
        epochs = [r[0] for r in batch.distinct().collect()]                 # one per silver batch
        if epochs:
            apply_changes(batch.sparkSession, changes_path, epochs, gold_path, state_path, updated_at)

    _run(stream.writeStream.foreachBatch(follow).option("checkpointLocation", checkpoint))


# ---------------------------------------------------------------------------
# R03
# ---------------------------------------------------------------------------
def daily_bars_stream(silver_stream: DataFrame, delay: str = "0 seconds") -> DataFrame:
    w = F.window(F.col("timestamp"), "1 day")
    return (silver_stream.withWatermark("timestamp", delay)
            .groupBy(w.alias("w"), "symbol").agg(*_ohlcv_aggs("timestamp"))
            .select(F.to_date(F.col("w.start")).alias("date"), "symbol", "open", "high", "low", "close",
                    "volume", "data_points", "first_timestamp", "last_timestamp"))


def run_daily_bars_stream(spark: SparkSession, silver_path: str, schema: T.StructType,
                          out_path: str, checkpoint: str, delay: str = "0 seconds",
                          max_files_per_trigger: int | None = None) -> None:
    """Daily bars up to the last row seen, the open day included: each
    micro-batch replaces the (symbol, day) bars it changed.  The state holds
    the days inside the watermark."""
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    bars = daily_bars_stream(reader.load(silver_path), delay)

    def replace(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        path = scratch_path(s, "daily-bars")
        batch.write.parquet(path)
        rows = s.read.schema(batch.schema).parquet(path)
        writes.replace_slices(s, out_path, rows, rows.select("symbol", F.col("date").alias("day")), "date", ("symbol",))

    _run(bars.writeStream.foreachBatch(replace).outputMode("update").option("checkpointLocation", checkpoint))
