"""Layer jobs on storage: load bronze, refresh silver (full / reference
incremental / carried incremental), refresh gold.

Layers are date-partitioned Parquet folders.  Without a table format, an
upsert (K05) is: read only the target partitions the new rows touch (a
partition filter on their dates), drop the rows whose key comes again, union
the new rows, write the result to a staging folder, then overwrite just those
partitions of the target from the staging copy.  Slices are replaced without a
staging copy (`writes.replace_days`).

State of the silver job, below ``state_path``: ``days`` (per symbol and day the
last validated row, partitioned by day) and ``last`` (per symbol the newest of
these, a small table whose maximum is the high-water mark).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barlake.operators import quality, writes
from barlake.operators.bars import daily_bars
from barlake.operators.layers import read_stored, record_schema, stored_days
from barlake.operators.sequence import choose_slices
from barlake.plans import gold as gold_plan
from barlake.plans import silver as silver_plan
from barlake.schema import GOLD_COLUMNS
from barlake.session import scratch_path


def merge_into_layer(spark: SparkSession, new: DataFrame, path: str,
                     keys: Sequence[str] = ("timestamp", "symbol"), partition_col: str = "date") -> None:
    """K05 + K06 on a partitioned folder: delete-then-insert by key, only in
    the partitions `new` touches, whose folders alone are listed; new columns are
    appended (old rows NULL)."""
    new = new if partition_col in new.columns else new.withColumn(partition_col, F.to_date("timestamp"))
    record_schema(spark, path, new.schema)         # a column of another type stops here
    new = _staged(spark, new, "merge-new")         # read for its dates, the keys and the rows
    dates = [r[0] for r in new.select(partition_col).distinct().collect()]      # bounded by the calendar
    if not dates:
        return
    target = read_stored(spark, path, dates, partition_col)
    if target is None:
        writes.write_layer(new, path, partition_by=partition_col)
        return
    kept = target.join(new.select(*keys), list(keys), "left_anti")
    merged = kept.unionByName(new, allowMissingColumns=True)
    staging = scratch_path(spark, "merge-staging")
    writes.write_layer(merged, staging, mode="overwrite", partition_by=partition_col)
    staged = spark.read.schema(merged.schema).parquet(staging)      # one schema: no footer merge
    writes.write_layer(staged, path, mode="overwrite", partition_by=partition_col)


def _staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared checkpoint folder and read back: a lineage cut
    that survives executor loss and lets two outputs share one computation."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)      # schema given: an empty stage reads fine


def refresh_silver(spark: SparkSession, bronze: DataFrame, silver_path: str, mode: str | None = None,
                   state_path: str | None = None, updated_at=None, lag_slices=None,
                   changed: DataFrame | None = None, since=None) -> DataFrame | None:
    """C03 as a job.  Returns the (symbol, day) slices whose silver rows may
    have changed - what gold has to follow - or None after a full rebuild or a
    reference run.

    * ``full``      - rebuild every partition from all of bronze;
    * ``reference`` - rows after the target's global high-water mark, no
      carried state (the original incremental model; late rows are lost);
    * ``carry``     - the same filter, seeded with each symbol's last validated
      row; equals a full refresh while bars arrive in time order.  Rows of
      `changed` at or before the mark are not applied: they are written to
      ``<state_path>/late``;
    * ``recompute`` - R04: rebuild the (symbol, day) slices that `changed` (the
      rows just loaded) touches, or all from the day of `since` on, and each
      symbol's next slice; equals a full refresh also when late rows arrive,
      days and slices that become empty included.

    The mode is ``recompute`` where `changed` or `since` is given, else
    ``carry``.  `lag_slices` None: by hour within days if a (symbol, day) holds
    more than SLICE_ROWS rows (and finer where hours do, `choose_slices`), else by day.  A run that failed can be repeated:
    ``last``, which mark and seeds come from, is written after all else."""
    mode = mode or ("carry" if changed is None and since is None else "recompute")
    if mode not in ("full", "reference", "carry", "recompute"):
        raise ValueError(f"unknown mode {mode}")
    if mode == "reference":
        target = read_stored(spark, silver_path)
        if target is not None:
            # the mark is read once as a value: `new` must not depend on files the merge replaces
            hwm = target.agg(F.max("timestamp")).first()[0]
            new = silver_plan.build_silver(bronze, updated_at=updated_at, high_water=hwm,
                                           lag_slices=lag_slices or silver_plan.LAG_SLICES)
            merge_into_layer(spark, new, silver_path)
            return None
        mode = "full"
    state = None if state_path is None else state_path.rstrip("/")
    if mode != "full" and (state is None or high_water_mark(spark, state) is None):
        if state is None:
            raise ValueError(f"{mode} mode needs a state_path")
        mode = "full"                              # first run
    if mode == "full":
        _full(spark, bronze, silver_path, state, updated_at, lag_slices)
        return None
    if mode == "carry":
        return _carry(spark, bronze, silver_path, state, updated_at, lag_slices, changed)
    if since is not None:
        first = F.to_date(F.lit(since))
        old = read_stored(spark, f"{state}/days", _days_from(spark, f"{state}/days", since, "day"), "day").select("symbol", "day")
        come = _from_day(bronze, first).select("symbol", F.to_date("timestamp").alias("day"))
        touched = old.unionByName(come).distinct()
    elif changed is not None:
        touched = (changed.select("symbol", "day") if "day" in changed.columns else
                   changed.select("symbol", F.to_date("timestamp").alias("day"))).distinct()
    else:
        raise ValueError("recompute mode needs `changed` rows or `since`")
    return _recompute(spark, bronze, silver_path, state, touched, updated_at, lag_slices)


SLICE_ROWS = 20_000        # rows of a (symbol, day) from which its LAG is split further
NEAR_DAYS = 3              # a neighbouring bar is looked for in so many days around first


def _summary(spark: SparkSession, valid: DataFrame, lag_slices) -> tuple[DataFrame, DataFrame, tuple]:
    """Of staged validated rows the day summary, each symbol's newest row of it
    (both staged) and the LAG slices."""
    days = _staged(spark, silver_plan.day_summary(valid, counted=True), "silver-days")
    newest = _staged(spark, silver_plan.seeds_before(days, counted=True), "silver-newest")
    if lag_slices is None:
        total, most = newest.agg(F.max("total"), F.max("most")).first()
        if (total or 0) <= SLICE_ROWS:
            lag_slices = ()
        else:
            lag_slices = ("day",) if most <= SLICE_ROWS else choose_slices(valid, ["symbol"], "timestamp", SLICE_ROWS, "hour")
    return days.drop("n"), newest.drop("total", "most"), tuple(lag_slices)


def _write_last(newest: DataFrame, state: str) -> None:
    newest.hint("rebalance").write.mode("overwrite").parquet(f"{state}/last")


def _full(spark, bronze, silver_path, state, updated_at, lag_slices) -> None:
    valid = _staged(spark, silver_plan.validated(bronze), "silver-valid")
    days, newest, slices = _summary(spark, valid, lag_slices)
    out = silver_plan.finish_silver(valid, updated_at, None, slices).withColumn("date", F.to_date("timestamp"))
    writes.write_whole(out, silver_path)
    if state is not None:
        writes.write_whole(days, f"{state}/days", "day", ("symbol",))
        _write_last(newest, state)


def high_water_mark(spark: SparkSession, state_path: str):
    """Time of the newest validated row, from the small ``last`` table; None before the first run."""
    last = read_stored(spark, f"{state_path.rstrip('/')}/last")
    return None if last is None else last.agg(F.max("timestamp")).first()[0]


def _carry(spark, bronze, silver_path, state, updated_at, lag_slices, changed):
    """Rows after the mark.  They are later than every stored row, so only the
    mark's own day is merged; other days are written as they are.  Writing them
    again (a retry) replaces the same rows."""
    last = read_stored(spark, f"{state}/last")        # replaced at the end, from a staged copy
    mark = last.agg(F.max("timestamp")).first()[0]
    if changed is not None:
        late = changed.filter(F.col("timestamp") <= F.lit(mark))
        # by mark: a repeated run, which finds the same mark, replaces its report
        (late.withColumn("mark", F.date_format(F.lit(mark), "yyyyMMdd'T'HHmmssSSSSSS")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("mark").parquet(f"{state}/late"))
    valid = _staged(spark, silver_plan.validated(silver_plan.since_high_water(bronze, mark)), "silver-valid")
    fresh, latest, slices = _summary(spark, valid, lag_slices)
    new = silver_plan.finish_silver(valid, updated_at, last, slices).withColumn("date", F.to_date("timestamp"))
    day = _as_date(mark)
    kept = read_stored(spark, silver_path, [day]).filter(F.col("timestamp") <= F.lit(mark))
    merged = _staged(spark, kept.unionByName(new, allowMissingColumns=True), "silver-new")
    writes.write_layer(merged, silver_path)
    old = read_stored(spark, f"{state}/days", [day], "day")
    same_day = old.join(fresh.select("symbol", "day"), ["symbol", "day"], "left_anti")
    _staged_overwrite(spark, same_day.unionByName(fresh), f"{state}/days", "day")
    newest = silver_plan._last_by(last.unionByName(latest.select(*last.columns)), ["symbol"]).select(*last.columns)
    _write_last(_staged(spark, newest, "silver-last"), state)
    return fresh.select("symbol", "day")


def _staged_overwrite(spark, rows, path, partition_col) -> None:
    writes.write_layer(_staged(spark, rows, "silver-state"), path, partition_by=partition_col, sort_by=("symbol",))


def _from_day(bronze: DataFrame, first) -> DataFrame:
    rows = bronze.filter(F.to_date("timestamp") >= first)
    return rows.filter(F.col("date") >= first) if "date" in bronze.columns else rows


def _of_slices(bronze: DataFrame, slices: DataFrame) -> DataFrame:
    """Bronze rows of the (symbol, day) slices; only the folders of their days
    are read (the list of days is bounded by the calendar)."""
    dates = [r[0] for r in slices.select("day").distinct().collect()]
    rows = bronze.withColumn("_day", F.to_date("timestamp"))
    if dates:           # a range that file statistics can serve where there are no folders
        rows = rows.filter((F.col("timestamp") >= F.lit(min(dates)).cast("timestamp"))
                           & (F.col("timestamp") < F.date_add(F.lit(max(dates)), 1).cast("timestamp")))
    rows = rows.filter(F.col("date" if "date" in bronze.columns else "_day").isin(dates)) if dates else rows.limit(0)
    wanted = slices.select("symbol", F.col("day").alias("_day"))
    return rows.join(wanted, ["symbol", "_day"], "left_semi").drop("_day").select(bronze.columns)


def _around(days: Sequence[date]) -> set[date]:
    return {d + timedelta(n) for d in days for n in range(-NEAR_DAYS, NEAR_DAYS + 1)}


def _days_from(spark, path, since, column="date") -> list[date]:
    return [d for d in stored_days(spark, path, column) if d >= _as_date(since)]


def neighbourhood(spark, path, column, touched: DataFrame, fresh: DataFrame, newest: DataFrame | None = None) -> DataFrame:
    """Rows (symbol, `column`, ...) of a folder with one row per symbol and day:
    the `fresh` ones in place of those of the `touched` slices, and for each of
    these at least the symbol's nearest stored days before and after."""
    beside = _beside(spark, path, column, touched, fresh.columns, newest)
    return beside.select(*fresh.columns).unionByName(fresh)


def _beside(spark, path, column, touched: DataFrame, columns: Sequence[str], newest: DataFrame | None = None) -> DataFrame:
    """The stored rows next to the (symbol, day) slices `touched` (no slice twice)
    and not of them, staged: `_after` if the day before in the symbol's sequence
    of stored and touched days is touched, `_before` if the day after is.

    Folders of the NEAR_DAYS days around the touched ones are read first (all, where
    those are most); a symbol with a touched slice that has no neighbour there, though
    folders lie further out on that side, is looked up in all of them.  `newest` (symbol, day)
    spares that after each symbol's last day."""
    dates = [r[0] for r in touched.select("day").distinct().collect()]      # bounded by the calendar
    present = stored_days(spark, path, column)
    around = _around(dates)
    near = [d for d in present if d in around]
    if 2 * len(near) > len(present):        # most of them: all at once, no second look
        near = present
    slices = (touched.filter("symbol is not null and day is not null")
              .select("symbol", F.col("day").alias(column), F.lit(True).alias("_in")))
    sequence = Window.partitionBy("symbol").orderBy(column)

    def looked_up(days, symbols=None):
        rows = (read_stored(spark, path, days, column).select(*columns, F.lit(False).alias("_in"))
                .unionByName(slices, allowMissingColumns=True))
        if symbols is not None:
            rows = rows.join(symbols, "symbol", "left_semi")
        own = Window.partitionBy("symbol").orderBy(F.col(column), F.col("_in").desc())
        rows = (rows.withColumns({"_day": F.lag(column).over(own), "_of": F.lag("_in").over(own)})
                .filter(~(~F.col("_in") & F.coalesce(F.col("_of") & (F.col("_day") == F.col(column)), F.lit(False))))
                .drop("_day", "_of"))
        day, a, b = F.col(column), F.lag(column).over(sequence), F.lead(column).over(sequence)
        rows = rows.withColumns({"_after": F.coalesce(F.lag("_in").over(sequence), F.lit(False)),
                                 "_before": F.coalesce(F.lead("_in").over(sequence), F.lit(False)),
                                 "_older": F.coalesce(F.datediff(day, a), F.lit(NEAR_DAYS + 1)) > NEAR_DAYS,
                                 "_newer": F.coalesce(F.datediff(b, day), F.lit(NEAR_DAYS + 1)) > NEAR_DAYS})
        return _staged(spark, rows.filter("_in or _after or _before"), "neighbours")

    out = looked_up(near)
    rows = out.filter("not _in").drop("_in", "_older", "_newer")
    if len(near) == len(present) or not dates:
        return rows
    # folders beyond the window: the days between may hold the symbol's neighbour
    older = F.col("_older") & (F.date_sub(column, NEAR_DAYS) > F.lit(min(present)))
    newer = F.col("_newer") & (F.date_add(column, NEAR_DAYS) < F.lit(max(present)))
    marks = out.filter("_in")
    if newest is not None:
        marks = marks.join(newest.select("symbol", F.col("day").alias("_newest")), "symbol", "left")
        newer = newer & F.coalesce(F.col(column) < F.col("_newest"), F.lit(False))
        older = older & F.col("_newest").isNotNull()
    open_ = _staged(spark, marks.filter(older | newer).select("symbol").distinct(), "neighbours-open")
    if open_.isEmpty():
        return rows
    far = looked_up(present, open_).filter("not _in").drop("_in", "_older", "_newer")
    return rows.join(open_, "symbol", "left_anti").unionByName(far)


def _with_next(spark, touched: DataFrame, beside: DataFrame, column: str) -> DataFrame:
    """The touched slices and each symbol's next stored one, staged: LAG having
    offset 1, no other can change with them."""
    following = beside.filter("_after").select("symbol", F.col(column).alias("day"))
    return _staged(spark, touched.select("symbol", "day").unionByName(following), "affected")


def _recompute(spark, bronze, silver_path, state, touched, updated_at, lag_slices):
    """R04 on the touched slices and each symbol's next one; state is read in the
    days around them, bronze once."""
    touched = _staged(spark, touched.filter("symbol is not null and day is not null"), "touched")
    last = read_stored(spark, f"{state}/last")
    beside = _beside(spark, f"{state}/days", "day", touched, ["day", *last.columns], last.select("symbol", F.to_date("timestamp").alias("day")))
    affected = _with_next(spark, touched, beside, "day")
    valid = _staged(spark, silver_plan.validated(_of_slices(bronze, affected)), "silver-valid")
    days, _, slices = _summary(spark, valid, lag_slices)
    fresh = days.join(touched, ["symbol", "day"], "left_semi")
    seeds = beside.filter("_before and not _after").select(*silver_plan.STATE_COLUMNS)
    new = silver_plan.finish_silver(valid, updated_at, seeds, slices)
    # a symbol whose newest day is gone has its newest before a touched slice
    standing = last.withColumn("day", F.to_date("timestamp")).join(touched, ["symbol", "day"], "left_anti")
    known = [x.select(*last.columns) for x in (standing, fresh, beside.filter("_before"))]
    newest = silver_plan._last_by(known[0].unionByName(known[1]).unionByName(known[2]), ["symbol"]).select(*last.columns)
    newest = _staged(spark, newest, "silver-last")
    writes.replace_slices(spark, silver_path, new.withColumn("date", F.to_date("timestamp")), affected)
    writes.replace_slices(spark, f"{state}/days", fresh, touched, "day", ("symbol",))
    _write_last(newest, state)
    return affected


def _as_date(value) -> date:
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    return date.fromisoformat(str(value)[:10])


def refresh_gold(spark: SparkSession, silver_path: str, gold_path: str, updated_at=None, suite=None) -> DataFrame | None:
    """C04 + K07: full replace of gold from stored silver (one row per symbol
    and day, sorted by symbol within each date partition - O01).  With a `suite`
    its tests run during the write; returns their report."""
    g = gold_plan.build_gold(read_stored(spark, silver_path).drop("date"), updated_at=updated_at)
    if suite is None:
        writes.write_whole(g, gold_path, "date", ("symbol",))
        return None
    g, seen = quality.observe_suite(g, suite)
    writes.write_whole(g, gold_path, "date", ("symbol",))
    return quality.observed_report(spark, seen, suite, "gold", lambda: read_stored(spark, gold_path))


def refresh_gold_since(spark: SparkSession, silver_path: str, gold_path: str, since,
                       updated_at=None) -> None:
    """Incremental gold: rebuild only the days >= `since` (e.g. the first day
    an incremental silver run touched).  New rows are staged first, then
    only those date partitions of gold are overwritten."""
    silver = read_stored(spark, silver_path, _days_from(spark, silver_path, since))
    fresh = gold_plan.build_gold_since(silver, read_stored(spark, gold_path), since, updated_at)
    writes.write_layer(_staged(spark, fresh, "gold-staging"), gold_path, mode="overwrite", sort_by=("symbol",))


def refresh_gold_slices(spark: SparkSession, silver_path: str, gold_path: str, slices: DataFrame,
                        updated_at=None) -> None:
    """Incremental gold after a silver run: the daily bars of the changed
    (symbol, day) `slices`, and each symbol's next day, whose return may change
    with them.  Silver is read for those days alone, gold for the days around."""
    slices = _staged(spark, slices.select("symbol", "day").distinct(), "gold-slices")
    dates = [r[0] for r in slices.select("day").distinct().collect()]        # bounded by the calendar
    if dates:
        rows = read_stored(spark, silver_path, dates).join(slices.withColumnRenamed("day", "date"), ["symbol", "date"], "left_semi")
        apply_bars(spark, _staged(spark, daily_bars(rows), "gold-bars"), slices, gold_path, updated_at)


def apply_bars(spark: SparkSession, bars: DataFrame, slices: DataFrame, gold_path: str, updated_at=None) -> None:
    """Replace the daily `bars` of the (symbol, day) `slices` in gold (a slice
    without one loses its row) and the metrics of each symbol's next day."""
    stamp = F.current_timestamp() if updated_at is None else F.lit(updated_at).cast("timestamp")
    if read_stored(spark, gold_path, []) is None:
        fresh = gold_plan.daily_metrics(bars).withColumn("updated_at", stamp).select(*GOLD_COLUMNS)
        writes.replace_slices(spark, gold_path, fresh, slices, "date", ("symbol",))
        return
    beside = _beside(spark, gold_path, "date", slices, bars.columns)
    affected = _with_next(spark, slices, beside, "date")
    rows = bars.unionByName(beside.filter("_after").select(*bars.columns))          # those of `affected`
    fresh = (gold_plan.daily_metrics(rows, beside.filter("_before and not _after"))
             .withColumn("updated_at", stamp).select(*GOLD_COLUMNS))
    writes.replace_slices(spark, gold_path, fresh, affected, "date", ("symbol",))


def refresh_layers(spark: SparkSession, bronze: DataFrame, root: str, mode: str | None = None,
                   changed: DataFrame | None = None, since=None, updated_at=None, lag_slices=None):
    """Silver then gold after a load: gold follows the slices silver touched
    (or is rebuilt after a full silver build).  Layout: ``<root>/silver``,
    ``<root>/gold``, state in ``<root>/_silver_state``.  Returns the slices."""
    root = root.rstrip("/")
    silver_path, gold_path = f"{root}/silver", f"{root}/gold"
    slices = refresh_silver(spark, bronze, silver_path, mode=mode, state_path=f"{root}/_silver_state",
                            updated_at=updated_at, lag_slices=lag_slices, changed=changed, since=since)
    if slices is None or read_stored(spark, gold_path, []) is None:
        refresh_gold(spark, silver_path, gold_path, updated_at)
    else:
        refresh_gold_slices(spark, silver_path, gold_path, slices, updated_at)
    return slices
