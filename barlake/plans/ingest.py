"""Bronze ingestion: normalise upstream bars and load them.

The original jobs fetch one frame per symbol over HTTP and insert rows one
at a time.  Here a fetch is a landing folder of upstream-shaped files; the
whole batch is one DataFrame and the load is one set-based write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.operators import quality, writes
from barlake.schema import (
    BRONZE_COLUMNS, CORRUPT, DEFAULT_SOURCE, MIN_ROWS_DAILY, MIN_ROWS_HOURLY, MIN_SYMBOLS, SOURCE_HOURLY, UPSTREAM_RENAMES,
)
from barlake.session import scratch_path
from barlake.sources.landing import missing_symbols, read_folder, require_rows, time_range


def with_metadata(df: DataFrame, source: str | None = None, ingested_at=None,
                  symbol: str | None = None) -> DataFrame:
    """Add `symbol` (when the frame is one symbol's), `source` and the
    load time."""
    cols = {}
    if symbol is not None:
        cols["symbol"] = F.lit(symbol)
    if source is not None:
        cols["source"] = F.lit(source)
    if ingested_at is not None:
        cols["ingestion_timestamp"] = F.lit(ingested_at).cast("timestamp")
    return df.withColumns(cols) if cols else df


def canonical_names(df: DataFrame) -> DataFrame:
    """Date/Datetime -> timestamp, Open -> open, ..."""
    if "Date" in df.columns and "Datetime" in df.columns:
        df = df.withColumn("Datetime", F.coalesce("Datetime", "Date")).drop("Date")
    present = {k: v for k, v in UPSTREAM_RENAMES.items() if k in df.columns}
    return df.withColumnsRenamed(present)


def to_utc(df: DataFrame, zone: str | None = None) -> DataFrame:
    """Bar time as a UTC TIMESTAMP.  Strings are parsed; wall-clock
    (TIMESTAMP_NTZ) values are read in `zone` (UTC by default)."""
    f = df.schema["timestamp"]
    ts = F.col("timestamp")
    if isinstance(f.dataType, T.StringType):
        ts = F.to_timestamp(ts)
    elif isinstance(f.dataType, T.TimestampNTZType):
        ts = ts.cast("timestamp") if zone is None else F.to_utc_timestamp(ts.cast("timestamp"), zone)
    return df.withColumn("timestamp", ts)


def nan_to_null(df: DataFrame, cols=("open", "high", "low", "close", "volume")) -> DataFrame:
    """Deliberate difference: NaN prices are stored as NULL (a NaN would pass
    `> 0` checks and be neither flagged nor repaired)."""
    return df.withColumns({c: F.when(F.isnan(F.col(c)), F.lit(None).cast("double")).otherwise(F.col(c))
                           for c in cols if c in df.columns})


def apply_defaults(df: DataFrame, now=None) -> DataFrame:
    """A column absent on insert gets its default; an explicit NULL is kept."""
    out = df
    if "source" not in df.columns:
        out = out.withColumn("source", F.lit(DEFAULT_SOURCE))
    if "ingestion_timestamp" not in df.columns:
        out = out.withColumn("ingestion_timestamp",
                             F.current_timestamp() if now is None else F.lit(now).cast("timestamp"))
    return out


def normalize_upstream(df: DataFrame, source: str | None = None, ingested_at=None,
                       symbol: str | None = None) -> DataFrame:
    """P06 (if nested) + P01 + P02 + P03 + P08 + P04: upstream frame -> the
    bronze column set in fixed order (DOUBLE prices)."""
    x = canonical_names(with_metadata(df, source, ingested_at, symbol))
    x = apply_defaults(to_utc(x), ingested_at)
    x = nan_to_null(x.withColumns({c: F.col(c).cast("double")
                                   for c in ("open", "high", "low", "close", "volume")}))
    return x.select(*BRONZE_COLUMNS, *([CORRUPT] if CORRUPT in x.columns else []))


def bronze_typed(df: DataFrame) -> DataFrame:
    """The decimal contract of the bronze table."""
    return writes.cast_bars(df)


def ingest_live(spark: SparkSession, landed: DataFrame, bronze_path: str, as_of,
                source: str = DEFAULT_SOURCE) -> dict[str, DataFrame]:
    """Landing batch -> non-empty check -> warnings -> conflict-ignoring
    load -> freshness.  Returns the reports (small DataFrames) and the touched
    (symbol, day) pairs."""
    batch = _evaluated(spark, normalize_upstream(landed, source=source, ingested_at=as_of))
    require_rows(batch, "no data fetched")
    issues = quality.batch_issues(batch)
    out = writes.load_bronze(spark, batch, bronze_path)
    fresh = quality.freshness(read_folder(spark, bronze_path, "bronze"), as_of)
    return {"issues": issues, "stats": out["stats"], "freshness": fresh, "touched": out["touched"]}


def backfill(spark: SparkSession, landed: DataFrame, bronze_path: str, source: str,
             expected_symbols, start=None, end=None, ingested_at=None,
             min_symbols: int = MIN_SYMBOLS, min_rows: int | None = None) -> dict[str, DataFrame]:
    """C02 for any interval: range scan -> missing-symbol report -> batch
    validation (raises below `min_symbols`, warns below `min_rows`, by default
    the source's own threshold) -> conflict-ignoring load -> load stats ->
    coverage of this source."""
    if min_rows is None:
        min_rows = MIN_ROWS_HOURLY if source == SOURCE_HOURLY else MIN_ROWS_DAILY
    batch = normalize_upstream(landed, source=source, ingested_at=ingested_at)
    corrupt = F.col(CORRUPT).isNotNull() if CORRUPT in batch.columns else F.lit(False)
    inside = time_range(batch.filter(~corrupt), start, end)
    batch = _evaluated(spark, inside.unionByName(batch.filter(corrupt)) if CORRUPT in batch.columns else inside)
    missing = missing_symbols(batch.filter(F.col("symbol").isNotNull()), expected_symbols)
    report = quality.check_batch(quality.validate_batch(batch, min_symbols, min_rows))
    out = writes.load_bronze(spark, batch, bronze_path)
    cov = quality.coverage(read_folder(spark, bronze_path, "bronze"), source)
    return {"missing": missing, "validation": report, "stats": out["stats"], "coverage": cov, "touched": out["touched"]}


def _evaluated(spark: SparkSession, batch: DataFrame) -> DataFrame:
    """The normalised batch as a staged table: the landing files are read and
    parsed once, whatever is checked, counted and loaded afterwards."""
    path = scratch_path(spark, "landed")
    batch.write.parquet(path)
    return spark.read.schema(batch.schema).parquet(path)
