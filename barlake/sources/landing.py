"""Landing-zone reads of upstream bars.

The original jobs fetch bars over HTTP one symbol at a time; here the
fetched frames are files in a landing folder, read as one DataFrame with an
explicit schema (never inferred) and a `symbol` column.
"""

from __future__ import annotations

import bz2
import gzip
from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.operators.layers import read_stored
from barlake.schema import CORRUPT, UPSTREAM_SCHEMA


def read_bars(spark: SparkSession, path: str, fmt: str = "parquet",
              schema: T.StructType = UPSTREAM_SCHEMA,
              start: datetime | str | None = None, end: datetime | str | None = None,
              symbols: Iterable[str] | None = None, skip: DataFrame | None = None) -> DataFrame:
    """Scan landed bars whose time is named ``Date`` or ``Datetime``.  Range and
    symbol predicates are plain filters so they reach the Parquet scan
    (`PushedFilters`).  A JSON or CSV line that does not parse, or that holds a
    value of another type, keeps its text in ``corrupt_record``.  `skip` (file):
    files known to be unreadable, of which no row is taken."""
    reader = spark.read.format(fmt)
    if skip is not None:
        reader = reader.option("ignoreCorruptFiles", "true")
    if fmt in ("csv", "json"):
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if fmt == "csv":
        reader = reader.option("header", "true").option("enforceSchema", "false")
        head = spark.read.option("header", "true").option("ignoreCorruptFiles", str(skip is not None)).csv(path).columns
        schema = T.StructType([schema[c] for c in head if c in schema.names] + [schema[CORRUPT]])
    df = reader.schema(schema).load(path)
    names = [c for c in ("Datetime", "Date") if c in df.columns]
    if not names:
        raise ValueError("landed bars have neither a Date nor a Datetime column")
    keep = F.col(CORRUPT).isNotNull() if CORRUPT in df.columns else F.lit(False)
    if start is not None or end is not None:
        inside = F.lit(False)
        for i, c in enumerate(names):
            here = F.lit(True)
            if start is not None:
                here = here & (F.col(c) >= F.lit(start).cast("timestamp"))
            if end is not None:
                here = here & (F.col(c) < F.lit(end).cast("timestamp"))
            for earlier in names[:i]:
                here = here & F.col(earlier).isNull()
            inside = inside | here
        df = df.filter(inside | keep)
    if symbols is not None:
        df = df.filter(F.col("symbol").isin(list(symbols)) | keep)
    if skip is not None:
        columns = df.columns
        df = (df.withColumn("_file", F.col("_metadata.file_path"))
              .join(skip.select(F.col("file").alias("_file")), "_file", "left_anti").select(*columns))
    return df


FILE_BYTES = 1 << 30       # a landed file (one fetch) is at most so long


def _fault(fmt: str, name: str, content: bytes) -> str | None:
    """Why a file can't be read whole, or None."""
    try:
        if fmt == "parquet":
            import pyarrow as pa
            import pyarrow.parquet as pq
            for _ in pq.ParquetFile(pa.BufferReader(content)).iter_batches():
                pass
        elif name.endswith((".gz", ".bz2")):
            (gzip if name.endswith(".gz") else bz2).decompress(content)
    except Exception as e:  # noqa: BLE001 - whatever the file's fault is, it is reported
        return (str(e) or type(e).__name__).splitlines()[0][:300]
    return None


def unreadable_files(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """(file, symbol, error) for each landed file that can't be read whole: every
    file's bytes come through Spark's own file system and are decoded in the task,
    one file at a time.  The symbol is that of the ``symbol=`` folder, else the
    file's name up to its first dot.  Lines of text files have their own check
    (`read_bars`); a longer file than FILE_BYTES is reported, not decoded."""
    def check(batches):
        import pyarrow as pa
        for batch in batches:
            for file, length, content in zip(*(batch.column(i) for i in range(3))):
                error = _fault(fmt, file.as_py(), content.as_py()) if content.is_valid else f"longer than {FILE_BYTES} bytes"
                if error is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([file.as_py()]), pa.array([error])], names=["file", "error"])

    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .select(F.col("_metadata.file_path").alias("file"), "length", F.when(F.col("length") <= FILE_BYTES, F.col("content"))))
    folder = F.regexp_extract("file", "/symbol=([^/]+)/", 1)
    stem = F.regexp_extract("file", "([^/.]+)[^/]*$", 1)
    return (files.mapInArrow(check, "file string, error string")
            .select("file", F.when(folder != "", F.url_decode(folder)).otherwise(stem).alias("symbol"), "error"))


def read_isolated(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType = UPSTREAM_SCHEMA,
                  start=None, end=None, symbols: Iterable[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """S01 with failures kept apart (one symbol's failure must not stop the
    others): (bars, failed).  The bars are `read_bars` over the files that can be
    read whole, with the same pushdown; a file that can't gives no row at all and
    one row of `failed` (`unreadable_files`)."""
    from barlake.session import scratch_path
    report = scratch_path(spark, "landing-faults")
    found = unreadable_files(spark, path, fmt)
    found.write.parquet(report)
    failed = spark.read.schema(found.schema).parquet(report)
    bars = read_bars(spark, path, fmt, schema, start, end, symbols, skip=failed.select("file"))
    return bars, failed


def symbol_report(bars: DataFrame, failed: DataFrame, expected: Iterable[str] | DataFrame) -> DataFrame:
    """S04 for a batch: per expected symbol its rows, its files that failed, and
    ``loaded``, ``partial`` (rows, but a file failed), ``failed`` or ``missing``."""
    if not isinstance(expected, DataFrame):
        expected = bars.sparkSession.createDataFrame([(s,) for s in expected], "symbol string")
    counts = (bars.groupBy("symbol").agg(F.count("*").alias("n_rows")).withColumn("n_failed", F.lit(0).cast("long"))
              .unionByName(failed.groupBy("symbol").agg(F.count("*").alias("n_failed")).withColumn("n_rows", F.lit(0).cast("long")))
              .groupBy("symbol").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_failed").alias("n_failed")))
    out = expected.select("symbol").distinct().join(counts, "symbol", "left").fillna(0, ["n_rows", "n_failed"])
    rows, bad = F.col("n_rows") > 0, F.col("n_failed") > 0
    return out.withColumn("status", F.when(rows & bad, "partial").when(rows, "loaded").when(bad, "failed").otherwise("missing"))


def time_range(df: DataFrame, start=None, end=None, time_col: str = "timestamp") -> DataFrame:
    """Start inclusive, end exclusive."""
    ts = F.col(time_col)
    if start is not None:
        df = df.filter(ts >= F.lit(start).cast("timestamp"))
    if end is not None:
        df = df.filter(ts < F.lit(end).cast("timestamp"))
    return df


def only_symbols(df: DataFrame, symbols: Iterable[str] | DataFrame, col: str = "symbol") -> DataFrame:
    """Keep tracked symbols (S03).  A literal list becomes an IN filter that is
    pushed to the scan; a symbol table becomes a left-semi join."""
    if isinstance(symbols, DataFrame):
        return df.join(symbols.select(F.col(col)).distinct(), col, "left_semi")
    return df.filter(F.col(col).isin(list(symbols)))


def missing_symbols(df: DataFrame, expected: Iterable[str] | DataFrame, col: str = "symbol") -> DataFrame:
    """Expected symbols for which nothing came back."""
    spark = df.sparkSession
    if not isinstance(expected, DataFrame):
        expected = spark.createDataFrame([(s,) for s in expected], f"{col} string")
    return expected.select(col).distinct().join(df.select(col).distinct(), col, "left_anti")


def require_rows(df: DataFrame, message: str = "no rows") -> DataFrame:
    """Raise when the batch is empty (S05); one cheap job (a LIMIT 1 probe)."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def layer_schema(spark: SparkSession, layer: str) -> T.StructType:
    """A layer's columns as its plan produces them (plus the `date` partition
    column), derived by planning the layers over an empty bronze frame."""
    from barlake.plans.gold import build_gold
    from barlake.plans.silver import build_silver
    from barlake.schema import BRONZE_SCHEMA
    empty = spark.createDataFrame([], BRONZE_SCHEMA)
    df = {"bronze": lambda: empty, "silver": lambda: build_silver(empty),
          "gold": lambda: build_gold(build_silver(empty))}[layer]()
    if "date" not in df.columns:
        df = df.withColumn("date", F.to_date("timestamp"))
    return df.schema


def read_layer(spark: SparkSession, root: str, layer: str) -> DataFrame:
    """Named scan of a layer table (S06), by the layer's record of columns.  A
    layer with no files yet (never written, or written empty) reads as an empty
    frame with the layer's columns."""
    return read_folder(spark, f"{root.rstrip('/')}/{layer}", layer)


def read_folder(spark: SparkSession, path: str, layer: str) -> DataFrame:
    """A layer's folder, empty with the layer's columns before its first rows."""
    df = read_stored(spark, path)
    return spark.createDataFrame([], layer_schema(spark, layer)) if df is None else df


def flatten_columns(df: DataFrame, struct_col: str) -> DataFrame:
    """Drop a header level (P06): a struct column's fields become top-level."""
    others = [c for c in df.columns if c != struct_col]
    return df.select(*others, f"{struct_col}.*")
