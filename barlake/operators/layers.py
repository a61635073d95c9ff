"""Stored layers (K06, S06): a versioned record of each layer's columns, and reads
by that record.

A layer is a Parquet folder partitioned by day.  Beside it, in
``<layer>_schema``, lies one small file per version of its columns.  A write
advances the record first - new columns go to the end, a column may widen (int to
long, float to double, a decimal to more digits) and any other change of type is
an error - and every read is given the newest version, so columns that older
files lack are NULL and no read opens footers to find a schema.  A read of some
days lists only their folders.

One writer per layer at a time, as for the layer itself.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_WIDER = [(T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()), (T.FloatType(), T.DoubleType())]


def storage(spark: SparkSession, path: str):
    """The path's file system and the path as its object."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it isn't there."""
    fs, p = storage(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def layer_record(spark: SparkSession, path: str) -> tuple[int, T.StructType] | None:
    """Number and columns of the layer's newest version; None without a record."""
    folder = f"{path.rstrip('/')}_schema"
    versions = [n for n in folder_names(spark, folder) if n.startswith("v") and n.endswith(".json")]
    if not versions:
        return None
    fs, p = storage(spark, f"{folder}/{versions[-1]}")
    stream = fs.open(p)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return int(versions[-1][1:-5]), T.StructType.fromJson(json.loads(text))


def _widened(name: str, old: T.DataType, new: T.DataType) -> T.DataType:
    if old == new:
        return old
    for chain in _WIDER:
        if old in chain and new in chain:
            return max(old, new, key=chain.index)
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType) and old.scale == new.scale:
        return max(old, new, key=lambda t: t.precision)
    raise ValueError(f"column {name} is stored as {old.simpleString()}, not {new.simpleString()}")


def merged_schema(old: T.StructType, new: T.StructType) -> T.StructType:
    """Old columns, widened where needed, then the new ones; all nullable."""
    by_name = {f.name: f for f in new.fields}
    kept = [(f, _widened(f.name, f.dataType, by_name.get(f.name, f).dataType)) for f in old.fields]
    known = {f.name for f in old.fields}
    added = [(f, f.dataType) for f in new.fields if f.name not in known]
    return T.StructType([T.StructField(f.name, t, True, f.metadata) for f, t in kept + added])


def record_schema(spark: SparkSession, path: str, schema: T.StructType, replace: bool = False) -> T.StructType:
    """Advance the layer's record by the columns of a write (all of them, for a
    write that replaces the whole layer) and return its columns."""
    current = layer_record(spark, path)
    plain = merged_schema(T.StructType([]), schema)
    out = plain if current is None or replace else merged_schema(current[1], plain)
    if current is None or out != current[1]:
        folder, number = f"{path.rstrip('/')}_schema", (current[0] if current else 0) + 1
        fs, temporary = storage(spark, f"{folder}/_writing-{number:08d}")
        stream = fs.create(temporary, True)
        stream.write(bytearray(out.json().encode()))
        stream.close()
        fs.rename(temporary, storage(spark, f"{folder}/v{number:08d}.json")[1])      # seen whole or not at all
    return out


def stored_days(spark: SparkSession, path: str, column: str = "date") -> list[date]:
    """Days that have a folder, by one listing of the layer (calendar-bounded)."""
    found = [n.split("=", 1)[1] for n in folder_names(spark, path) if n.startswith(f"{column}=")]
    return [date.fromisoformat(d) for d in found if d[:1].isdigit()]


def read_stored(spark: SparkSession, path: str, days: Iterable[date] | None = None, column: str = "date") -> DataFrame | None:
    """The layer by its record, or of it some days, whose folders alone are
    listed; None before the first write.  A folder without a record (written by
    others) is read by the columns of one of its files."""
    path = path.rstrip("/")
    record = layer_record(spark, path)
    fs, p = storage(spark, path)
    if not fs.exists(p):
        return None
    if record is None:
        try:
            df = spark.read.parquet(path)
        except Exception as e:  # noqa: BLE001 - a folder without data files
            if "UNABLE_TO_INFER_SCHEMA" in str(e):
                return None
            raise
        return df if days is None or column not in df.columns else df.filter(df[column].isin(list(days)))
    reader = spark.read.schema(record[1])
    if days is None:
        return reader.parquet(path)
    folders = [f for f in (f"{path}/{column}={d}" for d in sorted(set(days))) if fs.exists(storage(spark, f)[1])]
    if not folders:
        return spark.createDataFrame([], record[1])
    return reader.option("basePath", path).parquet(*folders)
