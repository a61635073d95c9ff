"""Helpers shared by the operators: staged tables, byte-level words, hashes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.session import scratch_path

SLICE_BYTES = 4 << 20     # a text is split into words this many bytes at a time


def staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared checkpoint folder and read it
    back: cuts the lineage, and survives the loss of any executor."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Words of the contamination rule: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z.
# Every UTF-8 byte of a non-ASCII character is 0x80 or more, so the rule holds byte by byte.
ALNUM_WORDS = bytes(b + 32 if 0x41 <= b <= 0x5A else
                    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
# Words between ASCII white space ([^\x20\x09-\x0D]+) after lower-casing A-Z.
SPACED_WORDS = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def word_lists(data: bytes, table: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a bounded slice at a time; ``table`` lower-cases and
    maps separators.  A slice never ends inside a word."""
    if len(data) <= SLICE_BYTES:
        yield data.translate(table).split()
        return
    rest = b""
    for i in range(0, len(data), SLICE_BYTES):
        part = rest + data[i:i + SLICE_BYTES].translate(table)
        words = part.split()
        rest = b""
        if i + SLICE_BYTES < len(data) and words and not part[-1:].isspace():
            rest = words.pop()
        yield words
    if rest:
        yield [rest]


def binaries(column: pa.Array) -> Iterable[bytes | None]:
    """A string column's UTF-8 bytes, without decoding."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return (x.as_py() for x in column.cast(kind))


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64), element by element."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def held_out(doc_id: str = "doc_id"):
    """crc32 of the id as text, modulo 4, is 2: never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))
