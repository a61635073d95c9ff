"""5. Packing by power-of-two decomposition.

A document's ids (its tokens and a closing id 0) are cut into pieces of 1024
while they last, and the rest into the powers of two of its binary form,
largest first.  Every piece is a sequence of its own, its length a power of
two, so no sequence crosses documents and none needs padding; sequences of
equal length form a bucket.

Tokens are those of the ``tokenizers`` file given.  A text is cut before each
space that follows a non-space: no pre-token of the byte-level pattern crosses
such a place, so the stretches between can be looked up one by one.  Texts with
other white space around spaces are encoded whole; the special token's string
and characters beyond Latin letters go through the tokenizer itself, the rest
through the same vocabulary's rank file, which gives the same ids.

Defined results: a null or empty text is the closing id alone; rows that share
a doc_id are packed one by one; a null doc_id is carried.  Extra columns are
ignored.
"""

from __future__ import annotations

import base64
from array import array
import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm.common import table

SEQUENCE = 1024
CLOSE = 0
TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"       # the same vocabulary as ranks
SPECIAL = "<|endoftext|>"
CACHE = 300_000
UNUSUAL = re.compile("[^\t\n\r\x20-\x7e\u00a1-\u024f]")    # beyond these the tokenizer itself decides

PIECES_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
                 "offset long, ids binary")


class Encoder(dict):
    """Stretch of text to its ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, tokenizer: str, ranks: str | None):
        import tiktoken
        from tokenizers import Tokenizer
        self.exact = Tokenizer.from_file(tokenizer)
        self.fast = None
        if ranks:
            with open(ranks, "rb") as f:
                merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges,
                                          special_tokens={})

    def whole(self, text: str) -> bytes:
        ids = self.fast.encode_ordinary(text) if self.fast and SPECIAL not in text and not UNUSUAL.search(text) else \
            self.exact.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def __missing__(self, stretch: str) -> bytes:
        if not stretch or stretch.isspace() or stretch[-1].isspace() or stretch[1:2].isspace():
            raise ValueError("white space next to a cut")
        if len(self) >= CACHE:
            self.clear()
        value = self.whole(stretch)
        if len(stretch) < 100:
            self[stretch] = value
        return value

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        if SPECIAL in text:
            return self.whole(text)
        head, *rest = text.split(" ")
        try:
            return b"".join([self[head], *(self[" " + s] for s in rest)])
        except ValueError:
            return self.whole(text)


def piece_lengths(n: int, longest: int = SEQUENCE) -> list[int]:
    """Powers of two that add up to ``n``, none above ``longest``."""
    out = [longest] * (n // longest)
    rest = n % longest
    return out + [1 << b for b in range(longest.bit_length(), -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, tokenizer: str | None = None, ranks: str | None = None,
         longest: int = SEQUENCE) -> DataFrame:
    """One row per piece, with its ids; ``sequence_id`` counts pieces within the
    input's partitions.  ``tokenizer`` and ``ranks`` are paths."""
    if tokenizer is None:
        tokenizer, ranks = public_tokenizers.path(TOKENIZER), public_tokenizers.path(RANKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, ranks)
        sequence = TaskContext.get().partitionId() << 40
        close = np.array([CLOSE], "<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = encoder.ids(text.as_py() or "") + close
                total, start = len(data) // 4, 0
                for n in piece_lengths(total, longest):
                    ids = data[4 * start:4 * (start + n)]
                    rows.append((doc_id, start, n, zlib.crc32(ids), total, sequence, 0, ids))
                    start += n
                    sequence += 1
                size += len(data)
                if size > 8 << 20:
                    yield _batch(rows)
                    rows, size = [], 0
            if rows:
                yield _batch(rows)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES_SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows))
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:7]), pa.array(cols[7], pa.binary())],
                                      names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                                             "offset", "ids"])


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Sequences of equal length side by side: one folder per length."""
    pieces.write.partitionBy("length").parquet(path)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).drop("ids")
