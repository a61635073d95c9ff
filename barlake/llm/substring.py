"""10. Substring dedup by content-defined chunking.

The chunks of a text are runs of CHUNK_WORDS words that end at a content-defined
cut: in every window of WINDOW words (the shortest passage) the word end with the
least gear rolling hash of the last 16 bytes, among the ends that leave room for
a whole chunk.  Every window has a cut, whatever its words, and the cut depends
on nothing outside it, so two documents that share a window share its chunk.

Windows whose chunk two documents have are candidates; their digests are grouped,
and a document is compared with the first document (smallest doc_id) of each of
its windows.  So every window that an earlier document has is found: there is no
least number of cuts, and the first holder is that of the whole window, not of
its parts.  From the window the match is extended word by word in both
directions; matches of more than PASSAGE_WORDS words are repeated passages.  The
first document keeps its passage; later ones lose theirs.

The shared chunks are told to the tasks as a bitmap of 2**BITMAP_BITS bits; a
chunk that is in it by chance only adds candidates.

Words are split at ASCII white space and compared byte for byte, so passages
match across different line breaks.  Defined results: null, empty and short
texts have no passages; a row without doc_id is neither a source nor cut; rows
that share a doc_id are not compared with each other; a document that is left
without any word by the cut is dropped from the filtered documents.  Extra
columns pass through ``remove_passages`` untouched.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm.common import binaries, mix64, staged, table

PASSAGE_WORDS = 50        # a repeated passage has more words than this
WINDOW = PASSAGE_WORDS + 1
CHUNK_WORDS = 20          # words of a chunk
CUTS = WINDOW - CHUNK_WORDS + 1   # word ends of a window that can be its cut; a power of two
BITMAP_BITS = 25
BLOCK = 8 << 20           # bytes hashed at a time

GEAR = np.random.default_rng(10).integers(0, 2**32, 256, np.uint32)
RADIX = 0x9E3779B97F4A7C15              # odd, so it has an inverse modulo 2**64
INVERSE = pow(RADIX, -1, 2**64)


def gear_hash(data: bytes) -> np.ndarray:
    """h[i] = sum of GEAR[data[i - j]] << j over the last 16 bytes, by doubling."""
    h = GEAR[np.frombuffer(data, np.uint8)]
    for step in (1, 2, 4, 8):
        shifted = h[:-step] << np.uint32(step)
        h = h.copy()
        h[step:] += shifted
    return h


def word_hashes_at_ends(norm: bytes, ends: np.ndarray) -> np.ndarray:
    """Gear hashes at the last byte of each word, in bounded blocks."""
    if len(norm) <= BLOCK:
        return gear_hash(norm)[ends - 1]
    out = np.empty(len(ends), np.uint32)
    for at in range(0, len(norm), BLOCK):
        lo = max(0, at - 15)
        here = slice(np.searchsorted(ends, at, "right"), np.searchsorted(ends, at + BLOCK, "right"))
        out[here] = gear_hash(norm[lo:at + BLOCK])[ends[here] - 1 - lo]
    return out


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


@dataclass
class Words:
    """A text's words as hashes, with rolling digests of any run of them."""

    hashes: np.ndarray
    sums: np.ndarray      # sums[i]: words before i, each times RADIX to its place
    shift: np.ndarray     # inverse powers of RADIX
    gear: np.ndarray      # gear hash at each word's end

    @classmethod
    def of(cls, data: bytes | None) -> Words:
        words = (data or b"").split()
        n = len(words)
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * _powers(RADIX, n), out=sums[1:])
        if n < WINDOW:
            return cls(hashes, sums, _powers(INVERSE, n + 1), np.empty(0, np.uint32))
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        return cls(hashes, sums, _powers(INVERSE, n + 1), word_hashes_at_ends(b" ".join(words), ends))

    def runs(self, n: int) -> np.ndarray:
        """Digests of all runs of n words."""
        return mix64((self.sums[n:] - self.sums[:-n]) * self.shift[:len(self.sums) - n])

    def chunks(self) -> np.ndarray:
        """The digest of each window's chunk."""
        key = self.gear[CHUNK_WORDS - 1:].astype(np.uint64) << np.uint64(32) | self.runs(CHUNK_WORDS) >> np.uint64(32)
        step = 1
        while step < CUTS:
            key = np.minimum(key[:-step], key[step:])
            step *= 2
        return mix64(key)

    @cached_property
    def windows(self) -> np.ndarray:
        return self.runs(WINDOW) if len(self.hashes) >= WINDOW else np.empty(0, np.uint64)

    @cached_property
    def ordered(self) -> tuple[np.ndarray, np.ndarray]:
        """Window digests in order, and their places."""
        places = np.argsort(self.windows, kind="stable")
        return self.windows[places], places


def _digests(docs: DataFrame, of: Callable[[Words], np.ndarray]) -> DataFrame:
    """(digest, doc_id): the distinct digests that ``of`` makes of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made():
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(digests).view(np.int64)),
                                               pa.array(np.repeat(np.array(ids, np.int64), list(map(len, digests))))],
                                              names=["digest", "doc_id"])

        for batch in batches:
            digests, ids, n = [], [], 0
            for doc_id, data in zip(batch.column(0).to_pylist(), binaries(batch.column(1))):
                words = Words.of(data)
                if len(words.hashes) >= WINDOW:
                    digests.append(np.unique(of(words)))
                    ids.append(doc_id)
                    n += len(digests[-1])
                if n >= 200_000:
                    yield made()
                    digests, ids, n = [], [], 0
            if n:
                yield made()

    return (docs.select(F.col("doc_id").cast("long"), "text").filter("doc_id is not null")
            .mapInArrow(run, "digest long, doc_id long"))


def _shared(digests: DataFrame) -> DataFrame:
    """(digest, source_id) of the digests that several documents have."""
    return (digests.groupBy("digest").agg(F.min("doc_id").alias("source_id"), F.max("doc_id").alias("last"))
            .filter("source_id < last").drop("last"))


def shared_chunks(docs: DataFrame) -> np.ndarray:
    """Bitmap, by the low bits of the digest, of the chunks that several documents have."""
    bit = F.col("digest").bitwiseAND(2**BITMAP_BITS - 1)
    parts = (_shared(_digests(docs, Words.chunks)).select(F.shiftright(bit, 15).alias("part"), bit.bitwiseAND(2**15 - 1).alias("bit"))
             .groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).collect())     # at most 2**(BITMAP_BITS - 15) rows
    out = np.zeros((2**(BITMAP_BITS - 15), 2**12), np.uint8)
    for part, bits in parts:
        out[part] = np.frombuffer(bits, np.uint8)
    return out.reshape(-1)


def candidate_windows(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(digest, doc_id): the windows whose chunk several documents have."""
    shared = spark.sparkContext.broadcast(shared_chunks(docs))

    def candidates(words: Words) -> np.ndarray:
        at = words.chunks() & np.uint64(2**BITMAP_BITS - 1)
        return words.windows[(shared.value[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)]

    return _digests(docs, candidates)


def _reach(left: Words, a: int, right: Words, places: np.ndarray) -> tuple[int, int]:
    """The place in ``right`` from which the most words equal those of ``left``
    from ``a`` on, and their number."""

    def equal(at: int) -> int:
        n = min(len(left.hashes) - a, len(right.hashes) - at)
        differ = left.hashes[a:a + n] != right.hashes[at:at + n]
        return int(differ.argmax()) if differ.any() else n

    if len(places) == 1:
        return int(places[0]), equal(int(places[0]))
    low, high = np.zeros(len(places), np.int64), np.minimum(len(left.hashes) - a, len(right.hashes) - places)
    while (low < high).any():
        mid = (low + high + 1) // 2
        same = ((left.sums[a + mid] - left.sums[a]) * left.shift[a] ==
                (right.sums[places + mid] - right.sums[places]) * right.shift[places])
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
    best = int(low.argmax())
    at, n = int(places[best]), equal(int(places[best]))
    if n < low[best]:                                   # digests met by chance
        at, n = max(((p, equal(p)) for p in places.tolist()), key=lambda x: x[1])
    return at, n


def common_passages(left: Words, right: Words) -> list[tuple[int, int]]:
    """Word ranges of ``left`` of more than PASSAGE_WORDS words that also occur
    in ``right``, grown from shared windows; they cover every shared window."""
    digests, places = right.ordered
    low = np.searchsorted(digests, left.windows, "left")
    high = np.searchsorted(digests, left.windows, "right")
    spans: list[tuple[int, int]] = []
    done = 0
    for a in np.flatnonzero(low < high).tolist():
        if a + WINDOW <= done:
            continue
        at, n = _reach(left, a, right, places[low[a]:high[a]])
        if n < WINDOW:
            continue
        m = min(a, at)
        differ = (left.hashes[a - m:a] != right.hashes[at - m:at])[::-1]
        spans.append((a - (int(differ.argmax()) if differ.any() else m), a + n))
        done = a + n
    return spans


def repeated_passages(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, source_id, first_word, n_words, passage): every passage of a
    document that an earlier document also has; ``passage`` is its digest."""
    windows = staged(spark, candidate_windows(spark, docs), "chunk-windows")
    first = staged(spark, _shared(windows), "chunk-sources")  # a table: the join can then split a digest with very many rows
    pairs = windows.join(first, "digest").filter("doc_id > source_id").select("doc_id", "source_id").distinct()
    pairs = staged(spark, pairs, "chunk-pairs")
    # both joins read one exchange of the texts; merge joins at every size
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    sources = texts.withColumnsRenamed({"doc_id": "source_id", "text": "source_text"})
    both = pairs.join(texts.hint("merge"), "doc_id").join(sources.hint("merge"), "source_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: OrderedDict[int, tuple] = OrderedDict()
        for batch in batches:
            out: list[tuple] = []
            for doc_id, source_id, text, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                                       binaries(batch.column(2)), binaries(batch.column(3))):
                if source_id not in recent or recent[source_id][0] != source:
                    recent[source_id] = (source, Words.of(source))
                    if len(recent) > 16:
                        recent.popitem(last=False)
                left = Words.of(text)
                for a, b in common_passages(left, recent[source_id][1]):
                    out.append((doc_id, source_id, a, b - a, xxhash.xxh3_128_hexdigest(left.hashes[a:b].tobytes())))
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.string())],
                names=["doc_id", "source_id", "first_word", "n_words", "passage"])

    return (both.select("doc_id", "source_id", "text", "source_text")
            .mapInArrow(run, "doc_id long, source_id long, first_word long, n_words long, passage string").distinct())


def _without(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the word ranges; white space around the rest is kept."""
    raw = np.frombuffer(data, np.uint8)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    begins = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    keep = np.ones(len(raw), bool)
    for first, n in spans:
        stop = begins[first + n] if first + n < len(begins) else len(raw)
        keep[begins[first]:stop] = False
    return raw[keep].tobytes()


def remove_passages(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` without the passages that earlier documents have; ``n_chars``,
    if there, follows the text.  Documents without a repeated passage are unchanged."""
    spans = (repeated_passages(spark, docs).groupBy(F.col("doc_id").alias("__passage_doc"))
             .agg(F.sort_array(F.collect_set(F.struct("first_word", "n_words"))).alias("__passage_spans")))
    joined = (docs.hint("merge").join(spans, docs["doc_id"].cast("long") == spans["__passage_doc"], "left")
              .drop("__passage_doc"))

    @F.pandas_udf("string")
    def cut(texts, spans):
        return pd.Series([None if s is None else _without(t.encode(), [(x["first_word"], x["n_words"]) for x in s]).decode()
                          for t, s in zip(texts, spans)], dtype=object)

    # only texts that lose something go through Python
    out = joined.withColumn("__passage_cut", cut(F.when(F.col("__passage_spans").isNotNull(), F.col("text")), "__passage_spans"))
    out = out.filter(r"__passage_cut is null or __passage_cut rlike '[^\\x20\\x09-\\x0D]'")
    if "n_chars" in docs.columns:
        n = F.length("__passage_cut").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("__passage_cut").isNull(), F.col("n_chars")).otherwise(n))
    return out.withColumn("text", F.coalesce("__passage_cut", "text")).select(docs.columns)


def op10_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(spark, table(spark, sf_dir, "documents"))
