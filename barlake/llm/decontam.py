"""1. Benchmark decontamination over a distributed positional inverted index.

``build_index`` reads the documents once and writes postings: one row per
(segment, term) with the term's positions in the segment, and one directory
row per segment (``term`` is NULL) with its documents.  A segment is a bounded
run of whole documents of one task; neighbouring documents are one position
apart, so no match can cross them.

``search`` looks for every window (``n`` consecutive words of an item, or the
whole item if it is shorter) in every segment: it takes the positions of the
window's rarest term, subtracts the term's offset, and intersects this list of
starts with the offset-adjusted lists of the next rarest terms until it is
empty or all terms are used up.  ``slop`` adds proximity matches: places where
every term of the window lies at most ``n + slop`` words from an occurrence of
its rarest term, in the same document.

Defined results: a null or empty text has no words; an item without words has
no windows; an item whose id is null counts in hits but is never listed;
repeated documents and items are each searched; an empty benchmark hits
nothing; columns other than the id and the text are ignored.  In
``remove_contaminated`` rows that share a doc_id (null included) share its
decision.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm.common import ALNUM_WORDS, binaries, staged, table, word_lists

WINDOW = 13
SEGMENT_WORDS = 1_000_000
#: Words of the benchmark that one search may hold; a larger one is searched in blocks of items.
BLOCK_WORDS = 2_000_000

INDEX_SCHEMA = "segment long, term binary, positions array<int>, doc_ids array<long>, lengths array<int>"
HITS_SCHEMA = ("segment long, doc_no int, doc_id long, n_words long, n_hit long, n_near long, "
               "items array<long>, hits array<int>")


def build_index(docs: DataFrame, terms: frozenset[bytes] | None = None, segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """Postings of ``docs`` (doc_id, text), written to a table; only those of
    ``terms``, if given."""

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        if terms is not None:
            known = {t: i for i, t in enumerate(sorted(terms))}
        base = TaskContext.get().partitionId() << 32
        n = 0
        vocab, ids, doc_ids, lengths = dict(known), [], [], []

        def flush() -> pa.RecordBatch:
            nonlocal n
            lens = np.array(lengths, np.int64)
            # one free position after each document
            pos = np.arange(lens.sum(), dtype=np.int64) + np.repeat(np.arange(len(lens)), lens)
            words = np.concatenate(ids) if ids else np.empty(0, np.int32)
            keep = words >= 0
            words, pos = words[keep], pos[keep].astype(np.int32)
            order = np.argsort(words, kind="stable")
            words, pos = words[order], pos[order]
            used, first = np.unique(words, return_index=True)
            names = np.array(list(vocab), object)[used] if len(used) else []
            k = len(used)
            ends = np.append(first, len(pos)).astype(np.int32)
            empty = pa.array([None] * k, pa.list_(pa.int64()))
            out = pa.RecordBatch.from_arrays([
                pa.array([base + n] * (k + 1), pa.int64()),
                pa.array([*names, None], pa.binary()),
                pa.concat_arrays([pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(pos, pa.int32())),
                                  pa.array([None], pa.list_(pa.int32()))]),
                pa.concat_arrays([empty, pa.array([doc_ids], pa.list_(pa.int64()))]),
                pa.array([None] * k + [lengths], pa.list_(pa.int32())),
            ], names=["segment", "term", "positions", "doc_ids", "lengths"])
            n += 1
            vocab.clear()
            vocab.update(known)
            ids.clear(), doc_ids.clear(), lengths.clear()
            return out

        size = 0
        grow = defaultdict(None, vocab)
        grow.default_factory = grow.__len__
        for batch in batches:
            for doc_id, data in zip(batch.column(0).to_pylist(), binaries(batch.column(1))):
                count = 0
                for words in word_lists(data or b"", ALNUM_WORDS):
                    if terms is None:
                        ids.append(np.fromiter(map(grow.__getitem__, words), np.int32, len(words)))
                    else:
                        ids.append(np.fromiter((known.get(w, -1) for w in words), np.int32, len(words)))
                    count += len(words)
                doc_ids.append(doc_id)
                lengths.append(count)
                size += count + 1
                if size >= segment_words:
                    vocab = dict(grow) if terms is None else vocab
                    yield flush()
                    grow.clear()
                    size = 0
        if lengths:
            vocab = dict(grow) if terms is None else vocab
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(segments, INDEX_SCHEMA)
    return staged(docs.sparkSession, rows, "postings")


def items_of(benchmark: DataFrame) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """The benchmark's items as words, in blocks of at most BLOCK_WORDS words
    (or one item); the driver holds one block at a time."""
    block, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("long"), F.col("text")).toLocalIterator():
        words = [w for part in word_lists((row[1] or "").encode(), ALNUM_WORDS) for w in part]
        if not words:
            continue
        if block and size + len(words) > BLOCK_WORDS:
            yield block
            block, size = [], 0
        block.append((row[0], words))
        size += len(words)
    yield block


def windows_of(items: list[tuple[int | None, list[bytes]]], n: int) -> dict[tuple[bytes, ...], set[int | None]]:
    """Distinct windows and the items that hold them."""
    out: dict[tuple[bytes, ...], set[int | None]] = {}
    for item_id, words in items:
        for i in range(max(1, len(words) - n + 1)):
            out.setdefault(tuple(words[i:i + n]), set()).add(item_id)
    return out


def _within(starts: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Mask of ``starts`` that are in the sorted ``positions``."""
    at = np.searchsorted(positions, starts)
    at[at == len(positions)] = 0
    return positions[at] == starts


def phrase_starts(window: tuple, order: list[int], postings: dict) -> np.ndarray | None:
    """Intersect offset-adjusted posting lists, rarest term first."""
    starts = None
    for i in order:
        positions = postings.get(window[i])
        if positions is None:
            return None
        if starts is None:
            starts = positions - i
        else:
            starts = starts[_within(starts + i, positions)]
        if not len(starts):
            return None
    return starts


def near_places(window: tuple, order: list[int], postings: dict, span: int, bounds: np.ndarray) -> np.ndarray | None:
    """Positions of the rarest term with every other term at most ``span`` words
    away in the same document; ``bounds`` are the documents' first positions."""
    anchor = postings.get(window[order[0]])
    for i in order[1:]:
        other = postings.get(window[i])
        if anchor is None or other is None or not len(anchor):
            return None
        doc = np.searchsorted(bounds, anchor, "right")
        lo = np.maximum(anchor - span, bounds[doc - 1])
        last = np.append(bounds[1:], np.iinfo(np.int32).max)[doc - 1] - 1
        hi = np.minimum(anchor + span, last)
        anchor = anchor[np.searchsorted(other, hi, "right") > np.searchsorted(other, lo, "left")]
    return anchor


def _search_block(index: DataFrame, items: list, n: int, slop: int | None) -> DataFrame:
    windows = windows_of(items, n)
    vocab = {w for window in windows for w in window}
    spark = index.sparkSession
    terms = spark.createDataFrame([(bytearray(w),) for w in vocab], "term binary")
    found = index.filter(F.col("term").isNotNull()).join(F.broadcast(terms), "term", "left_semi")   # at most BLOCK_WORDS
    freq = {bytes(r[0]): r[1] for r in
            found.groupBy("term").agg(F.sum(F.size("positions"))).collect()} if vocab else {}
    # a window with a term that no document holds can't occur
    plan = [(w, sorted(range(len(w)), key=lambda i: (freq[w[i]], i)), sorted(owners, key=str))
            for w, owners in windows.items() if all(t in freq for t in w)]
    shared = spark.sparkContext.broadcast(plan)

    def search_segment(key, rows):
        postings, directory = {}, None
        for term, positions, doc_ids, lengths in zip(rows["term"], rows["positions"], rows["doc_ids"], rows["lengths"]):
            if term is None:
                directory = (doc_ids, lengths)
            else:
                postings[bytes(term)] = np.asarray(positions, np.int64)
        lens = np.asarray(directory[1], np.int64)
        bounds = np.concatenate([[0], np.cumsum(lens + 1)])
        hit = np.zeros(bounds[-1] + 1, np.int8)
        owners: dict[int, set] = defaultdict(set)
        near = np.zeros(len(lens), np.int64)
        for window, order, ids in shared.value:
            starts = phrase_starts(window, order, postings)
            docs = ()
            if starts is not None:
                for i in range(len(window)):
                    hit[starts + i] = 1
                docs = np.unique(np.searchsorted(bounds, starts, "right") - 1)
                for d in docs:
                    owners[int(d)].update(ids)
            if slop is not None:
                places = near_places(window, order, postings, n + slop, bounds[:-1])
                if places is not None and len(places):
                    close = np.unique(np.searchsorted(bounds, places, "right") - 1)
                    near[np.setdiff1d(close, docs)] += 1
        total = np.concatenate([[0], np.cumsum(hit)])
        n_hit = total[bounds[1:]] - total[bounds[:-1]]
        return pd.DataFrame({
            "segment": key[0], "doc_no": np.arange(len(lens), dtype=np.int32),
            "doc_id": pd.array([None if d is None or d != d else int(d) for d in directory[0]], "Int64"),
            "n_words": lens, "n_hit": n_hit, "n_near": near,
            "items": [sorted(i for i in owners.get(d, ()) if i is not None) for d in range(len(lens))],
            "hits": [np.flatnonzero(hit[a:b]).astype(np.int32) if h else np.empty(0, np.int32)
                     for a, b, h in zip(bounds[:-1], bounds[1:], n_hit)],
        })

    return (found.unionByName(index.filter(F.col("term").isNull()))
            .groupBy("segment").applyInPandas(search_segment, HITS_SCHEMA))


def search(index: DataFrame, blocks: Iterable[list], n: int = WINDOW, slop: int | None = None) -> DataFrame:
    """One row per indexed document: words, hit words and their places, items
    with an occurring window, and (with ``slop``) windows only met nearby."""
    parts = [_search_block(index, block, n, slop) for block in blocks]
    out = parts[0]
    if len(parts) > 1:
        for p in parts[1:]:
            out = out.unionByName(p)
        out = (out.groupBy("segment", "doc_no").agg(
            F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.sum("n_near").alias("n_near"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
            F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits"))
            .withColumn("n_hit", F.size("hits").cast("long")))
    return out


def contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, n: int = WINDOW,
                  slop: int | None = None) -> DataFrame:
    """Index ``docs``, search the whole benchmark, and judge each document:
    contaminated if it has a hit word and at least one word in 20 is hit."""
    blocks = items_of(benchmark)
    head = list(islice(blocks, 2))
    # one block of items: only its terms need postings; more: index every term once
    terms = frozenset(w for _, words in head[0] for w in words) if len(head) == 1 else None
    index = build_index(docs, terms)
    names = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return search(index, chain(head, blocks), n, slop).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        "items", "n_near")


def remove_contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose document is not contaminated, all columns kept."""
    bad = (contamination(spark, docs, benchmark).filter("contaminated")
           .select(F.col("doc_id").alias("_bad_id")).distinct())
    return docs.hint("merge").join(bad, docs["doc_id"].eqNullSafe(bad["_bad_id"]), "left_anti")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items", "n_near")


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP1_SQL = f"""
with d as (select row_number() over () as r, doc_id, coalesce({_WORDS}, []) as w from documents),
b as (select item_id, {_WORDS} as w from benchmark where text is not null),
win as (select distinct item_id, len(x) as n, array_to_string(x, ' ') as g from (
  select item_id, unnest([w[i:i + 12] for i in range(1, greatest(1, len(w) - 12) + 1)]) as x from b where len(w) > 0)),
lens as (select distinct n from win),
pos as (select r, n, i, array_to_string(w[i:i + n - 1], ' ') as g from (
  select r, n, w, unnest(range(1, len(w) - n + 2)) as i from d, lens where len(w) >= n)),
m as (select r, i, pos.n, item_id from pos join win on pos.g = win.g and pos.n = win.n),
hit as (select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + n)) as p from m) group by r),
it as (select r, count(distinct item_id) as n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as s
       from m group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(s, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join hit using (r) left join it using (r)
"""
