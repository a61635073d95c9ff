"""8. Toxicity by the nearest labelled examples.

Examples are the distinct texts of at most SAMPLE labelled documents (the first
by a hash of the id).  Terms are words and their first 3 to 6 letters; every term
of every example is indexed.  A document is its TF-IDF vector over the terms of
the examples, counted over its whole text; a term weighs more the more surely it
comes with the label (the lower bound of its log odds ratio), and FLOOR at least,
so that texts without a telling term still have their nearest examples.

Neighbours are exact: postings hold every example of a term; frequent terms also
have the largest weight of each block of BLOCK examples.  The sum over a text's
rare terms is taken for all examples at once, and with the block maxima of the
frequent terms it bounds every cosine in a block; the blocks of the largest bounds
are scored first, then those whose bound reaches the K-th best cosine.  Neighbours vote with weight 1 / (0.1 + 1 - cosine); votes become
probabilities by a monotone fit (pool adjacent violators) on the examples' own
votes, each without itself.  A document that shares no term with any example has
no neighbours; its score is the share of toxic documents among the examples.

Defined results: a null or empty text has no terms; labels that are null are
left out, of repeated ones the larger counts; rows without doc_id teach nothing;
of rows that share a doc_id one text teaches (the smallest by hash), and all are
scored one by one; equal texts are one example, toxic if one of them is; with no
labels every score is 0.  Labels, lang, source and doc_id are no inputs of a score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm.common import ALNUM_WORDS, binaries, held_out, staged, table, word_lists

SAMPLE = 4096             # labelled documents
PREFIXES = (3, 4, 5, 6)   # letters
FLOOR = 0.02              # weight of a term that says nothing about the label
SURE = 4.0                # standard errors taken off a log odds ratio
FREQUENT = 8              # a term in more than one in so many examples has block maxima
BLOCK = 64
STEP = 8                  # blocks scored before the bounds are looked at
QUERIES = 64              # texts searched at once
K = 16
THRESHOLD = 0.3
WORD_CACHE = 400_000


def word_terms(word: bytes) -> list[str]:
    text = word.decode()
    return [text, *("^" + text[:n] for n in PREFIXES if len(text) >= n)]


def word_counts(data: bytes | None) -> Counter:
    out: Counter = Counter()
    for words in word_lists(data or b"", ALNUM_WORDS):
        out.update(words)
    return out


class TermIds(dict):
    """Word to the ids of its indexed terms; emptied when full."""

    def __init__(self, vocabulary: dict[str, int]):
        self.vocabulary = vocabulary

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= WORD_CACHE:
            self.clear()
        ids = self[word] = tuple(self.vocabulary[t] for t in word_terms(word) if t in self.vocabulary)
        return ids


def term_counts(data: bytes | None, terms: TermIds) -> tuple[np.ndarray, np.ndarray]:
    """Sorted ids of a text's indexed terms, and how often it has each."""
    words = word_counts(data)
    own = [terms[w] for w in words]
    sizes = list(map(len, own))
    ids = np.fromiter(chain.from_iterable(own), np.int64, sum(sizes))
    if not len(ids):
        return ids, np.empty(0)
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    counts = np.repeat(np.fromiter(words.values(), np.int64, len(sizes)), sizes)
    return ids[first], np.add.reduceat(counts[order], first).astype(float)


def unit(ids: np.ndarray, counts: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """TF-IDF weights of length one."""
    w = (1 + np.log(counts)) * weight[ids]
    return w / max(np.sqrt((w * w).sum()), 1e-300)


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ..., then those of start[1], and so on."""
    ends = np.cumsum(length)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + length, length)


def build_index(rows: list[tuple[np.ndarray, np.ndarray]], n_terms: int) -> dict[str, np.ndarray]:
    """Of example vectors (ids, weights): postings by rare term, and for frequent
    terms the weights by block and their block maxima."""
    n = len(rows)
    blocks = -(-n // BLOCK)
    terms = np.concatenate([r[0] for r in rows] or [np.empty(0, np.int64)])
    weights = np.concatenate([r[1] for r in rows] or [np.empty(0)])
    examples = np.repeat(np.arange(n, dtype=np.int32), [len(r[0]) for r in rows])
    row = np.full(n_terms, -1, np.int64)                   # dense row of a frequent term
    frequent = np.flatnonzero(np.bincount(terms, minlength=n_terms) > n / FREQUENT) if n > BLOCK else np.empty(0, np.int64)
    row[frequent] = np.arange(len(frequent))
    dense = np.zeros((blocks, len(frequent), BLOCK))
    of = row[terms]
    on = of >= 0
    dense[examples[on] // BLOCK, of[on], examples[on] % BLOCK] = weights[on]
    terms, weights, examples = terms[~on], weights[~on], examples[~on]
    order = np.argsort(terms, kind="stable")
    return {"n": np.int64(n), "start": np.concatenate([[0], np.cumsum(np.bincount(terms, minlength=n_terms))]),
            "examples": examples[order], "weights": weights[order], "row": row, "dense": dense,
            "maxima": dense.max(2).T.copy() if n else np.zeros((0, 0))}


def nearest(index: dict[str, np.ndarray], queries: list[tuple[np.ndarray, np.ndarray]], k: int = K,
            without: list[int] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query (sorted ids, weights): examples and cosines of the k nearest
    with a positive cosine; of equal cosines the first examples."""
    n, m = int(index["n"]), len(queries)
    blocks = -(-n // BLOCK)
    if not m or not n:
        return [(np.empty(0, np.int64), np.empty(0))] * m
    sums = np.zeros((m, blocks * BLOCK))
    often = np.zeros((m, index["maxima"].shape[0]))
    for q, (ids, w) in enumerate(queries):
        row = index["row"][ids]
        rare = row < 0
        often[q, row[~rare]] = w[~rare]
        start = index["start"][ids[rare]]
        length = index["start"][ids[rare] + 1] - start
        at = ranges(start, length)
        sums[q] = np.bincount(index["examples"][at], index["weights"][at] * np.repeat(w[rare], length), minlength=blocks * BLOCK)
    sums = sums.reshape(m, blocks, BLOCK)
    bounds = (sums.max(2) + often @ index["maxima"]) * (1 + 1e-9)
    if without is not None:
        sums[np.arange(m), np.array(without) // BLOCK, np.array(without) % BLOCK] = -np.inf
    scores = np.full((m, blocks, BLOCK), -np.inf)
    kth = np.zeros(m)
    waiting = np.ones((m, blocks), bool)
    first = np.zeros((m, blocks), bool)
    np.put_along_axis(first, np.argsort(-bounds, 1, kind="stable")[:, :STEP], True, 1)
    for chosen in (first, waiting):                        # the best blocks, then all that may still matter
        for b in np.argsort(-bounds.max(0), kind="stable").tolist():
            on = np.flatnonzero(chosen[:, b] & waiting[:, b] & (bounds[:, b] > 0) & (bounds[:, b] >= kth))
            if len(on):
                scores[on, b] = np.round(sums[on, b] + often[on] @ index["dense"][b], 9)
                waiting[on, b] = False
        if k < n:
            kth = np.maximum(0, np.partition(scores.reshape(m, -1), -k, 1)[:, -k])
    out = []
    for q, row in enumerate(scores.reshape(m, -1)):
        found = np.flatnonzero((row > 0) & (row >= kth[q]))
        found = found[np.lexsort((found, -row[found]))][:k]
        out.append((found, row[found]))
    return out


def vote(cosines: np.ndarray, labels: np.ndarray) -> float:
    weight = 1 / (0.1 + np.maximum(0, 1 - cosines))
    return float((weight * labels).sum() / weight.sum())


def monotone(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: points of a rising step function through (x, y),
    each level smoothed by one toxic and one clean example."""
    levels: list[list[float]] = []                     # sum, count, first x
    for a, b in sorted(zip(x.tolist(), y.tolist())):
        levels.append([b, 1, a])
        while len(levels) > 1 and (levels[-2][2] == levels[-1][2] or
                                   levels[-2][0] / levels[-2][1] >= levels[-1][0] / levels[-1][1]):
            s, n, _ = levels.pop()
            levels[-1][0] += s
            levels[-1][1] += n
    level = np.array([(s + 1) / (n + 2) for s, n, _ in levels])
    return np.array([v[2] for v in levels]), np.maximum.accumulate(level)


def term_weights(n: np.ndarray, toxic: np.ndarray, n_docs: int, n_toxic: int) -> np.ndarray:
    """Inverse document frequency times FLOOR plus the lower bound of the log odds
    ratio, for terms in ``n`` examples of which ``toxic`` are toxic."""
    cells = [toxic + 0.5, n - toxic + 0.5, n_toxic - toxic + 0.5, n_docs - n - n_toxic + toxic + 0.5]
    odds = np.log(cells[0] / cells[1]) - np.log(cells[2] / cells[3])
    error = np.sqrt(sum(1 / c for c in cells))
    return (np.log((1 + n_docs) / (1 + n)) + 0.1) * (FLOOR + np.maximum(0, odds - SURE * error))


def _examples(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, toxic, terms, counts) of the distinct texts of at most SAMPLE labelled documents."""
    known = (labels.filter("toxic is not null and doc_id is not null").select(F.col("doc_id").cast("long"), "toxic")
             .filter(~held_out()).groupBy("doc_id").agg(F.max("toxic").cast("long").alias("toxic"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE))
    one = (docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
           .join(F.broadcast(known), "doc_id")                                              # at most SAMPLE ids
           .groupBy("doc_id", "toxic").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("d"))
           .groupBy("d.hash", "d.text").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for data in binaries(batch.column(2)):
                terms: Counter = Counter()
                for word, n in word_counts(data).items():
                    for t in word_terms(word):
                        terms[t] += n
                made.append(terms)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([list(t) for t in made], pa.list_(pa.string())),
                pa.array([list(t.values()) for t in made], pa.list_(pa.int64()))], names=["doc_id", "toxic", "terms", "counts"])

    return staged(spark, one.select("doc_id", "toxic", "text").mapInArrow(
        run, "doc_id long, toxic long, terms array<string>, counts array<long>"), "toxic-examples")


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> dict:
    """The model: the examples as plain arrays, broadcast (bounded by SAMPLE
    documents), and the calibration of their votes."""
    collected = _examples(spark, docs, labels).orderBy("doc_id").toArrow().combine_chunks()  # at most SAMPLE rows
    lists = collected["terms"].combine_chunks() if collected.num_rows else pa.array([], pa.list_(pa.string()))
    names = lists.flatten().dictionary_encode()
    counts = collected["counts"].combine_chunks().flatten().to_numpy() if collected.num_rows else np.empty(0, np.int64)
    toxic = np.array(collected["toxic"].to_pylist(), np.int64)
    base = float(toxic.mean()) if len(toxic) else 0.0
    shared = spark.sparkContext.broadcast({
        "terms": names.dictionary.to_pylist(), "ids": names.indices.to_numpy().astype(np.int32),
        "counts": counts.astype(np.min_scalar_type(int(counts.max(initial=0)))),
        "sizes": lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64), "toxic": toxic,
        "doc_ids": np.array(collected["doc_id"].to_pylist(), np.int64), "base": base})
    model = {"examples": shared, "steps": np.zeros(1), "levels": np.full(1, base)}
    if 0 < base < 1:
        votes = _own_votes(spark, shared, len(toxic))
        if votes:
            model["steps"], model["levels"] = monotone(*(np.array(v) for v in zip(*votes)))
    return model


def searchable(m: dict) -> dict:
    """Adds weights, index and term ids to the broadcast examples, once
    in a worker."""
    if "index" not in m:
        n_terms, toxic = len(m["terms"]), m["toxic"]
        weight = term_weights(np.bincount(m["ids"], minlength=n_terms),
                              np.bincount(m["ids"], np.repeat(toxic, m["sizes"]), minlength=n_terms), len(toxic), int(toxic.sum()))
        m["weight"], m["lookup"] = weight, TermIds({t: i for i, t in enumerate(m["terms"])})
        ends = np.cumsum(m["sizes"])
        m["index"] = build_index([example_vector(m, e, ends) for e in range(len(toxic))], n_terms)
    return m


def example_vector(m: dict, e: int, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    part = slice(int(ends[e] - m["sizes"][e]), int(ends[e]))
    order = np.argsort(m["ids"][part])
    own = m["ids"][part][order].astype(np.int64)
    return own, unit(own, m["counts"][part][order].astype(float), m["weight"])


def _own_votes(spark: SparkSession, shared, n: int) -> list[tuple[float, int]]:
    """Each example's vote without itself, and its label: searched in tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = searchable(shared.value)
        ends = np.cumsum(m["sizes"])
        for batch in batches:
            own = batch.column(0).to_pylist()
            out = []
            for at in range(0, len(own), QUERIES):
                part = own[at:at + QUERIES]
                near = nearest(m["index"], [example_vector(m, e, ends) for e in part], without=part)
                out += [(vote(c, m["toxic"][f]), int(m["toxic"][e])) for e, (f, c) in zip(part, near) if len(f)]
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.float64()),
                                              pa.array([o[1] for o in out], pa.int64())], names=["raw", "toxic"])

    parts = max(1, min(16, n // 256))
    return [(r[0], r[1]) for r in spark.range(0, n, 1, parts)
            .mapInArrow(run, "raw double, toxic long").collect()]                           # at most SAMPLE rows


def score_toxicity(spark: SparkSession, docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, held_out, score, predicted, neighbours) for every row of ``docs``."""
    shared, steps, levels = model["examples"], model["steps"], model["levels"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = searchable(shared.value)
        for batch in batches:
            scores, neighbours = [], []
            for at in range(0, batch.num_rows, QUERIES):
                counted = [term_counts(data, m["lookup"]) for data in binaries(batch.column(2).slice(at, QUERIES))]
                queries = [(ids, unit(ids, counts, m["weight"])) for ids, counts in counted]
                for found, cosines in nearest(m["index"], queries):
                    score, near = m["base"], []
                    if len(found):
                        step = np.searchsorted(steps, vote(cosines, m["toxic"][found]), "right") - 1
                        score, near = float(levels[max(0, step)]), m["doc_ids"][found].tolist()
                    scores.append(score)
                    neighbours.append(near)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(scores, pa.float64()),
                pa.array([int(s >= THRESHOLD) for s in scores], pa.int32()), pa.array(neighbours, pa.list_(pa.int64()))],
                names=["doc_id", "held_out", "score", "predicted", "neighbours"])

    return (docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), "text")
            .mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, neighbours array<long>"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(spark, docs, fit(spark, docs, table(spark, sf_dir, "labels")))
