"""7. MinHash near-dedup with odd sketches.

Each text becomes its set of distinct 5-word shingles (64-bit hashes).  Texts
with one set are collapsed to a representative.  128 MinHash samples give 32
bands of 4 rows: a pair at similarity 0.75 shares a band with probability
1 - (1 - 0.75^4)^32 = 0.999995.  The samples, folded into a 512-bit parity bitmap (odd
sketch), estimate the similarity of a candidate pair from the bits by which the
two bitmaps differ; pairs whose estimate lies six standard deviations below the
threshold are let go, all others are confirmed on their full sets.

Candidates without all pairs of a bucket: the bucket's smallest member is
compared with every other one, and members that end in one component need no
further comparison.  Buckets that still hold several components go to tasks as a
whole (a large one in blocks, each pair of blocks a task), and there every pair
across components is tested, by odd sketch and then on its full sets, in the first
band it shares, until the two are connected; a task returns a spanning edge per
link that joins two components, never its pairs.  A shingle that no other candidate
text has can't be shared, so the number of a text's other shingles bounds every
intersection; texts and pairs whose bound stays below the threshold are left out,
which spares large families of loosely related texts most tests.  No other pair that
shares a band is skipped, unless its two documents are already connected.

Defined results: null, empty and white-space texts have no shingles and are
linked with nothing; fewer than five words are one shingle; rows that share a
doc_id are one document, linked with all that any of its texts is linked with; a
row without doc_id is linked with nothing, its
component is null and it is kept.  Other columns are ignored.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm.common import SPACED_WORDS, binaries, mix64, staged, table, word_lists
from barlake.llm.components import connected_components

SHINGLE = 5
PERCENT = 75              # links: 100 * intersection >= PERCENT * union
ROWS, BANDS = 4, 32
SAMPLES = ROWS * BANDS
SKETCH_BITS = 512
SIGMAS = 6
BLOCK = 4096              # texts of a bucket that one task takes from each side
BLOCK_BYTES = 32 << 20    # ... and the bytes of these, about
HELD_SHINGLES = 8 << 20   # shingles of full sets that a task holds
GROUP = 4096              # entries of small buckets that share a task

WORD_CACHE = 400_000
_rng = np.random.default_rng(7)
MULTIPLIERS = _rng.integers(0, 2**64, SAMPLES, np.uint64) | np.uint64(1)
OFFSETS = _rng.integers(0, 2**64, SAMPLES, np.uint64)
PRIME = np.uint64(0x9E3779B97F4A7C15)

SKETCH_SCHEMA = "doc_id long, print long, size long, n_shingles long, digest binary, bands array<long>, odd array<long>"


class WordHashes(dict):
    """Word to 64-bit hash; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(data: bytes | None, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    if not data:
        return np.empty(0, np.uint64)
    parts = [np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)) for words in word_lists(data, SPACED_WORDS)]
    words = parts[0] if len(parts) == 1 else np.concatenate(parts)
    if not len(words):
        return words
    width = min(SHINGLE, len(words))
    n = len(words) - width + 1
    out = np.full(n, width, np.uint64)
    for j in range(width):
        out *= PRIME
        out += words[j:j + n]
    return np.unique(mix64(out))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash samples, one row per (non-empty) set."""
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), SAMPLES), np.uint64)
    for i in range(SAMPLES):
        out[:, i] = np.minimum.reduceat(flat * MULTIPLIERS[i] + OFFSETS[i], starts)
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    rows = mix64(samples).reshape(len(samples), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(samples), BANDS)).copy()
    for j in range(ROWS):
        key = mix64(key * PRIME + rows[:, :, j])
    return key.view(np.int64)


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps: each sample flips one bit."""
    n = len(samples)
    bit = (mix64(samples + np.arange(SAMPLES, dtype=np.uint64) * PRIME) % np.uint64(SKETCH_BITS)).astype(np.int64)
    counts = np.zeros((n, SKETCH_BITS), np.uint8)
    np.add.at(counts, (np.repeat(np.arange(n), SAMPLES), bit.ravel()), 1)
    return np.packbits(counts & 1, axis=1).view(np.int64)


def differing_bits_limit() -> float:
    """Most differing bits of two odd sketches at the threshold, plus SIGMAS deviations."""
    p, n = 1 - PERCENT / 100, SKETCH_BITS
    changed, spread = 2 * SAMPLES * p, 2 * np.sqrt(SAMPLES * p * (1 - p))
    return n / 2 * (1 - (1 - 2 / n) ** (changed + SIGMAS * spread)) + SIGMAS * np.sqrt(n) / 4


def sketch(docs: DataFrame) -> DataFrame:
    """One row per document: hash of the text, set size, set digest, band keys, odd sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()

        def rows(ids, prints, sizes, sets):
            full = [s for s in sets if len(s)]
            samples = signatures(full) if full else np.empty((0, SAMPLES), np.uint64)
            keys, odd = iter(band_keys(samples).tolist()), iter(odd_sketches(samples).tolist())
            return pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(prints, pa.int64()), pa.array(sizes, pa.int64()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                pa.array([next(keys) if len(s) else None for s in sets], pa.list_(pa.int64())),
                pa.array([next(odd) if len(s) else None for s in sets], pa.list_(pa.int64())),
            ], names=["doc_id", "print", "size", "n_shingles", "digest", "bands", "odd"])

        for batch in batches:
            ids, prints, sizes, sets, size = [], [], [], [], 0
            for doc_id, data, mark in zip(batch.column(0).to_pylist(), binaries(batch.column(1)), batch.column(2).to_pylist()):
                ids.append(doc_id)
                prints.append(mark)
                sizes.append(len(data or b""))
                sets.append(shingle_set(data, hashes))
                size += len(sets[-1])
                if size >= 100_000 or len(ids) >= 1000:
                    yield rows(ids, prints, sizes, sets)
                    ids, prints, sizes, sets, size = [], [], [], [], 0
            if ids:
                yield rows(ids, prints, sizes, sets)

    return docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("print")).mapInArrow(run, SKETCH_SCHEMA)


def similarity(pairs: DataFrame) -> DataFrame:
    """``pairs(a, b, text_a, text_b)`` to (a, b, common, total): sizes of the
    intersection and the union of the full shingle sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, recent = WordHashes(), OrderedDict()
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            common, total = [], []
            for key, left, right in zip(a, binaries(batch.column(2)), binaries(batch.column(3))):
                if key not in recent or recent[key][0] != left:
                    recent[key] = (left, shingle_set(left, hashes))
                    if len(recent) > 16:
                        recent.popitem(last=False)
                x, y = recent[key][1], shingle_set(right, hashes)
                n = len(np.intersect1d(x, y, assume_unique=True))
                common.append(n)
                total.append(len(x) + len(y) - n)
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in (a, b, common, total)],
                                             names=["a", "b", "common", "total"])

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long, common long, total long")


def shared_counts(texts: DataFrame) -> DataFrame:
    """(cls, own): the number of a text's shingles that no other has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            ids, sets, size = [], [], 0
            for cls, data in zip(batch.column(0).to_pylist(), binaries(batch.column(1))):
                sets.append(shingle_set(data, hashes).view(np.int64))
                ids.append(np.full(len(sets[-1]), cls))
                size += len(sets[-1])
                if size >= 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v)) for v in (sets, ids)], names=["shingle", "cls"])
                    ids, sets, size = [], [], 0
            if size:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v)) for v in (sets, ids)], names=["shingle", "cls"])

    rows = texts.select("cls", "text").mapInArrow(run, "shingle long, cls long")
    return (rows.groupBy("shingle").agg(F.min("cls").alias("cls"), F.max("cls").alias("last")).filter("cls = last")
            .groupBy("cls").agg(F.count("*").alias("own")))


def _possible(n_a, shared_a, n_b, shared_b):
    """Whether two sets can reach the threshold."""
    most = F.least(shared_a, shared_b)
    return 100 * most >= PERCENT * (n_a + n_b - most)


def _confirm(spark: SparkSession, pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) of doc_ids among ``pairs`` of texts: odd sketches first, then
    full sets.  Both joins read one exchange of ``texts(cls, rep, odd, text)``."""
    left = texts.select(F.col("cls").alias("cls_a"), F.col("rep").alias("a"), F.col("odd").alias("odd_a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("cls").alias("cls_b"), F.col("rep").alias("b"), F.col("odd").alias("odd_b"), F.col("text").alias("text_b"))
    both = pairs.join(right, "cls_b").join(left, "cls_a")
    bits = sum((F.bit_count(F.col("odd_a")[i].bitwiseXOR(F.col("odd_b")[i])) for i in range(SKETCH_BITS // 64)), F.lit(0))
    close = both.filter(bits <= differing_bits_limit())
    links = similarity(close).filter(100 * F.col("common") >= PERCENT * F.col("total")).select("a", "b")
    return staged(spark, links, "minhash-links")


def link_bucket(rows: dict[str, np.ndarray], key: int, whole: bool, shingles) -> Iterator[tuple[int, int]]:
    """Spanning edges, as pairs of rows, of the links between the components of one
    bucket (or, unless ``whole``, between two of its blocks).  ``shingles(row)`` is
    a row's full set."""
    order = np.argsort(rows["comp"], kind="stable")
    comp, n, shared, side = (rows[c][order] for c in ("comp", "n", "shared", "side"))
    bands, odd = rows["bands"][order], rows["odd"][order]
    found, number = np.unique(comp, return_inverse=True)
    root = np.arange(len(found))            # every component's root; few, so unions rename
    behind = np.searchsorted(comp, comp, "right")
    limit = differing_bits_limit()
    for i in range(len(order)):
        j = np.arange(behind[i], len(order))
        j = j[root[number[j]] != root[number[i]]]
        if not whole:
            j = j[side[j] != side[i]]
        most = np.minimum(shared[i], shared[j])
        j = j[100 * most >= PERCENT * (n[i] + n[j] - most)]
        j = j[np.bitwise_count(odd[j] ^ odd[i]).sum(1) <= limit]
        j = j[bands[i][(bands[j] == bands[i]).argmax(1)] == key]        # the first band they share
        for k in j.tolist():
            if root[number[i]] == root[number[k]]:
                continue
            x, y = shingles(order[i]), shingles(order[k])
            if len(x) > len(y):
                x, y = y, x
            common = int((y[np.searchsorted(y, x).clip(max=len(y) - 1)] == x).sum())
            if 100 * common >= PERCENT * (len(x) + len(y) - common):
                root[root == root[number[k]]] = root[number[i]]
                yield int(order[i]), int(order[k])


def open_links(placed: DataFrame) -> DataFrame:
    """Spanning edges (a, b) of all buckets that hold several components."""

    def run(table):
        table = table.sort_by([(c, "ascending") for c in ("key", "s", "t", "rep", "cls")])
        rows = {c: table[c].to_numpy() for c in ("key", "s", "t", "side", "rep", "cls", "n", "shared", "comp")}
        for c, width in (("bands", BANDS), ("odd", SKETCH_BITS // 64)):
            rows[c] = table[c].combine_chunks().flatten().to_numpy().reshape(-1, width)
        texts, hashes, sets = table["text"].combine_chunks(), WordHashes(), {}
        held = 0

        def shingles(row):
            nonlocal held
            cls = rows["cls"][row]
            if cls not in sets:
                if held > HELD_SHINGLES:
                    sets.clear()
                    held = 0
                sets[cls] = shingle_set(next(iter(binaries(texts.slice(row, 1)))), hashes)
                held += len(sets[cls])
            return sets[cls]

        change = np.flatnonzero(np.concatenate([[True], (np.diff(rows["key"]) != 0) | (np.diff(rows["s"]) != 0) | (np.diff(rows["t"]) != 0)]))
        a, b = [], []
        for lo, hi in zip(change, np.append(change[1:], len(texts))):
            part = {c: v[lo:hi] for c, v in rows.items()}
            for i, j in link_bucket(part, part["key"][0], part["s"][0] == part["t"][0], lambda r: shingles(lo + r)):
                a.append(part["rep"][i])
                b.append(part["rep"][j])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return placed.groupBy("part").applyInArrow(run, "a long, b long")


def _members(spark: SparkSession, docs: DataFrame, reps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``members(key, cls, rep, n, size, shared)``: the band entries of texts that share
    a band and have enough shingles in common with others; and their ``texts``."""
    entries = reps.select(F.explode("bands").alias("key"), "cls", "rep", "n", "size")
    buckets = (entries.groupBy("key").agg(F.min("cls").alias("first"), F.max("cls").alias("last"))
               .filter("first < last").select("key"))
    met = staged(spark, entries.join(buckets, "key", "left_semi"), "minhash-met")
    wanted = reps.select("cls", F.col("rep").alias("doc_id"), "print", "bands", "odd").join(met.select("cls"), "cls", "left_semi")
    texts = (docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("print"))
             .join(wanted, ["doc_id", "print"]).dropDuplicates(["doc_id", "print"]).withColumnRenamed("doc_id", "rep"))
    texts = staged(spark, texts.select("cls", "rep", "bands", "odd", "text"), "minhash-texts")
    members = (met.join(shared_counts(texts), "cls", "left")
               .select("key", "cls", "rep", "n", "size", (F.col("n") - F.coalesce("own", F.lit(0))).alias("shared"))
               .filter(100 * F.col("shared") >= PERCENT * F.col("n")))
    return staged(spark, members, "minhash-members"), texts


def _placed(labelled: DataFrame, split: DataFrame, total: int) -> DataFrame:
    """The entries of open buckets, each in the tasks of its block's pairs;
    ``split(key, entries, bytes)`` has the buckets' sizes."""
    blocks = F.greatest(F.ceil(F.col("entries") / BLOCK), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int")
    return (labelled.join(split, "key").withColumn("blocks", blocks)
            .withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumns({"s": F.least("block", "other"), "t": F.greatest("block", "other")})
            .withColumn("side", F.when(F.col("block") == F.col("s"), 0).otherwise(1))
            .withColumn("part", F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("key"), F.lit(max(1, total // GROUP))))
                        .otherwise(F.xxhash64("key", "s", "t"))))


def near_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``."""
    sketches = staged(spark, sketch(docs), "minhash-sketches")
    full = sketches.filter("n_shingles > 0 and doc_id is not null")
    # texts of one set are one class; its smallest doc_id represents it
    first = F.min_by(F.struct("doc_id", "print", "size", "n_shingles", "bands", "odd"), F.struct("doc_id", "print"))
    reps = full.groupBy("digest").agg(first.alias("r")).select(
        F.monotonically_increasing_id().alias("cls"), "digest", F.col("r.doc_id").alias("rep"), "r.print",
        "r.size", F.col("r.n_shingles").alias("n"), "r.bands", "r.odd")
    reps = staged(spark, reps, "minhash-reps")
    members, texts = _members(spark, docs, reps)

    pivots = (members.groupBy("key").agg(F.min(F.struct("cls", "n", "shared")).alias("p"), F.max("cls").alias("last"))
              .filter("p.cls < last").select("key", "p"))
    pairs = (members.join(pivots, "key").filter("cls <> p.cls")
             .filter(_possible(F.col("n"), F.col("shared"), F.col("p.n"), F.col("p.shared")))
             .select(F.col("p.cls").alias("cls_a"), F.col("cls").alias("cls_b")).distinct())
    # a doc_id with several texts links the classes of all of them
    several = (sketches.filter("doc_id is not null").groupBy("doc_id")
               .agg(F.min(F.coalesce(F.hex("digest"), F.lit(""))).alias("low"), F.max(F.coalesce(F.hex("digest"), F.lit(""))).alias("high"))
               .filter("low <> high").select("doc_id"))
    own = full.join(several, "doc_id", "left_semi").join(reps.select("digest", "rep"), "digest").select(
        F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    links = staged(spark, _confirm(spark, pairs, texts).union(own), "minhash-first")
    component = connected_components(spark, links, "minhash")

    labelled = (members.join(component, F.col("rep") == F.col("node"), "left")
                .select("key", "cls", "n", "size", "shared", F.coalesce("component", "rep").alias("comp")))
    split = (labelled.groupBy("key", "comp").agg(F.count("*").alias("entries"), F.sum("size").alias("bytes")).groupBy("key")
             .agg(F.sum("entries").alias("entries"), F.sum("bytes").alias("bytes"), F.count("*").alias("comps"))
             .filter("comps > 1").drop("comps"))
    split = staged(spark, split, "minhash-open")
    total = split.agg(F.sum("entries")).first()[0] or 0
    if total:
        more = open_links(_placed(labelled, split, total).join(texts, "cls"))
        more = staged(spark, more, "minhash-more")
        if not more.isEmpty():
            known = component.filter("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
            component = connected_components(spark, known.union(more), "minhash")

    labels = (reps.join(component, reps["rep"] == component["node"], "left")
              .select("digest", F.coalesce("component", "rep").alias("component_id")))
    of_id = component.select(F.col("node").alias("doc_id"), F.col("component").alias("of_id"))
    known = sketches.filter("digest is not null").join(labels, "digest", "left")
    blank = sketches.filter("digest is null").join(of_id, "doc_id", "left").withColumnRenamed("of_id", "component_id")
    columns = ["doc_id", "n_shingles", F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("component_id")), "doc_id").alias("component_id")]
    return (known.select(*columns).unionByName(blank.select(*columns))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One document of each near-duplicate group, all columns kept."""
    gone = near_duplicates(spark, docs).filter("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.hint("merge").join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, table(spark, sf_dir, "documents"))
