"""3. Embedding near-dedup with randomised-rotation binary codes.

A unit vector is turned by random rotations; the signs of its turned components
are its binary code, and the stored correction factor is the
inner product of the vector with its code.  For another vector q the product of
q with the code, divided by the factor, is an unbiased estimate of <v, q>; its
error is at most EPSILON * sqrt((1 - f^2) / f^2 / (D - 1)) with overwhelming
probability.  Pairs whose estimate (by the first rotation) plus this bound stays
under the threshold are let go; all others are recomputed exactly in double
precision.

Candidates come from bands of code bits: two vectors meet where all bits of a
band agree.  The width of a band grows with the logarithm of the number of
vectors, so that buckets of unrelated vectors stay small, and the number of
bands follows from RECALL at the threshold.  A bucket with more than BLOCK
entries is split into blocks, and pairs of blocks are separate groups, so a hot
bucket spreads over tasks.  No pair is emitted: a group returns link counts
(each pair in its first common band only) and the edges of a spanning forest.

Vectors with the same components are collapsed to one with a multiplicity.
Defined results: a vector that is null, empty, zero, or holds null or non-finite
components links with nothing; vectors of different length never link; a row that
repeats another one's vec_id and vector is the same vector; rows that share a
vec_id and differ are vectors with links of their own, but one node of a component,
and the same holds where one of them can't link; a null vec_id links with nothing.  ``label`` and extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm.common import staged, table
from barlake.llm.components import connected_components

THRESHOLD = 0.95
RECALL = 0.995            # of pairs exactly at the threshold; closer pairs are surer
EPSILON = 5.0
BUCKET = 4                # unrelated vectors expected in a bucket
BLOCK = 1024              # entries of a bucket that one group takes from each side
GROUP = 8192              # entries of small buckets that share a group
PAIRS = 100_000           # pairs worked on at once
MAX_BANDS = 64

CODE_SCHEMA = "vec_id long, digest binary, dim int, vector binary, code binary, factor float"


def bands_for(n: int) -> tuple[int, int]:
    """Bits of a band and number of bands for ``n`` vectors."""
    agree = 1 - acos(THRESHOLD) / pi
    for width in range(max(8, ceil(log2(max(2, n / BUCKET)))), 7, -1):
        bands = ceil(log(1 - RECALL) / log(1 - agree ** width))
        if bands <= MAX_BANDS:
            return width, bands
    return 8, ceil(log(1 - RECALL) / log(1 - agree ** 8))


def rotations(dim: int, bits: int) -> np.ndarray:
    """Random orthogonal matrices, enough for ``bits`` code bits: (k, dim, dim)."""
    rng = np.random.default_rng([3, dim])
    return np.array([np.linalg.qr(rng.normal(size=(dim, dim)))[0] for _ in range(-(-bits // dim))])


def encode(vectors: DataFrame, bits: int) -> DataFrame:
    """Vector, code and correction factor; null where a vector can't link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            out: list[tuple] = []
            for vec_id, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                v = np.array([np.nan if x is None else x for x in values or []], np.float64)
                size = np.sqrt(v @ v) if len(v) and np.isfinite(v).all() else 0.0
                if not 0 < size < np.inf or vec_id is None:
                    out.append((vec_id, None, len(v), None, None, None))
                    continue
                if len(v) not in turns:
                    turns[len(v)] = rotations(len(v), bits)
                turned = turns[len(v)] @ (v / size)
                out.append((vec_id, xxhash.xxh3_128_digest(v.tobytes()), len(v), pack(v),
                            np.packbits(turned.reshape(-1) >= 0).tobytes(), float(np.abs(turned[0]).sum() / np.sqrt(len(v)))))
            cols = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays([
                pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.int32()),
                pa.array(cols[3], pa.binary()), pa.array(cols[4], pa.binary()), pa.array(cols[5], pa.float32())],
                names=["vec_id", "digest", "dim", "vector", "code", "factor"])

    return vectors.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(run, CODE_SCHEMA)


def pack(v: np.ndarray) -> bytes:
    """A vector's bytes: single precision where that loses nothing."""
    with np.errstate(over="ignore"):
        small = v.astype(np.float32)
    return small.tobytes() if (small == v).all() else v.tobytes()


def unpack(data: list[bytes], dim: int) -> np.ndarray:
    """Unit vectors in double precision, (rows, dim)."""
    out = np.array([np.frombuffer(d, np.float32 if len(d) == 4 * dim else np.float64) for d in data], np.float64)
    return out / np.sqrt(np.einsum("pd,pd->p", out, out))[:, None]


def band_keys(codes: np.ndarray, width: int, bands: int) -> np.ndarray:
    """Bits of each band as a number: (rows, bands)."""
    bits = np.unpackbits(codes, axis=1)[:, :width * bands].reshape(len(codes), bands, width)
    return bits @ (1 << np.arange(width, dtype=np.int64))


def estimates(turned: np.ndarray, signs: np.ndarray, factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of turned vectors with coded ones (signs -1, 1),
    and the bound on their error."""
    dim = turned.shape[1]
    product = np.einsum("pd,pd->p", turned, signs) / np.sqrt(dim) / factor
    return product, EPSILON * np.sqrt(((1 - factor ** 2) / factor ** 2).clip(0) / max(1, dim - 1))


def entries(reps: DataFrame, width: int, bands: int) -> DataFrame:
    """(band, key, dim, cls): one row per vector and band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls, dim, codes = (c.to_pylist() for c in batch.columns)
            n = len(cls)
            keys = [band_keys(np.frombuffer(c, np.uint8)[None], width, bands)[0] for c in codes]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.tile(np.arange(bands, dtype=np.int32), n)), pa.array(np.concatenate(keys) if keys else [], pa.int64()),
                pa.array(np.repeat(np.array(dim, np.int32), bands)), pa.array(np.repeat(np.array(cls, np.int64), bands))],
                names=["band", "key", "dim", "cls"])

    return reps.select("cls", "dim", "code").mapInArrow(run, "band int, key long, dim int, cls long")


def _pairs(starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows within buckets (consecutive rows), about PAIRS at a time."""
    held, n = [], 0
    small = sizes <= 64
    rows = np.concatenate([np.arange(a, a + m) for a, m in zip(starts[small], sizes[small])] or [np.empty(0, np.int64)])
    left = np.concatenate([np.arange(m - 1, -1, -1) for m in sizes[small]] or [np.empty(0, np.int64)])
    for step in range(1, 64):
        rows, left = rows[left >= step], left[left >= step]
        if not len(rows):
            break
        for at in range(0, len(rows), PAIRS):
            held.append((rows[at:at + PAIRS], rows[at:at + PAIRS] + step))
            n += len(held[-1][0])
            if n >= PAIRS:
                yield tuple(np.concatenate(x) for x in zip(*held))
                held, n = [], 0
    for start, m in zip(starts[~small].tolist(), sizes[~small].tolist()):
        for i in range(m - 1):
            held.append((np.full(m - 1 - i, start + i), np.arange(start + i + 1, start + m)))
            n += m - 1 - i
            if n >= PAIRS:
                yield tuple(np.concatenate(x) for x in zip(*held))
                held, n = [], 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held))


def link_group(rows: dict[str, np.ndarray], width: int, bands: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a group, whose rows are sorted by bucket: link counts per row,
    and for each row the smallest row its links reach."""
    dim = rows["unit"].shape[1]
    n = len(rows["cls"])
    turned = (rows["unit"] @ rotations(dim, dim)[0].T).astype(np.float32)
    signs = np.unpackbits(rows["code"], axis=1)[:, :dim].astype(np.float32) * 2 - 1
    counts = np.zeros(n, np.int64)
    edges = [(np.empty(0, np.int64),) * 2]
    new = np.flatnonzero(np.concatenate([[True], np.diff(rows["bucket"]) != 0]))
    for a, b in _pairs(new, np.diff(np.append(new, n))):
        keep = (rows["s"][a] == rows["t"][a]) | (rows["side"][a] != rows["side"][b])
        a, b = a[keep], b[keep]
        guess, error = estimates(turned[a], signs[b], rows["factor"][b])
        keep = guess + error >= THRESHOLD
        a, b = a[keep], b[keep]
        exact = np.einsum("pd,pd->p", rows["unit"][a], rows["unit"][b])
        keep = (exact >= THRESHOLD) & (rows["cls"][a] != rows["cls"][b])
        a, b = a[keep], b[keep]
        # a pair is counted in the first band it shares
        keys = band_keys(rows["code"][a], width, bands) == band_keys(rows["code"][b], width, bands)
        first = keys.any(1) & (keys.argmax(1) == rows["band"][a])
        a, b = a[first], b[first]
        np.add.at(counts, a, rows["mult"][b])
        np.add.at(counts, b, rows["mult"][a])
        edges.append((a, b))
    a, b = (np.concatenate(x) for x in zip(*edges))
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        for ends in (a, b, before[a], before[b]):
            np.minimum.at(root, ends, low)
        root = root[root]
        if (root == before).all():
            break
    return counts, root


def links(grouped: DataFrame, width: int, bands: int) -> DataFrame:
    """(cls, n, rep, root): partial link counts, and the vec_ids of the vector and
    of one it is connected with (or its own)."""

    def run(key, table):
        table = table.sort_by([(c, "ascending") for c in ("band", "key", "s", "t")])
        dim = key[1].as_py()
        rows = {c: table[c].to_numpy() for c in ("cls", "rep", "mult", "band", "key", "s", "t", "side")}
        change = np.zeros(len(rows["cls"]), np.int64)
        for c in ("band", "key", "s", "t"):
            change[1:] |= np.diff(rows[c]) != 0
        rows["bucket"] = np.cumsum(change)
        rows["unit"] = unpack(table["vector"].to_pylist(), dim)
        rows["code"] = np.frombuffer(b"".join(table["code"].to_pylist()), np.uint8).reshape(len(change), -1)
        rows["factor"] = table["factor"].to_numpy()
        counts, root = link_group(rows, width, bands)
        hit = np.flatnonzero(counts)
        return pa.table({"cls": rows["cls"][hit], "n": counts[hit], "rep": rows["rep"][hit], "root": rows["rep"][root[hit]]})

    return grouped.groupBy("part", "dim").applyInArrow(run, "cls long, n long, rep long, root long")


def near_duplicates(spark: SparkSession, vectors: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``."""
    total = vectors.count()
    width, bands = bands_for(total)
    coded = staged(spark, encode(vectors, width * bands), "embedding-codes")
    valid = coded.filter("code is not null")
    # equal vectors are one class; its smallest vec_id represents it
    reps = valid.groupBy("digest", "dim").agg(
        F.min("vec_id").alias("rep"), F.countDistinct("vec_id").alias("mult"), F.any_value("vector").alias("vector"),
        F.any_value("code").alias("code"), F.any_value("factor").alias("factor"))
    reps = staged(spark, reps.withColumn("cls", F.monotonically_increasing_id()), "embedding-classes")
    met = entries(reps, width, bands)
    sizes = met.groupBy("band", "key", "dim").agg(F.count("*").alias("size")).filter("size > 1")
    groups = max(1, total * bands // GROUP)
    placed = (met.join(sizes, ["band", "key", "dim"])
              .withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
              .withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .withColumn("s", F.least("block", "other")).withColumn("t", F.greatest("block", "other"))
              .withColumn("side", F.when(F.col("block") == F.col("s"), 0).otherwise(1))
              .withColumn("part", F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("band", "key"), F.lit(groups)))
                          .otherwise(F.xxhash64("band", "key", "s", "t")))
              .select("part", "band", "key", "s", "t", "side", "cls"))
    grouped = placed.join(reps.select("cls", "rep", "dim", "vector", "code", "factor", "mult"), "cls")
    found = staged(spark, links(grouped, width, bands), "embedding-links")
    # a vec_id with several vectors connects the classes of all of them
    kind = F.coalesce(F.concat_ws(":", F.hex("digest"), "dim"), F.lit(""))
    several = (coded.filter("vec_id is not null").groupBy("vec_id").agg(F.min(kind).alias("low"), F.max(kind).alias("high"))
               .filter("low <> high").select("vec_id"))
    own = valid.join(several, "vec_id", "left_semi").join(reps.select("digest", "dim", "rep"), ["digest", "dim"])
    edges = found.select(F.col("rep").alias("a"), F.col("root").alias("b")).union(own.select("vec_id", "rep"))
    component = connected_components(spark, edges, "embedding")
    counts = found.groupBy("cls").agg(F.sum("n").alias("n"))
    labels = (reps.join(counts, "cls", "left").join(component, reps["rep"] == component["node"], "left")
              .select("digest", "dim", (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n_links"),
                      F.coalesce("component", "rep").alias("component_id")))
    linked = valid.select("vec_id", "digest", "dim").join(labels, ["digest", "dim"]).select("vec_id", "n_links", "component_id")
    alone = (coded.filter("code is null").select("vec_id", F.lit(0).alias("n_links"))
             .join(component.withColumnsRenamed({"node": "vec_id", "component": "component_id"}), "vec_id", "left"))
    out = linked.unionByName(alone).select("vec_id", F.col("n_links").cast("long").alias("n_links"),
                                           F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op3_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, table(spark, sf_dir, "embeddings"))
