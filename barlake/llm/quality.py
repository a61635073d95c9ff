"""2. Quality by hierarchical empirical Bayes.

A logistic classifier on whole-text statistics gives each document evidence, a
log-likelihood ratio for good against bad text.  Sites pull the decision: the
share of good documents of a host is a Beta posterior shrunk towards the global
share, the share of a path (a part of a host) is shrunk towards its host's, with
prior strengths estimated from the spread between hosts and between paths by the
method of moments.  A document's posterior log-odds are its evidence plus the
log-odds of its path, computed without the document's own share; it is rejected
when good text has less than REJECT_BELOW probability.

The classifier is fitted on at most SAMPLE labelled documents (the first by a
hash of the id); site counts run over all documents.

Defined results: a null or empty text has the statistics of an empty text; a
null host or path is a site of its own; labels that are null or repeated for a
document count once, by their larger value; with labels of one class only, or
none, nothing is rejected; rows that share a doc_id are scored one by one, and
``keep_good`` removes all of them when each is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm.common import binaries, staged, table

SAMPLE = 20_000
REJECT_BELOW = 0.5
PRIOR_MIN, PRIOR_MAX = 2.0, 10_000.0     # bounds of the estimated prior strengths
SHARE_MIN = 0.02                         # a site's share of good text stays this far from 0 and 1
PUNCT = [c for c in range(33, 127) if not chr(c).isalnum()]
N_FEATURES = len(PUNCT) + 9
SLICE = 4 << 20


def text_statistics(data: bytes | None) -> np.ndarray:
    """Rates of characters and words over the whole text."""
    counts = np.zeros(256, np.int64)
    words = repeats = distinct = 0
    last = None
    for at in range(0, len(data or b""), SLICE):
        part = data[at:at + SLICE]
        counts += np.bincount(np.frombuffer(part, np.uint8), minlength=256)
        tokens = part.split()
        words += len(tokens)
        repeats += sum(map(eq, tokens, tokens[1:])) + bool(tokens and tokens[0] == last)
        distinct += len(set(tokens))
        last = tokens[-1] if tokens else last
    n, w = max(1, int(counts.sum())), max(1, words)
    upper, lower, digit = counts[65:91].sum(), counts[97:123].sum(), counts[48:58].sum()
    return np.array([*np.minimum(1, 20 * counts[PUNCT] / n), upper / n, lower / n, digit / n, counts[128:].sum() / n,
                     min(1, 10 * counts[10] / n), repeats / w, distinct / w, np.log1p(words) / 10, min(4, n / w / 10)],
                    np.float64)


def statistics(docs: DataFrame, host: str, path: str) -> DataFrame:
    """(doc_id, host, path, stats) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = [text_statistics(x).astype(np.float32) for x in binaries(batch.column(3))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(stats, pa.list_(pa.float32()))],
                                             names=["doc_id", "host", "path", "stats"])

    return docs.select(F.col("doc_id").cast("long"), F.col(host).cast("string").alias("host"),
                       F.col(path).cast("string").alias("path"), "text").mapInArrow(
        run, "doc_id long, host string, path string, stats array<float>")


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25) -> np.ndarray:
    """Weights and intercept by Newton's method with a ridge penalty."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = np.append(np.full(x.shape[1] - 1, ridge), 1e-6)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(h, x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _strength(shares: pd.DataFrame, mean: float) -> float:
    """Prior strength (pseudo-count) from the spread of shares of sites (n, good)."""
    n, good, sites, squares = (float(shares[c].iloc[0] or 0) for c in ("n", "good", "sites", "squares"))
    if sites < 2 or n <= 0:
        return PRIOR_MAX
    within = mean * (1 - mean)
    spread = max(0.0, squares / n - mean ** 2)              # weighted variance of site shares
    extra = spread - within * sites / n                     # less what sampling alone makes
    return float(np.clip(within / extra - 1 if extra > 0 else PRIOR_MAX, PRIOR_MIN, PRIOR_MAX))


def score_quality(spark: SparkSession, docs: DataFrame, labels: DataFrame, host: str = "source",
                  path: str = "lang") -> DataFrame:
    """(doc_id, evidence, host_share, path_share, good, rejected) for every document."""
    stats = staged(spark, statistics(docs, host, path), "quality-stats")
    known = (labels.filter("quality is not null and doc_id is not null")
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE))
    sample = stats.join(F.broadcast(known), "doc_id").select("stats", "quality").toPandas()     # at most SAMPLE ids
    y = sample["quality"].to_numpy(np.float64)
    base = float(y.mean()) if len(y) else 1.0
    if 0 < base < 1:
        x = np.array(sample["stats"].tolist(), np.float64)
        centre, scale = x.mean(0), x.std(0) + 1e-6
        w = fit_logistic((x - centre) / scale, y)
        weights, bias = w[:-1] / scale, w[-1] - centre @ (w[:-1] / scale) - np.log(base / (1 - base))
    else:
        weights, bias = np.zeros(N_FEATURES), 0.0

    evidence = F.lit(float(bias)) + sum((F.col("stats")[i].cast("double") * float(v) for i, v in enumerate(weights)), F.lit(0.0))
    prior = float(np.log(base / (1 - base))) if 0 < base < 1 else 30.0

    def chance(logit):
        return 1 / (1 + F.exp(-F.least(F.greatest(logit, F.lit(-30.0)), F.lit(30.0))))

    scored = staged(spark, stats.select("doc_id", "host", "path", F.round(evidence, 9).alias("evidence"))
                    .withColumn("share", F.round(chance(F.col("evidence") + prior), 9)), "quality-evidence")
    paths = scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("share").alias("good"))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("good").alias("host_good"))

    def spread(sites: DataFrame, n: str, good: str) -> pd.DataFrame:
        return sites.agg(F.sum(n).alias("n"), F.sum(good).alias("good"), F.count("*").alias("sites"),
                         F.sum(F.col(good) * F.col(good) / F.col(n)).alias("squares")).toPandas()

    top = spread(hosts, "host_n", "host_good")
    total = float(top["n"].iloc[0] or 0)
    mean = float(top["good"].iloc[0] or 0) / total if total else base
    mean = min(max(mean, SHARE_MIN), 1 - SHARE_MIN)
    host_prior, path_prior = _strength(top, mean), _strength(spread(paths, "n", "good"), mean)

    # leave the document's own share out of its site's posterior
    host_share = ((F.col("host_good") - F.col("share") + host_prior * mean) / (F.col("host_n") - 1 + host_prior))
    path_share = ((F.col("good") - F.col("share") + path_prior * F.col("host_share")) / (F.col("n") - 1 + path_prior))
    inside = F.least(F.greatest(F.col("path_share"), F.lit(SHARE_MIN)), F.lit(1 - SHARE_MIN))
    sites = (paths.join(hosts.withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h"))).drop("h")
             .withColumnsRenamed({"host": "h", "path": "p"}))
    out = (scored.join(sites, scored["host"].eqNullSafe(sites["h"]) & scored["path"].eqNullSafe(sites["p"]))
           .withColumn("host_share", host_share).withColumn("path_share", path_share)
           .withColumn("good", chance(F.col("evidence") + F.log(inside / (1 - inside)))))
    known_classes = 0 < base < 1
    return out.select("doc_id", "evidence", F.round("host_share", 6).alias("host_share"),
                      F.round("path_share", 6).alias("path_share"), F.round("good", 6).alias("good"),
                      (F.lit(known_classes) & (F.col("good") < REJECT_BELOW)).alias("rejected"))


def keep_good(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` that are not rejected, all columns kept."""
    bad = (score_quality(spark, docs, labels).groupBy(F.col("doc_id").alias("_bad"))
           .agg(F.bool_and("rejected").alias("r")).filter("r").drop("r"))
    return docs.hint("merge").join(bad, docs["doc_id"].cast("long").eqNullSafe(bad["_bad"]), "left_anti")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
