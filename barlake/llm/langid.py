"""4. Language identification by a bidirectional gated recurrent network over bytes.

Two GRU layers (reset-after form, piecewise linear gates) read the bytes of a
text forwards and backwards; a linear layer labels every position, and the
probabilities of the positions inside letters are averaged into the document's.
Training is backpropagation through time in numpy, on pieces of at most SAMPLE
documents (the first by a hash of the id); prediction reads every byte of every
text, in windows that overlap by CONTEXT bytes on both sides.

Defined results: ``und`` with score 0 for a null text or one without a letter;
rows without lang or doc_id teach nothing; with no teaching rows every text is
``und``; rows that share a doc_id teach once and are predicted one by one.  Extra columns and
the columns source and lang are no inputs of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm.common import binaries, held_out, table

SAMPLE = 6000            # documents, one piece each
PIECE = 96               # bytes of a training piece
HIDDEN = 12
STEPS, BATCH, RATE = 500, 128, 0.01
CORE, CONTEXT = 192, 16  # bytes labelled and bytes of context on each side, per window
WINDOWS = 512            # windows run at once
UNKNOWN = "und"


def init_net(classes: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    h = HIDDEN
    return {"table": rng.normal(0, 0.3, (2, 256, 3 * h)), "rec": rng.normal(0, 1 / np.sqrt(h), (2, h, 3 * h)),
            "out": rng.normal(0, 0.3, (2 * h, classes)), "bias": np.zeros(classes)}


def states(net: dict, x: np.ndarray, keep: bool = False):
    """Hidden states of both directions for bytes ``x`` (rows, steps): an array
    (2, steps, rows, HIDDEN), the second direction in reading order; with
    ``keep`` also what backpropagation needs."""
    rows, steps = x.shape
    h, hid = np.zeros((2, rows, HIDDEN), net["rec"].dtype), HIDDEN
    out = np.empty((2, steps, rows, hid), h.dtype)
    tape = []
    flat = net["table"].reshape(512, 3 * hid)
    both = np.stack([x.T, x.T[::-1].astype(np.int64) + 256], 1)      # (steps, 2, rows)
    for t in range(steps):
        g = np.matmul(h, net["rec"])
        a = flat[both[t]]
        zr = a[..., :2 * hid] + g[..., :2 * hid]
        zr *= 0.25
        zr += 0.5
        np.maximum(zr, 0, out=zr)
        np.minimum(zr, 1, out=zr)
        z, r = zr[..., :hid], zr[..., hid:]
        n = r * g[..., 2 * hid:]
        n += a[..., 2 * hid:]
        np.maximum(n, -1, out=n)
        np.minimum(n, 1, out=n)
        if keep:
            tape.append((h, zr, g[..., 2 * hid:], n))
        h = h - n
        h *= z
        h += n
        out[0, t], out[1, steps - 1 - t] = h[0], h[1]
    return (out, tape, both) if keep else out


def gradients(net: dict, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the weighted mean cross-entropy over all positions."""
    rows, steps = x.shape
    hid = HIDDEN
    out, tape, both = states(net, x, keep=True)
    flat = np.concatenate([out[0], out[1]], -1)                       # (steps, rows, 2 hid)
    logits = flat @ net["out"] + net["bias"]
    p = np.exp(logits - logits.max(-1, keepdims=True))
    p /= p.sum(-1, keepdims=True)
    p[:, np.arange(rows), y] -= 1
    p *= (weight / (weight.sum() * steps))[None, :, None]
    grad = {"out": np.einsum("trh,trc->hc", flat, p), "bias": p.sum((0, 1)),
            "table": np.zeros((512, 3 * hid)), "rec": np.zeros_like(net["rec"])}
    back = p @ net["out"].T
    dh = np.zeros((2, rows, hid))
    for t in range(steps - 1, -1, -1):
        h, zr, gn, n = tape[t]
        z, r = zr[..., :hid], zr[..., hid:]
        dh = dh + np.stack([back[t, :, :hid], back[steps - 1 - t, :, hid:]])
        dn = dh * (1 - z) * (np.abs(n) < 1)
        dzr = np.concatenate([dh * (h - n), dn * gn], -1) * (0.25 * ((zr > 0) & (zr < 1)))
        dg = np.concatenate([dzr, dn * r], -1)
        grad["rec"] += np.matmul(h.transpose(0, 2, 1), dg)
        np.add.at(grad["table"], both[t].reshape(-1), np.concatenate([dzr, dn], -1).reshape(-1, 3 * hid))
        dh = dh * z + np.matmul(dg, net["rec"].transpose(0, 2, 1))
    grad["table"] = grad["table"].reshape(2, 256, 3 * hid)
    return grad


def train(pieces: list[bytes], labels: np.ndarray, classes: int, steps: int = STEPS, seed: int = 4) -> dict[str, np.ndarray]:
    """Adam over random batches; classes weigh the same."""
    rng = np.random.default_rng(seed)
    net = init_net(classes, rng)
    x = np.full((len(pieces), PIECE), 32, np.uint8)
    for i, piece in enumerate(pieces):
        data = piece[:PIECE]
        x[i, :len(data)] = np.frombuffer(data, np.uint8)
    weight = (len(labels) / classes / np.maximum(1, np.bincount(labels, minlength=classes)))[labels]
    first = {k: np.zeros_like(v) for k, v in net.items()}
    second = {k: np.zeros_like(v) for k, v in net.items()}
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(x), BATCH)
        grad = gradients(net, x[pick], labels[pick], weight[pick])
        rate = RATE * min(1, 2 * (1 - step / (steps + 1)))
        for k, g in grad.items():
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            net[k] -= rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
    return net


def windows(data: bytes) -> np.ndarray:
    """Overlapping windows of a text, spaces beyond its ends."""
    n = -(-len(data) // CORE)
    padded = np.full(n * CORE + 2 * CONTEXT, 32, np.uint8)
    padded[CONTEXT:CONTEXT + len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, CORE + 2 * CONTEXT)[::CORE]


LETTER = np.array([65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])


def position_sums(net: dict, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window: summed probabilities over its letter positions, and their number."""
    out = states(net, x)[:, CONTEXT:-CONTEXT]
    logits = out[0] @ net["out"][:HIDDEN]
    logits += out[1] @ net["out"][HIDDEN:]
    logits += net["bias"]
    logits -= logits.max(-1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(-1, keepdims=True)
    letters = LETTER[x[:, CONTEXT:-CONTEXT]].T
    return np.einsum("tbc,tb->bc", logits, letters.astype(logits.dtype)), letters.sum(0)


def has_letter(data: bytes) -> bool:
    raw = np.frombuffer(data, np.uint8)
    if not LETTER[raw].any():
        return False
    return bool((LETTER[raw] & (raw < 128)).any()) or any(c.isalpha() for c in data.decode())


def predict(docs: DataFrame, net: dict[str, np.ndarray], langs: list[str]) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast({k: v.astype(np.float32) for k, v in net.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            total = np.zeros((batch.num_rows, len(langs)))
            count = np.zeros(batch.num_rows, np.int64)
            known = np.zeros(batch.num_rows, bool)
            held: list[np.ndarray] = []
            owner: list[np.ndarray] = []
            waiting = 0

            def flush():
                nonlocal waiting
                if held:
                    x, who = np.concatenate(held), np.concatenate(owner)
                    sums, n = position_sums(model, x)
                    np.add.at(total, who, sums)
                    np.add.at(count, who, n)
                held.clear(), owner.clear()
                waiting = 0

            for i, data in enumerate(binaries(batch.column(2))):
                if not langs or not data or not has_letter(data):
                    continue
                known[i] = True
                w = windows(data)
                at = 0
                while at < len(w):
                    part = w[at:at + WINDOWS - waiting]
                    held.append(part)
                    owner.append(np.full(len(part), i))
                    waiting += len(part)
                    at += len(part)
                    if waiting >= WINDOWS:
                        flush()
            flush()
            mean = total / np.maximum(1, count)[:, None]
            best = mean.argmax(1) if langs else np.zeros(batch.num_rows, int)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1),
                pa.array([langs[b] if k else UNKNOWN for b, k in zip(best, known)], pa.string()),
                pa.array([float(min(1, mean[i, b])) if k else 0.0 for i, (b, k) in enumerate(zip(best, known))], pa.float64()),
            ], names=["doc_id", "held_out", "lang_pred", "score"])

    return (docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), "text")
            .mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double"))


def fit(docs: DataFrame) -> tuple[dict[str, np.ndarray], list[str]]:
    """Train on one piece of each sampled document, from anywhere in its text."""
    size = F.greatest(F.length("text") - PIECE, F.lit(0)) + 1
    usable = (docs.filter("text is not null and lang is not null and doc_id is not null").filter(~held_out())
              .select("lang", F.substring("text", (F.pmod(F.xxhash64("doc_id", F.lit("at")), size) + 1).cast("int"), F.lit(PIECE))
                      .alias("piece"), F.xxhash64("doc_id").alias("order"), "doc_id"))
    # only rows whose hash can be among the first SAMPLE are sorted, so no task sends many to the driver
    share = 4 * SAMPLE / max(1, usable.agg(F.approx_count_distinct("doc_id")).first()[0])
    while True:
        highest = min(2**63 - 1, int(-2**63 + 2**64 * share))
        pieces = (usable.filter(F.col("order") <= F.lit(highest)).groupBy("order", "doc_id")
                  .agg(F.min(F.struct("lang", "piece")).alias("first")).orderBy("order", "doc_id").limit(SAMPLE)
                  .select("first.*").collect())
        if len(pieces) == SAMPLE or share >= 1:
            break
        share *= 4
    langs = sorted({p[0] for p in pieces})
    if not langs:
        return init_net(1, np.random.default_rng(0)), []
    labels = np.array([langs.index(p[0]) for p in pieces])
    return train([p[1].encode() for p in pieces], labels, len(langs)), langs


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, *fit(docs))
