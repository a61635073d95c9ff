"""Quality, language and toxicity: held-out accuracy, awkward rows, small brute forces."""

import math
import re
import zlib
from collections import Counter

import numpy as np
from cases import awkward, empty
from conftest import SF_GATE
from pyspark.sql import functions as F

from barlake.llm import langid as L
from barlake.llm import quality as Q
from barlake.llm import toxicity as T
from barlake.llm.common import table


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_quality_accuracy(spark):
    out = Q.op2_quality(spark, SF_GATE)
    docs, known = table(spark, SF_GATE, "documents"), table(spark, SF_GATE, "labels")
    assert out.count() == docs.count()
    c = {(r.quality, r.rejected): r["count"] for r in out.join(known, "doc_id").groupBy("quality", "rejected").count().collect()}
    assert c.get((1, True), 0) <= 0.005 * c[1, False]
    assert c[0, True] >= 0.95 * (c[0, True] + c.get((0, False), 0))


def test_site_posteriors_match_a_plain_computation(spark):
    out = [r.asDict() for r in Q.op2_quality(spark, SF_GATE).collect()]
    docs = {r.doc_id: (r.source, r.lang) for r in table(spark, SF_GATE, "documents").collect()}
    known = {r.doc_id: r.quality for r in table(spark, SF_GATE, "labels").collect()}
    base = sum(known.values()) / len(known)
    share = {r["doc_id"]: 1 / (1 + math.exp(-(r["evidence"] + math.log(base / (1 - base))))) for r in out}
    total = sum(share.values()) / len(share)

    def strength(groups):
        n = sum(c for c, _ in groups.values())
        within = total * (1 - total)
        extra = max(0, sum(g * g / c for c, g in groups.values()) / n - total ** 2) - within * len(groups) / n
        return min(max(within / extra - 1 if extra > 0 else Q.PRIOR_MAX, Q.PRIOR_MIN), Q.PRIOR_MAX)

    hosts, paths = {}, {}
    for i, (h, p) in docs.items():
        for d, k in ((hosts, h), (paths, (h, p))):
            c, g = d.get(k, (0, 0.0))
            d[k] = (c + 1, g + share[i])
    a, b = strength(hosts), strength(paths)
    for r in out:
        h, p = docs[r["doc_id"]]
        s = share[r["doc_id"]]
        host = (hosts[h][1] - s + a * total) / (hosts[h][0] - 1 + a)
        path = (paths[h, p][1] - s + b * host) / (paths[h, p][0] - 1 + b)
        assert abs(r["host_share"] - host) < 1e-4 and abs(r["path_share"] - path) < 1e-4
        inside = min(max(path, Q.SHARE_MIN), 1 - Q.SHARE_MIN)
        good = 1 / (1 + math.exp(-(r["evidence"] + math.log(inside / (1 - inside)))))
        assert abs(r["good"] - good) < 1e-3 and r["rejected"] == (r["good"] < Q.REJECT_BELOW)


def test_quality_awkward_rows(spark):
    docs = awkward(spark)
    for rows in ([], [(1, 1, 0), (1, None, 0), (None, 1, 0)], [(1, 1, 0), (13, 0, 0), (15, 0, 1), (2, 1, 0)]):
        out = Q.score_quality(spark, docs, labels(spark, rows))
        assert out.count() == docs.count()
        kept = Q.keep_good(spark, docs, labels(spark, rows))
        assert kept.columns == docs.columns
        if len(rows) < 4:
            assert kept.count() == docs.count()
    assert Q.score_quality(spark, empty(spark), labels(spark, [])).count() == 0


def test_language_accuracy(spark):
    docs = table(spark, SF_GATE, "documents")
    out = L.op4_langid(spark, SF_GATE).join(docs.select("doc_id", "lang"), "doc_id")
    right = out.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.95
    assert out.filter("score < 0 or score > 1 or score is null").count() == 0


def test_language_sample_is_full_with_few_labels(spark, monkeypatch):
    """The sample is taken from the labelled rows, however many others there are."""
    monkeypatch.setattr(L, "SAMPLE", 60)
    seen = []
    monkeypatch.setattr(L, "train", lambda pieces, labels, classes: seen.append(pieces))
    docs = (spark.range(40_000).withColumnRenamed("id", "doc_id")
            .withColumn("text", F.concat(F.lit("text "), F.col("doc_id")))
            .withColumn("lang", F.when(F.col("doc_id") % 200 == 0, F.when(F.col("doc_id") % 400 == 0, "en").otherwise("de"))))
    assert L.fit(docs)[1] == ["de", "en"] and len(seen[-1]) == 60
    few = docs.filter("lang is null or doc_id < 4000")                     # all labelled rows, where they are fewer
    taught = few.filter("lang is not null and crc32(cast(cast(doc_id as string) as binary)) % 4 <> 2")
    L.fit(few)
    assert sorted(seen[-1]) == sorted(r.text.encode() for r in taught.collect())
    L.fit(docs.unionByName(docs.filter("doc_id % 200 = 0").crossJoin(spark.range(30).select())))   # copies teach once
    assert len(seen[-1]) == len(set(seen[-1])) == 60


def test_language_gradients():
    rng = np.random.default_rng(0)
    net = L.init_net(3, rng)
    x, y = rng.integers(0, 256, (4, 7)).astype(np.uint8), np.array([0, 1, 2, 1])

    def loss():
        out = L.states(net, x)
        f = np.concatenate([out[0], out[1]], -1) @ net["out"] + net["bias"]
        return -(f - np.log(np.exp(f).sum(-1, keepdims=True)))[:, np.arange(4), y].mean()

    grad = L.gradients(net, x, y, np.ones(4))
    for k, v in net.items():
        flat = v.reshape(-1)
        for i in np.argsort(-np.abs(grad[k].reshape(-1)))[:4]:
            at = flat[i]
            flat[i] = at + 1e-6
            up = loss()
            flat[i] = at - 1e-6
            down = loss()
            flat[i] = at
            assert abs((up - down) / 2e-6 - grad[k].reshape(-1)[i]) < 1e-5


def test_language_windows_cover_every_byte():
    for n in (1, 191, 192, 193, 1000):
        data = bytes(range(33, 127)) * 20
        w = L.windows(data[:n])
        core = w[:, L.CONTEXT:-L.CONTEXT].reshape(-1)
        assert core[:n].tobytes() == data[:n] and (core[n:] == 32).all()


def test_language_awkward_rows(spark):
    docs = awkward(spark)
    net = L.init_net(2, np.random.default_rng(0))
    rows = L.predict(docs, net, ["de", "en"]).collect()
    assert len(rows) == docs.count()
    by = {r.doc_id: r for r in rows}
    assert by[4].lang_pred == by[5].lang_pred == by[6].lang_pred == "und" and by[4].score == 0
    assert all(by[i].lang_pred != "und" for i in (1, 9, 13))
    net, langs = L.fit(empty(spark))
    assert langs == [] and {r.lang_pred for r in L.predict(docs, net, langs).collect()} == {"und"}


def test_toxicity_held_out(spark):
    out = T.op8_toxicity(spark, SF_GATE)
    known = table(spark, SF_GATE, "labels")
    assert out.count() == table(spark, SF_GATE, "documents").count()
    c = {(r.toxic, r.predicted): r["count"] for r in
         out.join(known, "doc_id").filter("held_out").groupBy("toxic", "predicted").count().collect()}
    assert c[1, 1] >= 0.7 * (c[1, 1] + c.get((1, 0), 0))
    assert c.get((0, 1), 0) <= 0.05 * c[0, 0]


def test_block_max_search_is_exact():
    rng = np.random.default_rng(2)
    terms, n = 400, 700
    chance = 1 / np.arange(1, terms + 1)
    weight = rng.uniform(0.1, 5, terms)

    def vector():
        ids = np.unique(rng.choice(terms, 40, p=chance / chance.sum()))
        return ids, T.unit(ids, rng.integers(1, 6, len(ids)).astype(float), weight)

    examples = [vector() for _ in range(n - 1)]
    examples.append(examples[3])                            # a tie
    index = T.build_index(examples, terms)
    assert 0 < index["maxima"].shape[0] < terms             # both kinds of terms
    dense = np.zeros((n, terms))
    for e, (ids, w) in enumerate(examples):
        dense[e, ids] = w
    queries = [vector() for _ in range(60)] + [examples[3], (np.empty(0, np.int64), np.empty(0))]
    own = list(range(0, n, 11))
    for asked, without in ((queries, [-1] * len(queries)), ([examples[e] for e in own], own)):
        got = T.nearest(index, asked, without=None if without[0] < 0 else without)
        for (ids, w), skip, (found, cosines) in zip(asked, without, got):
            cos = np.round(dense[:, ids] @ w, 9)
            order = [e for e in np.lexsort((np.arange(n), -cos)) if e != skip and cos[e] > 0][:T.K]
            assert found.tolist() == order and np.allclose(cosines, cos[order], atol=1e-8)


def test_toxicity_equals_a_plain_computation(spark):
    docs = {r.doc_id: r.text or "" for r in table(spark, SF_GATE, "documents").select("doc_id", "text").collect()}
    known = {r.doc_id: r.toxic for r in table(spark, SF_GATE, "labels").collect()
             if r.toxic is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2}
    assert len(docs) == table(spark, SF_GATE, "documents").count() and len(known) <= T.SAMPLE

    def terms(text):
        out = Counter()
        for word in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)):
            out[word] += 1
            for k in (3, 4, 5, 6):
                if len(word) >= k:
                    out["^" + word[:k]] += 1
        return out

    first = {}
    for d in sorted(known):
        first.setdefault(docs[d], [d, 0])
        first[docs[d]][1] |= known[d]
    ids, toxic = zip(*sorted(first.values()))
    toxic, n = np.array(toxic), len(ids)
    bags = [terms(docs[d]) for d in ids]
    at = {t: i for i, t in enumerate(sorted(set().union(*bags)))}
    seen = np.zeros((n, len(at)))
    for e, bag in enumerate(bags):
        seen[e, [at[t] for t in bag]] = list(bag.values())
    df, a, pos = (seen > 0).sum(0), (seen > 0)[toxic == 1].sum(0), toxic.sum()
    cells = np.array([a, df - a, pos - a, n - df - pos + a]) + 0.5
    low = np.log(cells[0] * cells[3] / cells[1] / cells[2]) - 4 * np.sqrt((1 / cells).sum(0))
    weight = (np.log((1 + n) / (1 + df)) + 0.1) * (0.02 + np.maximum(0, low))

    def unit(x):
        w = np.where(x > 0, (1 + np.log(np.maximum(x, 1))) * weight, 0)
        return w / max(np.sqrt((w * w).sum()), 1e-300)

    rows = np.array([unit(x) for x in seen])

    def nearest(w, skip=None):
        cos = np.round(rows @ w, 9)
        return [(e, cos[e]) for e in sorted(range(n), key=lambda e: (-cos[e], e)) if e != skip and cos[e] > 0][:16]

    def vote(near):
        w = [1 / (0.1 + max(0, 1 - c)) for _, c in near]
        return sum(x * toxic[e] for x, (e, _) in zip(w, near)) / sum(w)

    pairs = [(vote(near), toxic[e]) for e in range(n) if (near := nearest(rows[e], e))]
    steps, levels = T.monotone(np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]))
    got = {r.doc_id: r for r in T.op8_toxicity(spark, SF_GATE).collect()}
    for d, text in docs.items():
        x = np.zeros(len(at))
        for t, c in terms(text).items():
            if t in at:
                x[at[t]] = c
        near = nearest(unit(x))
        assert [ids[e] for e, _ in near] == got[d].neighbours
        reach = [levels[max(0, np.searchsorted(steps, vote(near) + e, "right") - 1)] for e in (-1e-7, 1e-7)] if near else \
            [toxic.mean()] * 2
        assert reach[0] - 1e-9 <= got[d].score <= reach[1] + 1e-9
        assert got[d].predicted == int(got[d].score >= 0.3)


def test_toxicity_awkward_rows(spark):
    docs = awkward(spark)
    for rows in ([], [(1, 1, 1)], [(1, 1, 0), (2, 1, 1), (2, 1, None), (None, 1, 1), (10, 1, 1), (11, 1, 0)]):
        out = T.score_toxicity(spark, docs, T.fit(spark, docs, labels(spark, rows))).collect()
        assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    none = T.fit(spark, empty(spark), labels(spark, []))
    assert T.score_toxicity(spark, empty(spark), none).count() == 0


def test_monotone_fit():
    steps, levels = T.monotone(np.array([0.1, 0.2, 0.3, 0.4, 0.4]), np.array([0, 1, 0, 1, 1]))
    assert (np.diff(levels) >= 0).all() and steps[0] == 0.1
