import random
import re
from collections import Counter

import numpy as np
import pytest
from cases import awkward, empty, words
from conftest import SF_GATE

from barlake.llm import minhash as M
from barlake.llm.common import table
from barlake.llm.components import connected_components


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    n = min(5, len(w))
    return frozenset(tuple(w[j:j + n]) for j in range(len(w) - n + 1)) if w else frozenset()


def brute(docs):
    """Components by exact similarity; docs: {doc_id: text}."""
    sets = {i: shingles(t) for i, t in docs.items()}
    by = {}
    for i, s in sets.items():
        for g in s:
            by.setdefault(g, []).append(i)
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sets.items():
        for j, n in Counter(j for g in s for j in by[g] if j < i).items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def result(spark, docs):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in M.near_duplicates(spark, docs).collect()}


def test_query_matches_brute_force(spark):
    docs = {r.doc_id: r.text for r in table(spark, SF_GATE, "documents").collect()}
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in M.op7_minhash(spark, SF_GATE).collect()}
    assert got == brute(docs)


@pytest.mark.parametrize("block, size", [(4096, 32 << 20), (7, 32 << 20), (4096, 3000)])
def test_chains_of_near_copies(spark, monkeypatch, block, size):
    """Copies that drift: neighbours link, ends do not; in whole buckets, and in
    buckets split by entries or by bytes."""
    rng = random.Random(5)
    monkeypatch.setattr(M, "BLOCK", block)
    monkeypatch.setattr(M, "BLOCK_BYTES", size)
    docs, now = {}, words(50, 120).split()
    for i in rng.sample(range(1000), 60):
        docs[i] = " ".join(now)
        now = list(now)
        for _ in range(rng.choice([1, 2, 3])):
            now[rng.randrange(len(now))] = f"w{rng.randrange(10**6)}"
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    assert result(spark, df) == brute(docs)


@pytest.mark.parametrize("block", [4096, 20])
def test_family_with_sentences_left_out(spark, monkeypatch, block):
    """Loosely related members: many share bands without being linked."""
    monkeypatch.setattr(M, "BLOCK", block)
    rng = random.Random(11)
    sentences = [words(100 + i, 12) for i in range(20)]
    docs = {i: " ".join(s for s in sentences if rng.random() > 0.25) for i in range(150)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(4)
    assert result(spark, df) == brute(docs)


def test_repeated_ids_keep_all_their_links(spark):
    """A doc_id with two texts is linked with the near copies of both."""
    short, long_, other = words(1, 40), words(2, 400), words(3, 90)
    near = lambda text, n: " ".join(text.split()[:-n] + ["changed"])
    rows = [(1, short), (1, long_), (2, near(short, 1)), (9, near(long_, 2)), (5, other), (5, None), (4, near(other, 1)),
            (6, other), (6, ""), (7, None), (7, ""), (8, short), (8, short), (12, words(4, 50)), (12, words(5, 50))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in M.near_duplicates(spark, df).collect())
    component = {1: 1, 2: 1, 9: 1, 8: 1, 5: 4, 6: 4, 4: 4, 7: 7, 12: 12}
    assert got == sorted((i, len(shingles(t)), component[i], component[i] == i) for i, t in rows)


def test_awkward_rows(spark):
    df = awkward(spark)
    rows = M.near_duplicates(spark, df)
    assert rows.count() == df.count()
    docs = {r.doc_id: r.text for r in df.collect() if r.doc_id is not None}
    want = brute(docs)
    for r in rows.collect():
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == want[r.doc_id]
    kept = M.remove_near_duplicates(spark, df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.filter("doc_id is not null").collect()) == sorted(
        [i for i, v in want.items() if v[2]] + [7])


def test_empty_table(spark):
    assert M.near_duplicates(spark, empty(spark)).count() == 0
    assert M.remove_near_duplicates(spark, empty(spark)).count() == 0


def test_odd_sketches_let_similar_pairs_through():
    """No pair at or above the threshold exceeds the limit of differing bits."""
    rng = np.random.default_rng(0)
    for common in (75, 80, 90):
        sets = []
        for _ in range(300):
            both = rng.integers(0, 2**63, common, np.uint64)
            rest = rng.integers(0, 2**63, 100 - common, np.uint64)
            half = len(rest) // 2
            sets += [np.concatenate([both, rest[:half]]), np.concatenate([both, rest[half:]])]
        odd = M.odd_sketches(M.signatures(sets)).view(np.uint64)
        bits = np.bitwise_count(odd[::2] ^ odd[1::2]).sum(1)
        assert bits.max() <= M.differing_bits_limit()
    far = M.odd_sketches(M.signatures([rng.integers(0, 2**63, 100, np.uint64) for _ in range(200)])).view(np.uint64)
    assert (np.bitwise_count(far[::2] ^ far[1::2]).sum(1) > M.differing_bits_limit()).mean() > 0.95


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(i, i + 1) for i in range(500, 560)] + [(7, None)]
    parent = list(range(600))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if b is not None:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in
           connected_components(spark, spark.createDataFrame(pairs, "a long, b long"), "test").collect()}
    nodes = {x for a, b in pairs if b is not None and a != b for x in (a, b)}
    assert got == {x: find(x) for x in nodes}
