import re

import pytest
from cases import awkward, empty, words
from compare import compare
from conftest import SF_GATE, SF_SMALL

from barlake.llm import decontam as D

BENCH = "item_id long, text string, extra string"


def split(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, n=13):
    out = []
    for doc_id, text in docs:
        w = split(text)
        hit, who = set(), set()
        for item_id, t in items:
            iw = split(t)
            for i in range(max(1, len(iw) - n + 1) if iw else 0):
                win = iw[i:i + n]
                for j in range(len(w) - len(win) + 1):
                    if w[j:j + len(win)] == win:
                        hit.update(range(j, j + len(win)))
                        who.add(item_id)
        out.append((doc_id, len(w), len(hit), len(who - {None}), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


@pytest.mark.parametrize("sf", [SF_SMALL, SF_GATE])
def test_query_matches_sql(spark, con_small, con_gate, sf):
    ok, msg = compare(D.op1_decontaminate(spark, sf), con_small if sf == SF_SMALL else con_gate, D.OP1_SQL)
    assert ok, msg


def test_awkward_rows_match_brute_force(spark):
    docs = awkward(spark)
    items = [(1, words(2, 80)), (2, "one"), (3, None), (4, ""), (None, words(6, 60)), (1, "漢字 かな"), (5, "A a A")]
    got = D.contamination(spark, docs, spark.createDataFrame([(i, t, "x") for i, t in items], BENCH))
    rows = sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in got.collect()), key=str)
    assert rows == brute([(r.doc_id, r.text) for r in docs.collect()], items)


def test_blocks_and_full_index_give_the_same(spark, monkeypatch):
    docs = awkward(spark)
    bench = spark.createDataFrame([(i, words(s, 30), "x") for i, s in enumerate([2, 6, 9, 5])], BENCH)
    cols = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    one = sorted(map(str, D.contamination(spark, docs, bench).select(cols).collect()))
    monkeypatch.setattr(D, "BLOCK_WORDS", 40)
    assert sorted(map(str, D.contamination(spark, docs, bench).select(cols).collect())) == one


def test_segments_do_not_change_hits(spark):
    docs = awkward(spark)
    items = [(1, [w.encode() for w in split(words(2, 80))])]
    hits = [sorted((str(r.doc_id), r.n_hit, tuple(r.hits)) for r in D.search(D.build_index(docs, None, n), [items]).collect())
            for n in (10, 1_000_000)]
    assert hits[0] == hits[1]


def test_proximity_matches_brute_force(spark):
    texts = ["a b c d", "d c b a", "a x x b x x c x d", "a b", "a x x x x x x x x x x b c d"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = [(1, [b"a", b"b", b"c", b"d"])]
    rows = {r.doc_id: (r.n_hit, r.n_near) for r in D.search(D.build_index(docs), [items], n=4, slop=2).collect()}
    freq = {t: sum(x.split().count(t) for x in texts) for t in "abcd"}
    rare = min("abcd", key=lambda t: (freq[t], "abcd".index(t)))
    for i, t in enumerate(texts):
        w = t.split()
        near = any(all(any(abs(p - q) <= 6 and w[q] == o for q in range(len(w))) for o in "abcd")
                   for p in range(len(w)) if w[p] == rare)
        exact = "a b c d" in t
        assert rows[i] == (4 if exact else 0, int(near and not exact)), t


def test_empty_tables_and_filter(spark):
    docs, none = awkward(spark), spark.createDataFrame([], BENCH)
    assert D.contamination(spark, empty(spark), none).count() == 0
    assert D.contamination(spark, docs, none).filter("contaminated").count() == 0
    bench = spark.createDataFrame([(1, words(6, 60), "x")], BENCH)
    kept = D.remove_contaminated(spark, docs, bench)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 2
