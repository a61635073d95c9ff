"""Re-Pair token files: exact ids, round trips, random access."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from cases import awkward, empty
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from barlake.llm import repair as R
from barlake.llm.common import table
from barlake.session import scratch_path

PATH = public_tokenizers.path(R.TOKENIZER)
LIBRARY = Tokenizer.from_file(PATH)
ODD = ["", " ", "a", "don't WE'LL 'S", "Ünï ÀÉÎ İx ŉ ſt", "<|endoftext|>x <|startoftext|> <|", "e ́x é", "1,234.5", "x" * 500,
       "ΑΣ ΑΣΑ", "\x1ca\x1fb\x00", "漢字 かな😀 ÷×", "a b c\x85d", "'' 'll'll", "a\tb\nc\x0bd\x0ce\rf", "n't$$$ (x)"]


def ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(ODD), st.text(max_size=30), st.text("aé'ls1 .ÉßŁ\n", max_size=30)), max_size=4))
def test_ids_are_the_librarys(parts):
    encoder = test_ids_are_the_librarys.__dict__.setdefault("encoder", R.Encoder(PATH))
    for text in (" ".join(parts), "".join(parts)):
        assert np.frombuffer(encoder.ids(text.encode()), "<u2").tolist() == ids(text)


@pytest.mark.parametrize("seed", range(6))
def test_grammar_round_trip_and_ranges(seed):
    rng = random.Random(seed)
    phrases = [[rng.randrange(300) for _ in range(rng.randint(1, 12))] for _ in range(20)]
    x = [t for _ in range(rng.choice([0, 1, 40, 900])) for t in rng.choice(phrases)] + [7] * rng.choice([0, 1, 2, 5000])
    data = R.write_segment(np.array(x, "<u2"), 300)
    s = R.Segment(data)
    assert len(s) == len(x) and s.ids().tolist() == x
    for _ in range(50):
        a = rng.randint(0, len(x))
        b = rng.randint(a, len(x))
        assert s.ids(a, b).tolist() == x[a:b]
    if len(x) > 3000:
        assert len(data) < len(x)            # less than half of two bytes an id


def test_rules_are_frequent_pairs():
    rules, symbols = R.compress(np.array([1, 2, 3] * 50 + [4, 5] * 3), 10)
    assert [1, 2] in rules.tolist() or [2, 3] in rules.tolist()
    assert [4, 5] not in rules.tolist() and len(symbols) < 60
    assert R.lengths_of(np.array([[1, 2], [10, 3], [11, 11]]), 10).tolist() == [2, 3, 6]


def expected(rows):
    """(doc_id, start, n_tokens, crc) in ascending doc_id order."""
    docs = [(i, np.array(ids(t or "") + [R.END], "<u4")) for i, t in rows]
    out, at = [], 0
    for i, x in sorted(docs, key=lambda d: (d[0] is not None, d[0], zlib.crc32(d[1].astype("<u2").tobytes()))):
        out.append((i, at, len(x), zlib.crc32(x.tobytes())))
        at += len(x)
    return out


@pytest.mark.parametrize("shard", [1 << 20, 200, 1])
def test_awkward_rows(spark, monkeypatch, shard):
    """Nulls, repeats, very long texts, over one and many shards, parts and segments."""
    monkeypatch.setattr(R, "SHARD_IDS", max(shard, 50))
    monkeypatch.setattr(R, "PART_IDS", 20 * max(shard, 50))
    docs = awkward(spark).repartition(4)
    path = scratch_path(spark, "test-repair")
    R.write_ids(spark, docs, path)
    back = R.read_ids(spark, path)
    want = expected([(r.doc_id, r.text) for r in docs.collect()])
    order = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(map(tuple, back.drop("ids").collect()), key=order) == sorted(want, key=order)
    some = R.read_documents(spark, path, [1, 7, 15, 99]).collect()
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in some) == sorted((w[0], w[2], w[3]) for w in want if w[0] in (1, 7, 15))
    for r in some:
        assert zlib.crc32(r.ids) == r.ids_crc32
    stored = spark.read.parquet(path)
    assert stored.filter("first_doc > last_doc").isEmpty() and stored.agg(F.sum("docs")).first()[0] == len(want)


def test_empty_table(spark):
    path = scratch_path(spark, "test-repair")
    R.write_ids(spark, empty(spark), path)
    assert R.read_ids(spark, path).collect() == []


def test_prefix_sums_over_many_parts(spark):
    rows = [(p, s, (p * 7 + s) % 5) for p in range(0, 5000, 3) for s in range(2)]
    df = spark.createDataFrame(rows, "part int, shard int, n_ids long").repartition(3)
    want, at = {}, 0
    for p, s, n in rows:
        want[p, s] = at
        at += n
    got = {(r.part, r.shard): r.before for r in R.prefix_sums(df, ["part", "shard"], "n_ids").collect()}
    assert got == want


def test_query_equals_the_library(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()]
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in R.op12_token_ids(spark, SF_SMALL).collect())
    assert got == expected(docs)
