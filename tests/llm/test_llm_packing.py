import zlib

import numpy as np
import public_tokenizers
from cases import awkward, empty
from conftest import SF_GATE
from tokenizers import Tokenizer

from barlake.llm import packing as P
from barlake.llm.common import table


def check(docs, rows):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted((str(i), *tok.encode(t or "", add_special_tokens=False).ids, 0) for i, t in docs)
    by = {}
    for r in rows:
        by.setdefault((r.doc_id, r.sequence_id - r_rank(rows, r)), []).append(r)
    got = []
    for (i, _), pieces in by.items():
        pieces.sort(key=lambda r: r.start)
        assert [p.start for p in pieces] == list(np.cumsum([0] + [p.length for p in pieces])[:-1])
        assert all(p.doc_tokens == sum(q.length for q in pieces) for p in pieces)
        assert all(p.length & (p.length - 1) == 0 and p.length <= 1024 and p.offset == 0 for p in pieces)
        assert sorted((p.length for p in pieces), reverse=True) == [p.length for p in pieces]
        ids = b"".join(p.ids for p in pieces)
        assert all(p.ids_crc32 == zlib.crc32(p.ids) for p in pieces)
        got.append((str(i), *np.frombuffer(ids, "<u4").tolist()))
    assert sorted(got) == want
    assert len({r.sequence_id for r in rows}) == len(rows)


def r_rank(rows, r):
    """Pieces of one document have consecutive sequence ids: its place among them."""
    return len([1 for n in P.piece_lengths(r.doc_tokens) if n > r.length]) if r.length < 1024 else r.start // 1024


def test_round_trip(spark):
    docs = table(spark, SF_GATE, "documents").limit(300)
    rows = P.pack(docs).collect()
    check([(r.doc_id, r.text) for r in docs.collect()], rows)


def test_awkward_rows(spark):
    docs = awkward(spark)
    check([(r.doc_id, r.text) for r in docs.collect()], P.pack(docs).collect())


def test_encoder_equals_the_tokenizer():
    e = P.Encoder(public_tokenizers.path(P.TOKENIZER), public_tokenizers.path(P.RANKS))
    tok = Tokenizer.from_file(public_tokenizers.path(P.TOKENIZER))
    for t in ["", " ", "a  b", "a \nb", " lead", "trail ", "<|endoftext|> a", "漢字 kana", "don't I'll", "a\x1c b", "\n\n a\n b",
              "é  ê\t\t z", "1 22 333", "😀 ok", "a  b", "x\r\n y", "ǅ ǆ", "é x"]:
        assert np.frombuffer(e.ids(t), "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)


def test_empty_table_and_buckets(spark, tmp_path):
    assert P.pack(empty(spark)).count() == 0
    pieces = P.pack(awkward(spark))
    P.write_buckets(pieces, f"{tmp_path}/buckets")
    back = spark.read.parquet(f"{tmp_path}/buckets")
    assert back.count() == pieces.count()
    assert back.filter("octet_length(ids) <> 4 * length").count() == 0


def test_lengths():
    for n in (1, 2, 1023, 1024, 1025, 5000):
        out = P.piece_lengths(n)
        assert sum(out) == n and all(x & (x - 1) == 0 and x <= 1024 for x in out)
        assert len([x for x in out if x < 1024]) == len({x for x in out if x < 1024})
