import random

from cases import awkward, empty, words
from conftest import SF_GATE

from barlake.llm import substring as S
from barlake.llm.common import table


def flagged(docs, n=51):
    """Documents that share a run of n words with a smaller id."""
    seen, out = {}, set()
    for i, t in sorted((i, t) for i, t in docs if i is not None):
        w = (t or "").encode().split()
        runs = {tuple(w[j:j + n]) for j in range(len(w) - n + 1)}
        if any(seen.get(r, i) != i for r in runs):
            out.add(i)
        for r in runs:
            seen.setdefault(r, i)
    return out


def test_query_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF_GATE, "documents").collect()]
    rows = S.op10_substring(spark, SF_GATE).collect()
    assert {r.doc_id for r in rows} == flagged(docs)
    texts = dict(docs)
    for r in rows:
        part = texts[r.doc_id].encode().split()[r.first_word:r.first_word + r.n_words]
        assert r.n_words > 50 and r.source_id < r.doc_id
        assert b" ".join(part) in b" ".join(texts[r.source_id].encode().split())


def test_passages_shifted_by_insertions(spark):
    rng = random.Random(3)
    passages = [words(100 + i, n) for i, n in enumerate([51, 60, 75, 120, 300, 50, 30])]
    docs, want = [], set()
    for i in range(140):
        p = i % 7
        text = words(1000 + i, rng.randint(0, 90)) + "\n" + passages[p].replace(" ", rng.choice([" ", "\n", "  "])) + " " + \
            words(5000 + i, rng.randint(0, 90))
        docs.append((i, text))
        if i >= 7 and p < 5:
            want.add(i)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id for r in S.repeated_passages(spark, df).collect()}
    assert got <= want
    assert len(got) >= 0.97 * len(want)


def test_awkward_rows_and_filter(spark):
    df = awkward(spark)
    docs = [(r.doc_id, r.text) for r in df.collect()]
    assert {r.doc_id for r in S.repeated_passages(spark, df).collect()} == flagged(docs) == {3, 11}
    out = S.remove_passages(spark, df)
    assert out.columns == df.columns and out.dtypes == df.dtypes
    rows = {r.doc_id: r for r in out.collect()}
    assert 11 not in rows                                  # nothing is left of it
    assert rows[3].text.split() == words(4, 30).split() and rows[3].n_chars == len(rows[3].text)
    same = {i: t for i, t in docs if i not in (3, 11)}
    assert all(rows[i].text == t for i, t in same.items())
    assert out.count() == df.count() - 1


def test_empty_table(spark):
    assert S.repeated_passages(spark, empty(spark)).count() == 0
    assert S.remove_passages(spark, empty(spark)).columns == empty(spark).columns


def test_hash_blocks_agree(monkeypatch):
    import numpy as np
    data = b" ".join(words(9, 400).encode().split())
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    whole = S.word_hashes_at_ends(data, ends)
    monkeypatch.setattr(S, "BLOCK", 97)
    assert (S.word_hashes_at_ends(data, ends) == whole).all()
    h = 0
    for b in data[:16]:
        h = (h * 2 + int(S.GEAR[b])) % 2**32
    assert h == int(S.gear_hash(data)[15])


def test_passage_whose_parts_come_from_other_documents(spark):
    """The first holder of the whole passage is found, not those of its parts."""
    p = words(50, 80).split()
    docs = [(1, words(51, 30) + " " + " ".join(p[:40])), (2, " ".join(p[40:]) + " " + words(52, 30))]
    docs += [(3 + i, words(60 + i, 20) + " " + " ".join(p[i:i + 50]) + " " + words(90 + i, 20)) for i in range(0, 31, 5)]
    docs += [(100, words(53, 25) + " " + " ".join(p) + " " + words(54, 25)), (200, " ".join(p[:70]) + " " + words(55, 25)),
             (201, words(56, 9) + " " + " ".join(p[9:60]))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.source_id, r.first_word, r.n_words) for r in S.repeated_passages(spark, df).collect()}
    assert got == {(200, 100, 0, 70), (201, 100, 9, 51)}


def test_every_passage_of_51_words_and_repeated_lines(spark):
    """Full recall however few distinct word ends a passage has."""
    docs, want = [], set()
    for k in range(300):                                       # prose of exactly 51 words
        p = words(10_000 + k, 51)
        docs += [(2 * k, words(20_000 + k, 7) + " " + p + " " + words(30_000 + k, 7)), (2 * k + 1, words(40_000 + k, 5) + "\n" + p)]
        want.add(2 * k + 1)
    for k in range(60):                                        # one line of 1 to 10 words over and over
        line = words(50_000 + k, 1 + k % 10).split()
        p = " ".join((line * 60)[:51 + k])
        docs += [(1000 + 2 * k, words(60_000 + k, 12) + " " + p + " " + words(70_000 + k, 3)), (1001 + 2 * k, p + " " + words(80_000 + k, 20))]
        want.add(1001 + 2 * k)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id for r in S.repeated_passages(spark, df).collect()}
    assert got == want == flagged(docs)


def test_matches_in_repetitive_texts_are_exact():
    rng = random.Random(11)
    for _ in range(300):
        a, b = ([rng.choice("ab").encode() * rng.randint(1, 2) for _ in range(rng.randint(40, 90))] * rng.randint(1, 3) for _ in range(2))
        p = [rng.choice([b"x", b"y"])] * rng.randint(40, 130)
        i, j = rng.randint(0, len(a)), rng.randint(0, len(b))
        a, b = a[:i] + p + a[i:], b[:j] + p[rng.randint(0, 9):] + b[j:]
        runs = {tuple(b[k:k + 51]) for k in range(len(b) - 50)}
        covered = {w for k in range(len(a) - 50) if tuple(a[k:k + 51]) in runs for w in range(k, k + 51)}
        spans = S.common_passages(S.Words.of(b" ".join(a)), S.Words.of(b" ".join(b)))
        assert {w for x, y in spans for w in range(x, y)} == covered
        text = b" " + b" ".join(b) + b" "
        assert all(b" " + b" ".join(a[x:y]) + b" " in text for x, y in spans)
