"""Embeddings, token counts, HTML extraction, and the pipeline."""

import html as H
import json
import re

import numpy as np
import public_tokenizers
from cases import awkward, empty, words
from conftest import SF_GATE, SF_SMALL

import corpus_pipeline
from barlake.llm import embedding as E
from barlake.llm import tokencount as C
from barlake.llm import wrappers as W
from barlake.llm.common import table

VECTORS = "vec_id long, embedding array<double>, label int, rep long"


def links(rows):
    """Brute force: {vec_id: (n_links, component_id)}."""
    ok = {i: np.array(v) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    near = {i: set() for i, _ in rows}
    for i, a in ok.items():
        for j, b in ok.items():
            if i != j and len(a) == len(b) and a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= 0.95:
                near[i].add(j)
    out = {}
    for i in near:
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out[i] = (len(near[i]), min(seen, key=lambda x: (x is None, x)))
    return out


def test_embedding_links_match_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows, n = [], 0
    for size in (1, 1, 2, 5, 40, 90):
        base = rng.normal(size=32)
        for _ in range(size):
            rows.append((n * 3 % 1000, (base + rng.normal(size=32) * np.linalg.norm(base) / 32 ** 0.5 * 0.12).tolist()))
            n += 1
    rows += [(2000 + i, rng.normal(size=32).tolist()) for i in range(200)] + [(3000 + i, [1.0, 2.0, 3.0]) for i in range(30)]
    rows += [(4000, None), (4001, []), (4002, [0.0] * 32), (4003, [float("nan")] * 32), (4004, [None] * 32),
             (4005, [float("inf")] * 32), (4006, [2.0, 4.0, 6.0]), (4007, rows[0][1])]
    df = spark.createDataFrame([(i, v, 0, 1) for i, v in rows], VECTORS)
    want = links(rows)
    for block in (1024, 16):          # whole buckets, and buckets split into blocks
        monkeypatch.setattr(E, "BLOCK", block)
        got = {r.vec_id: (r.n_links, r.component_id) for r in E.near_duplicates(spark, df).collect()}
        found = sum(got[i][0] for i in want)
        assert set(got) == set(want) and found >= 0.99 * sum(v[0] for v in want.values())
        assert all(got[i][0] <= want[i][0] for i in want)
        assert sum(got[i] == want[i] for i in want) >= 0.98 * len(want)


def test_embedding_null_and_empty(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0], 0, 1), (1, [1.0, 0.0], 0, 1), (1, [1.0, 0.0], 0, 1), (2, [1.0, 0.01], 0, 1)], VECTORS)
    got = sorted(map(tuple, E.near_duplicates(spark, df).collect()), key=str)
    assert got == sorted([(None, 0, None, True), (1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False)], key=str)
    assert E.near_duplicates(spark, spark.createDataFrame([], VECTORS)).count() == 0


def test_embedding_repeated_ids_with_different_vectors(spark):
    """Vectors of their own, one node of a component."""
    near = lambda x: [1.0, x, 0.0]
    rows = [(1, near(0.0)), (1, near(0.01)), (2, near(0.02)), (3, near(0.03)), (2, [0.0, 0.0, 1.0]), (7, [0.0, 0.05, 1.0]),
            (8, [0.0, 1.0, 0.0]), (8, None), (6, [0.0, 1.0, 0.01]), (9, [-1.0, 0.0, 0.0]), (9, [0.0, -1.0, 0.0]), (3, near(0.03))]
    got = sorted(map(tuple, E.near_duplicates(spark, spark.createDataFrame([(i, v, 0, 1) for i, v in rows], VECTORS)).collect()))
    assert got == sorted([(1, 3, 1, True), (1, 3, 1, True), (2, 3, 1, False), (3, 3, 1, False), (3, 3, 1, False), (2, 1, 1, False),
                          (7, 1, 1, False), (8, 1, 6, False), (8, 0, 6, False), (6, 1, 6, True), (9, 0, 9, True), (9, 0, 9, True)])


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(0)
    v = rng.normal(size=(2000, 64))
    v /= np.linalg.norm(v, axis=1)[:, None]
    q = 0.9 * v + 0.1 * rng.normal(size=v.shape) / 8
    q /= np.linalg.norm(q, axis=1)[:, None]
    turn = E.rotations(64, 64)[0]
    turned = v @ turn.T
    factor = np.abs(turned).sum(1) / 8
    guess, error = E.estimates(q @ turn.T, np.where(turned >= 0, 1.0, -1.0), factor)
    exact = (v * q).sum(1)
    assert abs((guess - exact).mean()) < 0.005 and (np.abs(guess - exact) <= error).all()


def test_embedding_query(spark):
    out = E.op3_embedding(spark, SF_SMALL)
    assert out.count() == table(spark, SF_SMALL, "embeddings").count()


def best_count(word, pieces):
    best = [(0.0, 0)]
    for i in range(1, len(word) + 1):
        s, n = best[i - 1][0] + C.UNKNOWN_SCORE, best[i - 1][1] + 1
        for j in range(i):
            p = pieces.get(word[j:i])
            if p is not None and (best[j][0] + p > s or best[j][0] + p == s and best[j][1] + 1 < n):
                s, n = best[j][0] + p, best[j][1] + 1
        best.append((s, n))
    return best[-1][1]


def test_token_counts_match_plain_programming(spark, monkeypatch):
    pieces = C.load_pieces(public_tokenizers.path(C.PIECES))
    docs = table(spark, SF_SMALL, "documents").unionByName(awkward(spark).select("doc_id", "text", "lang", "source", "n_chars")).limit(260)
    rows = sorted(map(tuple, C.count_tokens(docs).collect()), key=str)
    known = {}
    want = []
    for r in docs.collect():
        w = (r.text or "").split()
        for x in w:
            if x not in known:
                known[x] = best_count("▁" + x, pieces) if len(x) < 1000 else None
        want.append((r.doc_id, len(w), sum(known[x] for x in w) if None not in map(known.get, w) else -1))
    assert all(a[:2] == b[:2] and b[2] in (a[2], -1) for a, b in zip(rows, sorted(want, key=str)))


def test_token_trie_restarts():
    pieces = {"▁a": -1.0, "b": -1.0, "ab": -1.5, "▁": -2.0, "a": -1.2}
    trie = C.PreTokenTrie(pieces)
    old, C.MOST_NODES = C.MOST_NODES, 3
    try:
        for w in ["▁aab", "▁ab", "▁abab", "▁xyz", "▁aab"] * 3:
            assert trie.count(w) == best_count(w, pieces)
    finally:
        C.MOST_NODES = old
    assert sum(len(p) for p in C.words_of("a b " * 10)) == 20


def test_pages_match_a_plain_parse(spark):
    rows = W.op9_extract(spark, SF_GATE).collect()
    source = {r.page_id: r.html for r in table(spark, SF_GATE, "pages").collect()}
    assert len(rows) == len(source)
    for r in rows:
        body = re.search(r"<article>(.*?)</article>", source[r.page_id], re.S)[1]
        parts = (" ".join(H.unescape(re.sub(r"<[^>]+>", " ", p)).split()) for p in re.split(r"</?(?:h1|p)>", body))
        assert r.text == "\n".join(filter(None, parts)) and r.n_chars == len(r.text)


def test_page_parts(spark):
    page = ("<html><head><title>T</title><style>p{}</style></head><body><header>Head</header><nav><ul><li>Menu</li></ul></nav>"
            "<div class='cookie-notice'>Cookies</div><article><h1>A &amp; B</h1><p>one <b>two</b>three\n  four</p>{}"
            "<aside>Side</aside><form><input>Form</form><div class=\"ad\">Ad</div><script>if (a<b) x();</script>"
            "<p>last&nbsp;&lt;p&gt;</p><section id='comments'><p>Me too</p></section></article><footer>Foot</footer>")
    lists = ["", "<ul><li>x</li></ul>", "<ul><li>x</li><li>y</li><li>z</li></ul>"]
    pages = [(i, "http://h.example/a", page.replace("{}", x), 1) for i, x in enumerate(lists)]
    pages += [(10, None, None, 1), (11, "", "", 1), (12, "http://o.example/", "<p>only <i>body</i><p>text", 1), (12, "http://o.example/", "<br>", 1)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, host long")
    rows = {(r.page_id, r.n_chars): r for r in W.extract(spark, df).collect()}
    by = {r.page_id: r.text for r in rows.values() if r.n_chars}
    for i, extra in enumerate(["", "\nx", "\nx\ny\nz"]):
        assert by[i] == f"A & B\none twothree four{extra}\nlast <p>"
    assert by[12] == "only body\ntext"
    assert sorted(r.page_id for r in rows.values() if not r.n_chars) == [10, 11, 12]
    assert W.extract(spark, df.limit(0)).count() == 0


def test_hosts_with_two_kinds_of_pages(spark):
    """A page without <article> keeps its text whatever the host's other pages have."""
    article = "<html><body><nav><a>Menu</a></nav><div><p>x</p></div><article><h1>T</h1><p>one</p><p>two</p></article><footer>F</footer></body></html>"
    plain = "<html><body><nav><a>Menu</a></nav><div><h2>List</h2><p>first</p><p>second<br>line</p><div>third</div></div><footer>F</footer></body></html>"
    old = "<body><table><tr><td>old <b>text</b></td></tr></table><p>end</p></body>"
    urls = ["http://mixed.example/{}", None, "/relative/{}", "odd"]
    made = [(u and u.format(k), html) for u in urls for k, html in enumerate([article, plain, old])]
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(made)], "page_id long, url string, html string")
    want = ["T\none\ntwo", "List\nfirst\nsecond line\nthird", "old text\nend"]
    got = {r.page_id: r.text for r in W.extract(spark, df).collect()}
    assert [got[i] for i in range(len(made))] == want * len(urls)


def test_alignment_makes_optional_and_repeated_groups():
    a = W.fold("article h1 # /h1 p # /p p # /p /article".split())[0]
    b = W.fold("article h1 # /h1 p # /p /article".split())[0]
    c = W.fold("article h1 # /h1 img p # /p p # /p /article".split())[0]
    both = W.align(a, b)
    assert both == ["article", "h1", "#", "/h1", ["+", ["p", "#", "/p"]], "/article"]
    assert W.align(both, c)[4] == ["?", "img"]
    assert W.roles(W.align(both, c), b) == [True, True]
    assert W.fold(["p", "#", "/p"] * 3)[1] == [[0, 1, 2]]


def test_many_shapes_of_a_host(spark, monkeypatch):
    monkeypatch.setattr(W, "GROUP", 4)
    pages = [(i, "http://h.example/", "<body><nav>m</nav><article>" + "".join(f"<h{1 + (i >> b) % 2}>t{b}</h{1 + (i >> b) % 2}>" for b in range(5)) +
              "</article>") for i in range(32)]
    rows = W.extract(spark, spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert {r.text for r in rows} == {"t0\nt1\nt2\nt3\nt4"}


def test_pipeline_stages(spark):
    """Each stage against its operator's rule on the stage's own input."""
    from test_llm_decontam import brute as hits
    from test_llm_minhash import brute as groups
    docs = table(spark, SF_GATE, "documents")
    cols = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_GATE)
        if name != "pack":
            assert out.columns == cols
        before = {r.doc_id: r.text for r in docs.collect()}
        out = spark.createDataFrame(out.collect(), out.schema)
        after = {r.doc_id: r for r in out.collect()}
        seen[name] = len(after)
        if name == "quality":
            label = {r.doc_id: r.quality for r in table(spark, SF_GATE, "labels").collect()}
            gone = [label[i] for i in before if i not in after and i in label]
            assert gone.count(1) == 0 and gone.count(0) > 0.9 * list(label.values()).count(0)
        elif name == "near_dedup":
            assert set(after) == {i for i, v in groups(before).items() if v[2]}
        elif name == "substring_dedup":
            assert set(after) <= set(before) and any(after[i].text != before[i] for i in after)
        elif name == "decontaminate":
            items = [(r.item_id, r.text) for r in table(spark, SF_GATE, "benchmark").collect()]
            bad = {r[0] for r in hits(list(before.items())[:150], items) if r[4]}
            assert not bad & set(after)
        else:
            assert set(after) == set(before)
        docs = out
    run = corpus_pipeline.run(spark, SF_GATE)
    assert run.select("doc_id").distinct().count() == seen["pack"]


def test_awkward_rows_through_the_pipeline(spark, tmp_path):
    awkward(spark).write.parquet(f"{tmp_path}/documents.parquet")
    table(spark, SF_SMALL, "labels").write.parquet(f"{tmp_path}/labels.parquet")
    table(spark, SF_SMALL, "benchmark").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    empty(spark).write.parquet(f"{tmp_path}/none/documents.parquet")
    table(spark, SF_SMALL, "labels").limit(0).write.parquet(f"{tmp_path}/none/labels.parquet")
    table(spark, SF_SMALL, "benchmark").limit(0).write.parquet(f"{tmp_path}/none/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
