"""The divergence audit against SQL and a plain computation."""

import re
from collections import Counter, defaultdict

import pytest
from cases import awkward, empty
from compare import compare
from conftest import SF_GATE, SF_SMALL

from barlake.llm import divergence as D

WORD = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows):
    counts, df, groups, out = defaultdict(Counter), defaultdict(Counter), defaultdict(set), []
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        terms = WORD.findall(text.translate(LOWER))
        groups[lang].add(source)
        counts[lang, source].update(terms)
        df[lang].update(set(terms))
    for lang, sources in groups.items():
        kept = [t for t, n in df[lang].items() if n >= 3]

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10 ** 9 * (c[t] + 1) // (total + len(kept)) for t in kept}
        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        f = lambda x, y: (x - y) * (x - y) // y
        for s in sources:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, 200)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, r) for r, (item, v) in enumerate(found[:most], 1)]
    return sorted(out)


def got(spark, df):
    return sorted(map(tuple, D.audit(spark, df).collect()))


@pytest.mark.parametrize("group_block, term_block, held", [(64, 4096, 400_000), (2, 3, 4), (1, 1, 1)])
def test_awkward_rows_in_any_cube(spark, monkeypatch, group_block, term_block, held):
    for name, value in (("GROUP_BLOCK", group_block), ("TERM_BLOCK", term_block), ("HELD", held)):
        monkeypatch.setattr(D, name, value)
    rows = [("Das DAS das x_y z", "de", s) for s in "abcde"] + [("é É é ß das", "de", "a"), ("das!", "de", "ä"), (None, "de", "f"),
            ("x", "xx", "only"), (None, "yy", "p"), ("", "yy", "q"), ("rare one", "zz", "p"), ("w " * 900 + "v", "en", "a"),
            ("w v", "en", "b"), ("v u\x00w", "en", None), ("u u u", None, None), ("u", None, ""), ("U", "", "k"), ("u", "", "k")]
    frame = spark.createDataFrame([(i, t, la, s, "x", 1) for i, (t, la, s) in enumerate(rows)],
                                  "doc_id long, text string, lang string, source string, term string, n int").repartition(3)
    assert got(spark, frame) == plain(rows)
    more = awkward(spark)
    assert got(spark, more) == plain([(r.text, r.lang, r.source) for r in more.collect()])


def test_empty_table(spark):
    assert got(spark, empty(spark)) == []


def test_sums_beyond_a_long_stay_exact():
    import numpy as np
    a, b = np.array([[10 ** 9] * 40]), np.array([[1] * 40])
    hi, lo = D.compare_cell(a, b, np.array([1]), np.array([1]))
    assert (int(hi[0, 0]) << D.LIMB) + int(lo[0, 0]) == 40 * (10 ** 9 - 1) ** 2 > 2 ** 63


def test_query_equals_sql(spark, con_small, con_gate):
    for sf, con in ((SF_SMALL, con_small), (SF_GATE, con_gate)):
        ok, msg = compare(D.op13_divergence(spark, sf), con, D.OP13_SQL)
        assert ok, msg
