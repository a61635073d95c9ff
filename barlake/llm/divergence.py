"""13. Source divergence audit by three-dimensional cube partitioning.

How far do the word distributions of the sources of one language lie apart, and
which words make a source stand out?  Terms are counted per (lang, source) and
kept where enough documents of the language have them.  Every group, and each
language as a whole, gives each kept term a smoothed share p in billionths; the
divergence of p from q adds (p - q)^2 / q, rounded down, over all kept terms.

Pairs of groups are compared in a cube of cells (group block, group block, term
block).  A group's counts in a term block, a slice, are replicated to the cells of
its own block with each other block; a cell adds up, for its pairs in both
directions, what the terms that occur in one of its slices contribute beyond two
absent counts; sums over cells are reduced along the term axis, and the
contribution of two absent counts, a constant of the pair, is added for all kept
terms at once.  So only counts above 0 travel, a cell holds at most GROUP_BLOCK
groups on each side and about TERM_BLOCK terms, and a hot source or a frequent word
is one count per term or group like any other.

Defined results: null lang, source and text are read as ''; documents are rows,
so repeated rows count as often as they stand; a group without terms has count 0
throughout; a language without kept terms has pairs of value 0 and no terms; an
only source has no pairs; an empty table gives an empty result.  A value beyond a
long is null.  Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barlake.llm.common import binaries, staged, table, word_lists

LEAST_DOCS = 3            # documents of the language that have a kept term
SHARE = 1_000_000_000
TOP_TERMS = 200
GROUP_BLOCK = 64          # groups of a block
TERM_BLOCK = 4096         # kept terms of a block, about
HELD = 400_000            # counts a task holds before it passes them on
LIMB = 30                 # sums are kept in two limbs, the lower one of so many bits

# Terms: [^\x00-\x40\x5B-\x60\x7B-\x7F]+ after lower-casing A-Z, byte by byte (see common.ALNUM_WORDS).
LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))

COUNTS = "lang string, source string, term string, n long, docs long"


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, added up within
    tasks as far as HELD counts go; a row with a null term for each group seen."""
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[tuple, Counter] = defaultdict(Counter)
        with_term: dict[tuple, Counter] = defaultdict(Counter)
        held = 0

        def rows():
            cols: list[list] = [[], [], [], [], []]
            for group, counter in n.items():
                have = with_term[group]
                terms = [None, *counter]
                for col, part in zip(cols, ([group[0]] * len(terms), [group[1]] * len(terms), [None, *(t.decode() for t in counter)],
                                            [0, *counter.values()], [0, *(have[t] for t in counter)])):
                    col.extend(part)
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in cols[:3]), *(pa.array(c, pa.int64()) for c in cols[3:])],
                                              names=["lang", "source", "term", "n", "docs"])

        for batch in batches:
            for lang, source, data in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), binaries(batch.column(0))):
                counter, seen = n[lang, source], set()
                held -= len(counter)
                for words in word_lists(data, LETTERS):
                    counter.update(words)
                    seen.update(words)
                with_term[lang, source].update(seen)
                held += len(counter)
                if held > HELD:
                    yield rows()
                    n.clear()
                    with_term.clear()
                    held = 0
        if n:
            yield rows()

    per_task = docs.select(text("text"), text("lang"), text("source")).mapInArrow(run, COUNTS)
    return per_task.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SHARE * (count + 1) / (total + kept)), exactly."""
    wide = lambda x: x.cast("decimal(19,0)")
    return F.expr("1") + _div(F.lit(SHARE).cast("decimal(10,0)") * wide(count + 1), wide(total + kept))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def excess(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q) as a long; both are at most SHARE + 1."""
    return _div((p - q) * (p - q), q)


def _limbs(x: np.ndarray, axis: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of signed 64-bit numbers along an axis, in two limbs that can't overflow."""
    return (x >> LIMB).sum(axis), (x & ((1 << LIMB) - 1)).sum(axis)


def compare_cell(a: np.ndarray, b: np.ndarray, a0: np.ndarray, b0: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups with shares ``a`` (groups, terms) against ``b``: limbs of the sums
    of floor((p - q)^2 / q) less the same of the absent shares, (groups of a, of b)."""
    hi = np.zeros((len(a), len(b)), np.int64)
    lo = np.zeros_like(hi)
    for i in range(len(a)):
        d = a[i] - b
        d0 = a0[i] - b0
        hi[i], lo[i] = _limbs(d * d // b - (d0 * d0 // b0)[:, None], 1)
    return hi, lo


CELL = "lang string, a int, b int, hi long, lo long"


def _cell(key, rows):
    """One cell of the cube: rows (side, grp, p0, term, p); a null term names a
    group of the block, the others are its counts above 0."""
    lang, left, right = key[0].as_py(), key[1].as_py(), key[2].as_py()
    side, grp, p0, p = (rows[c].to_numpy() for c in ("side", "grp", "p0", "p"))
    named = rows["term"].is_null().to_numpy()
    terms = rows["term"].filter(pa.array(~named)).combine_chunks().dictionary_encode()
    at = terms.indices.to_numpy()
    shares, absent, names = [], [], []
    for s in ((0,) if left == right else (0, 1)):
        head = named & (side == s)
        order = np.argsort(grp[head])
        names.append(grp[head][order])
        absent.append(p0[head][order])
        m = np.repeat(absent[-1][:, None], len(terms.dictionary), 1)
        here = side[~named] == s
        m[np.searchsorted(names[-1], grp[~named][here]), at[here]] = p[~named][here]
        shares.append(m)
    out: list[tuple] = []
    for x, y in (((0, 0),) if left == right else ((0, 1), (1, 0))):
        hi, lo = compare_cell(shares[x], shares[y], absent[x], absent[y])
        i, j = np.meshgrid(np.arange(len(names[x])), np.arange(len(names[y])), indexing="ij")
        keep = (names[x][i] != names[y][j]).ravel()
        out.append((names[x][i].ravel()[keep], names[y][j].ravel()[keep], hi.ravel()[keep], lo.ravel()[keep]))
    a, b, hi, lo = (np.concatenate(c) for c in zip(*out))
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "a": pa.array(a, pa.int32()), "b": pa.array(b, pa.int32()),
                     "hi": pa.array(hi, pa.int64()), "lo": pa.array(lo, pa.int64())})


def cube_sums(groups: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, a, b, hi, lo): each pair's sum over the terms that occur in a slice
    of its blocks.  ``groups(lang, grp, p0, blocks, term_blocks)``,
    ``counts(lang, grp, p0, term, p, blocks, term_blocks)``."""
    block = F.floor(F.col("grp") / GROUP_BLOCK).cast("int")
    t = F.pmod(F.xxhash64("term"), F.col("term_blocks")).cast("int")
    heads = groups.withColumns({"t": F.explode(F.sequence(F.lit(0), (F.col("term_blocks") - 1).cast("int"))),
                                "term": F.lit(None).cast("string"), "p": F.lit(0).cast("long")})
    cols = ["lang", "grp", "p0", "t", "term", "p", "blocks"]
    slices = counts.withColumn("t", t).select(*cols).unionByName(heads.select(*cols)).withColumn("own", block)
    cells = (slices.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("lang", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "t",
                     F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"), "grp", "p0", "term", "p"))
    partial = cells.groupBy("lang", "i", "j", "t").applyInArrow(_cell, CELL)
    return partial.groupBy("lang", "a", "b").agg(*[F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("hi", "lo")])


def numbered(groups: DataFrame) -> DataFrame:
    """``groups`` with ``grp``: a number from 0 within each language."""
    w = Window.partitionBy("lang").orderBy("source")
    return groups.withColumn("grp", F.row_number().over(w) - 1)


def audit(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank), see the module's head."""
    counted = staged(spark, term_counts(docs), "divergence-counts")
    found = counted.filter("term is not null")
    kept = (found.groupBy("lang", "term").agg(F.sum("n").alias("n_lang"), F.sum("docs").alias("docs"))
            .filter(F.col("docs") >= LEAST_DOCS).drop("docs"))
    kept = staged(spark, kept, "divergence-kept")
    counts = staged(spark, found.drop("docs").join(kept, ["lang", "term"]), "divergence-slices")
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n_lang").alias("n_all"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counted.filter("term is null").select("lang", "source").distinct()
    groups = (numbered(groups).join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
              .fillna(0, ["total", "v", "n_all"]))
    sizes = groups.groupBy("lang").agg(F.ceil(F.count("*") / GROUP_BLOCK).cast("int").alias("blocks"))
    p0 = F.when(F.col("v") > 0, share(F.lit(0).cast("long"), F.col("total"), F.greatest("v", F.lit(1)))).otherwise(1)
    groups = groups.join(sizes, "lang").withColumns({
        "p0": p0.cast("long"), "term_blocks": F.greatest(F.ceil(F.col("v") / TERM_BLOCK), F.lit(1)).cast("int")})
    groups = staged(spark, groups, "divergence-groups")
    shared = counts.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("v")))

    q = share(F.col("n_lang"), F.col("n_all"), F.col("v"))
    terms = (shared.withColumn("q", q).filter("p > q")
             .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), excess(F.col("p"), F.col("q")).alias("value")))
    terms = ranked(terms).filter(F.col("rank") <= TOP_TERMS)

    sums = cube_sums(groups, shared)
    side = lambda x: groups.select("lang", F.col("grp").alias(x), F.col("source").alias(f"{x}_source"),
                                   F.col("p0").alias(f"{x}_p0"), *(["v"] if x == "a" else []))
    absent = excess(F.col("a_p0"), F.col("b_p0")).cast("decimal(19,0)") * F.col("v").cast("decimal(18,0)")
    value = F.col("hi").cast("decimal(27,0)") * F.lit(1 << LIMB).cast("decimal(10,0)") + F.col("lo") + absent
    pairs = (sums.join(side("a"), ["lang", "a"]).join(side("b"), ["lang", "b"])
             .select("lang", F.col("a_source").alias("source"), F.lit("pair").alias("part"), F.col("b_source").alias("item"),
                     value.try_cast("long").alias("value")))
    return ranked(pairs).unionByName(terms)


def ranked(rows: DataFrame) -> DataFrame:
    w = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())
    return rows.withColumn("rank", F.row_number().over(w))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark, table(spark, sf_dir, "documents"))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
OP13_SQL = f"""WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}') AS text FROM documents
), words AS (
  SELECT d, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs
), kept AS MATERIALIZED (
  SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT d) >= {LEAST_DOCS}
), langs AS (
  SELECT lang, count(*) AS v, sum(n) AS n_all FROM kept GROUP BY lang
), counts AS MATERIALIZED (
  SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL
), groups AS MATERIALIZED (
  SELECT lang, source, coalesce((SELECT sum(n) FROM counts c WHERE c.lang = g.lang AND c.source = g.source), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM docs) g
), shares AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + ({SHARE}::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.total + l.v)::HUGEINT AS p,
    1 + ({SHARE}::HUGEINT * (k.n + 1)) // (l.n_all + l.v)::HUGEINT AS q
  FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (
    SELECT x.lang, x.source, y.source AS other, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
    FROM shares x JOIN shares y USING (lang, term) GROUP BY x.lang, x.source, y.source
  ) s ON s.lang = a.lang AND s.source = a.source AND s.other = b.source
), found AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM found QUALIFY part = 'pair' OR rank <= {TOP_TERMS}"""
