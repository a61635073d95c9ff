"""9. HTML extraction by union-free wrappers, one per host and kind of page.

A page is a stream of tags and texts.  Folding replaces adjacent repetitions of
a group of tags by the group in a repetition (`+`), which gives the page's
shape.  The shapes of a host are aligned pair by pair: equal items match; where
a repeated group of one stream meets a single copy of its content in the other,
the copy counts as one repetition; repeated groups that begin alike are aligned
inside; what remains unmatched becomes optional.  The result, a regular
expression without unions, is the host's wrapper, and its text slots are judged
once: a slot is main text if it lies in the article (or the main part; in the
body for pages that have neither) and in no menu, header, footer, sidebar,
notice, advert, form, script, style or reader comment.  A text that its
page's own tags put into the article or outside stays there; others count as in
the article if the slot that they are aligned with is, so a chance alignment
never takes a text away.

Pages with text in an article or main part and pages without are two kinds: each
has its own wrapper, so a host's articles take nothing from its other pages.

Shapes are aligned GROUP at a time and the results again, so a host with very
many shapes is never one task's work; equal shapes of a host count once.

Defined results: a null, empty or text-free page gives an empty text; a null or
odd url has the host '', whose pages have nothing in common and are each their
own wrapper; rows that share a page_id are extracted one by one;
unclosed and stray tags are tolerated; extra columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from difflib import SequenceMatcher
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm.common import staged, table

GROUP = 32                # shapes or wrappers of a host aligned by one task
LONGEST_REPEAT = 24       # items of a repeated group
SHAPES_BROADCAST = 50_000 # up to so many judged shapes are sent to every task

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|select|svg)\b[^>]*>.*?(?:</\1\s*>|\Z)"
                   r"|<(/?)([a-zA-Z][\w:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S | re.I)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

# HTML's block elements, elements outside the main text, and usual names of such parts.
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section "
                   "summary table tbody td tfoot th thead title tr ul".split())
CONTAINERS = BLOCKS - frozenset("p li dt dd h1 h2 h3 h4 h5 h6 hr option tr td th".split()) | {"button", "label", "iframe"}
OUTSIDE = frozenset("nav header footer aside form head title menu dialog button label iframe fieldset legend".split())
OUTSIDE_NAMES = frozenset("ad ads advert adverts advertisement advertisements adsense banner banners breadcrumb breadcrumbs "
                          "comment comments consent cookie cookies disclaimer disqus footer form header login masthead menu "
                          "modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup "
                          "promo promotion related replies reply search share sharing sidebar signup social sponsor sponsored "
                          "subscribe subscription toolbar widget".split())
ARTICLE = "article"

Item = str | list         # a token, or ["+", items]


def host_of(url: str | None) -> str:
    m = re.match(r"\s*(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:\s]*)", url or "")
    return m[1].lower() if m else ""


def tokens(html: str) -> tuple[list[str], list[str], list[int]]:
    """Token stream (``#`` for a text), the raw texts, and each text's block."""
    stream: list[str] = []
    texts: list[str] = []
    blocks: list[int] = []
    block = at = 0
    space = False             # white space was left out since the last text of this block

    def text(raw: str) -> None:
        nonlocal space
        if raw and not raw.isspace():
            stream.append("#")
            texts.append(" " + raw if space else raw)
            blocks.append(block)
            space = False
        elif raw:
            space = True

    for m in TOKEN.finditer(html):
        text(html[at:m.start()])
        at = m.end()
        name = (m[3] or "").lower()
        if not name:
            continue
        if name in BLOCKS:
            block += 1
            space = False
        if name == "br":
            space = True
        if m[2]:
            stream.append(f"/{name}")
        else:
            found = " ".join(next(filter(None, g), "") for g in NAMES.findall(m[4])) if m[4] else ""
            marks = sorted(OUTSIDE_NAMES.intersection(re.split(r"[\s_-]+", found.lower()))) if found else []
            if "main" in found.lower().split():
                marks.append("=main")
            stream.append(".".join([name, *marks]))
    text(html[at:])
    return stream, texts, blocks


def fold(stream: list[str]) -> tuple[list[Item], list[list[int]]]:
    """The shape of a stream, and for each of its text slots (in order) the
    texts that fall into it."""
    keys: list = list(stream)
    slots: list = []
    n = 0
    for s in stream:
        slots.append([[n]] if s == "#" else [])
        n += s == "#"
    length = 1
    while length <= min(LONGEST_REPEAT, len(keys) // 2):
        out_keys, out_slots, i, folded = [], [], 0, False
        while i < len(keys):
            group = keys[i:i + length]
            j = i + length
            if len(group) == length and keys[j:j + length] == group:
                merged = [list(x) for part in slots[i:j] for x in part]
                while keys[j:j + length] == group:
                    again = [x for part in slots[j:j + length] for x in part]
                    for a, b in zip(merged, again):
                        a.extend(b)
                    j += length
                if length == 1 and isinstance(group[0], list):
                    out_keys.append(group[0])
                else:
                    out_keys.append(["+", group])
                out_slots.append(merged)
                i, folded = j, True
            else:
                out_keys.append(keys[i])
                out_slots.append(slots[i])
                i += 1
        keys, slots = out_keys, out_slots
        length = 1 if folded and length > 1 else length + 1
    return keys, [x for part in slots for x in part]


def _key(item: Item) -> str:
    return item if isinstance(item, str) else json.dumps(item)


def _absorb(items: list, groups: list[list]) -> list:
    """Single copies of a repeated group's content count as one repetition."""
    for group in groups:
        inner, n = group[1], len(group[1])
        i = 0
        while i + n <= len(items):
            if items[i:i + n] == inner:
                items = [*items[:i], group, *items[i + n:]]
            i += 1
    return items


def _repeated(items: list) -> list[list]:
    return [x for x in items if isinstance(x, list) and x[0] == "+"]


def _plain(wrapper: list) -> list:
    return [x[1] if isinstance(x, list) and x[0] == "?" else x for x in wrapper]


def align(wrapper: list, shape: list) -> list:
    """Wrapper of both.  Optional items are ["?", item]."""
    if wrapper == shape:
        return wrapper
    maybe = [isinstance(x, list) and x[0] == "?" for x in wrapper]
    a = _plain(wrapper)
    if not any(maybe):
        a = _absorb(a, _repeated(_plain(shape)))
        maybe = [False] * len(a)
    other = [isinstance(x, list) and x[0] == "?" for x in shape]
    b = _plain(shape)
    if not any(other):
        b = _absorb(b, _repeated(a))
        other = [False] * len(b)
    out: list = []

    def optional(item):
        return ["?", item]

    match = SequenceMatcher(None, [_key(x) for x in a], [_key(x) for x in b], autojunk=False)
    for kind, i1, i2, j1, j2 in match.get_opcodes():
        if kind == "equal":
            out += [optional(x) if m or o else x for x, m, o in zip(a[i1:i2], maybe[i1:i2], other[j1:j2])]
            continue
        left, right = a[i1:i2], b[j1:j2]
        if len(left) == len(right) == 1 and all(isinstance(x, list) and x[0] == "+" for x in left + right) and \
                _key(left[0][1][0]) == _key(right[0][1][0]):
            merged = ["+", align(left[0][1], right[0][1])]
            out.append(optional(merged) if maybe[i1] or other[j1] else merged)
        else:
            out += [optional(x) for x in left] + [optional(x) for x in right]
    return out


def judge(items: list, stack: list[str] | None = None) -> list[bool | None]:
    """For each text slot in order: outside (False), in the article (True), or
    neither (None)."""
    stack = [] if stack is None else stack
    out: list[bool | None] = []
    for item in items:
        while isinstance(item, list) and item[0] == "?":
            item = item[1]
        if isinstance(item, list):
            out += judge(item[1], stack)
        elif item == "#":
            names = [s.split(".") for s in stack]
            if any(n[0] in OUTSIDE or set(n[1:]) - {"=main"} for n in names):
                out.append(False)
            else:
                out.append(True if any(n[0] in (ARTICLE, "main") or "=main" in n for n in names) else None)
        elif item[0] == "/":
            name = item[1:]
            if name in CONTAINERS and any(s.split(".")[0] == name for s in stack):
                while stack.pop().split(".")[0] != name:
                    pass
        else:
            name, *marks = item.split(".")
            if name in CONTAINERS or set(marks) - {"=main"} and name in ("span", "table"):
                stack.append(item)
    return out


def _slots(items: list) -> int:
    n = 0
    for item in items:
        while isinstance(item, list) and item[0] == "?":
            item = item[1]
        n += _slots(item[1]) if isinstance(item, list) else item == "#"
    return n


def roles(wrapper: list, shape: list) -> list[bool]:
    """Whether each text slot of a shape is main text, by its own place and the
    wrapper's slots it is aligned with."""
    judged = judge(wrapper)
    own = judge(shape)
    taken: list[bool | None] = list(own)
    a, b = _plain(wrapper), shape
    at_a = [0]
    for x in a:
        at_a.append(at_a[-1] + _slots([x]))
    at_b = [0]
    for x in b:
        at_b.append(at_b[-1] + _slots([x]))
    match = SequenceMatcher(None, [_key(x) for x in a], [_key(x) for x in b], autojunk=False)
    for i, j, n in match.get_matching_blocks():
        for k in range(n):
            taken[at_b[j + k]:at_b[j + k + 1]] = judged[at_a[i + k]:at_a[i + k + 1]]
    inside = any(own)
    return [o if o is not None else bool(v) or not inside for o, v in zip(own, taken)]


def main_text(html: str, main: list[bool] | None) -> str:
    """Texts of main slots, by block."""
    stream, texts, blocks = tokens(html)
    shape, slots = fold(stream)
    if main is None or len(main) != len(slots):
        main = roles(shape, shape)
    chosen = sorted(i for flag, at in zip(main, slots) if flag for i in at)
    parts: dict[int, list[str]] = {}
    for i in chosen:
        parts.setdefault(blocks[i], []).append(texts[i])
    lines = (" ".join(unescape("".join(p)).split()) for p in parts.values())
    return "\n".join(x for x in lines if x)


def _shape(html: str | None) -> tuple[str, str, bool]:
    items = fold(tokens(html or "")[0])[0]
    shape = json.dumps(items)
    return shape, xxhash.xxh3_128_hexdigest(shape), any(judge(items))


def shapes(pages: DataFrame) -> DataFrame:
    """(host, digest, shape, article) of every page; ``article``: it has text in
    an article or main part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [_shape(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([
                pa.array([host_of(u.as_py()) for u in batch.column(1)], pa.string()),
                pa.array([m[1] for m in made], pa.string()), pa.array([m[0] for m in made], pa.string()),
                pa.array([m[2] for m in made], pa.bool_())],
                names=["host", "digest", "shape", "article"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "host string, digest string, shape string, article boolean")


def infer(spark: SparkSession, found: DataFrame) -> DataFrame:
    """(host, article, wrapper): the shapes (host, article, shape) of each host
    and kind of page aligned into one."""

    def run(key, table):
        ordered = sorted(table["shape"].to_pylist(), key=lambda s: (-len(s), s))
        wrapper = json.loads(ordered[0])
        for s in ordered[1:]:
            wrapper = align(wrapper, json.loads(s))
        return pa.table({"host": [key[0].as_py()], "article": [key[1].as_py()], "shape": [json.dumps(wrapper)]})

    kind = ["host", "article"]
    current = found.select(*kind, "shape")
    while True:
        sizes = current.groupBy(*kind).agg(F.count("*").alias("n"))
        grouped = (current.join(sizes, kind)
                   .withColumn("part", F.pmod(F.xxhash64("shape"), F.ceil(F.col("n") / GROUP))))
        current = staged(spark, grouped.groupBy(*kind, "part").applyInArrow(run, "host string, article boolean, shape string"),
                         "wrappers")
        if not current.groupBy(*kind).count().filter("count > 1").head(1):
            return current.withColumnRenamed("shape", "wrapper")


def extract(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    found = staged(spark, shapes(pages).filter("host <> ''").groupBy("host", "digest", "article")
                   .agg(F.min("shape").alias("shape")), "page-shapes")

    @F.pandas_udf("array<boolean>")
    def judged(wrapper, shape):
        import pandas as pd
        return pd.Series([roles(json.loads(w), json.loads(s)) for w, s in zip(wrapper, shape)], dtype=object)

    known = staged(spark, found.join(infer(spark, found), ["host", "article"]).select("host", "digest", judged("wrapper", "shape").alias("main")),
                   "page-roles")
    few = known.count() <= SHAPES_BROADCAST

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([
                *batch.columns, pa.array([host_of(u.as_py()) for u in batch.column(1)], pa.string()),
                pa.array([_shape(x.as_py())[1] for x in batch.column(2)], pa.string())],
                names=["page_id", "url", "html", "host", "digest"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py() or "", m) for h, m in zip(batch.column(2), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    rows = (pages.select(F.col("page_id").cast("long"), "url", "html")
            .mapInArrow(placed, "page_id long, url string, html string, host string, digest string"))
    joined = rows.join(F.broadcast(known) if few else known, ["host", "digest"], "left")
    return joined.select("page_id", "url", "html", "main").mapInArrow(
        run, "page_id long, url string, text string, n_chars long")


def op9_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark, table(spark, sf_dir, "pages"))
