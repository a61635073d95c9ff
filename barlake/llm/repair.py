"""12. Token-id files with Re-Pair grammar compression.

Texts are encoded, each document closes with the id END, and all ids lie in
ascending order of doc_id in a table of shards (the file format, below).  A
shard holds whole documents; its ids are compressed by a grammar of its own:
pairs of neighbouring symbols that are frequent are replaced by nonterminals,
again and again, until no pair is frequent enough or the symbols no longer fit 16
bits.  A step takes many pairs at once, the most frequent first where two
overlap, and counts all pairs exactly.  The rules are stored with the length each
expands to, so any range of a shard's ids is decoded from the symbols that cover
it alone (`Segment.ids`), and a document from the shard that holds it
(`read_documents`, which prunes shards by their least and greatest doc_id).

File format: a Parquet table, one row per shard: ``part`` and ``shard`` order the
shards, ``first_doc`` and ``last_doc`` are the least and greatest doc_id, ``docs``
the number of documents, ``n_ids`` the number of ids, ``doc_ids`` (little-endian
64-bit, `nulls` of them null and in front) and ``doc_lengths`` (32-bit) the
documents, ``segments`` the compressed ids.  A shard has one segment of at most
SHARD_IDS ids, or, where one document is longer, several of that document alone.
A segment is a header of four 32-bit numbers (first nonterminal, bytes of a
symbol, rules, symbols), the rules as pairs of symbols, their lengths (32-bit)
and the symbols.

Ids are those of the ``tokenizers`` file.  Its pattern never matches across white
space and its normalisation never composes across it, so texts are cut at ASCII
white space and every distinct stretch of a task is encoded once.

Defined results: a null, empty or white-space text is END alone; documents with
a null doc_id come first; rows that share a doc_id are documents of their own, in
the order of their ids' hash; an empty table gives no shards.  Extra columns are
ignored.
"""

from __future__ import annotations

import re
import string
import sys
import types
import zlib
from array import array
from collections.abc import Iterator
from operator import attrgetter

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barlake.llm.common import binaries, staged, table
from barlake.session import scratch_path

TOKENIZER = "word_bpe_49k.json"
END = 2
SHARD_IDS = 1 << 20       # ids of a shard, about
PART_IDS = 8 << 20        # ids of a range of documents that one task compresses, about
LEAST_COUNT = 6           # a pair below this is not worth a rule
STEP_RULES = 4096         # pairs replaced at once
LEAST_GAIN = 0.03         # a step that shortens the symbols by less is the last
SYMBOLS = 1 << 16         # symbols fit 16 bits, pairs 32
SLOT_BITS = 17
CODES = {"<u2": "H", "<u4": "I"}
CACHE = 400_000           # distinct stretches a worker keeps
PIECES = 700_000          # and distinct pieces
CACHED_BYTES = 100
TOKEN_ID = attrgetter("id")
PUNCTUATION = string.punctuation.encode()
# The tokenizer file's pattern, for the letters of stretches without unusual characters.
_LETTER = "a-z\u00df-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017e"
PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[0-9]|[^0-9{_LETTER}]+")
UNUSUAL = re.compile("[^!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017e]")

IDS = "row long, doc_id long, n long, hash long, ids binary"
SHARDS = ("part int, shard int, first_doc long, last_doc long, docs int, nulls int, n_ids long, doc_ids binary, "
          "doc_lengths binary, segments array<binary>")


class Encoder(dict):
    """A stretch's UTF-8 bytes to its ids, as little-endian 16- or 32-bit bytes.

    Stretches of printable ASCII and composed Latin letters, which normalisation
    only lower-cases, are cut by the pattern here, so that the library's model
    sees each distinct piece once; all others, those that may hold a special
    token's string (<|...|>) too, go through the whole tokenizer."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        self.tokenizer = Tokenizer.from_file(path)
        self.size = max(self.tokenizer.get_vocab(True).values()) + 1
        self.kind = "<u2" if self.size <= SYMBOLS else "<u4"
        self.model = self.tokenizer.model
        self.letters = {ord(c): ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(c)[0][0]
                        for c in map(chr, [*range(0x21, 0x7F), *range(0xC0, 0x180)])}
        self.pieces: dict[str | bytes, bytes] = {}

    def piece(self, key: str | bytes, piece: str) -> bytes:
        shown = piece if piece.isascii() else piece.translate(self.letters)
        value = array(CODES[self.kind], map(TOKEN_ID, self.model.tokenize(shown))).tobytes()
        if len(self.pieces) >= PIECES:
            self.pieces.clear()
        self.pieces[key] = value
        return value

    def miss(self, stretch: bytes) -> bytes:
        known = self.pieces
        word = stretch.rstrip(PUNCTUATION)              # what follows a word is one piece
        if word.isalpha() and len(stretch) <= CACHED_BYTES and b"<|" not in stretch:       # ASCII letters
            low, rest = word.lower(), stretch[len(word):]
            value = known.get(low) or self.piece(low, low.decode())
            if rest:
                value += known.get(rest) or self.piece(rest, rest.decode())
        else:
            text = stretch.decode()
            if len(stretch) > CACHED_BYTES:
                return self.whole(text)
            if UNUSUAL.search(text) or "<|" in text:
                value = self.whole(text)
            else:
                value = b"".join([known.get(x) or self.piece(x, x) for x in PIECE.findall(text.lower())])
        if len(self) >= CACHE:
            self.clear()
        self[stretch] = value
        return value

    def whole(self, text: str) -> bytes:
        return array(CODES[self.kind], self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def ids(self, text: bytes) -> bytes:
        stretches = text.split()
        found = list(map(self.get, stretches))
        if None in found:
            found = [self.get(s) or self.miss(s) if f is None else f for f, s in zip(found, stretches)]
        return b"".join(found)


def worker_encoder(path: str) -> Encoder:
    """The worker process's encoder: the next tasks that Spark gives to the same
    worker go on with what it has cached."""
    kept = sys.modules.setdefault("_barlake_worker", types.ModuleType("_barlake_worker"))
    encoders = vars(kept).setdefault("encoders", {})
    if path not in encoders:
        encoders[path] = Encoder(path)
    return encoders[path]


def encoded(docs: DataFrame, path: str, end: int) -> DataFrame:
    """(row, doc_id, n, hash, ids): every document's ids, the last one ``end``;
    ``row`` is unique, ``hash`` of the ids orders rows that share a doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path)
        close = np.array([end], encoder.kind).tobytes()
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            out: list[tuple] = []
            size = 0
            for doc_id, text in zip(batch.column(0).to_pylist(), binaries(batch.column(1))):
                data = encoder.ids(text or b"") + close
                out.append((row, doc_id, len(data) // len(close), zlib.crc32(data), data))
                row += 1
                size += len(data)
                if size > 8 << 20:
                    yield _table(out, IDS)
                    out, size = [], 0
            if out:
                yield _table(out, IDS)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, IDS)


_TYPES = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<binary>": pa.list_(pa.binary())}


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.strip().split(" ") for f in schema.split(",")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, (_, t) in zip(columns, fields)], names=[f[0] for f in fields])


def _frequent(keys: np.ndarray, least: int, most: int) -> np.ndarray:
    """The most frequent pairs, at most ``most``, by rising count."""
    keys = np.sort(keys)
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    counts = np.diff(starts, append=len(keys))
    often = counts >= least
    pairs, counts = keys[starts[often]], counts[often]
    return pairs[np.argsort(counts, kind="stable")][-most:]


def _places(keys: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places to replace, and each one's number among ``pairs`` (by rising
    count): of overlapping pairs the more frequent one, in a run of one symbol
    every other place.  Pairs are looked up by a hash; where two share a slot the
    less frequent one waits for the next step."""
    slot = lambda x: (x * np.uint32(0x9E3779B1)) >> np.uint32(32 - SLOT_BITS)
    held, number = np.zeros(1 << SLOT_BITS, np.uint32), np.zeros(1 << SLOT_BITS, np.uint16)
    held[slot(pairs)] = pairs
    number[slot(pairs)] = np.arange(1, len(pairs) + 1)
    at = slot(keys)
    rank = number[at]
    rank[held[at] != keys] = 0
    again = np.flatnonzero((keys[1:] == keys[:-1]) & (rank[1:] > 0)) + 1
    if len(again):
        starts = np.diff(again, prepend=-1) > 1
        first = again[starts][np.cumsum(starts) - 1]
        rank[again[(again - first) % 2 == 0]] = 0
    places = np.flatnonzero(rank)
    ranks = np.append(rank, 0)           # so that the places before the first and after the last are 0
    mine = ranks[places]
    keep = (mine > ranks[places - 1]) & (mine > ranks[places + 1])
    return places[keep], mine[keep].astype(np.int64) - 1


def compress(ids: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
    """Rules (pairs of symbols, those from ``first`` on being nonterminals in the
    order of the rules) and the symbols left; no rules for ids beyond 16 bits."""
    top, rules = first, [np.empty((0, 2), np.int64)]
    if top >= SYMBOLS:
        return rules[0], ids
    symbols = ids.astype(np.uint16)
    while top < SYMBOLS and len(symbols) > 1:
        keys = symbols[:-1].astype(np.uint32) << np.uint32(16) | symbols[1:]
        pairs = _frequent(keys, LEAST_COUNT, min(STEP_RULES, SYMBOLS - top))
        if not len(pairs):
            break
        places, rule = _places(keys, pairs)
        used = np.bincount(rule, minlength=len(pairs)) >= LEAST_COUNT / 2
        places, rule = places[used[rule]], rule[used[rule]]
        if not len(places):
            break
        number = (top + np.cumsum(used) - 1).astype(np.uint16)
        symbols[places] = number[rule]
        rules.append(np.stack([pairs[used] >> np.uint32(16), pairs[used] & np.uint32(0xFFFF)], 1).astype(np.int64))
        top += int(used.sum())
        before, stay = len(symbols), np.ones(len(symbols), bool)
        stay[places + 1] = False
        symbols = symbols[stay]
        if len(places) < LEAST_GAIN * before:
            break
    return np.concatenate(rules), symbols


def lengths_of(rules: np.ndarray, first: int) -> np.ndarray:
    """Number of ids each rule expands to."""
    out: list[int] = []
    for a, b in rules.tolist():
        out.append((out[a - first] if a >= first else 1) + (out[b - first] if b >= first else 1))
    return np.array(out, "<u4")


def write_segment(ids: np.ndarray, first: int) -> bytes:
    rules, symbols = compress(ids, first)
    kind = "<u2" if first + len(rules) <= SYMBOLS else "<u4"
    header = np.array([first, np.dtype(kind).itemsize, len(rules), len(symbols)], "<u4")
    return b"".join([header.tobytes(), rules.astype(kind).tobytes(), lengths_of(rules, first).tobytes(), symbols.astype(kind).tobytes()])


class Segment:
    """A compressed segment; ``ids(a, b)`` decodes any range from the symbols that cover it."""

    def __init__(self, data: bytes):
        self.first, size, n_rules, n = np.frombuffer(data, "<u4", 4).tolist()
        kind, at = f"<u{size}", 16
        rules = np.frombuffer(data, kind, 2 * n_rules, at).reshape(-1, 2).astype(np.int64)
        at += 2 * n_rules * size
        self.lengths = np.frombuffer(data, "<u4", n_rules, at).astype(np.int64)
        self.symbols = np.frombuffer(data, kind, n, at + 4 * n_rules).astype(np.int64)
        # every rule's ids, one behind another
        self.begin = np.concatenate([[0], np.cumsum(self.lengths)])
        self.flat = np.empty(self.begin[-1], np.int64)
        begin = self.begin.tolist()
        for k, (a, b) in enumerate(rules.tolist()):
            at = begin[k]
            for x in (a, b):
                if x < self.first:
                    self.flat[at] = x
                    at += 1
                else:
                    j = x - self.first
                    n = begin[j + 1] - begin[j]
                    self.flat[at:at + n] = self.flat[begin[j]:begin[j + 1]]
                    at += n
        rule = np.maximum(self.symbols - self.first, 0)
        self.ends = np.cumsum(np.where(self.symbols < self.first, 1, self.lengths[rule] if n_rules else 1))

    def __len__(self) -> int:
        return int(self.ends[-1]) if len(self.ends) else 0

    def ids(self, begin: int = 0, end: int | None = None) -> np.ndarray:
        end = len(self) if end is None else end
        if begin >= end:
            return np.empty(0, np.int64)
        i, j = np.searchsorted(self.ends, begin, "right"), np.searchsorted(self.ends, end, "left") + 1
        symbols, before = self.symbols[i:j], int(self.ends[i - 1]) if i else 0
        n = np.diff(self.ends[i:j], prepend=before)
        rule = np.maximum(symbols - self.first, 0)
        plain = symbols < self.first
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        where = np.repeat(np.where(plain, 0, self.begin[rule]), n) + inside
        out = np.where(np.repeat(plain, n), np.repeat(symbols, n), self.flat[where] if len(self.flat) else 0)
        return out[begin - before:end - before]


def shards_of(rows: DataFrame, first: int, kind: str) -> DataFrame:
    """Shards of rows that lie in order within partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard = TaskContext.get().partitionId(), 0
        held: list[tuple] = []

        def close():
            ids = np.frombuffer(b"".join(x[2] for x in held), kind)
            known = [x[0] for x in held if x[0] is not None]
            segments = [write_segment(ids[a:a + SHARD_IDS], first) for a in range(0, len(ids), SHARD_IDS)]
            return _table([(part, shard, min(known, default=None), max(known, default=None), len(held), len(held) - len(known),
                            len(ids), np.array([x[0] or 0 for x in held], "<i8").tobytes(),
                            np.array([x[1] for x in held], "<u4").tobytes(), segments)], SHARDS)

        total = 0
        for batch in batches:
            for doc in zip(batch["doc_id"].to_pylist(), batch["n"].to_pylist(), binaries(batch["ids"])):
                if held and total + doc[1] > SHARD_IDS:
                    yield close()
                    held, total, shard = [], 0, shard + 1
                held.append(doc)
                total += doc[1]
        if held:
            yield close()

    return rows.select("doc_id", "n", "ids").mapInArrow(run, SHARDS)


def write_ids(spark: SparkSession, docs: DataFrame, path: str, tokenizer: str | None = None, end: int = END) -> None:
    """Encode ``docs`` and write the table of shards at ``path``."""
    tokenizer = tokenizer or public_tokenizers.path(TOKENIZER)
    known = Encoder(tokenizer)
    rows = staged(spark, encoded(docs, tokenizer, end), "repair-ids")
    total = rows.agg(F.sum("n")).first()[0] or 0
    order = ["doc_id", "hash", "row"]
    parts = rows.repartitionByRange(max(1, -(-total // PART_IDS)), *order).sortWithinPartitions(*order)
    shards_of(parts, max(known.size, end + 1), known.kind).write.parquet(path)


def prefix_sums(rows: DataFrame, order: list[str], value: str) -> Column | DataFrame:
    """``rows`` with ``before``: the sum of ``value`` over the rows before, by
    (part, ...) order.  Sums run within parts, over parts within blocks of 1,024
    parts, and over blocks, so no task sorts all rows."""
    part, rest = order[0], order[1:]
    block = F.floor(F.col(part) / 1024)
    inner = Window.partitionBy(part).orderBy(*rest).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_in_part", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    parts = rows.groupBy(part).agg(F.sum(value).alias("_n")).withColumn("_block", block)
    blocks = parts.groupBy("_block").agg(F.sum("_n").alias("_b"))
    # one row per 1,024 parts
    blocks = blocks.select("_block", F.coalesce(F.sum("_b").over(Window.orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0)).alias("_before_block"))
    ahead = Window.partitionBy("_block").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.join(blocks, "_block").select(
        part, (F.col("_before_block") + F.coalesce(F.sum("_n").over(ahead), F.lit(0))).alias("_before_part"))
    return rows.join(parts, part).withColumn("before", F.col("_before_part") + F.col("_in_part")).drop("_before_part", "_in_part")


def decode(shards: DataFrame, only: list[int] | None = None) -> Iterator:
    """Rows (doc_id, start within the shard, n, ids) of the shards' documents, or
    of ``only`` those ids."""
    wanted = None if only is None else set(only)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                yield from _documents(r, wanted)

    return shards.select("before", "nulls", "doc_ids", "doc_lengths", "segments").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def _documents(r: dict, wanted: set | None) -> Iterator[pa.RecordBatch]:
    """A shard's documents; of a shard with several segments one is open at a time."""
    ids = [None] * r["nulls"] + np.frombuffer(r["doc_ids"], "<i8").tolist()[r["nulls"]:]
    lengths = np.frombuffer(r["doc_lengths"], "<u4").astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    take = range(len(ids)) if wanted is None else [k for k, i in enumerate(ids) if i in wanted]
    segment = Segment(r["segments"][0]) if len(r["segments"]) == 1 and take else None
    whole = segment.ids().astype("<u4") if segment and wanted is None else None
    out: list[tuple] = []
    size = 0
    for k in take:
        a, n = int(starts[k]), int(lengths[k])
        if whole is not None:
            data = whole[a:a + n].tobytes()
        elif segment:
            data = segment.ids(a, a + n).astype("<u4").tobytes()
        else:
            data = b"".join(Segment(s).ids().astype("<u4").tobytes() for s in r["segments"])
        out.append((ids[k], r["before"] + a, n, zlib.crc32(data), data))
        size += len(data)
        if size > 8 << 20:
            yield _table(out, _DOCS)
            out, size = [], 0
    if out:
        yield _table(out, _DOCS)


_DOCS = "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The shards at ``path`` decoded: (doc_id, start, n_tokens, ids_crc32, ids),
    ``start`` counting the ids of all documents before."""
    shards = spark.read.schema(SHARDS).parquet(path)
    before = prefix_sums(shards.select("part", "shard", "n_ids"), ["part", "shard"], "n_ids").select("part", "shard", "before")
    return decode(shards.join(before, ["part", "shard"]))


def read_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Random access: (doc_id, n_tokens, ids_crc32, ids) of some documents, from
    the shards that can hold them and the symbols that cover them."""
    shards = spark.read.schema(SHARDS).parquet(path)
    hit = F.lit(False)
    for i in doc_ids:
        hit = hit | ((F.col("first_doc") <= i) & (F.col("last_doc") >= i))
    return decode(shards.filter(hit).withColumn("before", F.lit(0).cast("long")), doc_ids).drop("start")


def op12_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "repair-shards")
    write_ids(spark, table(spark, sf_dir, "documents"), path)
    return read_ids(spark, path).drop("ids")
