"""6. Token counts under a unigram vocabulary, on a trie of pre-tokens.

A pre-token is a run of non-space characters with the word mark in front; its
segmentation is the sequence of vocabulary pieces with the largest sum of
scores (fewest pieces among equals); a character no piece covers is one token
at UNKNOWN_SCORE.  Distinct pre-tokens of a task go into a trie.  A node's
forward score is the best over the pieces that end there of the score of the
node where the piece begins plus the piece's own, so a prefix that many
pre-tokens share is computed once; the token count is kept at the terminal.  A
document's count is the sum over its pre-tokens.

The pieces and scores are those of the given piece file: log-probabilities by
Zipf's law over the pieces' ranks, which is what a merge-rank file offers in
place of trained ones.

Defined results: null, empty and white-space texts have no tokens; rows that
share a doc_id are counted one by one; a null doc_id is carried; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm.common import table

PIECES = "piece_bpe_32k.model"
MARK = "▁"
ZIPF_OFFSET = 2.7
UNKNOWN_SCORE = -20.0
SLICE_CHARS = 4 << 20
MOST_NODES = 600_000      # a task's trie starts anew beyond this
MOST_WORDS = 300_000      # and its table of counted pre-tokens beyond this


def load_pieces(path: str) -> dict[str, float]:
    """Piece to score."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    total = log(sum(1 / (r + ZIPF_OFFSET) for r in range(len(pieces))))
    return {p: -log(r + ZIPF_OFFSET) - total for r, p in enumerate(pieces)}


class PreTokenTrie:
    """Pre-tokens share the forward scores of their common prefixes."""

    def __init__(self, pieces: dict[str, float]):
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)
        self.clear()

    def clear(self) -> None:
        self.children: dict[tuple[int, str], int] = {}
        self.score, self.tokens = [0.0], [0]
        self.terminal: dict[str, int] = {}

    def count(self, word: str) -> int:
        """Tokens of a pre-token."""
        known = self.terminal.get(word)
        if known is not None:
            return known
        if len(self.score) > MOST_NODES or len(self.terminal) > MOST_WORDS:
            self.clear()
        children, score, tokens, pieces = self.children, self.score, self.tokens, self.pieces
        path, node = [0], 0
        for at, char in enumerate(word, 1):
            child = children.get((node, char))
            if child is None:
                before = path[at - 1]
                best, fewest = score[before] + UNKNOWN_SCORE, tokens[before] + 1
                for begin in range(max(0, at - self.longest), at):
                    piece = pieces.get(word[begin:at])
                    if piece is not None:
                        start = path[begin]
                        s, n = score[start] + piece, tokens[start] + 1
                        if s > best or s == best and n < fewest:
                            best, fewest = s, n
                child = children[node, char] = len(score)
                score.append(best)
                tokens.append(fewest)
            path.append(child)
            node = child
        if len(word) < 200:
            self.terminal[word] = tokens[node]
        return tokens[node]


def words_of(text: str) -> Iterator[list[str]]:
    """Pre-tokens without their mark, a bounded slice at a time."""
    if len(text) <= SLICE_CHARS:
        yield text.split()
        return
    rest = ""
    for at in range(0, len(text), SLICE_CHARS):
        part = rest + text[at:at + SLICE_CHARS]
        words = part.split()
        rest = words.pop() if words and not part[-1].isspace() and at + SLICE_CHARS < len(text) else ""
        yield words
    if rest:
        yield [rest]


def count_tokens(docs: DataFrame, piece_file: str | None = None) -> DataFrame:
    """(doc_id, n_words, n_tokens) of every row; ``piece_file`` is a path."""
    piece_file = piece_file or public_tokenizers.path(PIECES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = PreTokenTrie(load_pieces(piece_file))
        for batch in batches:
            n_words, n_tokens = [], []
            for text in batch.column(1):
                words = tokens = 0
                for part in words_of(text.as_py() or ""):
                    words += len(part)
                    get = trie.terminal.get
                    for w in part:
                        n = get(MARK + w)
                        tokens += trie.count(MARK + w) if n is None else n
                        if n is None:
                            get = trie.terminal.get      # the table may have been started anew
                n_words.append(words)
                n_tokens.append(tokens)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())],
                                             names=["doc_id", "n_words", "n_tokens"])

    return (docs.select(F.col("doc_id").cast("long"), "text")
            .mapInArrow(run, "doc_id long, n_words long, n_tokens long"))


def op6_tokencount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
