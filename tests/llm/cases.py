"""Small tables with the awkward rows every operator must take."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rep long, key string, _bad string"


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n))


def awkward(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows,
    extra columns whose names the operators use inside."""
    long_text = words(1, 30_000)
    passage = words(2, 80)
    rows = [
        (1, long_text, "en", "a"), (2, passage + " " + words(3, 40), "en", "a"), (3, words(4, 30) + "\n" + passage, None, "b"),
        (4, "", "de", None), (5, None, "de", "b"), (6, " \n\t ", "en", "c"), (7, "one", "en", "c"), (7, "one", "en", "c"),
        (8, "one", "fr", "c"), (None, words(5, 60), "en", "a"), (None, None, None, None), (9, "漢字 かな 漢字", "ja", "a"),
        (10, words(6, 60), "en", "a"), (11, words(6, 60), "en", "a"), (12, "<|endoftext|> a  b \n c", "en", "a"),
        (13, "x" * 50_000, "en", "a"), (14, "ONE", "en", "a"), (15, "a a a a a a a a " * 200, "en", "a"),
    ]
    return spark.createDataFrame([(i, t, la, s, len(t or ""), 5, "k", "z") for i, t, la, s in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
