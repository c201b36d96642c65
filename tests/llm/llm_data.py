"""Small documents for the tests of the training-data operators."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, start int, key string, node long"


def frame(spark, rows, extra=True):
    """Documents from (doc_id, text) rows, with extra columns of clashing names."""
    full = [(d, t, "en", "s", len(t) if t is not None else None, 7, "k", 3) for d, t in rows]
    df = spark.createDataFrame(full, SCHEMA)
    return df if extra else df.select("doc_id", "text", "lang", "source", "n_chars")


def prose(rng: random.Random, n: int, vocabulary: int = 5000) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}x" for _ in range(n)]


def odd_rows():
    """Null, empty, blank, one-word, repeated and long texts, a null id."""
    rng = random.Random(5)
    long = " ".join(prose(rng, 60_000, 40_000))
    return [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "same text of six words here"),
            (6, "same text of six words here"), (7, long), (8, long + " end"), (9, "ÄÖ 日本   x\x1fy"),
            (None, "no id at all but words enough"), (10, "a " * 40)]
