"""Small hand-made documents for the tests of the operators."""

from __future__ import annotations

import random

from pyspark.sql import types as T

#: Column names that operators use inside.
CLASHES = ["part", "node", "a", "b", "score", "shard", "slot", "language", "cuts", "key", "band", "component", "tail", "bucket", "mark", "n", "one"]


def prose(seed: int, words: int, letters: str = "abcdefghij") -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 8))) for _ in range(words))


def documents(spark, rows, extra=()):
    """rows: (doc_id, text) or (doc_id, text, lang)."""
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("text", T.StringType()),
            T.StructField("lang", T.StringType()),
            T.StructField("source", T.StringType()),
            T.StructField("n_chars", T.LongType()),
            *(T.StructField(c, T.StringType()) for c in extra),
        ]
    )
    full = []
    for row in rows:
        doc_id, text, lang = (*row, None)[:3]
        full.append((doc_id, text, lang, "src", None if text is None else len(text), *(f"{c}!" for c in extra)))
    return spark.createDataFrame(full, schema)


def odd_rows():
    """Nulls, empty and very long texts, texts without words, repeated rows and ties."""
    long = prose(1, 30_000)
    same = prose(2, 120)
    return [
        (1, None),
        (2, ""),
        (3, "  \n\t "),
        (4, "!!! ... ???"),
        (5, "one"),
        (6, "one two three"),
        (7, long),
        (8, long),
        (9, same),
        (9, same),
        (10, same),
        (11, "Ünï çödé — “漢字” İstanbul ΣΑΣ " + prose(3, 60)),
        (12, "word " * 500),
        (13, None),
        (None, "a row without id " + prose(4, 60)),
        (None, None),
        (14, prose(5, 300)),
    ]
