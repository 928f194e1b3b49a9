"""Small tables with the awkward cases every operator must answer: null ids and texts, empty and very
long texts, repeated rows, and extra columns whose names clash with the operators' own."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("n", "rid", "score", "size", "bucket", "shard", "words", "runs", "keys", "length", "page", "r", "votes", "d1",
            "held_out", "evidence", "place", "h", "p", "list", "vec", "rep", "query", "token")


def clash(df):
    """``df`` with extra columns under names the operators use inside."""
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHING if c not in df.columns])


def words(rng: random.Random, n: int, vocabulary: int = 300) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


AWKWARD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (None, "some text without an id here now", "en", "a", 9),
    (3, "The same words again and again , twice in the table", "en", "a", 9),
    (3, "The same words again and again , twice in the table", "en", "a", 9),
    (4, " \n\t ", None, "b", 4),
    (5, "12 34 !!!", "de", None, 9),
    (6, "word " * 30_000, "en", "a", 150_000),
    (7, "a" * 50_000, "en", "b", 50_000),
    (8, "Ünïcödé 日本語 🙂 é end", "de", "b", 20),
]


def awkward(spark):
    return clash(spark.createDataFrame(AWKWARD, DOCS))


def empty(spark):
    return spark.createDataFrame([], DOCS)
