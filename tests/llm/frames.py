"""Small tables for the tests of this folder."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def documents(spark: SparkSession, texts: list[str | None], ids: list[int | None] | None = None) -> DataFrame:
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, SCHEMA)


#: Null, empty, blank, wordless, short, repeated and very long texts.
ODD_TEXTS = [
    None,
    None,
    "",
    " ",
    "!!! ???",
    "!!! ???",
    "one",
    "one two three",
    "ONE two, three",
    "äöü ßé ñ 漢字 😀",
    "a" * 50_000,
    " ".join(f"long{i % 977}" for i in range(30_000)),
]


def odd_documents(spark: SparkSession) -> DataFrame:
    """ODD_TEXTS, a repeated row, a repeated id with another text, null ids, and columns with the names that operators use inside."""
    texts = [*ODD_TEXTS, "one two three", "another text of the id", "no id here", None]
    ids = [*range(len(ODD_TEXTS)), 7, 7, None, None]
    df = documents(spark, texts, ids)
    extra = "score secrets share raw own_id own_hash before n part hashed nth rank shard lang_pred toxic key class node words at".split()
    return df.selectExpr("*", *[f"'x' as `{c}`" for c in extra])


def empty_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
