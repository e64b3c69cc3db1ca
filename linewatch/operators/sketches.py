"""Approximate percentiles from mergeable sketches (KLL): a table of small rows that can be stored, and merged between runs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewatch.functions.numbers import finite_or_null, number_of

#: Size of a sketch: more is finer.
SIZE = 1600


def rank_error(size: int = SIZE) -> float:
    """How far the share of rows below a found value may be from the wanted one, with a confidence of 99 %: the sketch's published bound."""
    return 2.296 / size**0.9723


def percentile_sketches(df: DataFrame, columns: Sequence[str], size: int = SIZE) -> DataFrame:
    """column, n, sketch: one row per column, from one pass. What is no finite number is left out; a column without any has a null sketch."""
    values = [finite_or_null(number_of(df, c)) for c in columns]
    wide = df.agg(
        *[F.kll_sketch_agg_double(v, F.lit(size)).alias(f"s{i}") for i, v in enumerate(values)], *[F.count(v).alias(f"n{i}") for i, v in enumerate(values)]
    )
    items = [
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("n"), F.when(F.col(f"n{i}") > 0, F.col(f"s{i}")).alias("sketch"))
        for i, c in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*items)))


def merge_sketches(*tables: DataFrame) -> DataFrame:
    """The sketches of several tables of them, a row per column again."""
    rows = reduce(DataFrame.unionByName, [t.select("column", "n", "sketch") for t in tables])
    merged = rows.where("n > 0").groupBy("column").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
    names = rows.select("column").distinct()
    return names.join(merged, "column", "left").select("column", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), "sketch")


def sketched_percentiles(sketches: DataFrame, share: float) -> dict[str, float | None]:
    """A value whose rank is about ``share``, per column; ``None`` for a column without values."""
    value = F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(share))))
    return {r.column: r.value for r in sketches.select("column", value.alias("value")).collect()}
