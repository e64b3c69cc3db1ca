"""Column lists: drop, align, tolerate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linewatch.functions.numbers import number_or_zero
from linewatch.schema import quoted


def present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The asked columns that exist, in the asked order."""
    return [c for c in columns if c in df.columns]


def require(df: DataFrame, column: str) -> None:
    if column not in df.columns:
        raise ValueError(f"column '{column}' not found")


def drop_unused(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*present(df, columns))


def align(df: DataFrame, reference: Sequence[str]) -> DataFrame:
    """Exactly the reference columns, in that order; missing ones are 0."""
    return df.select(
        *[F.col(quoted(c)) if c in df.columns else F.lit(0.0).alias(c) for c in reference]
    )


def align_numeric(df: DataFrame, reference: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """:func:`align` with every feature coerced to a finite double."""

    def feature(c: str) -> Column:
        return number_or_zero(df, c) if c in df.columns else F.lit(0.0)

    return df.select(*[F.col(quoted(c)) for c in keep], *[feature(c).alias(c) for c in reference])
