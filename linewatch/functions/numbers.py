"""Numeric coercion and clean-up."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linewatch.schema import quoted


# What a number looks like as text. Other text is not parsed at all: a failed
# parse costs far more than the look at its shape.
NUMBER_TEXT = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf(inity)?)\s*$"


def to_number(c: Column) -> Column:
    """Number to double, NaN to null."""
    x = c.cast("double")
    return F.when(~F.isnan(x), x)


def text_to_number(c: Column) -> Column:
    """Text to double; what does not parse, and NaN, becomes null."""
    return F.when(c.rlike(NUMBER_TEXT), c.try_cast("double"))


def number_of(df: DataFrame, name: str) -> Column:
    """A column of any type as a number."""
    c, kind = F.col(quoted(name)), df.schema[name].dataType
    return text_to_number(c) if isinstance(kind, T.StringType) else to_number(c)


def is_finite(c: Column) -> Column:
    """True for a double that is neither null, NaN nor infinite."""
    return F.coalesce(_below_infinity(c), F.lit(False))


def _below_infinity(c: Column) -> Column:
    """Null for null. NaN counts as more than infinity."""
    return F.abs(c) < F.lit(math.inf)


def finite_or_zero(c: Column) -> Column:
    """Null, NaN and infinities become 0."""
    return F.when(_below_infinity(c), c).otherwise(F.lit(0.0))


def finite_or_null(c: Column) -> Column:
    return F.when(_below_infinity(c), c)


def number_or_zero(df: DataFrame, name: str) -> Column:
    """A column of any type as a finite double, 0 where it is none."""
    text = isinstance(df.schema[name].dataType, T.StringType)
    return finite_or_zero(number_of(df, name) if text else F.col(quoted(name)).cast("double"))


def metric_name(c: Column) -> Column:
    """A column name made safe for metric systems."""
    return F.translate(c, "()?", "___")


#: Hash values are below this.
HASH_SPACE = 2**60


def stable_hash(*cols: Column, seed: int = 0) -> Column:
    """60 hash bits as a non-negative bigint. MD5 gives the same value in every
    SQL engine, so seeded choices can be checked outside Spark."""
    text = F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def unit_hash(*cols: Column, seed: int = 0) -> Column:
    """A hash-derived double in [0, 1): the top 52 of the 60 bits, exactly."""
    bits = F.shiftright(stable_hash(*cols, seed=seed), 8)
    return bits.cast("double") / F.lit(float(2**52))
