"""Table and column statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linewatch.functions.numbers import finite_or_null
from linewatch.operators.moments import co_moments
from linewatch.schema import quoted

# Fixed value: the least deviation in reference statistics.
STD_FLOOR = 1e-6


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(quoted(column)).alias(column)).agg(F.count(F.lit(1)).alias("n"))


def rarest_class_size(df: DataFrame, label: str) -> DataFrame:
    return value_counts(df, label).agg(F.min("n").alias("n"))


def _as_rows(df: DataFrame, names: Sequence[str], fields: dict[str, list[Column]]) -> DataFrame:
    """One wide aggregate row to one row per column: a single pass over the data
    whatever the number of columns."""
    wide = df.agg(
        *[F.struct(*[c.alias(f) for f, c in zip(fields, cols)]).alias(f"s{i}")
          for i, cols in enumerate(zip(*fields.values()))]
    )
    items = [
        F.struct(F.lit(n).alias("feature"), *[F.col(f"s{i}.{f}").alias(f) for f in fields])
        for i, n in enumerate(names)
    ]
    return wide.select(F.inline(F.array(*items)))


def profile(df: DataFrame) -> DataFrame:
    """Rows, non-null values, least and greatest value (as text) per column."""
    cols = [F.col(quoted(c)) for c in df.columns]
    fields = {
        "rows": [F.count(F.lit(1)) for _ in cols],
        "non_null": [F.count(c) for c in cols],
        "min_value": [F.min(c).cast("string") for c in cols],
        "max_value": [F.max(c).cast("string") for c in cols],
    }
    return _as_rows(df, df.columns, fields).withColumnRenamed("feature", "column_name")


def _long(df: DataFrame, names: Sequence[str], values: Sequence[Column], fields: dict[str, Column]) -> DataFrame:
    """``fields`` of ``x`` for each of the doubles ``values``, one row per name, also without any row: a single pass over the data. The values
    are grouped by their position, so the aggregate is as narrow, and compiled, for any number of columns; one wide aggregate is
    interpreted beyond a hundred sums."""
    each = df.select(F.posexplode(F.array(*[c.cast("double") for c in values])).alias("_at", "x"))
    found = each.groupBy("_at").agg(*[c.alias(f) for f, c in fields.items()])
    named = df.sparkSession.createDataFrame(list(enumerate(names)), "_at int, feature string")
    return named.join(found, "_at", "left").select("feature", *fields)


def fit_scaler(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean and population deviation per feature."""
    return _long(df, features, [F.col(quoted(c)) for c in features], {"mean": F.avg("x"), "std": F.stddev_pop("x")})


def reference_statistics(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean, population deviation (floored), min, max and count of the finite
    values per feature; (0, 1, 0, 1, 0) where there is none."""
    cols = [finite_or_null(F.col(quoted(c)).cast("double")) for c in features]
    floored = F.greatest(F.stddev_pop("x"), F.lit(STD_FLOOR))
    fields = {"mean": F.avg("x"), "std": floored, "min": F.min("x"), "max": F.max("x"), "count": F.count("x")}
    found = _long(df, features, cols, fields)
    # A feature without any finite value has no spread, and one without a row is not counted at all.
    some = F.coalesce(F.col("count") > 0, F.lit(False))
    empty = {"mean": 0.0, "std": 1.0, "min": 0.0, "max": 1.0}
    return found.select(
        "feature", *[F.when(some, F.col(f)).otherwise(F.lit(v)).alias(f) for f, v in empty.items()], F.coalesce("count", F.lit(0)).cast("bigint").alias("count")
    )


def covariance_rows(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Sample covariance of each pair (i <= j) of a few features, in one pass."""
    pairs = [(a, b) for i, a in enumerate(features) for b in features[i:]]
    wide = df.agg(
        *[F.covar_samp(quoted(a), quoted(b)).alias(f"p{i}") for i, (a, b) in enumerate(pairs)]
    )
    items = [
        F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(f"p{i}").alias("cov"))
        for i, (a, b) in enumerate(pairs)
    ]
    return wide.select(F.inline(F.array(*items)))


def mean_and_covariance(df: DataFrame, features: Sequence[str]) -> tuple[list[float], list[list[float]]]:
    """Mean vector and sample covariance matrix of the complete rows, in one pass. Their size depends on the number
    of features only, so both come to the driver."""
    held = co_moments(df, features)
    return held.mean, held.covariance()
