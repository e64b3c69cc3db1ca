"""Class ids, dummies and scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linewatch.config import DEFAULTS
from linewatch.functions.labels import fill_label, label_index
from linewatch.functions.numbers import HASH_SPACE, stable_hash
from linewatch.operators.columns import present, require
from linewatch.operators.ordering import dense_index
from linewatch.operators.stats import fit_scaler
from linewatch.schema import CATEGORIES, GROUP, quoted
from linewatch.session import materialise

def distinct_values(df: DataFrame, values: Mapping[str, Column]) -> dict[str, list[str]]:
    """The sorted distinct texts of several columns in one job, as lists: for classes and for categories that
    become columns of a table. :func:`fit_categories` keeps any number of values as a table."""
    if not values:
        return {}
    items = [F.struct(F.lit(n).alias("name"), c.alias("value")) for n, c in values.items()]
    rows = df.select(F.inline(F.array(*items))).distinct().collect()
    return {
        n: sorted(r["value"] for r in rows if r["name"] == n and r["value"] is not None)
        for n in values
    }


def fit_labels(df: DataFrame, target: str = GROUP) -> list[str]:
    """The sorted class names; a class id is a position in this list."""
    require(df, target)
    return distinct_values(df, {target: fill_label(F.col(quoted(target)))})[target]


def label_encode(
    df: DataFrame, target: str = GROUP, classes: Sequence[str] | None = None
) -> tuple[DataFrame, list[str]]:
    require(df, target)
    classes = fit_labels(df, target) if classes is None else list(classes)
    return df.withColumn(target, label_index(F.col(quoted(target)), classes)), classes


def category_text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("nan"))


def fit_one_hot(df: DataFrame, columns: Sequence[str] = CATEGORIES) -> dict[str, list[str]]:
    return distinct_values(
        df, {c: category_text(F.col(quoted(c))) for c in present(df, columns)}
    )


def one_hot_columns(df_columns: Sequence[str], categories: dict[str, list[str]]) -> list[str]:
    kept = [c for c in df_columns if c not in categories]
    return kept + [f"{c}_{v}" for c, values in categories.items() for v in values]


def one_hot(df: DataFrame, categories: dict[str, list[str]]) -> DataFrame:
    """One 0/1 column per fitted value, named ``column_value``, in place of the
    source columns. A value not seen at the fit gives zeros only."""
    categories = {c: v for c, v in categories.items() if c in df.columns}
    dummies = [
        (category_text(F.col(quoted(c))) == F.lit(v)).cast("double").alias(f"{c}_{v}")
        for c, values in categories.items()
        for v in values
    ]
    kept = [F.col(quoted(c)) for c in df.columns if c not in categories]
    return df.select(*kept, *dummies)


@dataclass(frozen=True)
class Categories:
    """``values``: name, value, position, a stored table; ``sizes``: number of values by column."""

    values: DataFrame
    sizes: dict[str, int]


def fit_categories(df: DataFrame, columns: Sequence[str] = CATEGORIES) -> Categories:
    """The values of any number of any columns, each with its position in its column. Positions go by a hash of the
    value, so they depend on the values alone and no task sorts all of a column."""
    names = present(df, columns)
    items = [
        F.struct(F.lit(c).alias("name"), category_text(F.col(quoted(c))).alias("value")) for c in names
    ]
    spark = df.sparkSession
    if not names:
        return Categories(spark.createDataFrame([], "name string, value string, position bigint"), {})
    found = materialise(spark, df.select(F.inline(F.array(*items))).distinct(), "values")
    hashed = found.withColumn("_hash", stable_hash(F.col("value")))
    width = max(1, HASH_SPACE // (found.count() // DEFAULTS.bucket_rows + 1))
    placed = dense_index(hashed, "_hash", ["name"], "position", width, ties=["value"]).drop("_hash")
    placed = materialise(spark, placed, "categories")
    sizes = {r.name: r.n for r in placed.groupBy("name").agg(F.count(F.lit(1)).alias("n")).collect()}
    return Categories(placed, {c: sizes.get(c, 0) for c in names})


def encode_categories(df: DataFrame, categories: Categories, out: str = "categories", keep: bool = False) -> DataFrame:
    """One sparse 0/1 vector ``out`` in place of the source columns: the columns one after the other, each as wide as it has
    values. A value not seen at the fit is all zeros. ``keep`` leaves the source columns."""
    names = [c for c in categories.sizes if c in df.columns]
    # A column without a value at the fit is as wide as nothing.
    held = {c: categories.sizes[c] for c in names if categories.sizes[c]}
    encoded = df
    if not held:
        encoded = encoded.withColumn(out, array_to_vector(F.array().cast("array<double>")))
        return encoded if keep else encoded.drop(*names)
    for c, n in held.items():
        own = categories.values.where(F.col("name") == c).select(
            F.col("value").alias(f"_value_{c}"), F.col("position").cast("double").alias(f"_at_{c}")
        )
        joined = category_text(F.col(quoted(c))) == F.col(quoted(f"_value_{c}"))
        encoded = encoded.join(own, joined, "left").drop(f"_value_{c}")
    # Positions as plain names: a vector column cannot be assembled from names with dots. One beyond the last stands for a new value, and is dropped.
    at = {f"_c{i}": F.coalesce(F.col(quoted(f"_at_{c}")), F.lit(float(n))) for i, (c, n) in enumerate(held.items())}
    encoded = encoded.withColumns(at).drop(*[f"_at_{c}" for c in held])
    made = [f"{c}v" for c in at]
    widest = df.sparkSession.createDataFrame([tuple(float(n - 1) for n in held.values())], list(at))
    model = OneHotEncoder(inputCols=list(at), outputCols=made, handleInvalid="keep", dropLast=True).fit(widest)
    encoded = VectorAssembler(inputCols=made, outputCol=out).transform(model.transform(encoded)).drop(*at, *made)
    return encoded if keep else encoded.drop(*names)


@dataclass(frozen=True)
class Scaler:
    features: list[str]
    mean: list[float]
    std: list[float]

    @classmethod
    def fit(cls, df: DataFrame, features: Sequence[str]) -> Scaler:
        rows = {r["feature"]: r for r in fit_scaler(df, features).collect()}
        ordered = [rows[f] for f in features]
        return cls(
            list(features), [r["mean"] or 0.0 for r in ordered], [r["std"] or 0.0 for r in ordered]
        )

    def column(self, feature: str) -> Column:
        i = self.features.index(feature)
        # A constant feature is only centred.
        return (F.col(quoted(feature)) - F.lit(self.mean[i])) / F.lit(self.std[i] or 1.0)

    def transform(self, df: DataFrame) -> DataFrame:
        kept = [F.col(quoted(c)) for c in df.columns if c not in set(self.features)]
        return df.select(*kept, *[self.column(f).alias(f) for f in self.features])
