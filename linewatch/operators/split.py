"""Positional splits, samples and folds."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewatch.config import DEFAULTS
from linewatch.functions.numbers import HASH_SPACE, stable_hash
from linewatch.operators.ordering import dense_index
from linewatch.schema import ROW_ID, quoted

def raw_split_point(rows: int, share: float = DEFAULTS.raw_train_share) -> int:
    return int(rows * share)


def test_split_point(rows: int, share: float = DEFAULTS.test_share) -> int:
    return rows - math.ceil(rows * share)


def split_at(df: DataFrame, point: int, order: str = ROW_ID) -> tuple[DataFrame, DataFrame]:
    """Rows before a position and rows from it on, by a dense order. Both halves
    are plain filters, which reach the scan."""
    return df.where(F.col(quoted(order)) < point), df.where(F.col(quoted(order)) >= point)


def raw_split(df: DataFrame, order: str = ROW_ID) -> tuple[DataFrame, DataFrame]:
    return split_at(df, raw_split_point(df.count()), order)


def train_test_split(df: DataFrame, order: str = ROW_ID) -> tuple[DataFrame, DataFrame]:
    return split_at(df, test_split_point(df.count()), order)


def sample_rows(
    df: DataFrame, size: int = DEFAULTS.drift_sample_rows, order: str = ROW_ID, seed: int = DEFAULTS.seed
) -> DataFrame:
    """``size`` rows without replacement, in the random order of a seeded hash."""
    return (
        df.withColumn("_draw", stable_hash(F.col(quoted(order)), seed=seed))
        .orderBy("_draw", order)
        .limit(size)
    )


def latest(df: DataFrame, rows: int, order: str = ROW_ID) -> DataFrame:
    return df.orderBy(F.desc(order)).limit(rows)


def stratified_folds(
    df: DataFrame,
    label: str,
    order: str = ROW_ID,
    folds: int = DEFAULTS.folds,
    seed: int = DEFAULTS.seed,
    rows: int | None = None,
    bucket_rows: int = DEFAULTS.bucket_rows,
) -> DataFrame:
    """A fold number per row, each class dealt out evenly in hash order.

    The rank of a row in its class is taken in hash ranges, so a class that holds
    most of the table is still many buckets.
    """
    rows = df.count() if rows is None else rows
    width = max(1, HASH_SPACE // max(1, math.ceil(rows / bucket_rows)))
    drawn = df.withColumn("_draw", stable_hash(F.col(quoted(order)), seed=seed))
    ranked = dense_index(drawn, "_draw", [label], "_rank", width, ties=[order])
    return ranked.withColumn("fold", (F.col("_rank") % folds).cast("int")).drop("_draw", "_rank")
