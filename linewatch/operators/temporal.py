"""Future label, lag and rolling features."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from linewatch.config import DEFAULTS
from linewatch.functions.numbers import finite_or_null, number_of
from linewatch.operators.columns import present
from linewatch.operators.ordering import (
    BUCKET,
    POSITION,
    carry_fill,
    dense_from,
    dense_index,
    halo_at,
    with_position,
)
from linewatch.operators.quantiles import medians
from linewatch.schema import GROUP, ROW_ID, SENSORS, TARGET, quoted
from linewatch.session import materialise


def create_future_target(
    df: DataFrame,
    target: str = GROUP,
    shift: int = DEFAULTS.shift_rows,
    order: str = ROW_ID,
    by: Sequence[str] = (),
    bucket_rows: int = DEFAULTS.bucket_rows,
    dense: bool | None = None,
) -> DataFrame:
    """The class ``shift`` rows ahead as ``Future_Downtime_Label``. Rows without
    one go, unless no row has one. ``order`` may have gaps."""
    if target not in df.columns:
        return df

    def columns(w: WindowSpec) -> list[Column]:
        return [
            *[F.col(quoted(c)) for c in df.columns],
            F.lead(F.col(quoted(target)), shift).over(w).cast("int").alias(TARGET),
        ]

    placed = with_position(df, order, by, dense, bucket_rows)
    ahead = halo_at(placed, columns, 0, shift, by, bucket_rows)
    # Some row has a label exactly if a class sits at position >= shift; the look
    # stops at the first one.
    classes_ahead = F.col(quoted(target)).isNotNull() & (F.col(POSITION) >= shift)
    none = placed.where(classes_ahead).select(F.lit(1)).isEmpty()
    return ahead if none else ahead.where(F.col(TARGET).isNotNull())


def lag_one(c: Column, fill: Column, w: WindowSpec) -> Column:
    return F.coalesce(F.lag(c, 1).over(w), fill)


def rolling_mean(c: Column, w: WindowSpec, rows: int = DEFAULTS.rolling_rows) -> Column:
    """Mean of the row and the ``rows - 1`` before it; infinities do not count."""
    return F.avg(finite_or_null(c)).over(w.rowsBetween(-(rows - 1), 0))


def rolling_std(c: Column, w: WindowSpec, rows: int = DEFAULTS.rolling_rows) -> Column:
    """Sample deviation over the same frame, 0 for a single value."""
    spread = F.stddev_samp(finite_or_null(c)).over(w.rowsBetween(-(rows - 1), 0))
    return F.coalesce(spread, F.lit(0.0))


@dataclass(frozen=True)
class SensorFit:
    """Fill values of the sensors, and the sensors that hold an infinity."""

    medians: dict[str, float]
    infinite: tuple[str, ...] = ()


def fit_sensors(df: DataFrame, sensors: Sequence[str] = SENSORS) -> SensorFit:
    sensors = present(df, sensors)
    if not sensors:
        return SensorFit({})
    numbers = {c: number_of(df, c) for c in sensors}
    row = df.agg(
        *[F.count(x) for x in numbers.values()],
        *[F.bool_or(F.abs(x) == F.lit(math.inf)) for x in numbers.values()],
    ).first()
    counts, infinite = row[: len(sensors)], row[len(sensors) :]
    return SensorFit(
        medians(df, sensors, counts=dict(zip(sensors, counts))),
        tuple(c for c, hit in zip(sensors, infinite) if hit),
    )


def add_temporal_features(
    df: DataFrame,
    sensors: Sequence[str] = SENSORS,
    fit: SensorFit | None = None,
    order: str = ROW_ID,
    by: Sequence[str] = (),
    bucket_rows: int = DEFAULTS.bucket_rows,
    rolling_rows: int = DEFAULTS.rolling_rows,
    ahead: tuple[str, int, str] | None = None,
    fill_from: DataFrame | None = None,
    dense: bool | None = None,
    numbered: bool = False,
) -> DataFrame:
    """Sensors to numbers with gaps at the median, then ``_lag1``, ``_mean5`` and
    ``_std5`` for each; the other columns are filled forward, backward, then 0.

    All row windows share one exchange and one sort. With ``by``, windows and fills stay within a group.
    ``order`` may have gaps; it is then ranked once, into a stored table. ``numbered`` says that the caller has just made
    ``order`` as a position from 0, so that there is nothing to look at.
    ``ahead`` adds a look-ahead column (source, rows, name) in the same pass and
    drops the rows that have none; ``fill_from`` is then the table without them, of a dense order from 0.
    Without any sensor column the frame is returned as it is.
    """
    sensors = present(df, sensors)
    if not sensors:
        return df
    fit = fit_sensors(df, sensors) if fit is None else fit
    others = [c for c in df.columns if c not in sensors]

    def number(c: str) -> Column:
        return F.coalesce(number_of(df, c), F.lit(float(fit.medians[c])))

    numbers = df.select(
        *[number(c).alias(c) if c in sensors else F.col(quoted(c)) for c in df.columns]
    )
    # Columns that cannot hold nulls need no fill.
    nullable = {f.name for f in df.schema.fields if f.nullable}
    gaps = [c for c in others if c in nullable and c != order and c not in by]
    low = 0 if numbered else dense_from(numbers, order) if dense is None and not by else None
    if low is not None:
        placed = numbers.withColumn(POSITION, (F.col(quoted(order)) - F.lit(low)).cast("bigint"))
    elif dense:
        placed = with_position(numbers, order, by, dense, bucket_rows)
    else:
        placed = dense_index(numbers, order, by, POSITION, bucket_rows)
        placed = materialise(df.sparkSession, placed, "placed")

    def columns(w: WindowSpec) -> list[Column]:
        made = []
        for c in sensors:
            x = F.col(quoted(c))
            made += [
                lag_one(x, F.lit(float(fit.medians[c])), w).alias(f"{c}_lag1"),
                rolling_mean(x, w, rolling_rows).alias(f"{c}_mean5"),
                rolling_std(x, w, rolling_rows).alias(f"{c}_std5"),
            ]
        if ahead:
            source, rows, name = ahead
            made.append(F.lead(F.col(quoted(source)), rows).over(w).cast("int").alias(name))
        return [*[F.col(quoted(c)) for c in df.columns], *made]

    reach = ahead[1] if ahead else 0
    featured = halo_at(placed, columns, rolling_rows - 1, reach, by, bucket_rows, keep=True)
    if ahead:
        featured = featured.where(F.col(quoted(ahead[2])).isNotNull())
    source = placed if fill_from is None else fill_from.withColumn(POSITION, F.col(quoted(order)).cast("bigint"))
    # A window of infinities alone has no mean and takes the last one before it.
    means = [f"{c}_mean5" for c in fit.infinite if c in sensors]
    if means:
        # The means are made in the pass above, so their summaries need its result.
        featured = materialise(df.sparkSession, featured, "featured")
        return carry_fill(featured, [*gaps, *means], POSITION, bucket_rows, by=by)
    return carry_fill(featured, gaps, POSITION, bucket_rows, source=source, by=by)
