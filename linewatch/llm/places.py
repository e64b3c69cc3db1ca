"""Places of rows in groups of any size: rows are sorted together, and meet what is known of their group in spans of that order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linewatch.operators.ordering import ordered_index
from linewatch.session import materialise

#: Rows of a group that meet in one task.
SPAN = 5_000
#: Rows sorted in one task, and the number of such tasks at most.
SORTED_ROWS, SORTED_PARTS = 20_000, 20_000
GROUP, SPAN_NO = "_group", "_span"


def in_order(rows: DataFrame, columns: Sequence[str], nth: str) -> DataFrame:
    """``rows``, stored, with ``nth``: 0, 1, ... by ``columns``, null first."""
    parts = max(SORTED_ROWS, rows.count() // SORTED_PARTS)
    return materialise(rows.sparkSession, ordered_index(rows, columns, nth, parts), "ordered")


def span_of(nth: Column) -> Column:
    return F.floor(nth / SPAN)


def groups_of(ordered: DataFrame, group: str, nth: str) -> DataFrame:
    """group, first, n: where each group begins in the order and how many rows it has. ``group`` leads the order."""
    sizes = ordered.groupBy(F.col(group).alias("group")).agg(F.min(nth).alias("first"), F.count(F.lit(1)).alias("n"))
    return materialise(ordered.sparkSession, sizes, "groups")


def meet(ordered: DataFrame, groups: DataFrame, group: str, nth: str) -> DataFrame:
    """``ordered`` with the columns of its group and the keys ``_group`` and ``_span``: a large group is many keys, null is one as any other."""
    spans = F.sequence(span_of(F.col("first")), span_of(F.col("first") + F.col("n") - 1))
    known = groups.select(F.struct("group").alias(GROUP), F.explode(spans).alias(SPAN_NO), *[c for c in groups.columns if c != "group"])
    keyed = ordered.withColumn(GROUP, F.struct(F.col(group).alias("group"))).withColumn(SPAN_NO, span_of(F.col(nth)))
    return keyed.join(known, [GROUP, SPAN_NO])


def running(met: DataFrame, sums: dict[str, str], order: str, backwards: bool = False) -> DataFrame:
    """``met``, which has ``_group`` and ``_span``, with running sums within the group, the row's own value in it. ``sums`` names the sum of each
    column; spans are summed alone, and a row per span carries what comes before it."""
    key = F.col(order).desc() if backwards else F.col(order)
    span = F.col(SPAN_NO).desc() if backwards else F.col(SPAN_NO)
    inside = Window.partitionBy(GROUP, SPAN_NO).orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(GROUP).orderBy(span).rowsBetween(Window.unboundedPreceding, -1)
    totals = met.groupBy(GROUP, SPAN_NO).agg(*[F.sum(c).alias(f"{s}_of") for c, s in sums.items()])
    carried = totals.select(GROUP, SPAN_NO, *[F.coalesce(F.sum(f"{s}_of").over(before), F.lit(0)).alias(f"{s}_of") for s in sums.values()])
    local = met.select("*", *[F.sum(c).over(inside).alias(s) for c, s in sums.items()])
    joined = local.join(carried, [GROUP, SPAN_NO])
    return joined.withColumns({s: F.col(s) + F.col(f"{s}_of") for s in sums.values()}).drop(*[f"{s}_of" for s in sums.values()])
