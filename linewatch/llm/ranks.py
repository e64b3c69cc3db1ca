"""Gapless ranks within groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linewatch.llm.names import unused

#: Rows of a group that are ranked together. What is summed over parts is at most a row for each.
RANKED_ROWS = 2_000


def parts_for(rows: int) -> int:
    return rows // RANKED_ROWS + 1


def ranked(df: DataFrame, group: list[str], part: str, order: list[Column | str], name: str) -> DataFrame:
    """``df`` with ``name``: 0, 1, ... within ``group``, by (``part``, ``order``). A task ranks one part of a group; what
    comes before it is summed over a row per part. Group columns must not be null."""
    n, before, nth = (unused(df, c) for c in ("n", "before", "nth"))
    sizes = df.groupBy(*group, part).agg(F.count(F.lit(1)).alias(n))
    earlier = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*group, part, F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(before))
    within = Window.partitionBy(*group, part).orderBy(*order)
    out = df.withColumn(nth, F.row_number().over(within)).join(sizes, [*group, part])
    return out.withColumn(name, (F.col(before) + F.col(nth) - 1).cast("bigint")).drop(nth, before)
