"""Exact interpolated percentiles of long columns.

Spark's exact ``percentile`` keeps a map of all distinct values in one task. For
long columns the wanted order statistics are cornered first: a sketch names two
values around the rank, one pass counts rows below, at and between them, and this
repeats on the open interval between until it is short enough to sort. All
columns advance in the same passes, and one summary row per pass reaches the
driver.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from linewatch.functions.numbers import number_of
from linewatch.operators.sketches import percentile_sketches, sketched_percentiles
from linewatch.session import materialise

# Values of a column that meet in one row at most: what is longer is narrowed first,
# unless it has about half as many distinct values.
EXACT_ROWS = 5_000
SKETCH_ACCURACY = 1000


@dataclass
class _Search:
    """The k-th smallest value lies among ``inside`` rows strictly between ``low``
    and ``high``, with ``below`` rows at or under ``low``; or it is ``found``."""

    column: Column
    k: int
    inside: int
    below: int = 0
    low: float | None = None
    high: float | None = None
    found: float | None = None

    def rows(self) -> Column:
        keep = F.lit(True)
        if self.low is not None:
            keep = keep & (self.column > self.low)
        if self.high is not None:
            keep = keep & (self.column < self.high)
        return F.when(keep, self.column)


def exact_percentiles(
    df: DataFrame,
    columns: Mapping[str, Column] | Sequence[str],
    share: float,
    exact_rows: int = EXACT_ROWS,
    accuracy: int = SKETCH_ACCURACY,
    counts: Mapping[str, int] | None = None,
) -> dict[str, float | None]:
    """The linearly interpolated ``share`` percentile per column, nulls left out;
    ``None`` for a column without values. ``counts`` saves counting the values."""
    if not isinstance(columns, Mapping):
        columns = {c: number_of(df, c) for c in columns}
    if not columns:
        return {}
    names = list(columns)
    frame = df.select(*[columns[n].alias(f"v{i}") for i, n in enumerate(names)])
    if any(n in df.columns and isinstance(df.schema[n].dataType, StringType) for n in names):
        # Text is parsed once, not in every pass.
        frame = materialise(df.sparkSession, frame, "numbers")
    cols = {n: F.col(f"v{i}") for i, n in enumerate(names)}
    if counts is None:
        counts = dict(zip(names, frame.agg(*[F.count(cols[n]) for n in names]).first()))
    distinct = dict.fromkeys(names, 0)
    if long := [n for n in names if counts[n] > exact_rows]:
        found = frame.agg(*[F.approx_count_distinct(cols[n]) for n in long]).first()
        distinct |= dict(zip(long, found))

    short = [n for n in names if counts[n] and distinct[n] <= exact_rows / 2]
    result: dict[str, float | None] = dict.fromkeys(names)
    if short:
        row = frame.agg(*[F.percentile(cols[n], F.lit(share)) for n in short]).first()
        result |= dict(zip(short, row))

    long = [n for n in long if n not in short]
    ranks = {n: share * (counts[n] - 1) for n in long}
    searches = {
        (n, k): _Search(cols[n], k, counts[n])
        for n in long
        for k in {math.floor(ranks[n]), math.ceil(ranks[n])}
    }
    _run(frame, list(searches.values()), exact_rows, accuracy)
    for n in long:
        low = searches[n, math.floor(ranks[n])].found
        high = searches[n, math.ceil(ranks[n])].found
        step = ranks[n] - math.floor(ranks[n])
        result[n] = low if low == high else low + step * (high - low)
    return result


def _run(frame: DataFrame, searches: list[_Search], exact_rows: int, accuracy: int) -> None:
    while todo := [s for s in searches if s.found is None]:
        wide = [s for s in todo if s.inside > exact_rows]
        if wide:
            _narrow(frame, wide, accuracy)
            continue
        ends = [F.get(F.sort_array(F.collect_list(s.rows())), F.lit(s.k - s.below)) for s in todo]
        for s, value in zip(todo, frame.agg(*ends).first()):
            s.found = value


def _narrow(frame: DataFrame, searches: list[_Search], accuracy: int) -> None:
    margin = 2.0 / accuracy
    sketches = []
    for s in searches:
        at = (s.k - s.below) / (s.inside - 1)
        shares = [max(0.0, at - margin), min(1.0, at + margin)]
        sketches.append(F.percentile_approx(s.rows(), shares, accuracy))
    bounds = frame.agg(*sketches).first()
    counts = []
    for s, (a, b) in zip(searches, bounds):
        rows = s.rows()
        counts += [F.count_if(rows < a), F.count_if(rows == a)]
        counts += [F.count_if((rows > a) & (rows < b)), F.count_if(rows == b)]
    row = frame.agg(*[c.alias(f"n{i}") for i, c in enumerate(counts)]).first()
    for i, (s, (a, b)) in enumerate(zip(searches, bounds)):
        under, at_a, between, at_b = row[4 * i : 4 * i + 4]
        at_b = 0 if a == b else at_b
        k = s.k - s.below
        if k < under:
            s.high, s.inside = a, under
        elif k < under + at_a:
            s.found = a
        elif k < under + at_a + between:
            s.low, s.high, s.below, s.inside = a, b, s.below + under + at_a, between
        elif k < under + at_a + between + at_b:
            s.found = b
        else:
            passed = under + at_a + between + at_b
            s.low, s.below, s.inside = b, s.below + passed, s.inside - passed


def medians(
    df: DataFrame,
    columns: Sequence[str],
    exact_rows: int = EXACT_ROWS,
    counts: Mapping[str, int] | None = None,
    approximate: int | None = None,
) -> dict[str, float]:
    """Column medians; 0 for a column without any number. ``approximate`` is the size of a sketch to take them from, in one pass."""
    if approximate:
        found = sketched_percentiles(percentile_sketches(df, columns, approximate), 0.5)
    else:
        found = exact_percentiles(df, columns, 0.5, exact_rows, counts=counts)
    return {c: 0.0 if m is None else m for c, m in found.items()}
