"""Count, mean and co-moments of many features in one pass, mergeable.

Each task sums its rows, shifted by their mean, batch by batch; two such sums merge exactly, so tables, days or shards can be fitted apart and put together later."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import asdict, dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewatch.schema import quoted

#: Sums that reach the driver at most, each a matrix of the feature count; tasks merge theirs before.
SLOTS = 64


@dataclass(frozen=True)
class CoMoments:
    """``m2`` holds the sums of products of deviations from ``mean`` over ``n`` rows."""

    n: int
    mean: list[float]
    m2: list[list[float]]

    @staticmethod
    def of(x: np.ndarray) -> CoMoments:
        if not len(x):
            return CoMoments(0, [0.0] * x.shape[1], [[0.0] * x.shape[1] for _ in range(x.shape[1])])
        mean = x.mean(axis=0)
        moved = x - mean
        return CoMoments(len(x), mean.tolist(), (moved.T @ moved).tolist())

    def merge(self, other: CoMoments) -> CoMoments:
        if not self.n or not other.n:
            return self if self.n else other
        n = self.n + other.n
        gap = np.subtract(other.mean, self.mean)
        m2 = np.add(self.m2, other.m2) + np.outer(gap, gap) * (self.n * other.n / n)
        return CoMoments(n, (np.array(self.mean) + gap * (other.n / n)).tolist(), m2.tolist())

    def covariance(self) -> list[list[float]]:
        """The sample covariance; 0 of fewer than two rows."""
        return (np.array(self.m2) / (self.n - 1)).tolist() if self.n > 1 else [[0.0] * len(self.mean) for _ in self.mean]

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> CoMoments:
        return CoMoments(**json.loads(text))


def merged(parts: Iterable[CoMoments], width: int) -> CoMoments:
    return reduce(CoMoments.merge, parts, CoMoments.of(np.zeros((0, width))))


def co_moments(df: DataFrame, features: Sequence[str]) -> CoMoments:
    """Of the rows whose features are all finite numbers; others are left out. One pass, one exchange of a matrix per task."""
    width = len(features)
    values = df.select(F.array(*[F.coalesce(F.col(quoted(f)).cast("double"), F.lit(float("nan"))) for f in features]).alias("x"))

    def row(slot: int, task: int, held: CoMoments) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([task], pa.int32()), pa.array([held.to_json()])], names=["slot", "task", "held"])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = merged([], width)
        for batch in batches:
            x = np.asarray(batch.column("x").flatten(), float).reshape(batch.num_rows, width)
            held = held.merge(CoMoments.of(x[np.isfinite(x).all(axis=1)]))
        task = TaskContext.get().partitionId()
        yield row(task % SLOTS, task, held)

    def together(rows: pa.Table) -> pa.Table:
        # In one order, whichever task was done first.
        rows = rows.sort_by("task")
        held = merged(map(CoMoments.from_json, rows.column("held").to_pylist()), width)
        return pa.Table.from_batches([row(rows.column("slot")[0].as_py(), 0, held)])

    schema = "slot int, task int, held string"
    found = values.mapInArrow(sums, schema).groupBy("slot").applyInArrow(together, schema).collect()
    return merged([CoMoments.from_json(r.held) for r in sorted(found, key=lambda r: r.slot)], width)
