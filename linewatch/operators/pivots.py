"""Near rows of the same class, with bounded work for each row, whatever the number of rows and features.

Each class is cut into cells around pivots, the means of a bounded sample. A row is compared with its own cell and then with the cells whose pivots are
next, ``probes`` in all, save those that the triangle inequality rules out: a row of another cell is at least as far away as the plane between the two pivots. Where no
more than ``probes`` cells are left, the result is exact. Cells of many rows are cut into chunks, and a row looks into one chunk of each.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linewatch.functions.numbers import is_finite
from linewatch.operators.neighbours import nearest_neighbours
from linewatch.schema import quoted
from linewatch.session import materialise

#: Rows of a cell, on average. A cell of more than twice as many is cut into chunks.
CELL_ROWS = 8192
#: Cells that a row is compared with.
PROBES = 16
#: Rows that the pivots of a class are fitted on, and pivots of a class at most.
SAMPLE_ROWS, PIVOTS = 16_384, 2_048
#: Rows of a class that one task compares with its pivots, or with a chunk.
BATCH_ROWS = 32_768
#: Rows compared at once, and columns whose least distance is looked at first.
STRIP, STRIDE = 256, 64


def complete(features: Sequence[str]) -> Column:
    """True for a row whose features are all finite numbers."""
    out = F.lit(True)
    for f in features:
        out = out & is_finite(F.col(quoted(f)).cast("double"))
    return out


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(values.flatten(), float).reshape(len(column), width)


def _lists(values: np.ndarray) -> pa.ListArray:
    """The rows of a matrix."""
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(values.ravel()))


def means(x: np.ndarray, n: int, rounds: int = 10) -> np.ndarray:
    """``n`` centres of the rows ``x`` by Lloyd's rounds; the first ones are rows. Fewer if fewer rows differ."""
    centres = np.unique(x, axis=0)
    centres = centres[np.random.default_rng(len(x)).permutation(len(centres))[:n]]
    for _ in range(rounds if len(centres) > 1 else 0):
        near = np.argmin((centres**2).sum(1) - 2 * x @ centres.T, axis=1)
        held = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres[held > 0] = sums[held > 0] / held[held > 0, None]
    return centres


def _pivots(vectors: DataFrame, sizes: DataFrame, width: int) -> DataFrame:
    """label, pivots: one row per class, from about SAMPLE_ROWS of its rows at most."""
    drawn = vectors.join(sizes, "label").where(F.pmod(F.xxhash64("id", F.lit(3)), F.col("n")) < SAMPLE_ROWS)

    def fit(rows: pa.Table) -> pa.Table:
        x = _matrix(rows.sort_by("id").column("x"), width)
        middle = x.mean(axis=0)
        made = means(x - middle, rows.column("pivots")[0].as_py()) + middle
        return pa.table({"label": rows.column("label").slice(0, 1), "pivots": pa.array([made.tolist()], pa.list_(pa.list_(pa.float64())))})

    return drawn.groupBy("label").applyInArrow(fit, "label string, pivots array<array<double>>")


def _placed(vectors: DataFrame, sizes: DataFrame, pivots: DataFrame, probes: int, width: int) -> DataFrame:
    """``vectors`` with ``cells``, the ``probes`` nearest ones, and ``beyond``, how far away a row of each must be at least."""
    batches = F.ceil(F.col("n") / BATCH_ROWS)
    left = vectors.join(sizes, "label").withColumn("batch", F.pmod(F.xxhash64("id", F.lit(5)), batches)).select("label", "batch", "id", "x")
    right = pivots.join(sizes, "label").select(
        "label", F.explode(F.sequence(F.lit(0).cast("bigint"), batches - 1)).alias("batch"), "pivots"
    )

    def place(rows: pa.Table, known: pa.Table) -> pa.Table:
        x = _matrix(rows.column("x"), width)
        centres = np.array(known.column("pivots")[0].as_py()).reshape(-1, width) if known.num_rows else np.zeros((1, width))
        middle = centres.mean(axis=0)
        a, c = x - middle, centres - middle
        apart = np.sqrt(np.maximum(((c[:, None, :] - c[None, :, :]) ** 2).sum(-1) if len(c) <= 64 else _square(c, c), 0))
        cells, beyond = [], []
        for s in range(0, len(a), STRIP):
            gaps = _square(a[s : s + STRIP], c)
            order = np.argsort(gaps, axis=1, kind="stable")[:, :probes]
            gaps = np.take_along_axis(gaps, order, axis=1)
            between = apart[order[:, :1], order]
            with np.errstate(invalid="ignore", divide="ignore"):
                far = np.where(between > 0, (gaps - gaps[:, :1]) / (2 * between), 0.0)
            cells.append(order)
            beyond.append(far)
        return pa.table(
            {
                "label": rows.column("label"),
                "id": rows.column("id"),
                "x": rows.column("x"),
                "cells": _lists(np.vstack(cells).astype(np.int32)),
                "beyond": _lists(np.vstack(beyond)),
            }
        )

    schema = "label string, id bigint, x array<double>, cells array<int>, beyond array<double>"
    return left.groupBy("label", "batch").cogroup(right.groupBy("label", "batch")).applyInArrow(place, schema)


def _square(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T


def compare(a: np.ndarray, b: np.ndarray, k: int, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` rows of ``b`` nearest to each row of ``a``, but for the one at ``own``: (row of a, row of b, squared distance) by row and distance,
    of equal distances the first rows of ``b``. A matrix product finds who can be among them, and their distances are computed again."""
    rows, cols, found = [], [], []
    middle = b.mean(axis=0)
    moved = b - middle
    extra = -len(b) % STRIDE
    for s in range(0, len(a), STRIP):
        part = a[s : s + STRIP]
        d2 = _square(part - middle, moved)
        if own is not None:
            d2[np.arange(len(part)), own[s : s + STRIP]] = np.inf
        padded = np.pad(d2, ((0, 0), (0, extra)), constant_values=np.inf) if extra else d2
        least = padded.reshape(len(part), -1, STRIDE)
        heads = least.min(axis=2)
        # The k nearest lie in the k stretches with the least heads.
        taken = np.argpartition(heads, k - 1, axis=1)[:, :k] if heads.shape[1] > k else np.broadcast_to(np.arange(heads.shape[1]), heads.shape)
        few = np.take_along_axis(least, taken[:, :, None], axis=1).reshape(len(part), -1)
        kth = min(k, few.shape[1]) - 1
        limit = np.partition(few, kth, axis=1)[:, kth]
        slack = 1e-9 * (1 + np.where(np.isfinite(limit), limit, 0) + ((part - middle) ** 2).sum(1))
        can = d2 <= (limit + slack)[:, None]
        if can.sum() > 8 * k * len(part):
            # Many equally near: the first of them are enough.
            tied = can & (d2 >= (limit - slack)[:, None])
            can &= ~tied | (np.cumsum(tied, axis=1) <= k)
        row, col = np.nonzero(can & np.isfinite(d2))
        exact = ((part[row] - b[col]) ** 2).sum(axis=1)
        order = np.lexsort((col, exact, row))
        row, col, exact = row[order], col[order], exact[order]
        keep = np.arange(len(row)) - np.searchsorted(row, row, side="left") < k
        rows.append(row[keep] + s)
        cols.append(col[keep])
        found.append(exact[keep])
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(found)


FOUND = "label string, id bigint, neighbour bigint, d2 double"


def _rows_found(label: pa.ChunkedArray, ids: np.ndarray, neighbours: np.ndarray, d2: np.ndarray) -> pa.Table:
    name = label[0].as_py() if len(label) else None
    return pa.table({"label": pa.array([name] * len(ids), pa.string()), "id": pa.array(ids, pa.int64()), "neighbour": pa.array(neighbours, pa.int64()), "d2": pa.array(d2, pa.float64())})


def _own_cell(chunked: DataFrame, k: int, width: int) -> DataFrame:
    """The k best of each wanted row in its own chunk."""

    def search(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("id")
        ids, x = rows.column("id").to_numpy(), _matrix(rows.column("x"), width)
        at = np.flatnonzero(rows.column("wanted").to_numpy())
        if not len(at):
            return _rows_found(rows.column("label"), *[np.zeros(0)] * 3)
        row, col, d2 = compare(x[at], x, k, at)
        return _rows_found(rows.column("label"), ids[at][row], ids[col], d2)

    return chunked.groupBy("label", "cell", "chunk").applyInArrow(search, FOUND)


def _other_cells(visits: DataFrame, chunked: DataFrame, k: int, width: int) -> DataFrame:
    """What visiting rows find in chunks that are not their own and is nearer than ``reach``. Visits to a chunk are dealt out in batches, each with a copy of it."""
    keys = ["label", "cell", "chunk"]
    batches = visits.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / BATCH_ROWS).alias("batches"))
    left = visits.join(batches, keys).withColumn("batch", F.pmod(F.xxhash64("id", F.lit(11)), F.col("batches")))
    right = chunked.join(batches, keys).select(
        *keys, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("batches") - 1)).alias("batch"), "id", "x"
    )

    def search(asking: pa.Table, chunk: pa.Table) -> pa.Table:
        if not asking.num_rows or not chunk.num_rows:
            return _rows_found(asking.column("label"), *[np.zeros(0)] * 3)
        chunk = chunk.sort_by("id")
        own, ids = asking.column("id").to_numpy(), chunk.column("id").to_numpy()
        row, col, d2 = compare(_matrix(asking.column("x"), width), _matrix(chunk.column("x"), width), k)
        near = d2 <= asking.column("reach").to_numpy()[row]
        return _rows_found(asking.column("label"), own[row[near]], ids[col[near]], d2[near])

    left = left.select(*keys, "batch", "id", "x", "reach")
    left = left.toDF(*left.columns)
    return left.groupBy(*keys, "batch").cogroup(right.groupBy(*keys, "batch")).applyInArrow(search, FOUND)


def near_neighbours(
    members: DataFrame,
    features: Sequence[str],
    k: int,
    wanted: DataFrame | None = None,
    chunk_rows: int = CELL_ROWS,
    probes: int = PROBES,
) -> DataFrame:
    """``label, id, neighbour, d2, rank``: k near rows of the same class for the rows of ``wanted`` (``label, id``; default all). ``members`` holds ``label`` text,
    ``id`` and the features.

    A row is compared with about ``2 * probes * chunk_rows`` rows at most, and half of that where cells are even, and exactly with its whole class if that has no more cells than ``probes`` or
    the triangle inequality rules out the others. Rows with a null, NaN or infinite feature have no neighbours and are none. A row that meets fewer than k others searches
    its whole class, so each complete row has k neighbours if its class has as many."""
    spark, width = members.sparkSession, len(features)
    whole = members.where(complete(features))
    vectors = whole.select("label", "id", F.array(*[F.col(quoted(f)).cast("double") for f in features]).alias("x"))
    sizes = whole.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.withColumn("pivots", F.least(F.lit(PIVOTS), F.ceil(F.col("n") / chunk_rows)).cast("int"))
    sizes = materialise(spark, sizes, "sizes")
    pivots = materialise(spark, _pivots(vectors, sizes, width), "pivots")
    placed = materialise(spark, _placed(vectors, sizes.select("label", "n"), pivots, probes, width), "placed")
    cells = placed.groupBy("label", F.get("cells", F.lit(0)).alias("cell")).agg(F.ceil(F.count(F.lit(1)) / (2 * chunk_rows)).alias("chunks"))
    cells = materialise(spark, cells, "cells")
    chunk = F.pmod(F.xxhash64("id", F.lit(7)), F.col("chunks")).alias("chunk")
    asked = placed.withColumn("cell", F.get("cells", F.lit(0))).join(cells, ["label", "cell"])
    if wanted is None:
        flagged = asked.withColumn("wanted", F.lit(True))
    else:
        flags = wanted.select("label", "id").distinct().withColumn("wanted", F.lit(True))
        flagged = asked.join(flags, ["label", "id"], "left").withColumn("wanted", F.coalesce("wanted", F.lit(False)))
    chunked = materialise(spark, flagged.select("label", "cell", chunk, "id", "x", "wanted", "cells", "beyond"), "chunks")
    first = materialise(spark, _own_cell(chunked.select("label", "cell", "chunk", "id", "x", "wanted"), k, width), "first")
    reach = first.groupBy("label", "id").agg(F.when(F.count(F.lit(1)) >= k, F.max("d2")).alias("reach"))
    asking = chunked.where("wanted and size(cells) > 1").join(reach, ["label", "id"], "left")
    asking = asking.withColumn("reach", F.coalesce("reach", F.lit(float("inf"))))
    # A hair less than the bound, for its rounding.
    near_enough = F.filter(
        F.slice(F.arrays_zip("cells", "beyond"), F.lit(2), F.lit(probes)),
        lambda c: c["beyond"] * (1 - 1e-9) <= F.sqrt("reach"),
    )
    visits = asking.select("label", "id", "x", "reach", F.inline(near_enough)).withColumnRenamed("cells", "cell")
    visits = visits.join(cells, ["label", "cell"]).select("label", "cell", chunk, "id", "x", "reach")
    second = _other_cells(visits, chunked.select("label", "cell", "chunk", "id", "x"), k, width)
    order = Window.partitionBy("label", "id").orderBy("d2", "neighbour")
    best = first.unionByName(second).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    near = materialise(spark, best, "near")
    served = near.where(F.col("rank") == k).select("label", "id")
    short = materialise(spark, chunked.where("wanted").select("label", "id").join(served, ["label", "id"], "left_anti"), "short")
    if short.isEmpty():
        return near
    exact = nearest_neighbours(whole, features, k, short)
    return near.join(short, ["label", "id"], "left_anti").unionByName(exact)
