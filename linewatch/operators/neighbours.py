"""Nearest rows of the same class, exact, without comparing all pairs of a class.

Rows are projected on the direction of greatest variance. Distances along it
never exceed true distances, so once a row knows k candidates at most d away, only
rows whose projection is within d can be nearer. The projection is cut into cells
and the cells into chunks of bounded length; a row searches one chunk first and
then just the chunks its d cannot rule out. A task compares one chunk with one
bounded batch of searching rows and returns one row for each, with its k best. Tables of one row per
class or per chunk go to all tasks, so rows move only into their chunks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from linewatch.functions.numbers import stable_hash
from linewatch.operators.stats import mean_and_covariance
from linewatch.schema import quoted
from linewatch.session import materialise

CHUNK_ROWS = 2048
SEGMENTS = 64
CHUNK = ["label", "cell", "chunk"]
FOUND = T.StructField("found", T.ArrayType(T.StructType().add("d2", "double").add("neighbour", "long")))
# Searching rows compared at once, so that a block of distances stays in the cache.
BLOCK = 128


def main_direction(df: DataFrame, features: Sequence[str]) -> list[float]:
    """Unit vector of greatest variance."""
    _, cov = mean_and_covariance(df, features)
    return np.linalg.eigh(np.array(cov))[1][:, -1].tolist()


def _cells(df: DataFrame, features: Sequence[str], chunk_rows: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``label, id, x`` plus projection, cell, and chunk of the cell; the bounds of each class; the chunks of each cell."""
    direction = main_direction(df, features)
    terms = [F.col(quoted(f)).cast("double") * F.lit(w) for f, w in zip(features, direction)]
    placed = df.select(
        "label",
        "id",
        F.array(*[F.col(quoted(f)).cast("double") for f in features]).alias("x"),
        sum(terms[1:], terms[0]).alias("p"),
    )
    # One row per class: percentiles of the projection, and how finely to cut
    # between two of them so that a cell holds about one chunk. Each class has as many as its own size asks for.
    shares = [i / SEGMENTS for i in range(SEGMENTS + 1)]
    fine = F.percentile_approx("p", shares, 10 * SEGMENTS)
    grid = placed.groupBy("label").agg(fine.alias("fine"), F.count(F.lit(1)).alias("n"))
    segments = F.least(F.lit(SEGMENTS), F.ceil(F.col("n") / chunk_rows)).cast("int")
    taken = F.transform(F.sequence(F.lit(0), segments), lambda i: F.get("fine", F.floor(i * SEGMENTS / segments).cast("int")))
    cuts = F.greatest(F.lit(1), F.ceil(F.col("n") / (segments * chunk_rows)))
    spark = df.sparkSession
    grid = materialise(spark, grid.select("label", taken.alias("bounds"), cuts.alias("cuts")), "grid")
    kept = placed.columns
    placed = placed.join(F.broadcast(grid), "label").select(*kept, _cell(F.col("p")).alias("cell"))
    sizes = placed.groupBy("label", "cell").agg(
        F.ceil(F.count(F.lit(1)) / chunk_rows).alias("chunks")
    )
    sizes = materialise(spark, sizes, "sizes")
    chunk = F.pmod(stable_hash(F.col("id"), seed=1), F.col("chunks")).alias("chunk")
    return placed.join(F.broadcast(sizes), ["label", "cell"]).select(*kept, "cell", chunk, "chunks"), grid, sizes


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once for all its places in there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _cell(p: Column) -> Column:
    """Cell number along the projection; the outer cells reach to infinity."""

    def inside(p: Column, segment: Column) -> Column:
        low, high = F.get("bounds", segment - 1), F.get("bounds", segment)
        cut = F.floor((p - low) / (high - low) * F.col("cuts")).cast("bigint")
        within = F.greatest(F.lit(0), F.least(cut, F.col("cuts") - 1))
        return (segment - 1) * F.col("cuts") + F.when(high > low, within).otherwise(F.lit(0))

    return _once(p, lambda p: _once(_segment(p), lambda segment: inside(p, segment)))


def _segment(p: Column) -> Column:
    reached = F.size(F.filter("bounds", lambda b: b <= p))
    return F.greatest(F.lit(1), F.least(reached, F.size("bounds") - 1))


def _points(table: pa.Table) -> np.ndarray:
    return table.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)


def _k_best(a: np.ndarray, own: np.ndarray, b: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Columns of the k nearest rows of ``b`` for each of ``a``, the first of equal ones first, and their squared distances. ``ids`` ascend."""
    k = min(k, len(b))
    cols, best = np.empty((len(a), k), dtype=np.int64), np.empty((len(a), k))
    finite = np.isfinite(a).all() and np.isfinite(b).all()
    for start in range(0, len(a), BLOCK):
        part = slice(start, start + BLOCK)
        d2 = np.zeros((len(a[part]), len(b)))
        for f in range(a.shape[1]):
            d = a[part, f, None] - b[None, :, f]
            d *= d
            d2 += d
        if not finite:
            d2[np.isnan(d2)] = np.inf
        at = np.searchsorted(ids, own[part])
        row = np.arange(len(d2))
        at = np.minimum(at, len(ids) - 1)
        itself = ids[at] == own[part]
        d2[row[itself], at[itself]] = np.inf
        for i in range(k):
            col = d2.argmin(axis=1)
            cols[part, i], best[part, i] = col, d2[row, col]
            d2[row, col] = np.inf
    return cols, best


def _search(requests: DataFrame, members: DataFrame, k: int, chunk_rows: int) -> DataFrame:
    """``requests`` (with a ``batch``) and the k best of each within its chunk, as ``found``. Requests to one chunk are split
    into batches, and the chunk is copied to each."""
    batches = requests.groupBy(*CHUNK).agg(F.ceil(F.count(F.lit(1)) / chunk_rows).alias("batches"))
    batches = F.broadcast(materialise(requests.sparkSession, batches, "batches"))
    left = requests.join(batches, CHUNK).withColumn(
        "batch", F.pmod(stable_hash(F.col("id"), seed=2), F.col("batches"))
    ).drop("batches")
    right = members.join(batches, CHUNK).select(
        *CHUNK, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("batches") - 1)).alias("batch"), "id", "x"
    )
    schema = T.StructType([*left.schema.fields, FOUND])
    kind = pa.list_(pa.struct([("d2", pa.float64()), ("neighbour", pa.int64())]))

    def nearest(wanted: pa.Table, chunk: pa.Table) -> pa.Table:
        if not wanted.num_rows or not chunk.num_rows:
            return pa.table({**{c: wanted.column(c)[:0] for c in wanted.column_names}, "found": pa.array([], kind)})
        chunk = chunk.sort_by("id")
        ids, own = chunk.column("id").to_numpy(), wanted.column("id").to_numpy()
        cols, best = _k_best(_points(wanted), own, _points(chunk), ids, k)
        real = np.isfinite(best)
        ends = np.concatenate([[0], np.cumsum(real.sum(axis=1))]).astype(np.int32)
        near = [pa.array(best[real]), pa.array(ids[cols[real]])]
        found = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(near, ["d2", "neighbour"]))
        return wanted.append_column("found", found.cast(kind))

    keys = [*CHUNK, "batch"]
    # The two sides may stem from one table; new column identities tell them apart.
    left = left.toDF(*left.columns)
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(nearest, schema)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("label", "id").orderBy("d2", "neighbour")
    each = found.select("label", "id", F.explode("found").alias("f")).select("label", "id", "f.neighbour", "f.d2")
    return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _reached(rows: DataFrame, grid: DataFrame, k: int) -> DataFrame:
    """``rows`` with the cells ``low_cell`` to ``high_cell`` that may hold one of their k nearest. A row that knows fewer than k looks
    through its own segment first; where that is the only one, these are all cells."""
    # A hair wider than the bound, for the rounding of the projection.
    slack = F.lit(1e-9) * (F.abs(F.col("p")) + 1)
    known = F.size("found") >= k
    radius = F.when(known, F.sqrt(F.get("found", F.lit(k - 1)).getField("d2")) + slack)
    first = (_segment(F.col("p")) - 1) * F.col("cuts")
    return rows.join(F.broadcast(grid), "label").withColumns(
        {
            "low_cell": F.when(known, _cell(F.col("p") - radius)).otherwise(first),
            "high_cell": F.when(known, _cell(F.col("p") + radius)).otherwise(first + F.col("cuts") - 1),
            "last_cell": F.col("cuts") * (F.size("bounds") - 1) - 1,
        }
    ).drop("bounds", "cuts")


def _visits(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """The chunks of the cells from ``low_cell`` to ``high_cell`` for each row, but for the one it has searched."""
    spread = rows.select(
        "label",
        "id",
        "x",
        F.col("cell").alias("own_cell"),
        F.col("chunk").alias("own_chunk"),
        F.explode(F.sequence("low_cell", "high_cell")).alias("cell"),
    ).join(F.broadcast(sizes), ["label", "cell"])
    visits = spread.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)))
    done = (F.col("cell") == F.col("own_cell")) & (F.col("chunk") == F.col("own_chunk"))
    return visits.where(~done).select(*CHUNK, "id", "x")


def nearest_neighbours(
    members: DataFrame,
    features: Sequence[str],
    k: int,
    wanted: DataFrame | None = None,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``label, id, neighbour, d2, rank`` for the rows of ``wanted`` (``label,
    id``; default all). ``members`` holds ``label`` text, ``id`` and the features.

    A row that already has k copies of itself looks no further: nothing can be
    nearer.
    """
    spark = members.sparkSession
    members = materialise(spark, members.select("label", F.col("id").cast("bigint").alias("id"), *[F.col(quoted(f)) for f in features]), "members")
    placed, grid, sizes = _cells(members, features, chunk_rows)
    placed = materialise(spark, placed, "cells")
    bases = placed if wanted is None else placed.join(wanted, ["label", "id"], "left_semi")
    first = materialise(spark, _search(bases, placed, k, chunk_rows), "nearest").drop("batch")
    copies = F.coalesce((F.size("found") >= k) & (F.get("found", F.lit(k - 1)).getField("d2") == 0), F.lit(False))
    reached = materialise(spark, _reached(first.where(~copies), grid, k), "reached")
    alone = (F.col("low_cell") == F.col("cell")) & (F.col("high_cell") == F.col("cell")) & (F.col("chunks") == 1)
    # A row without k in its whole segment goes on to all cells below.
    settled = alone & (F.size("found") >= k)
    closed = first.where(copies).select("label", "id", "found").unionByName(reached.where(settled).select("label", "id", "found"))
    closed = closed.select("label", "id", F.posexplode("found").alias("at", "f"))
    closed = closed.select("label", "id", "f.neighbour", "f.d2", (F.col("at") + 1).alias("rank"))
    open_rows = reached.where(~settled)
    short = F.size("found") < k
    pairs = open_rows.where(~short).select("label", "id", "found")
    second = _search(_visits(open_rows.where(~short), sizes), placed, k, chunk_rows)
    pairs = pairs.unionByName(second.select("label", "id", "found"))
    lacking = open_rows.where(short)
    if not lacking.isEmpty():
        pairs = pairs.unionByName(_widened(lacking, placed, grid, sizes, k, chunk_rows))
    return closed.unionByName(_best(pairs, k))


def _widened(rows: DataFrame, placed: DataFrame, grid: DataFrame, sizes: DataFrame, k: int, chunk_rows: int) -> DataFrame:
    """``label, id, found`` of rows that know fewer than k: from their segment, which gives most of them a bound, and then from all cells within it."""
    spark = rows.sparkSession
    seen = rows.select("label", "id", "found").unionByName(_search(_visits(rows, sizes), placed, k, chunk_rows).select("label", "id", "found"))
    seen = materialise(spark, _best(seen, k), "segment")
    found = seen.groupBy("label", "id").agg(F.array_sort(F.collect_list(F.struct("d2", "neighbour"))).alias("found"))
    again = rows.drop("found").join(found, ["label", "id"], "left")
    again = again.withColumn("found", F.coalesce("found", F.array().cast(FOUND.dataType))).drop("low_cell", "high_cell", "last_cell")
    again = _reached(again, grid, k)
    unbounded = F.size("found") < k
    again = again.withColumn("low_cell", F.when(unbounded, F.lit(0)).otherwise(F.col("low_cell")))
    again = again.withColumn("high_cell", F.when(unbounded, F.col("last_cell")).otherwise(F.col("high_cell")))
    again = materialise(spark, again, "again")
    third = _search(_visits(again, sizes), placed, k, chunk_rows)
    # A row seen in both rounds counts once.
    both = again.select("label", "id", "found").unionByName(third.select("label", "id", "found"))
    return both.select("label", "id", F.explode("found").alias("f")).distinct().select("label", "id", F.array("f").alias("found"))
