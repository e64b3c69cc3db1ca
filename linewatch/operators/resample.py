"""Oversampling of rare classes on segments between near rows (SMOTE)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewatch.config import DEFAULTS
from linewatch.functions.numbers import stable_hash, unit_hash
from linewatch.operators.neighbours import nearest_neighbours
from linewatch.operators.ordering import dense_index
from linewatch.operators.pivots import complete, near_neighbours
from linewatch.schema import ROW_ID, quoted
from linewatch.session import materialise

MAX_NEIGHBOURS = 5


#: Synthetic rows numbered together.
DRAW_ROWS = 10_000


def neighbour_count(rarest: int) -> int:
    return min(MAX_NEIGHBOURS, max(1, rarest - 1))


def _draws(sizes: DataFrame, most: int, k: int, seed: int) -> DataFrame:
    """One row per missing row of a class (``rows`` of them, ``n`` complete): base position, neighbour rank, and the
    place on the segment, all from a seeded hash of class and number. Numbers are dealt out in runs, so a class that
    lacks many rows is many short arrays."""
    missing = F.lit(most) - F.col("rows")
    last_run = F.floor((missing - 1) / DRAW_ROWS)
    runs = sizes.where(missing > 0).select(
        "label", "n", missing.alias("missing"), F.explode(F.sequence(F.lit(0).cast("bigint"), last_run)).alias("run")
    )
    low = F.col("run") * DRAW_ROWS
    numbers = F.sequence(low, F.least(low + DRAW_ROWS, F.col("missing")) - 1)
    number, text = F.col("draw"), F.col("label")
    return runs.repartition("label", "run").select("label", "n", F.explode(numbers).alias("draw")).select(
        "label",
        "draw",
        F.pmod(stable_hash(text, F.lit("base"), number, seed=seed), F.col("n")).alias("base"),
        (F.pmod(stable_hash(text, F.lit("rank"), number, seed=seed), F.lit(k)) + 1).cast("int").alias("rank"),
        unit_hash(text, F.lit("place"), number, seed=seed).alias("place"),
    )


def smote(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    order: str = ROW_ID,
    seed: int = DEFAULTS.seed,
    chunk_rows: int | None = None,
    bucket_rows: int = DEFAULTS.bucket_rows,
    exact: bool = False,
) -> DataFrame:
    """``label`` and features of all rows, plus synthetic rows until every class
    is as large as the largest. ``synthetic`` tells them apart, and ``draw`` numbers them within their class.

    Neighbours are near ones, found with bounded work (:func:`near_neighbours`), or the nearest if ``exact``; ``chunk_rows`` overrides the size of what a row is
    compared with at once. Rows with a null, NaN or infinite feature are kept and count in their class, but no synthetic row is made from them. A class with too few complete rows
    for the wanted neighbours leaves the table as it is. Rows without a class are kept and are no class.
    """
    columns = [F.col(quoted(label)), *[F.col(quoted(f)).cast("double").alias(f) for f in features]]
    none = F.lit(None).cast("bigint").alias("draw")
    original = df.select(*columns, F.lit(False).alias("synthetic"), none)
    spark = df.sparkSession
    text = F.col(quoted(label)).cast("string")
    usable = complete(features)
    sizes = df.where(text.isNotNull()).groupBy(text.alias("label")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(usable).alias("n")
    )
    sizes = materialise(spark, sizes, "sizes")
    classes, rarest, most = sizes.agg(F.count(F.lit(1)), F.min("rows"), F.max("rows")).first()
    if classes < 2 or rarest == most:
        return original
    small = sizes.where(F.col("rows") < most)
    k = neighbour_count(rarest)
    if small.agg(F.min("n")).first()[0] <= k:
        return original
    growing = df.where(usable).join(small.select(F.col("label").alias("_small")), text == F.col("_small"), "left_semi")
    indexed = dense_index(growing, order, [label], "_at", bucket_rows)
    plain = {f: f"f{i}" for i, f in enumerate(features)}
    members = materialise(
        spark,
        indexed.select(
            F.col(quoted(label)).cast("string").alias("label"),
            F.col("_at").alias("id"),
            *[F.col(quoted(f)).cast("double").alias(s) for f, s in plain.items()],
        ),
        "members",
    )
    draws = materialise(spark, _draws(sizes, most, k, seed), "draws")
    wanted = draws.select("label", F.col("base").alias("id")).distinct()
    search = nearest_neighbours if exact else near_neighbours
    near = search(members, list(plain.values()), k, wanted, **({"chunk_rows": chunk_rows} if chunk_rows else {}))
    picked = draws.join(
        near.select("label", F.col("id").alias("base"), "rank", "neighbour"), ["label", "base", "rank"]
    )
    names = list(plain.values())
    base = members.select("label", F.col("id").alias("base"), *[F.col(n).alias(f"{n}_b") for n in names])
    other = members.select("label", F.col("id").alias("neighbour"), *[F.col(n).alias(f"{n}_n") for n in names])
    pairs = picked.join(base, ["label", "base"]).join(other, ["label", "neighbour"])
    made = pairs.select(
        F.col("label").cast(df.schema[label].dataType).alias(label),
        *[
            (F.col(f"{s}_b") + F.col("place") * (F.col(f"{s}_n") - F.col(f"{s}_b"))).alias(f)
            for f, s in plain.items()
        ],
        F.lit(True).alias("synthetic"),
        F.col("draw"),
    )
    return original.unionByName(made)
