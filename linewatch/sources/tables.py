"""Raw tables and splits on any path scheme Spark can read."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from linewatch.operators.split import raw_split_point, split_at
from linewatch.schema import ROW_ID, raw_schema

FORMATS = ("csv", "parquet")


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None
) -> DataFrame:
    """A raw table or a split. A CSV has a header; its columns go by position, so
    the nameless first one becomes ``row_id``."""
    if fmt not in FORMATS:
        raise ValueError(f"format {fmt!r} is none of {FORMATS}")
    if fmt == "csv":
        return spark.read.schema(schema or raw_schema()).option("header", True).csv(path)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_first_available(
    paths: Sequence[str], read: Callable[[str], DataFrame]
) -> tuple[DataFrame, str]:
    """The first path that can be read, with its name."""
    for path in paths:
        try:
            return read(path), path
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"none of {list(paths)} is available")


def with_row_id(df: DataFrame, fmt: str = "parquet") -> DataFrame:
    """A dense ``row_id`` in file order for a table read from files.

    Parquet rows know their place in the file. In text files a row's place is
    counted within its input split. Only the number of rows per file or split is
    summed up, one row each, and goes to the tasks that read the files, so that no row is moved.
    """
    columns = [c for c in df.columns if c != ROW_ID]
    if fmt == "parquet":
        placed = df.select(
            *columns,
            F.col("_metadata.file_path").alias("_file"),
            F.lit(0).cast("bigint").alias("_block"),
            F.col("_metadata.row_index").alias("_place"),
        )
    else:
        placed = df.select(
            *columns,
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_place"),
        )
    parts = placed.groupBy("_file", "_block").agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        "_file", "_block", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    row_id = F.col("_offset") + F.col("_place") - F.col("_first")
    return placed.join(F.broadcast(offsets), ["_file", "_block"]).select(row_id.alias(ROW_ID), *columns)


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """``row_id`` goes first, so that the order survives in any file layout."""
    ordered = df.select(ROW_ID, *[c for c in df.columns if c != ROW_ID])
    if fmt == "csv":
        ordered.write.mode("overwrite").option("header", True).csv(path)
    else:
        ordered.write.mode("overwrite").parquet(path)


def split_and_save(
    df: DataFrame, train_path: str, infer_path: str, fmt: str = "csv", share: float = 0.85
) -> tuple[DataFrame, DataFrame]:
    """Write the positional splits; each is a filter on the scan."""
    train, infer = split_at(df, raw_split_point(df.count(), share))
    write_table(train, train_path, fmt)
    write_table(infer, infer_path, fmt)
    return train, infer
