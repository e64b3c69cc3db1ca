"""Run log: one row per named parameter or metric of a run."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def run_rows(
    spark: SparkSession, run_id: str, kind: str, values: Mapping[str, object], clock: Column | None = None
) -> DataFrame:
    rows = [(run_id, kind, name, str(value)) for name, value in values.items()]
    frame = spark.createDataFrame(rows, "run_id string, kind string, name string, value string")
    return frame.withColumn("logged_at", F.current_timestamp() if clock is None else clock)


def append_run(rows: DataFrame, path: str) -> None:
    rows.coalesce(1).write.mode("append").parquet(path)


def count_rows(counts: DataFrame, column: str, prefix: str, run_id: str) -> DataFrame:
    """Value counts as run-log rows named ``prefix`` + value."""
    return counts.select(
        F.lit(run_id).alias("run_id"),
        F.lit("param").alias("kind"),
        F.concat(F.lit(prefix), F.col(column).cast("string")).alias("name"),
        F.col("n").cast("string").alias("value"),
    )
