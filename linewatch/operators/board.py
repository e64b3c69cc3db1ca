"""Queries of the status board and the result store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewatch.config import DEFAULTS
from linewatch.functions.labels import status_icon
from linewatch.operators.split import latest


def latest_predictions(predictions: DataFrame, order: str = "seq") -> DataFrame:
    """The newest predictions of the kept ones, newest last."""
    rows = min(DEFAULTS.latest_predictions, DEFAULTS.kept_predictions)
    return latest(predictions, rows, order).orderBy(order)


def latest_prediction(predictions: DataFrame, order: str = "seq") -> DataFrame:
    return latest(predictions, 1, order)


def board(predictions: DataFrame, order: str = "seq") -> DataFrame:
    """The newest rows first, as the board shows them."""
    rows = min(DEFAULTS.board_rows, DEFAULTS.board_kept)
    return status_rows(latest(predictions, rows, order)).orderBy(F.desc(order))


def status_rows(predictions: DataFrame) -> DataFrame:
    """Time of day (or the text as it came), icon class and group."""
    text = F.col("timestamp").cast("string")
    group = F.coalesce(F.col("predicted_downtime"), F.lit("N/A"))
    return predictions.withColumns(
        {
            "time": F.coalesce(F.date_format(F.try_to_timestamp(text), "HH:mm:ss"), text),
            "machine": F.coalesce(F.col("machine_id"), F.lit("N/A")),
            "line": F.coalesce(F.col("assembly_line_no"), F.lit("N/A")),
            "icon": status_icon(group),
            "group": group,
        }
    )
