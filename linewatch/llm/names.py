"""Column names that are free."""

from __future__ import annotations

from pyspark.sql import DataFrame


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores behind it as no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
