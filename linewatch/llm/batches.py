"""Sizes of the batches that Python workers get."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import SparkSession

#: Rows with a whole text or a bag each.
TEXT_ROWS = 1_000
#: Texts that are Python strings at once.
STRINGS = 256


def strings(texts: pa.Array) -> Iterator[str]:
    """The texts of a column one after the other, null as empty, few of them held as strings."""
    for at in range(0, len(texts), STRINGS):
        for text in texts.slice(at, STRINGS).to_pylist():
            yield text or ""


@contextmanager
def text_batches(spark: SparkSession, rows: int = TEXT_ROWS) -> Iterator[None]:
    """Within, what runs hands at most ``rows`` rows at once to a Python worker: a batch of long rows is
    held by the worker and by its executor, and neither gives such memory back soon."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)
