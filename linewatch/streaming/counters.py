"""Service counters that follow a running scoring stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from linewatch.streaming.drift import STATE_STORE

#: Metrics that are what the last batch says; a feature's drift flag stays set; all others add up.
LATEST = ("drifted_features_count", "model_health_status")
FLAG = "feature_drift_"
GAUGES = "metric string, value double, batch_id bigint"


class Totals(StatefulProcessor):
    """A metric so far, and the last batch that is in it. A batch that the scoring stream has run again is not counted twice."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "value double, last bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        (metric,) = key
        value, last = self.total.get() if self.total.exists() else (0.0, -1)
        new = pd.concat(list(rows)).sort_values("batch_id").drop_duplicates("batch_id")
        new = new[new["batch_id"] > last]
        if not len(new):
            return
        if metric in LATEST:
            value = float(new["value"].iloc[-1])
        elif metric.startswith(FLAG):
            value = 1.0
        else:
            value = float(value + new["value"].sum())
        last = int(new["batch_id"].iloc[-1])
        self.total.update((value, last))
        yield pd.DataFrame({"metric": [metric], "value": [value], "scored_batch": [last]})

    def close(self) -> None:
        pass


def live_counters(spark: SparkSession, results: str, out: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """The counters of :func:`score_stream`, from what it writes to ``results`` batch by batch, as a running aggregate with state by metric.

    A micro-batch writes the metrics that changed to a folder of its own in ``out``; :func:`current_counters` reads them. It may run beside the scoring stream, and a
    restart goes on from its checkpoint."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    gauges = spark.readStream.schema(GAUGES).parquet(f"{results}/gauges")
    changed = gauges.groupBy("metric").transformWithStateInPandas(Totals(), "metric string, value double, scored_batch bigint", "update", "none")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/update={batch_id}")

    return (
        changed.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def current_counters(spark: SparkSession, out: str) -> DataFrame:
    """metric, value: each metric as it was last written."""
    rows = spark.read.parquet(out)
    return rows.groupBy("metric").agg(F.max_by("value", "update").alias("value"))
