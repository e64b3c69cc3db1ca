"""Queries of readers, writers and stored results. Results are written below the
shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linewatch.catalog.base import (
    LINE_FEATURES,
    RAW_SQL,
    SENSORS,
    TORQUE,
    VOLTAGE,
    hash_sql,
    machine_events,
    query,
    r6,
    table,
)
from linewatch.config import DEFAULTS
from linewatch.operators.encode import Scaler, fit_labels, fit_one_hot
from linewatch.operators.quantiles import medians
from linewatch.operators.stats import value_counts
from linewatch.operators.temporal import SensorFit
from linewatch.schema import quoted, raw_schema
from linewatch.session import run_dir
from linewatch.sources.bundle import Bundle, load_bundle, save_bundle
from linewatch.sources.log import write_message_log
from linewatch.sources.messages import decode, message_source, to_messages
from linewatch.sources.runlog import append_run, count_rows, run_rows
from linewatch.sources.tables import (
    read_first_available,
    read_table,
    split_and_save,
    with_row_id,
    write_table,
)
from linewatch.streaming.replay import replay, write_replay
from linewatch.streaming.score import write_log

RAW_COLUMNS_SQL = "row_id, d_text as date_text, t_text as time_text, machine, line, torque, voltage, reason"


def raw_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "row_id",
        F.col("Date").alias("date_text"),
        F.col("Timestamp").alias("time_text"),
        F.col("Machine_ID").alias("machine"),
        F.col("Assembly_Line_No").alias("line"),
        F.col(quoted(TORQUE)).alias("torque"),
        F.col(quoted(VOLTAGE)).alias("voltage"),
        F.col("Downtime").alias("reason"),
    )


@query("raw_table_o01", f"with {RAW_SQL} select {RAW_COLUMNS_SQL} from raw")
def raw_table(spark: SparkSession, sf: str) -> DataFrame:
    path = run_dir(spark, "raw")
    write_table(machine_events(spark, sf), path, "parquet")
    return raw_columns(read_table(spark, path, "parquet", raw_schema(SENSORS)))


@query(
    "row_numbering_o01",
    "select l_orderkey, l_linenumber, l_extendedprice, row_number() over () - 1 as row_id from lineitem",
)
def row_numbering(spark: SparkSession, sf: str) -> DataFrame:
    """Dense row ids in file order for a table that has none."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return with_row_id(lines, "parquet")


@query("csv_scan_o02", f"with {RAW_SQL} select {RAW_COLUMNS_SQL} from raw")
def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = run_dir(spark, "csv")
    write_table(machine_events(spark, sf), path, "csv")
    return raw_columns(read_table(spark, path, "csv", raw_schema(SENSORS)))


@query(
    "split_and_save_o03",
    f"""with {RAW_SQL} select {RAW_COLUMNS_SQL}, case when row_id < (select floor(count(*) * 0.85) from raw)
      then 'train' else 'inference' end as part from raw""",
)
def split_save(spark: SparkSession, sf: str) -> DataFrame:
    train, infer = run_dir(spark, "train"), run_dir(spark, "inference")
    split_and_save(machine_events(spark, sf), train, infer)
    parts = {"train": train, "inference": infer}
    read = [
        raw_columns(read_table(spark, path, "csv", raw_schema(SENSORS))).withColumn("part", F.lit(name))
        for name, path in parts.items()
    ]
    return read[0].unionByName(read[1])


@query("first_available_o04", "select o_orderkey, 'second' as source from orders")
def fallback(spark: SparkSession, sf: str) -> DataFrame:
    paths = {run_dir(spark, "absent"): "first", f"{sf}/orders.parquet": "second"}
    df, path = read_first_available(list(paths), lambda p: read_table(spark, p))
    return df.select("o_orderkey", F.lit(paths[path]).alias("source"))


@query(
    "to_messages_o05",
    f"""with {RAW_SQL} select machine as key, row_id, torque, voltage, false as has_label from raw""",
)
def messages(spark: SparkSession, sf: str) -> DataFrame:
    sent = to_messages(machine_events(spark, sf))
    return sent.select(
        "key",
        F.get_json_object("value", "$.row_id").cast("bigint").alias("row_id"),
        F.get_json_object("value", f"$['{TORQUE}']").alias("torque"),
        F.get_json_object("value", f"$['{VOLTAGE}']").alias("voltage"),
        F.col("value").contains("Downtime").alias("has_label"),
    )


def stored(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over what is there and return all it wrote, with the number of
    the micro-batch."""
    spark = stream.sparkSession
    path, checkpoint = run_dir(spark, name), run_dir(spark, f"{name}-checkpoint")

    def write(batch: DataFrame, batch_id: int) -> None:
        # The stream's own log says which batches are done: an empty marker file in each folder costs more than the rows of a short one.
        batch.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/batch={batch_id}")

    started = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    started.awaitTermination()
    return spark.read.parquet(path)


@query(
    "replay_o06",
    "select event_id as row_id, (event_id // 5000)::int as batch from events",
)
def paced_replay(spark: SparkSession, sf: str) -> DataFrame:
    path = run_dir(spark, "replay")
    write_replay(machine_events(spark, sf), path, rows_per_file=5000)
    seen = stored(replay(spark, path), "replayed")
    return seen.select(F.get_json_object("value", "$.row_id").cast("bigint").alias("row_id"), "batch")


@query(
    "message_log_o06",
    f"""with {RAW_SQL}, p as (select row_id, machine, ({hash_sql(0, "coalesce(machine, '')")} % 3)::int as partition from raw),
      o as (select *, row_number() over (partition by partition order by row_id) - 1 as "offset" from p)
      select row_id, machine, partition, "offset", 1000 * ("offset" * 30 + 1700000000) as sent_ms, case when "offset" <= 1000 then 0 else 1 end as run from o""",
)
def log_replay(spark: SparkSession, sf: str) -> DataFrame:
    """A log of three partitions, read by offsets in two runs: what its clock has published by then, and the rest after a restart."""
    path, out, checkpoint = (run_dir(spark, n) for n in ("log", "logged", "log-checkpoint"))
    start = 1_700_000_000_000
    write_message_log(machine_events(spark, sf), path, partitions=3, start_ms=start, rows_per_file=777)
    for run, now in enumerate((start + 1000 * 30_000 + 5, start + 10**12)):
        stream = message_source(spark, {"kind": "log", "path": path, "now_ms": str(now)})
        rows = stream.withColumn("run", F.lit(run))
        rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.parquet(out).select(
        F.get_json_object("value", "$.row_id").cast("bigint").alias("row_id"),
        F.get_json_object("value", "$.Machine_ID").alias("machine"),
        "partition",
        "offset",
        F.unix_millis("sent_at").alias("sent_ms"),
        "run",
    )


@query("message_source_o07", f"with {RAW_SQL} select row_id, machine from raw")
def source(spark: SparkSession, sf: str) -> DataFrame:
    path = run_dir(spark, "messages")
    to_messages(machine_events(spark, sf)).select("value").write.text(path)
    stream = message_source(spark, {"kind": "files", "path": path, "files_per_trigger": 10})
    received = stored(stream, "received")
    return received.select(
        F.get_json_object("value", "$.row_id").cast("bigint").alias("row_id"),
        F.get_json_object("value", "$.Machine_ID").alias("machine"),
    )


@query(
    "decode_o08",
    """select event_id, case when event_id % 19 = 0 or event_id % 23 = 0 then null else concat('M', user_id) end as machine_id,
      case when event_id % 19 = 0 then null else 'L1' end as line,
      case when event_id % 19 = 0 then null when event_id % 5 = 0 then 'high' else json_extract_string(props, '$.k') end as k,
      event_id % 19 = 0 or event_id % 23 = 0 as bad from events""",
)
def decoded(spark: SparkSession, sf: str) -> DataFrame:
    """Broken lines, messages without a machine, and text where a number belongs."""
    lines = table(spark, sf, "events").selectExpr(
        "event_id",
        "case when event_id % 19 = 0 then concat('{', props) else concat('{', "
        "case when event_id % 23 = 0 then '' else concat('\"Machine_ID\": \"M', user_id, '\", ') end, "
        "'\"Assembly_Line_No\": \"L1\", \"k\": ', "
        "case when event_id % 5 = 0 then '\"high\"' else get_json_object(props, '$.k') end, '}') end as value",
    )
    out = decode(lines, ["k"])
    return out.select(
        "event_id",
        "machine_id",
        F.col("assembly_line_no").alias("line"),
        F.col("data.k").alias("k"),
        F.col("_bad").isNotNull().alias("bad"),
    )


@query(
    "log_files_o09",
    """select event_id, event_type, true as fits from events""",
)
def log_files(spark: SparkSession, sf: str) -> DataFrame:
    """Log rows through files of at most 100 rows, counted per file."""
    path = run_dir(spark, "log")
    write_log(table(spark, sf, "events").select("event_id", "event_type"), path, 0, DEFAULTS.log_rows)
    back = spark.read.schema("event_id bigint, event_type string").option("header", True).csv(f"{path}/batch_id=0")
    named = back.select("*", F.col("_metadata.file_name").alias("file"))
    # Opening the files costs most, so they are read once: a file's rows, which are few, meet in a window.
    rows = F.count(F.lit(1)).over(Window.partitionBy("file"))
    return named.select("event_id", "event_type", (rows <= 100).alias("fits"))


@query(
    "bundle_o24",
    " union all ".join(
        f"select '{c}' as feature, round(avg({c}), 4) as mean, round(stddev_pop({c}), 4) as std, "
        f"round(median({c}), 4) as median, 'A,N,R' as classes from lineitem"
        for c in LINE_FEATURES
    ),
)
def bundle(spark: SparkSession, sf: str) -> DataFrame:
    """Fitted parts saved, loaded, and listed from what was loaded."""
    lines = table(spark, sf, "lineitem")
    path = run_dir(spark, "bundle")
    fitted = Bundle(
        sensors=LINE_FEATURES,
        categories=fit_one_hot(lines, ["l_linestatus"]),
        features=LINE_FEATURES,
        classes=fit_labels(lines, "l_returnflag"),
        sensor_fit=SensorFit(medians(lines, LINE_FEATURES)),
        scaler=Scaler.fit(lines, LINE_FEATURES),
    )
    save_bundle(spark, fitted, path)
    loaded = load_bundle(spark, path, with_model=False)
    rows = [
        (f, m, s, loaded.sensor_fit.medians[f], ",".join(loaded.classes))
        for f, m, s in zip(loaded.scaler.features, loaded.scaler.mean, loaded.scaler.std)
    ]
    listed = spark.createDataFrame(
        rows, "feature string, mean double, std double, median double, classes string"
    )
    return listed.select("feature", *[r6(c, 4).alias(c) for c in ("mean", "std", "median")], "classes")


@query(
    "run_log_o25",
    """select 'run-1' as run_id, 'param' as kind, concat('downtime_group_', event_type) as name, count(*)::varchar as value
      from events group by event_type union all select 'run-1', 'metric', 'train_size', count(*)::varchar from events""",
)
def run_log(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    path = run_dir(spark, "runs")
    clock = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    counted = count_rows(value_counts(events, "event_type"), "event_type", "downtime_group_", "run-1")
    append_run(counted.withColumn("logged_at", clock), path)
    append_run(run_rows(spark, "run-1", "metric", {"train_size": events.count()}, clock), path)
    return spark.read.parquet(path).select("run_id", "kind", "name", "value")
