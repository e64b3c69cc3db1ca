"""Readers, messages, and streaming jobs, including restarts."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from linewatch.catalog.models import sent_messages, sent_rows, small_bundle
from linewatch.operators.drift import changes_of, detect_drift, detect_with_states, drift_per_message, moving_statistics
from linewatch.operators.metrics import drifted_features, service_counters
from linewatch.plans.features import serving_features
from linewatch.schema import raw_schema
from linewatch.session import run_dir, together
from linewatch.catalog.sources import log_files, stored
from linewatch.streaming import score as score_module
from linewatch.sources.log import TASK_ROWS, LogReader, write_message_log
from linewatch.sources.messages import dead_letters, decode, good, kafka_options, message_source, to_messages
from linewatch.sources.tables import read_first_available, read_table, with_row_id
from linewatch.streaming.counters import current_counters, live_counters
from linewatch.streaming.drift import drift_stream, latest_states
from linewatch.streaming.replay import pace, replay, write_replay
from linewatch.streaming.score import score, score_stream


def test_messages_keep_nulls_and_drop_the_label(spark):
    df = spark.createDataFrame([(1, "M", None, float("nan"), "x")], "row_id int, Machine_ID string, a string, b double, Downtime string")
    row = to_messages(df).first()
    assert row.key == "M" and json.loads(row.value) == {"row_id": 1, "Machine_ID": "M", "a": None, "b": None}


def test_decode(spark):
    lines = [
        '{"Machine_ID": "M", "Assembly_Line_No": "L", "a": 1.5, "b": NaN}',
        '{"Machine_ID": "M", "Assembly_Line_No": "L", "a": "text", "other": 1}',
        '{"Machine_ID": "M"}',
        "{broken",
        "",
        "null",
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    out = decode(df, ["a", "b"])
    rows = good(out).collect()
    assert [(r.machine_id, r.data.a, r.extra) for r in rows] == [("M", "1.5", None), ("M", "text", {"other": "1"})]
    assert [r.value for r in dead_letters(out).collect()] == lines[2:]


def test_kafka_options_and_unknown_source(spark):
    options = kafka_options("host:9092", "t", "u", "p")
    assert options["startingOffsets"] == "earliest" and options["kafka.security.protocol"] == "SASL_SSL"
    with pytest.raises(ValueError):
        message_source(spark, {"kind": "smoke"})
    assert options["maxOffsetsPerTrigger"] == "100000"
    del options["maxOffsetsPerTrigger"]
    with pytest.raises(ValueError):
        message_source(spark, {"kind": "kafka", **options})
    assert pace() == {"processingTime": "30 seconds"}


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_row_ids_follow_the_files(spark, fmt):
    """Dense, in file order, over files of several splits."""
    path = run_dir(spark, "unnumbered")
    rows = spark.range(30_000).select(F.col("id").cast("string").alias("Date"))
    rows.repartitionByRange(3, F.col("Date").cast("bigint")).sortWithinPartitions(F.col("Date").cast("bigint")).write.option("header", True).format(fmt).save(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        schema = "Date string"
        df = spark.read.schema(schema).option("header", True).format(fmt).load(path)
        numbered = with_row_id(df, fmt).toPandas()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert (numbered["row_id"] == numbered["Date"].astype(int)).all()
    assert sorted(numbered["row_id"]) == list(range(30_000))


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_row_ids_move_no_rows(spark, fmt):
    """Even where joins are not broadcast by size: a file's rows would meet in one task."""
    path = run_dir(spark, "unmoved")
    spark.range(1000).select(F.col("id").cast("string").alias("Date")).coalesce(1).write.option("header", True).format(fmt).save(path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.read.schema("Date string").option("header", True).format(fmt).load(path)
        numbered = with_row_id(df, fmt)
        plan = numbered._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.row_id for r in numbered.collect()) == list(range(1000))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_csv_with_nameless_first_column(spark, tmp_path):
    (tmp_path / "s.csv").write_text(",Date,Timestamp,Machine_ID,Assembly_Line_No,Downtime\n0,1/5/2024,1:2:3,M,L,\n")
    row = read_table(spark, "file:" + str(tmp_path / "s.csv"), "csv", raw_schema([])).first()
    assert row.row_id == 0 and row.Date == "1/5/2024" and row.Downtime is None


def test_no_source_available(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_first_available(["file:" + str(tmp_path / "x")], lambda p: read_table(spark, p))


def test_replay_is_one_write_in_order(spark):
    path = run_dir(spark, "replayed")
    write_replay(spark.range(0).selectExpr("id as row_id"), path)
    write_replay(spark.range(5, 1005, numPartitions=7).selectExpr("id as row_id"), path, rows_per_file=100)
    write_replay(spark.range(1005, 1105).selectExpr("id as row_id"), path, rows_per_file=100)
    seen = []

    def write(batch, batch_id):
        seen.append([json.loads(r.value)["row_id"] for r in batch.collect()])

    stream = message_source(spark, {"kind": "files", "path": path, "files_per_trigger": 1})
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", run_dir(spark, "c")).trigger(availableNow=True).start()
    assert query.awaitTermination(120)
    assert seen == [list(range(s, s + 100)) for s in range(5, 1105, 100)]


def test_log_of_a_file_source_stays_short(spark):
    source, checkpoint, kept = run_dir(spark, "in"), run_dir(spark, "c"), "spark.sql.streaming.minBatchesToRetain"
    write_replay(spark.range(60).selectExpr("id as row_id"), source, rows_per_file=1)
    seen = []
    spark.conf.set(kept, "2")
    try:
        for _ in range(2):
            stream = message_source(spark, {"kind": "files", "path": source, "files_per_trigger": 1})
            query = stream.writeStream.foreachBatch(lambda b, i: seen.append((i, json.loads(b.first().value)["row_id"])))
            assert query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination(120)
            # What has been read stays known to a restart.
            write_replay(spark.range(60, 62).selectExpr("id as row_id"), source, rows_per_file=1)
    finally:
        spark.conf.unset(kept)
    assert seen == [(i, i) for i in range(62)]
    log = [p for p in (Path(checkpoint.removeprefix("file:")) / "sources" / "0").iterdir() if not p.name.startswith(".")]
    assert len(log) < 45


def test_a_stored_batch_is_its_rows_and_no_marker(spark):
    """One folder and one file for each short micro-batch; what is read back are all rows with their batch."""
    source = run_dir(spark, "in")
    write_replay(spark.range(50).selectExpr("id as row_id"), source, rows_per_file=10)
    kept = Path(source.removeprefix("file:")).parent
    back = stored(replay(spark, source), "markless")
    (path,) = kept.glob("markless-*/batch=0/..")
    assert sorted(p.name for p in path.iterdir()) == [f"batch={i}" for i in range(5)]
    assert not list(path.glob("*/_*")) and len(list(path.glob("*/part-*"))) == 5
    rows = back.select(F.get_json_object("value", "$.row_id").cast("int").alias("row_id"), "batch").collect()
    assert sorted((r.row_id, r.batch) for r in rows) == [(i, i // 10) for i in range(50)]


def test_a_message_is_parsed_and_its_numbers_are_read_once(spark):
    lines = ['{"Machine_ID": "M", "Assembly_Line_No": "L", "a": "1.5", "b": "inf", "x": 1}', '{"Machine_ID": "M", "Assembly_Line_No": "L", "a": "NaN"}']
    decoded = decode(spark.createDataFrame([(v,) for v in lines], "value string"), ["a", "b"])
    flat = decoded.select("data.a", "data.b", "extra")
    made = serving_features(flat, ["a", "b"], {}, ["a", "a_lag1", "a_mean5", "a_std5", "b", "b_lag1", "b_mean5"], ["extra"])
    assert made.collect() == [({"x": "1"}, 1.5, 1.5, 1.5, 0.0, 0.0, 0.0, 0.0), (None, *[0.0] * 7)]
    parsed = flat._jdf.queryExecution().optimizedPlan().toString()
    assert parsed.count("from_json(MapType") == 1
    numbers = serving_features(spark.createDataFrame([("1", "2")], "a string, b string"), ["a", "b"], {}, ["a", "a_lag1", "a_mean5", "b"])
    assert numbers._jdf.queryExecution().analyzed().toString().count("RLIKE") == 2


def test_drift_stream_with_restart(spark):
    df = spark.range(600).selectExpr("id as row_id", "id % 2 as m", "case when id < 300 then 0D else 40D end + id % 10 as x")
    source, path, checkpoint = (run_dir(spark, n) for n in ("in", "out", "check"))

    def go():
        lines = message_source(spark, {"kind": "files", "path": source, "files_per_trigger": 1})
        parsed = lines.select(F.from_json("value", "row_id bigint, m bigint, x double").alias("m")).select("m.*")
        assert drift_stream(parsed, ["x"], path, checkpoint, by=["m"], every=10).awaitTermination(240)

    write_replay(df.where("row_id < 250"), source, rows_per_file=125)
    go()
    write_replay(df.where("row_id >= 250"), source, rows_per_file=125)
    go()
    got = spark.read.parquet(f"{path}/changes").select("m", "feature", "seq")
    want = detect_drift(df, ["x"], by=["m"]).select("m", "feature", "seq")
    assert got.exceptAll(want).count() == 0 and got.count() == want.count() > 0
    last = spark.read.parquet(f"{path}/stats").where("batch_id = 4").first()
    assert last["count"] == 60 and last.seen == 600


def test_state_of_a_drift_stream_has_no_more_parts_than_cores(spark):
    """Each part is a task of every micro-batch, whatever a batch job's shuffles have."""
    df = spark.range(200).selectExpr("id as row_id", "id % 2 as m", "if(id < 100, 0D, 40D) as x")
    source, name = run_dir(spark, "in"), "spark.sql.shuffle.partitions"
    write_replay(df, source, rows_per_file=100)
    before = spark.conf.get(name)
    found = []
    for shuffled, given in (("21", None), ("3", None), ("21", 5)):
        path, checkpoint = run_dir(spark, "out"), run_dir(spark, "check")
        lines = message_source(spark, {"kind": "files", "path": source, "files_per_trigger": 1})
        parsed = lines.select(F.from_json("value", "row_id bigint, m bigint, x double").alias("m")).select("m.*")
        spark.conf.set(name, shuffled)
        try:
            query = drift_stream(parsed, ["x"], path, checkpoint, by=["m"], every=10, partitions=given)
            assert spark.conf.get(name) == shuffled
        finally:
            spark.conf.set(name, before)
        assert query.awaitTermination(240)
        found.append(len([p for p in (Path(checkpoint.removeprefix("file:")) / "state" / "0").iterdir() if p.name.isdigit()]))
        assert spark.read.parquet(f"{path}/changes").select("m", "feature").distinct().count() == 2
        assert spark.read.parquet(f"{path}/stats").where("batch_id = 1").first().seen == 200
    assert found == [spark.sparkContext.defaultParallelism, 3, 5]


def test_steps_side_by_side(spark):
    """All end before the first error is raised."""
    done = []
    assert together(spark, lambda: spark.range(3).count(), lambda: "b") == [3, "b"]
    with pytest.raises(ValueError, match="one"):
        together(spark, lambda: int("one"), lambda: done.append(spark.range(5).count()))
    assert done == [5]


def test_drift_stream_starts_warm_and_takes_new_features(spark):
    """A warmed detector goes on; a feature that joins at a restart starts anew, as do groups that turn up; what is left starts a stored table."""
    from linewatch.operators.drift import states_of

    df = spark.range(900).selectExpr(
        "id as row_id", "if(id < 600, id % 2, id % 3) as m", "case when id < 500 then 0D else 40D end + id % 10 as x",
        "case when id % 5 = 0 then double('NaN') when id < 700 then 1D else 9D end as late",
    )
    kind = "row_id bigint, m bigint, x double, late double"
    source, path, checkpoint = (run_dir(spark, n) for n in ("in", "out", "check"))
    warm = states_of(detect_with_states(df.where("row_id < 210"), ["x"], by=["m"]))

    def go(features):
        lines = message_source(spark, {"kind": "files", "path": source, "files_per_trigger": 1})
        parsed = lines.select(F.from_json("value", kind).alias("m")).select("m.*")
        query = drift_stream(parsed, features, path, checkpoint, by=["m"], every=7, warm=warm, stats={"x": {"mean": 3.0, "std": 2.0, "count": 5}})
        assert query.awaitTermination(240)

    write_replay(df.where("row_id >= 210 and row_id < 400"), source, rows_per_file=95)
    go(["x"])
    write_replay(df.where("row_id >= 400"), source, rows_per_file=125)
    go(["x", "late"])
    want = changes_of(detect_with_states(df, ["x"], by=["m"]), ["m"]).where("seq >= 210")
    want = want.unionByName(changes_of(detect_with_states(df.where("row_id >= 400"), ["late"], by=["m"]), ["m"]))
    got = spark.read.parquet(f"{path}/changes").select("m", "feature", "seq")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select("m", "feature", "seq").collect()))
    assert {r.feature for r in got.collect()} == {"x", "late"}
    left = latest_states(spark, path)
    assert left.count() == 6
    plain = states_of(detect_with_states(df, ["x"], by=["m"])).select("group.m", "state")
    assert sorted(map(tuple, left.where("feature = 'x'").select("group.m", "state").collect())) == sorted(map(tuple, plain.collect()))
    start = {"x": dict(mean=3.0, std=2.0, min=0.0, max=1.0, count=5)}
    dense = df.where("row_id >= 210").withColumn("row_id", F.col("row_id") - 210)
    moved = moving_statistics(dense, ["x"], every=7, start=start).first()
    last = spark.read.parquet(f"{path}/stats").where("feature = 'x'").orderBy(F.desc("batch_id")).first()
    assert (last.seen, last["count"]) == (690, moved["count"]) and last["mean"] == pytest.approx(moved["mean"]) and last["std"] == pytest.approx(moved["std"])


def test_score_stream_survives_odd_messages_and_a_restart(spark, sf):
    """Messages without a counter or a machine, broken ones, and unknown fields, over three batches."""
    bundle = small_bundle(spark, sf)
    rows = sent_rows(spark, sf).where("`Unnamed: 0` < 300")
    source, results, checkpoint = (run_dir(spark, n) for n in ("in", "results", "check"))
    clock = F.to_timestamp(F.lit("2024-01-01 10:20:30"))

    def go(check=checkpoint):
        stream = message_source(spark, {"kind": "files", "path": source, "files_per_trigger": 1})
        query = score_stream(stream, bundle, results, check, clock)
        assert query.awaitTermination(400)
        return [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]

    write_replay(rows.where("`Unnamed: 0` < 150"), source, 150, "Unnamed: 0")
    assert go() == [150]
    odd = [
        "{broken",
        json.dumps({"Machine_ID": "M1", "Assembly_Line_No": "L1", "Voltage(volts)": 3, "odd": {"a": [1]}}),
        json.dumps({"Machine_ID": "M1", "Assembly_Line_No": "L1", "row_id": "text"}),
    ]
    spark.createDataFrame([(x,) for x in odd], "value string").coalesce(1).write.mode("append").text(source)
    assert go() == [3]
    write_replay(rows.where("`Unnamed: 0` >= 150"), source, 150, "Unnamed: 0")
    assert go() == [150]

    refused = rows.where("Machine_ID is null").count()
    scored = spark.read.parquet(f"{results}/scored")
    n = 300 - refused + 2
    assert sorted(r.seq for r in scored.select("seq").collect()) == list(range(n))
    assert spark.read.text(f"{results}/dead").count() == refused + 1
    stored = score(to_messages(rows).select("value"), bundle, clock).select("data.Unnamed: 0", "predicted_downtime", "confidence")
    got = scored.where(F.col("data.`Unnamed: 0`").isNotNull()).select("data.Unnamed: 0", "predicted_downtime", "confidence")
    assert got.exceptAll(stored).count() == 0 and got.count() == stored.count() == n - 2
    assert spark.read.parquet(f"{results}/predictions").count() == n
    log = spark.read.option("header", True).option("escape", '"').csv(f"{results}/log")
    assert log.count() == n and [tuple(r) for r in log.select("Date", "Timestamp").distinct().collect()] == [("2024-01-01", "10:20:30")]
    extras = [json.loads(r.Extra) for r in log.where("`Unnamed: 0` is null").select("Extra").collect() if r.Extra]
    assert extras == [{"odd": '{"a":[1]}'}]
    assert log.where("Extra like '%Shift%'").count() == n - 2

    # Drift and statistics are those of one pass over all good messages in order.
    values = [F.col("features")[i].alias(f) for i, f in enumerate(bundle.features)]
    scaled = scored.select("seq", *values)
    whole = changes_of(detect_with_states(scaled, bundle.features, "seq")).select("feature", "seq")
    assert spark.read.parquet(f"{results}/drift").select("feature", "seq").exceptAll(whole).count() == 0
    assert spark.read.parquet(f"{results}/drift").count() == whole.count()
    want = moving_statistics(scaled, bundle.features, "seq", start=bundle.reference_stats).toPandas()
    left = spark.read.parquet(f"{results}/stats/batch_id=2").toPandas()
    both = want.merge(left, on="feature", suffixes=("", "_stream"))
    assert len(both) == len(bundle.features) and (both["seen"] == n).all()
    assert (both["count"] == both["count_stream"]).all()
    for column in ("mean", "std", "min", "max"):
        assert both[column].to_numpy() == pytest.approx(both[f"{column}_stream"].to_numpy(), rel=1e-9, abs=1e-9)
    gauges = spark.read.parquet(f"{results}/gauges").where("metric = 'predictions_total'").agg(F.sum("value")).first()[0]
    assert gauges == n

    # The counters that follow the stream, over a restart, and over a batch that is written again.
    out, counted = run_dir(spark, "live"), run_dir(spark, "live-checkpoint")
    assert live_counters(spark, results, out, counted).awaitTermination(240)
    again = spark.read.parquet(f"{results}/gauges/batch_id=1").collect()
    spark.createDataFrame(again).write.mode("overwrite").parquet(f"{results}/gauges/batch_id=1")
    assert live_counters(spark, results, out, counted).awaitTermination(240)
    flagged = scored.join(drift_per_message(spark.read.parquet(f"{results}/drift")), "seq", "left")
    whole = {r.metric: r.value for r in service_counters(flagged).unionByName(drifted_features(flagged)).collect()}
    live = {r.metric: r.value for r in current_counters(spark, out).collect()}
    last = {r.metric: r.value for r in spark.read.parquet(f"{results}/gauges/batch_id=2").collect()}
    assert set(live) == set(whole)
    for name, value in live.items():
        assert value == pytest.approx(last[name] if name == "drifted_features_count" else whole[name])
    with pytest.raises(ValueError):
        go(run_dir(spark, "another"))


def test_a_batch_of_the_scoring_stream_is_numbered_once(spark, sf, monkeypatch):
    """The projection is put together once for all batches, and only the results are stored: numbers of rows are not made again for the detectors."""
    bundle = small_bundle(spark, sf)
    source, results = run_dir(spark, "in"), run_dir(spark, "results")
    write_replay(sent_rows(spark, sf).where("`Unnamed: 0` < 300"), source, 150, "Unnamed: 0")
    calls, plain = [], score_module.decode
    monkeypatch.setattr(score_module, "decode", lambda *given: calls.append(1) or plain(*given))
    kept = Path(results.removeprefix("file:")).parent
    before = {p.name for p in kept.iterdir()}
    stream = message_source(spark, {"kind": "files", "path": source, "files_per_trigger": 1})
    assert score_stream(stream, bundle, results, run_dir(spark, "check")).awaitTermination(400)
    assert len(calls) == 1
    assert not [p.name for p in kept.iterdir() if p.name not in before and p.name.startswith(("sorted", "placed"))]
    scored = spark.read.parquet(f"{results}/scored")
    rows = scored.orderBy("seq").select("batch_id", "seq", F.col("data.`Unnamed: 0`").cast("bigint").alias("sent")).collect()
    assert [r.seq for r in rows] == list(range(len(rows))) and [r.sent for r in rows] == sorted(r.sent for r in rows)
    assert {r.batch_id for r in rows} == {0, 1}
    kinds = {"arrived", "scored", "detected", "states", "drift", "stats", "gauges", "predictions", "log", "dead"}
    assert kinds <= {p.name for p in Path(results.removeprefix("file:")).iterdir()}


def test_message_log_is_read_by_offsets(spark):
    """What the clock has published, then the rest; empty partitions; rows without a key; a log that has not begun."""
    df = spark.range(500).selectExpr("id * 3 as row_id", "if(id % 7 = 0, null, concat('M', id % 5)) as Machine_ID", "cast(id as double) as a", "'x' as Downtime")
    path, out, checkpoint = (run_dir(spark, n) for n in ("log", "out", "check"))
    write_message_log(df, path, partitions=6, interval_ms=10, start_ms=1_000, rows_per_file=16)

    def go(now, log=path, to=out, check=checkpoint):
        stream = message_source(spark, {"kind": "log", "path": log, "now_ms": str(now)})
        query = stream.writeStream.format("parquet").option("checkpointLocation", check).trigger(availableNow=True).start(to)
        assert query.awaitTermination(120)
        return spark.read.schema("value string, sent_at timestamp, partition int, offset bigint").parquet(to)

    assert go(999).count() == 0
    assert go(1_000 + 370).groupBy("partition").agg(F.max("offset").alias("m")).where("m > 37").count() == 0
    rows = [(r.partition, r.offset, json.loads(r.value), r.sent_at) for r in go(10**9).collect()]
    assert sorted(r[2]["row_id"] for r in rows) == list(range(0, 1500, 3)) and "Downtime" not in rows[0][2]
    by_partition = {}
    for p, offset, message, sent in sorted(rows, key=lambda r: r[:2]):
        by_partition.setdefault(p, []).append((offset, message))
        assert sent.timestamp() * 1000 == pytest.approx(1_000 + 10 * offset)
    for held in by_partition.values():
        assert [o for o, _ in held] == list(range(len(held)))
        assert [m["row_id"] for _, m in held] == sorted(m["row_id"] for _, m in held)
    keys = [{m["Machine_ID"] for _, m in held} for held in by_partition.values()]
    assert sum(map(len, keys)) == 6 and len(keys) < 6  # a key has one partition
    empty = run_dir(spark, "empty")
    write_message_log(df.limit(0), empty, partitions=2)
    assert go(10**9, empty, run_dir(spark, "out"), run_dir(spark, "check")).count() == 0


def test_score_stream_over_a_log(spark, sf):
    """An ordered source: messages are numbered by time, partition and offset, over two runs."""
    bundle = small_bundle(spark, sf)
    rows = sent_rows(spark, sf).where("`Unnamed: 0` < 240")
    path, results, checkpoint = (run_dir(spark, n) for n in ("log", "results", "check"))
    write_message_log(rows, path, "Unnamed: 0", partitions=2, interval_ms=1000, rows_per_file=25)
    clock = F.to_timestamp(F.lit("2024-01-01 10:20:30"))
    for now in (50_000, 10**9):
        stream = message_source(spark, {"kind": "log", "path": path, "now_ms": str(now)})
        assert score_stream(stream, bundle, results, checkpoint, clock).awaitTermination(400)
    refused = rows.where("Machine_ID is null").count()
    scored = spark.read.parquet(f"{results}/scored")
    stored = spark.read.parquet(f"{path}/rows").selectExpr("sent_at", "partition", "offset", "cast(get_json_object(value, '$[\\'Unnamed: 0\\']') as bigint) as sent", "key")
    first = [r.sent for r in stored.where("offset <= 50 and key is not null").orderBy("sent_at", "partition", "offset").collect()]
    later = [r.sent for r in stored.where("offset > 50 and key is not null").orderBy("sent_at", "partition", "offset").collect()]
    got = [int(r.sent) for r in scored.orderBy("seq").select(F.col("data.`Unnamed: 0`").alias("sent")).collect()]
    assert got == first + later and len(got) == 240 - refused and later
    assert [r.seq for r in scored.select("seq").orderBy("seq").collect()] == list(range(len(got)))
    plain = score(to_messages(rows).select("value"), bundle, clock).select("data.Unnamed: 0", "predicted_downtime", "confidence")
    assert scored.select("data.Unnamed: 0", "predicted_downtime", "confidence").exceptAll(plain).count() == 0


def test_score_stream_with_history(spark, sf):
    """Features over a machine's last readings do not depend on where the batches are cut."""
    bundle = small_bundle(spark, sf)
    rows = sent_rows(spark, sf).where("`Unnamed: 0` < 120")
    found = []
    for per_file in (40, 120):
        source, results = run_dir(spark, "in"), run_dir(spark, "results")
        write_replay(rows, source, per_file, "Unnamed: 0")
        stream = message_source(spark, {"kind": "files", "path": source, "files_per_trigger": 1})
        assert score_stream(stream, bundle, results, run_dir(spark, "check"), history="state").awaitTermination(400)
        scored = spark.read.parquet(f"{results}/scored").orderBy("seq").collect()
        found.append([(r.seq, [round(x, 9) for x in r.features], r.predicted_downtime) for r in scored])
    assert found[0] == found[1]
    at = bundle.features.index("Torque(Nm)_std5")
    assert len({f[1][at] for f in found[0]}) > 10
    with pytest.raises(ValueError):
        score_stream(stream, bundle, results, "x", history="some")


def test_a_task_reads_many_files_of_a_log(spark):
    """A task costs more than a small file: stretches of files, cut where the run before ended, and every row once."""
    path = run_dir(spark, "many")
    df = spark.range(2_000).selectExpr("id as row_id", "concat('M', id % 5) as Machine_ID")
    write_message_log(df, path, partitions=2, interval_ms=10, rows_per_file=16)
    reader = LogReader({"path": path, "now_ms": str(10**9)})
    start, end = {"0": 37, "1": 0}, reader.latestOffset()
    assert sum(end.values()) == 2_000
    parts = reader.partitions(start, end)
    assert len(parts) == 2
    read = [(r["partition"], r["offset"]) for p in parts for b in reader.read(p) for r in b.to_pylist()]
    assert read == [(p, o) for p in (0, 1) for o in range(start[str(p)], end[str(p)])]
    reader.shape["counts"] = {"0": 10 * TASK_ROWS}
    parts = reader.partitions({"0": 37}, {"0": 10 * TASK_ROWS})
    assert len(parts) <= 12 and all(p.high - p.low <= TASK_ROWS for p in parts)
    assert [p.low for p in parts] == [37, *[p.high for p in parts[:-1]]] and parts[-1].high == 10 * TASK_ROWS


def test_log_files_are_read_once(spark, sf):
    """Each holds 100 rows: a second pass for the counts would open all of them again."""
    plan = log_files(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("FileScan csv") == 1


def test_messages_of_a_table_are_dealt_out_by_number(spark, sf, monkeypatch):
    """Short messages would fill a task by the million if it went by bytes."""
    monkeypatch.setattr(score_module, "TASK_MESSAGES", 100)
    scored = score_module.score(sent_messages(spark, sf), small_bundle(spark, sf))
    plan = scored._jdf.queryExecution().executedPlan().toString()
    good = sent_messages(spark, sf).where("value like '%\"Machine_ID\":\"M%'").count()
    assert "RoundRobinPartitioning(11)" in plan and scored.count() == good
