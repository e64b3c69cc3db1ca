"""Queries of resampling, learning, scoring and the streaming jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linewatch.catalog.base import (
    GROUP_SQL,
    MACHINES,
    NUMBERS_SQL,
    ORACLES,
    RAW_SQL,
    SENSORS,
    hash_sql,
    machine_events,
    numbers,
    query,
    r6,
    table,
)
from linewatch.catalog.sources import stored
from linewatch.catalog.statistics import scored as scored_events
from linewatch.config import Settings
from linewatch.functions.labels import best_class, class_probabilities, confidence, downtime_group
from linewatch.functions.numbers import stable_hash
from linewatch.operators.anomaly import AnomalyModel
from linewatch.operators.board import latest_predictions
from linewatch.operators.drift import DEFAULT_STATS
from linewatch.operators.encode import Scaler
from linewatch.operators.neighbours import nearest_neighbours
from linewatch.operators.ordering import dense_index
from linewatch.operators.resample import smote
from linewatch.operators.score import prediction_record, scored_log
from linewatch.operators.stats import reference_statistics
from linewatch.operators.softmax_trees import softmax_trees
from linewatch.operators.train import assemble, boosted_trees, grid_search, predict
from linewatch.plans.features import feature_table
from linewatch.schema import TARGET, quoted
from linewatch.session import materialise, run_dir
from linewatch.sources.bundle import Bundle, bundle_profile, load_bundle, save_bundle
from linewatch.sources.messages import message_source, to_messages
from linewatch.streaming.counters import current_counters, live_counters as follow_counters
from linewatch.streaming.drift import drift_stream
from linewatch.streaming.replay import write_replay
from linewatch.streaming.score import counter_stream, score, score_stream

NEAREST_SQL = """idx as (select event_type as label, row_number() over (partition by event_type order by row_id) - 1 as id, s1, s2 from numbers),
  pairs as (select a.label, a.id, b.id as neighbour, (a.s1 - b.s1) * (a.s1 - b.s1) + (a.s2 - b.s2) * (a.s2 - b.s2) as d2
    from idx a join idx b on a.label = b.label and a.id <> b.id),
  ranked as (select *, row_number() over (partition by label, id order by d2, neighbour) as rank from pairs),
  near as (select * from ranked where rank <= 5)"""


@query(
    "nearest_neighbours_o74",
    f"with {NUMBERS_SQL}, {NEAREST_SQL} select label, id, rank::int as rank, round(sqrt(d2), 6) as distance from near",
)
def neighbours(spark: SparkSession, sf: str) -> DataFrame:
    """Distances to the five nearest rows of the same class, for every row."""
    df = numbers(spark, sf).withColumnRenamed("event_type", "label")
    members = dense_index(df, by=["label"], out="id").select("label", "id", "s1", "s2")
    found = nearest_neighbours(members, ["s1", "s2"], 5)
    return found.select("label", "id", "rank", r6(F.sqrt("d2")).alias("distance"))


_BASE = hash_sql(42, "z.event_type", "'base'", "j")
_RANK = hash_sql(42, "z.event_type", "'rank'", "j")
_PLACE = hash_sql(42, "z.event_type", "'place'", "j")


@query(
    "smote_o74",
    f"""with {NUMBERS_SQL}, {NEAREST_SQL},
      sizes as (select event_type, count(*) as n from numbers group by event_type),
      z as (select event_type, n, (select max(n) from sizes) as most from sizes),
      draws as (select z.event_type as label, {_BASE} % n as base, {_RANK} % 5 + 1 as rank,
          ({_PLACE} >> 8)::double / 4503599627370496.0 as place
        from z, unnest(range(most - n)) as t(j)),
      made as (select d.label, b.s1 + place * (o.s1 - b.s1) as s1, b.s2 + place * (o.s2 - b.s2) as s2 from draws d
        join near r on r.label = d.label and r.id = d.base and r.rank = d.rank
        join idx b on b.label = d.label and b.id = d.base
        join idx o on o.label = d.label and o.id = r.neighbour)
      select event_type as label, round(s1, 6) + 0.0 as s1, round(s2, 6) + 0.0 as s2, false as synthetic from numbers
      union all select label, round(s1, 6) + 0.0, round(s2, 6) + 0.0, true from made""",
)
def oversample(spark: SparkSession, sf: str) -> DataFrame:
    grown = smote(numbers(spark, sf), ["s1", "s2"], "event_type", exact=True)
    return grown.select(
        F.col("event_type").alias("label"), r6("s1").alias("s1"), r6("s2").alias("s2"), "synthetic"
    )


EMBEDDING = [f"e{i}" for i in range(64)]


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        "vec_id", "label", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(EMBEDDING)]
    )


_WIDE = {name: hash_sql(42, "label", f"'{name}'", "j") for name in ("base", "rank", "place")}


@query(
    "smote_wide_o74",
    f"""with v as (select label::varchar as label, row_number() over (partition by label order by vec_id) - 1 as id, embedding::double[] as x from embeddings),
      n as (select label, count(*) as n, least(5, greatest(1, (select min(c) from (select count(*) as c from v group by label)) - 1)) as k from v group by label),
      draws as (select label, j as draw, {_WIDE["base"]} % n as base, {_WIDE["rank"]} % k + 1 as rank, ({_WIDE["place"]} >> 8)::double / 4503599627370496.0 as place
        from (select n.*, unnest(range((select max(n) from n) - n)) as j from n)),
      wanted as (select distinct label, base from draws),
      pairs as (select a.label, a.id, b.id as neighbour, list_sum(list_transform(list_zip(a.x, b.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) as d2
        from v a join wanted w on w.label = a.label and w.base = a.id join v b on a.label = b.label and a.id <> b.id),
      near as (select *, row_number() over (partition by label, id order by d2, neighbour) as rank from pairs),
      made as (select d.label, d.draw, list_transform(list_zip(b.x, o.x), lambda p: p[1] + place * (p[2] - p[1])) as x from draws d
        join near r on r.label = d.label and r.id = d.base and r.rank = d.rank
        join v b on b.label = d.label and b.id = d.base join v o on o.label = d.label and o.id = r.neighbour)
      select label, draw, round(x[1], 6) + 0.0 as first, round(x[64], 6) + 0.0 as last, round(list_sum(x), 6) + 0.0 as total from made""",
)
def oversample_wide(spark: SparkSession, sf: str) -> DataFrame:
    """The synthetic rows between vectors of 64 features, one by one."""
    grown = smote(vectors(spark, sf), EMBEDDING, "label", "vec_id").where("synthetic")
    total = sum((F.col(e) for e in EMBEDDING[1:]), F.col(EMBEDDING[0]))
    return grown.select(
        F.col("label").cast("string").alias("label"), "draw", r6(EMBEDDING[0]).alias("first"), r6(EMBEDDING[-1]).alias("last"), r6(total).alias("total")
    )


BASE_SQL = "case when user_id % 3 = 0 then 0 when event_id % 7 < 3 then 1 else 2 end"
# One label in eleven is another one.
LABEL_SQL = f"(({BASE_SQL}) + case when {hash_sql(7, 'event_id')} % 11 = 0 then 1 else 0 end) % 3"
DEFAULT_GRID = Settings()


def learning_table(spark: SparkSession, sf: str) -> tuple[DataFrame, list[str]]:
    """Whole-number features of few values, so that the bins are exact, and a label that mostly is a function of two of them."""
    noise = (stable_hash(F.col("event_id"), seed=7) % 11 == 0).cast("int")
    df = table(spark, sf, "events").select(
        F.col("event_id").alias("row_id"),
        (F.col("user_id") % 3).cast("double").alias("line"),
        (F.col("event_id") % 7).cast("double").alias("day"),
        (F.col("event_id") % 2).cast("double").alias("noise"),
        ((F.expr(BASE_SQL) + noise) % 3).cast("int").alias("label"),
    )
    return df, ["line", "day", "noise"]


@query(
    "classifier_o76",
    f"""with t as (select event_id as row_id, user_id % 3 as line, event_id % 7 as day, event_id % 2 as odd, ({LABEL_SQL})::int as label from events),
      n as (select line, day, odd, label, count(*) as n from t group by all),
      most as (select line, day, odd, arg_max(label, n) as prediction from n group by line, day, odd)
      select row_id, label, prediction from t join most using (line, day, odd)""",
)
def classifier(spark: SparkSession, sf: str) -> DataFrame:
    """One model of all classes: where the features are equal, it predicts the most frequent class."""
    df, names = learning_table(spark, sf)
    learn = materialise(spark, df, "learn")
    model = softmax_trees(learn, names, "label", 3, rounds=40)
    return predict(model, assemble(learn, names, ["row_id", "label"])).select("row_id", "label", F.col("prediction").cast("int").alias("prediction"))


# Recall of the most frequent class of the other folds where the features are equal.
FOLDS_SQL = f"""t as (select event_id, user_id % 3 as line, event_id % 7 as day, event_id % 2 as odd, ({LABEL_SQL})::int as label from events),
  f as (select *, (row_number() over (partition by label order by {hash_sql(42, 'event_id')}, event_id) - 1) % 3 as fold from t),
  n as (select held, line, day, odd, label, count(*) as n from f, range(3) h(held) where fold <> held group by all),
  most as (select held, line, day, odd, arg_max(label, n) as prediction from n group by held, line, day, odd),
  recalls as (select fold, f.label, avg((f.label = prediction)::int) as recall
    from f join most m on m.held = f.fold and m.line = f.line and m.day = f.day and m.odd = f.odd group by fold, f.label),
  scores as (select fold, avg(recall) as score from recalls group by fold),
  cv as (select round(avg(score), 6) as cv_mean, round(stddev_pop(score), 6) as cv_std from scores)"""


@query(
    "grid_search_o77",
    f"""with {FOLDS_SQL} select trees, depth, 0.1::double as rate, cv_mean, cv_std, trees = 200 and depth = 6 as best
      from (values (200), (400)) t(trees), (values (6), (10)) d(depth), cv""",
)
def search(spark: SparkSession, sf: str) -> DataFrame:
    """Every candidate of the default grid with its scores over the folds. All learn the most frequent classes, so the first is the best."""
    df, names = learning_table(spark, sf)
    result = grid_search(materialise(spark, df, "learn"), names, "label", "row_id", DEFAULT_GRID)
    rows = [
        (c["n_estimators"], c["max_depth"], c["learning_rate"], round(c["cv_mean"], 6), round(c["cv_std"], 6),
         all(c[k] == v for k, v in result.best.items()))
        for c in result.candidates
    ]
    return spark.createDataFrame(rows, "trees int, depth int, rate double, cv_mean double, cv_std double, best boolean")


@query("cross_validation_o78", f"with {FOLDS_SQL} select (select count(*) from events) as rows, cv_mean, cv_std from cv")
def cross_validation(spark: SparkSession, sf: str) -> DataFrame:
    """The candidate that the default grid ends in on the recorded run: 400 trees of depth 10."""
    df, names = learning_table(spark, sf)
    one = Settings(trees=(400,), depths=(10,))
    learn = materialise(spark, df, "learn")
    result = grid_search(learn, names, "label", "row_id", one)
    row = (learn.count(), round(result.cv_mean, 6), round(result.cv_std, 6))
    return spark.createDataFrame([row], "rows bigint, cv_mean double, cv_std double")


PROBABILITY_SQL = """p as (select row_id, s1 + 1 as a, s2 + 1 as b, s1 + s2 + 1 as c, 20.0::double as d from numbers),
  q as (select row_id, [a / (a + b + c + d), b / (a + b + c + d), c / (a + b + c + d), d / (a + b + c + d)] as ps from p)"""


def probabilities(spark: SparkSession, sf: str) -> DataFrame:
    df = numbers(spark, sf).selectExpr("*", "array(s1 + 1, s2 + 1, s1 + s2 + 1, 20.0D) as w")
    total = F.aggregate("w", F.lit(0.0), lambda x, y: x + y)
    return df.withColumn("probabilities", F.transform("w", lambda x: x / total))


CLASSES = ["Infrastructure", "Machine_Issue", "Normal", "Operations"]


@query(
    "predict_o79",
    f"""with {NUMBERS_SQL}, {PROBABILITY_SQL} select row_id, list_position(ps, list_max(ps))::int - 1 as prediction,
      round(list_max(ps), 6) as confidence from q""",
)
def prediction(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("probabilities")
    return probabilities(spark, sf).select(
        "row_id", best_class(p).alias("prediction"), r6(confidence(p)).alias("confidence")
    )


@query(
    "prediction_record_o80",
    f"""with {NUMBERS_SQL}, {PROBABILITY_SQL}, n as (select event_id, user_id from events)
      select row_id as seq, user_id::varchar as machine_id, (user_id % 3)::varchar as assembly_line_no,
        case when row_id % 6 < 4 then ['Infrastructure', 'Machine_Issue', 'Normal', 'Operations'][row_id % 6 + 1]
          else concat('Unknown_Class_', row_id % 6) end as predicted_downtime,
        round(list_max(ps), 6) as confidence, 1704067200::bigint as at, round(ps[2], 6) as machine_issue, round(ps[4], 6) as class_3
      from q join n on n.event_id = q.row_id""",
)
def record(spark: SparkSession, sf: str) -> DataFrame:
    rows = probabilities(spark, sf).selectExpr(
        "row_id as seq", "user_id as machine_id", "user_id % 3 as assembly_line_no",
        "row_id % 6 as prediction", "probabilities",
    )
    made = prediction_record(rows, CLASSES, F.timestamp_seconds(F.lit(1704067200)))
    short = rows.select("seq", class_probabilities(F.col("probabilities"), CLASSES[:3], 4).alias("short"))
    return made.join(short, "seq").select(
        "seq",
        "machine_id",
        "assembly_line_no",
        "predicted_downtime",
        r6("confidence").alias("confidence"),
        F.unix_timestamp("timestamp").alias("at"),
        r6(F.col("probabilities")["Machine_Issue"]).alias("machine_issue"),
        r6(F.col("short")["Class_3"]).alias("class_3"),
    )


@query(
    "scored_log_o81",
    f"""with {RAW_SQL} select row_id, torque, '2024-01-01' as d, '10:20:30' as t, coalesce(machine, 'M') as machine, line,
      {GROUP_SQL} as downtime, row_id % 4 = 0 as is_anomaly, row_id % 5 = 0 as drift_detected from raw""",
)
def log(spark: SparkSession, sf: str) -> DataFrame:
    raw = machine_events(spark, sf).withColumns(
        {
            "machine_id": F.coalesce("Machine_ID", F.lit("M")),
            "predicted_downtime": downtime_group(F.col("Downtime")),
            "is_anomaly": F.when(F.col("row_id") % 4 == 0, True),
            "drift_detected": F.when(F.col("row_id") % 5 == 0, True),
        }
    )
    clock = F.to_timestamp(F.lit("2024-01-01 10:20:30"))
    out = scored_log(raw, ["row_id", SENSORS[0], "Date", "Timestamp"], clock)
    return out.toDF("row_id", "torque", "d", "t", "machine", "line", "downtime", "is_anomaly", "drift_detected")


_bundles: dict[tuple[str, str], str] = {}

TORQUE, VOLTAGE = SENSORS
NO_COUNTER = Settings(include_row_id_feature=False)


def learnable(spark: SparkSession, sf: str) -> DataFrame:
    """Raw rows whose class ten rows ahead is a function of the torque, and whose voltage steps."""
    events = table(spark, sf, "events").selectExpr("event_id", "user_id", "cast(get_json_object(props, '$.k') as int) % 5 as k")
    earlier = events.select((F.col("event_id") + 10).alias("event_id"), F.col("k").alias("before"))
    return events.join(earlier, "event_id", "left").selectExpr(
        "event_id as row_id",
        "'2024-01-01' as Date",
        "'10:20:30' as Timestamp",
        "concat('M', user_id % 6) as Machine_ID",
        "concat('L', user_id % 3) as Assembly_Line_No",
        f"cast(k as string) as `{TORQUE}`",
        f"cast(event_id div 160 % 2 * 10 as string) as `{VOLTAGE}`",
        "case when before < 2 then 'Machine_Failure' when before = 2 then 'Planned_Stop' else 'No_Machine_Failure' end as Downtime",
    )


def small_bundle(spark: SparkSession, sf: str) -> Bundle:
    """A bundle fitted on learnable events, kept in the shared folder for the
    queries that score with it. Its anomalies are extreme torques."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _bundles:
        path = run_dir(spark, "bundle")
        made = feature_table(learnable(spark, sf), SENSORS, MACHINES, NO_COUNTER)
        frame = materialise(spark, made.frame, "features")
        scaler = Scaler.fit(frame, made.features)
        scaled = materialise(spark, scaler.transform(frame), "scaled")
        data = assemble(scaled, made.features, [TARGET])
        weights = [[float(i == j and f == TORQUE) for j in range(len(made.features))] for i, f in enumerate(made.features)]
        fitted = Bundle(
            sensors=SENSORS,
            categories=made.categories,
            features=made.features,
            classes=made.classes,
            sensor_fit=made.sensor_fit,
            scaler=scaler,
            anomaly=AnomalyModel([0.0] * len(made.features), weights, 100.0),
            reference_stats={
                r["feature"]: {s: r[s] for s in DEFAULT_STATS}
                for r in reference_statistics(scaled, made.features).collect()
            },
            model=boosted_trees(TARGET, trees=2, depth=2).fit(data),
        )
        save_bundle(spark, fitted, path)
        _bundles[key] = path
    return load_bundle(spark, _bundles[key])


@query(
    "bundle_profile_o26",
    """with n as (select 12 + count(distinct user_id % 6) + count(distinct user_id % 3) as f from events)
      select 'classes' as name, 'Machine_Issue,Normal,Operations' as value union all select 'features', f::varchar from n
      union all select 'sensors', '2' union all select 'reference_statistics', f::varchar from n
      union all select 'detector_states', '0' union all select 'threshold', '100.0' union all select 'models', '3'""",
)
def bundle_contents(spark: SparkSession, sf: str) -> DataFrame:
    """A fitted bundle with a model, saved, loaded and listed."""
    return bundle_profile(spark, small_bundle(spark, sf))


def sent_rows(spark: SparkSession, sf: str) -> DataFrame:
    """What machines send: the counter under the sender's name, an extreme torque now and then, no machine now and then, a
    field that nobody asked for, and a voltage that steps along the good messages."""
    rows = table(spark, sf, "events").selectExpr(
        "event_id", "user_id", "cast(get_json_object(props, '$.k') as int) % 5 as k", "event_id % 29 >= 2 as good"
    )
    placed = dense_index(rows, "event_id", by=["good"], out="p")
    return placed.selectExpr(
        "event_id as `Unnamed: 0`",
        "'2024-01-01' as Date",
        "'10:20:30' as Timestamp",
        "case when good then concat('M', user_id % 6) end as Machine_ID",
        "concat('L', user_id % 3) as Assembly_Line_No",
        f"cast(case when event_id % 97 = 0 then 1000 else k end as string) as `{TORQUE}`",
        f"cast(p div 160 % 2 * 10 as string) as `{VOLTAGE}`",
        "concat('S', user_id) as Shift",
    )


def sent_messages(spark: SparkSession, sf: str) -> DataFrame:
    return to_messages(sent_rows(spark, sf)).select("value")


# Two rounds of boosting on a perfect split: 1, and a tenth of the loss's gradient there.
GOOD_SQL = """g as (select event_id, row_number() over (order by event_id) - 1 as p, user_id,
      json_extract_string(props, '$.k')::int % 5 as k from events where event_id % 29 >= 2),
  m as (select 1 / (1 + exp(-2 * (1 + 0.1 * 4 / (1 + exp(2))))) as hit),
  sent as (select event_id, p, concat('M', user_id % 6) as machine_id, concat('L', user_id % 3) as assembly_line_no, concat('S', user_id) as shift,
    case when event_id % 97 <> 0 and k < 2 then 'Machine_Issue' when event_id % 97 <> 0 and k = 2 then 'Operations' else 'Normal' end as predicted,
    round(hit / (hit + 2 * (1 - hit)), 4) as confidence, event_id % 97 = 0 as is_anomaly, p >= 160 and p % 160 = 31 as drift from g, m)"""


@query(
    "score_messages_o79",
    f"with {GOOD_SQL} select event_id as seq, machine_id, assembly_line_no, predicted, confidence, is_anomaly from sent",
)
def score_table(spark: SparkSession, sf: str) -> DataFrame:
    """The scoring projection on a stored table of messages. Messages without a
    machine are refused."""
    scored = score(sent_messages(spark, sf), small_bundle(spark, sf))
    return scored.select(
        "seq",
        "machine_id",
        "assembly_line_no",
        F.col("predicted_downtime").alias("predicted"),
        r6("confidence", 4).alias("confidence"),
        "is_anomaly",
    )


@query(
    "score_stream_o90",
    f"""with {GOOD_SQL} select p as seq, event_id, machine_id, assembly_line_no, predicted, confidence, is_anomaly, drift, shift from sent
      union all select null, event_id, null, concat('L', user_id % 3), null, null, null, null, null from events where event_id % 29 < 2""",
)
def streamed(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions, log files, drift and refused messages of a stream."""
    fitted = small_bundle(spark, sf)
    source, results = run_dir(spark, "sent"), run_dir(spark, "results")
    write_replay(sent_rows(spark, sf), source, rows_per_file=5000, order="Unnamed: 0")
    stream = message_source(spark, {"kind": "files", "path": source, "files_per_trigger": 1})
    score_stream(stream, fitted, results, run_dir(spark, "results-checkpoint")).awaitTermination()
    logged = spark.read.option("header", True).option("escape", '"').csv(f"{results}/log").select(
        F.col(quoted("Unnamed: 0")).cast("bigint").alias("event_id"),
        F.col("Downtime").alias("predicted"),
        F.col("Is_Anomaly").cast("boolean").alias("is_anomaly"),
        F.get_json_object("Extra", "$.Shift").alias("shift"),
    )
    counters = spark.read.parquet(f"{results}/scored").select("seq", F.col(f"data.{quoted('Unnamed: 0')}").cast("bigint").alias("event_id"))
    drifted = spark.read.parquet(f"{results}/drift").where(F.col("feature") == VOLTAGE).select("seq", F.lit(True).alias("drift"))
    made = spark.read.parquet(f"{results}/predictions").join(counters, "seq").join(drifted, "seq", "left").join(logged, "event_id")
    good_rows = made.where(F.col("predicted") == F.col("predicted_downtime")).select(
        "seq", "event_id", "machine_id", "assembly_line_no", "predicted", r6("confidence", 4).alias("confidence"), "is_anomaly",
        F.coalesce("drift", F.lit(False)).alias("drift"), "shift",
    )
    dead = spark.read.text(f"{results}/dead").select(
        F.get_json_object("value", "$['Unnamed: 0']").cast("bigint").alias("event_id"),
        F.get_json_object("value", "$.Assembly_Line_No").alias("assembly_line_no"),
    )
    return good_rows.unionByName(dead, allowMissingColumns=True)


@query(
    "drift_stream_o91",
    """with recursive x as (select row_number() over (order by event_id) as i, value as s1,
        json_extract_string(props, '$.k')::double as s2 from events where event_id % 50 = 49),
      e as (select i, s1 as m1, 0.0::double as v1, s2 as m2, 0.0::double as v2 from x where i = 1
        union all
        select x.i, 0.99 * m1 + 0.01 * x.s1, 0.99 * v1 + 0.01 * (x.s1 - m1) * (x.s1 - m1),
          0.99 * m2 + 0.01 * x.s2, 0.99 * v2 + 0.01 * (x.s2 - m2) * (x.s2 - m2)
        from e join x on x.i = e.i + 1),
      l as (select * from e where i = (select max(i) from x)),
      n as (select count(*) as n from events),
      g as (select event_id, user_id % 2 as machine, row_number() over (partition by user_id % 2 order by event_id) - 1 as p from events)
    select 's1' as feature, n as messages, round(m1, 6) as mean, round(sqrt(v1), 6) as std,
      least(0.0, (select min(s1) from x)) as min, greatest(1.0, (select max(s1) from x)) as max, (select count(*) from x) as count from l, n
    union all select 's2', n, round(m2, 6), round(sqrt(v2), 6), least(0.0, (select min(s2) from x)),
      greatest(1.0, (select max(s2) from x)), (select count(*) from x) from l, n
    union all select concat('step of ', machine), event_id, null, null, null, null, null from g where p >= 160 and p % 160 = 31""",
)
def streamed_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Moving statistics, and each machine's detector on its stepping series, over a stream."""
    rows = numbers(spark, sf).selectExpr("row_id", "s1", "s2", "user_id % 2 as machine")
    df = dense_index(rows, by=["machine"], out="p").selectExpr("row_id", "s1", "s2", "machine", "p div 160 % 2 * 10D as step")
    source, results = run_dir(spark, "numbers"), run_dir(spark, "drift")
    write_replay(df, source, rows_per_file=3333)
    lines = message_source(spark, {"kind": "files", "path": source, "files_per_trigger": 1})
    kind = "row_id bigint, s1 double, s2 double, machine bigint, step double"
    parsed = lines.select(F.from_json("value", kind).alias("m")).select("m.*")
    drift_stream(parsed, ["s1", "s2", "step"], results, run_dir(spark, "drift-checkpoint"), by=["machine"]).awaitTermination()
    last = spark.read.parquet(f"{results}/stats").where("feature <> 'step'")
    ends = last.groupBy("feature").agg(F.max_by(F.struct("*"), "batch_id").alias("r")).select("r.*")
    changes = spark.read.parquet(f"{results}/changes").where("feature = 'step'")
    return ends.select(
        "feature", F.col("seen").alias("messages"), r6("mean").alias("mean"), r6("std").alias("std"), "min", "max", "count"
    ).unionByName(
        changes.select(F.concat(F.lit("step of "), "machine").alias("feature"), F.col("seq").alias("messages")), allowMissingColumns=True
    )


@query(
    "result_store_o92",
    f"with {GOOD_SQL} select event_id as seq, machine_id from sent order by event_id desc limit 100",
)
def result_store(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions appended by a stream, and the newest 100 of them."""
    source = run_dir(spark, "sent")
    sent_messages(spark, sf).write.text(source)
    stream = message_source(spark, {"kind": "files", "path": source, "files_per_trigger": 4})
    kept = stored(score(stream, small_bundle(spark, sf)), "predictions")
    return latest_predictions(kept).select("seq", "machine_id")


@query("live_counters_o93", ORACLES["service_counters_o39"])
def live_counters(spark: SparkSession, sf: str) -> DataFrame:
    """The counters as a running aggregate over a stream of scored rows; the last
    state is the answer."""
    source, path = run_dir(spark, "scored"), run_dir(spark, "counters")
    rows = scored_events(spark, sf)
    rows.repartition(4).write.parquet(source)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(source)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    started = (
        counter_stream(stream)
        .writeStream.outputMode("complete")
        .foreachBatch(write)
        .option("checkpointLocation", run_dir(spark, "counters-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    started.awaitTermination()
    return spark.read.parquet(path).select("metric", r6("value", 4).alias("value"))


@query(
    "live_counters_stream_o93",
    f"""with {GOOD_SQL}, c as (select count(*)::double as n, (count(*) filter (is_anomaly))::double as a, (count(*) filter (confidence <= 0.5))::double as low,
        (count(*) filter (confidence <= 0.75))::double as mid from sent)
      select 'predictions_total' as metric, n as value from c union all select 'anomalies_detected_total', a from c union all select 'prediction_confidence_count', n from c
      union all select 'prediction_confidence_bucket_le_0.5', low from c union all select 'prediction_confidence_bucket_le_0.75', mid from c
      union all select 'prediction_confidence_bucket_le_+Inf', n from c union all select 'model_health_status', 1.0 from c
      union all select distinct concat('feature_drift_', '{VOLTAGE.replace("(", "_").replace(")", "_")}'), 1.0 from sent where drift""",
)
def counters_of_a_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The counters that follow a scoring stream, stopped and started again between its batches."""
    fitted = small_bundle(spark, sf)
    source, results, out, checkpoint, counted = (run_dir(spark, n) for n in ("sent", "results", "live", "results-checkpoint", "live-checkpoint"))
    n = table(spark, sf, "events").agg(F.max("event_id")).first()[0]
    for low, high in ((0, n // 2), (n // 2, n + 1)):
        part = sent_rows(spark, sf).where(F.col("`Unnamed: 0`").between(low, high - 1))
        write_replay(part, source, rows_per_file=n + 1, order="Unnamed: 0")
        stream = message_source(spark, {"kind": "files", "path": source, "files_per_trigger": 1})
        score_stream(stream, fitted, results, checkpoint).awaitTermination()
        follow_counters(spark, results, out, counted).awaitTermination()
    kept = ["predictions_total", "anomalies_detected_total", "prediction_confidence_count", "model_health_status"]
    kept += [f"prediction_confidence_bucket_le_{b}" for b in ("0.5", "0.75", "+Inf")] + ["feature_drift_" + VOLTAGE.replace("(", "_").replace(")", "_")]
    return current_counters(spark, out).where(F.col("metric").isin(kept))
