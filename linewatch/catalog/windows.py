"""Queries of the order-dependent operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linewatch.catalog.base import (
    GROUP_SQL,
    NUMBERS_SQL,
    RAW_SQL,
    SENSORS,
    hash_sql,
    machine_events,
    numbers,
    plain_names,
    query,
    r6,
    table,
)
from linewatch.functions.labels import downtime_group
from linewatch.operators.board import board, latest_prediction, latest_predictions
from linewatch.operators.drift import moving_statistics
from linewatch.operators.encode import label_encode
from linewatch.operators.ordering import (
    carry_fill,
    dense_index,
    drop_repeats,
    every_nth,
    halo_select,
    rising_edge,
)
from linewatch.operators.quantiles import medians
from linewatch.operators.split import raw_split, sample_rows, stratified_folds, train_test_split
from linewatch.operators.temporal import (
    add_temporal_features,
    create_future_target,
    lag_one,
    rolling_mean,
    rolling_std,
)
from linewatch.schema import GROUP, TARGET

BUCKET_ROWS = 10_000


def grouped(spark: SparkSession, sf: str) -> DataFrame:
    """Row id and class id."""
    named = machine_events(spark, sf).select("row_id", "Machine_ID", downtime_group(F.col("Downtime")).alias(GROUP))
    return label_encode(named, GROUP)[0]


CLASS_SQL = f"""{RAW_SQL}, named as (select row_id, machine, {GROUP_SQL} as g from raw),
  coded as (select row_id, machine, g, (dense_rank() over (order by g) - 1)::int as c from named)"""


@query(
    "dense_index_o40",
    """select event_id, row_number() over (order by event_id) - 1 as dense_id from events
      where event_type <> 'click' and event_id % 7 <> 3""",
)
def dense(spark: SparkSession, sf: str) -> DataFrame:
    gappy = table(spark, sf, "events").where("event_type <> 'click' and event_id % 7 <> 3")
    return dense_index(gappy.select("event_id"), "event_id", bucket_rows=BUCKET_ROWS)


@query(
    "dense_index_by_machine_o40",
    f"""with {RAW_SQL} select row_id, machine,
      row_number() over (partition by machine order by row_id) - 1 as dense_id from raw""",
)
def dense_by(spark: SparkSession, sf: str) -> DataFrame:
    raw = machine_events(spark, sf).select("row_id", F.col("Machine_ID").alias("machine"))
    return dense_index(raw, by=["machine"], bucket_rows=BUCKET_ROWS)


@query(
    "future_target_o41",
    f"""with {CLASS_SQL}, ahead as (select row_id, c, lead(c, 10) over (order by row_id) as label from coded)
      select row_id, c as class_id, label from ahead where label is not null""",
)
def future_target(spark: SparkSession, sf: str) -> DataFrame:
    ahead = create_future_target(grouped(spark, sf), bucket_rows=BUCKET_ROWS)
    return ahead.select("row_id", F.col(GROUP).alias("class_id"), F.col(TARGET).alias("label"))


@query(
    "future_target_by_machine_o41",
    f"""with {CLASS_SQL}, ahead as (select row_id, lead(c, 10) over (partition by machine order by row_id) as label from coded)
      select row_id, label from ahead where label is not null""",
)
def future_target_by(spark: SparkSession, sf: str) -> DataFrame:
    placed = dense_index(grouped(spark, sf), by=["Machine_ID"], out="place", bucket_rows=BUCKET_ROWS)
    ahead = create_future_target(placed, order="place", by=["Machine_ID"], bucket_rows=BUCKET_ROWS, dense=True)
    return ahead.select("row_id", F.col(TARGET).alias("label"))


# Ids with small gaps everywhere, and with long stretches of nothing.
GAPPY = "event_id % 7 <> 3 and (event_id // 700) % 3 <> 1"
GAPPY_SPARK = "event_id % 7 <> 3 and (event_id div 700) % 3 <> 1"
SHORT_BUCKETS = 30


@query(
    "future_target_gappy_o41",
    f"""with t as (select event_id as row_id, user_id % 4 as c from events where {GAPPY}),
      ahead as (select row_id, lead(c, 10) over (order by row_id)::int as label from t)
      select row_id, label from ahead where label is not null""",
)
def future_target_gappy(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").where(GAPPY_SPARK).selectExpr("event_id as row_id", f"user_id % 4 as {GROUP}")
    return create_future_target(rows, bucket_rows=SHORT_BUCKETS).select("row_id", F.col(TARGET).alias("label"))


@query(
    "lag_one_o42",
    f"""with {NUMBERS_SQL}, m as (select median(s1) as m from numbers)
      select row_id, coalesce(lag(s1) over (order by row_id), m.m) as lag1 from numbers, m""",
)
def lag(spark: SparkSession, sf: str) -> DataFrame:
    df = numbers(spark, sf)
    median = F.lit(medians(df, ["s1"])["s1"])
    return halo_select(
        df,
        lambda w: ["row_id", lag_one(F.col("s1"), median, w).alias("lag1")],
        1,
        0,
        bucket_rows=BUCKET_ROWS,
    )


@query(
    "rolling_mean_o43",
    f"""with {NUMBERS_SQL} select row_id,
      round(avg(s1) over (order by row_id rows 4 preceding), 6) + 0.0 as mean5 from numbers""",
)
def mean5(spark: SparkSession, sf: str) -> DataFrame:
    return halo_select(
        numbers(spark, sf),
        lambda w: ["row_id", r6(rolling_mean(F.col("s1"), w)).alias("mean5")],
        4,
        0,
        bucket_rows=BUCKET_ROWS,
    )


@query(
    "rolling_std_o44",
    f"""with {NUMBERS_SQL} select row_id,
      round(coalesce(stddev_samp(s1) over (order by row_id rows 4 preceding), 0), 6) + 0.0 as std5 from numbers""",
)
def std5(spark: SparkSession, sf: str) -> DataFrame:
    return halo_select(
        numbers(spark, sf),
        lambda w: ["row_id", r6(rolling_std(F.col("s1"), w)).alias("std5")],
        4,
        0,
        bucket_rows=BUCKET_ROWS,
    )


@query(
    "carry_fill_o45",
    """with gaps as (select event_id as row_id,
      case when event_id < 40 or event_id % 17 < 9 then null else value end as x,
      case when event_id < 900 or event_id % 1000 < 990 then null else event_type end as t,
      cast(null as varchar) as none from events),
    forward as (select row_id,
      last_value(x ignore nulls) over (order by row_id rows unbounded preceding) as x,
      last_value(t ignore nulls) over (order by row_id rows unbounded preceding) as t from gaps)
    select row_id,
      coalesce(x, first_value(x ignore nulls) over (order by row_id rows between current row and unbounded following), 0) as x,
      coalesce(t, first_value(t ignore nulls) over (order by row_id rows between current row and unbounded following), '0') as t,
      '0' as none from forward""",
)
def fill(spark: SparkSession, sf: str) -> DataFrame:
    gaps = table(spark, sf, "events").selectExpr(
        "event_id as row_id",
        "case when event_id < 40 or event_id % 17 < 9 then null else value end as x",
        "case when event_id < 900 or event_id % 1000 < 990 then null else event_type end as t",
        "cast(null as string) as none",
    )
    return carry_fill(gaps, bucket_rows=500)


@query(
    "halo_window_o46",
    f"""with {NUMBERS_SQL} select row_id, lag(s2, 3) over w as back, lead(s2, 7) over w as ahead,
      sum(s2) over (order by row_id rows between 3 preceding and 7 following) as around
      from numbers window w as (order by row_id)""",
)
def halo(spark: SparkSession, sf: str) -> DataFrame:
    return halo_select(
        numbers(spark, sf),
        lambda w: [
            "row_id",
            F.lag("s2", 3).over(w).alias("back"),
            F.lead("s2", 7).over(w).alias("ahead"),
            F.sum("s2").over(w.rowsBetween(-3, 7)).alias("around"),
        ],
        3,
        7,
        bucket_rows=1000,
    )


TEMPORAL_SQL = """n as (select row_id, machine, line, try_cast(torque as double) as t0, try_cast(voltage as double) as v0 from {source}),
  m as (select coalesce(median(t0), 0) as mt, coalesce(median(v0), 0) as mv from n),
  f as (select row_id, machine, line, coalesce(t0, mt) as t, coalesce(v0, mv) as v, mt, mv from n, m),
  w as (select row_id,
    last_value(machine ignore nulls) over (order by row_id rows unbounded preceding) as machine, line,
    t as torque, coalesce(lag(t) over (order by row_id), mt) as torque_lag1,
    avg(t) over (order by row_id rows 4 preceding) as torque_mean5,
    coalesce(stddev_samp(t) over (order by row_id rows 4 preceding), 0) as torque_std5,
    v as voltage, coalesce(lag(v) over (order by row_id), mv) as voltage_lag1,
    avg(v) over (order by row_id rows 4 preceding) as voltage_mean5,
    coalesce(stddev_samp(v) over (order by row_id rows 4 preceding), 0) as voltage_std5 from f),
  temporal as (select row_id, coalesce(machine, first_value(machine ignore nulls) over
      (order by row_id rows between current row and unbounded following), '0') as machine, line,
    torque, torque_lag1, torque_mean5, torque_std5, voltage, voltage_lag1, voltage_mean5, voltage_std5 from w)"""

SENSOR_COLUMNS = [f"{s}{e}" for s in ("torque", "voltage") for e in ("", "_lag1", "_mean5", "_std5")]


def short_names(df: DataFrame) -> DataFrame:
    named = plain_names(df)
    return named.toDF(
        *[
            c.replace("Torque_Nm", "torque").replace("Voltage_volts", "voltage") for c in named.columns
        ]
    )


@query(
    "temporal_features_o47",
    f"with {RAW_SQL}, {TEMPORAL_SQL.format(source='raw')} select row_id, machine, line, "
    + ", ".join(f"round({c}, 6) + 0.0 as {c}" for c in SENSOR_COLUMNS)
    + " from temporal",
)
def temporal(spark: SparkSession, sf: str) -> DataFrame:
    raw = machine_events(spark, sf).drop("Date", "Timestamp", "Downtime")
    made = short_names(add_temporal_features(raw, SENSORS, bucket_rows=BUCKET_ROWS))
    return made.select(
        "row_id",
        F.col("Machine_ID").alias("machine"),
        F.col("Assembly_Line_No").alias("line"),
        *[r6(c).alias(c) for c in SENSOR_COLUMNS],
    )


@query(
    "temporal_by_machine_o47",
    """with n as (select event_id as row_id, user_id % 6 as machine, case when event_id % 13 = 0 then null else value end as x,
        case when event_id % 11 < 4 then null else concat('n', event_id) end as note from events),
      m as (select median(x) as m from n),
      f as (select row_id, machine, coalesce(x, m) as x, m, note from n, m),
      w as (select row_id, machine, x, coalesce(lag(x) over g, m) as lag1,
          avg(x) over (partition by machine order by row_id rows 4 preceding) as mean5,
          coalesce(stddev_samp(x) over (partition by machine order by row_id rows 4 preceding), 0) as std5,
          coalesce(last_value(note ignore nulls) over (partition by machine order by row_id rows unbounded preceding),
            first_value(note ignore nulls) over (partition by machine order by row_id rows between current row and unbounded following),
            '0') as note from f window g as (partition by machine order by row_id))
      select row_id, machine, note, round(x, 6) + 0.0 as x, round(lag1, 6) + 0.0 as lag1, round(mean5, 6) + 0.0 as mean5,
        round(std5, 6) + 0.0 as std5 from w""",
)
def temporal_by_machine(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").selectExpr(
        "event_id as row_id",
        "user_id % 6 as machine",
        "case when event_id % 13 = 0 then null else value end as x",
        "case when event_id % 11 < 4 then null else concat('n', event_id) end as note",
    )
    made = add_temporal_features(rows, ["x"], by=["machine"], bucket_rows=500)
    named = made.withColumnsRenamed({"x_lag1": "lag1", "x_mean5": "mean5", "x_std5": "std5"})
    return named.select("row_id", "machine", "note", *[r6(c).alias(c) for c in ("x", "lag1", "mean5", "std5")])


@query(
    "rising_edge_o48",
    """with f as (select event_id as row_id, value > 50 as flag from events)
      select row_id, flag, flag and not coalesce(lag(flag) over (order by row_id), false) as newly from f""",
)
def edges(spark: SparkSession, sf: str) -> DataFrame:
    flags = table(spark, sf, "events").selectExpr("event_id as row_id", "value > 50 as flag")
    return rising_edge(flags, "flag", "newly", bucket_rows=BUCKET_ROWS)


@query(
    "rising_edge_gappy_o48",
    f"""with f as (select event_id as row_id, user_id % 3 as g, value > 50 as flag from events where {GAPPY})
      select row_id, flag and not coalesce(lag(flag) over (order by row_id), false) as newly,
        flag and not coalesce(lag(flag) over (partition by g order by row_id), false) as newly_in_group from f""",
)
def edges_gappy(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").where(GAPPY_SPARK)
    flags = rows.selectExpr("event_id as row_id", "user_id % 3 as g", "value > 50 as flag")
    both = rising_edge(flags, "flag", "newly", bucket_rows=SHORT_BUCKETS)
    both = rising_edge(both, "flag", "newly_in_group", by=["g"], bucket_rows=SHORT_BUCKETS)
    return both.select("row_id", "newly", "newly_in_group")


@query("every_nth_o49", "select event_id, value from events where event_id % 50 = 49")
def nth(spark: SparkSession, sf: str) -> DataFrame:
    return every_nth(table(spark, sf, "events"), 50, "event_id").select("event_id", "value")


@query(
    "drop_repeats_o50",
    """with t as (select event_id as row_id, user_id % 3 as stamp from events),
      l as (select row_id, stamp, lag(stamp) over (order by row_id) as before from t)
      select row_id, stamp from l where row_id = 0 or stamp is distinct from before""",
)
def repeats(spark: SparkSession, sf: str) -> DataFrame:
    stamps = table(spark, sf, "events").selectExpr("event_id as row_id", "user_id % 3 as stamp")
    return drop_repeats(stamps, "stamp", bucket_rows=BUCKET_ROWS)


@query(
    "drop_repeats_gappy_o50",
    f"""with t as (select event_id as row_id, user_id % 3 as stamp from events where {GAPPY} and event_id > 5),
      l as (select row_id, stamp, lag(stamp) over (order by row_id) as before, row_number() over (order by row_id) as n from t)
      select row_id, stamp from l where n = 1 or stamp is distinct from before""",
)
def repeats_gappy(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").where(GAPPY_SPARK + " and event_id > 5")
    return drop_repeats(rows.selectExpr("event_id as row_id", "user_id % 3 as stamp"), "stamp", bucket_rows=SHORT_BUCKETS)


@query(
    "moving_statistics_o58",
    """with recursive x as (select row_number() over (order by event_id) as i, value as s1,
        json_extract_string(props, '$.k')::double as s2 from events where event_id % 50 = 49),
      e as (select i, s1 as m1, 0.0::double as v1, 0.99 * 5.0 + 0.01 * s2 as m2,
          0.99 * 4.0 + 0.01 * (s2 - 5.0) * (s2 - 5.0) as v2 from x where i = 1
        union all
        select x.i, 0.99 * m1 + 0.01 * x.s1, 0.99 * v1 + 0.01 * (x.s1 - m1) * (x.s1 - m1),
          0.99 * m2 + 0.01 * x.s2, 0.99 * v2 + 0.01 * (x.s2 - m2) * (x.s2 - m2)
        from e join x on x.i = e.i + 1),
      l as (select * from e where i = (select max(i) from x))
    select 's1' as feature, round(m1, 6) as mean, round(sqrt(v1), 6) as std, (select min(s1) from x) as min,
      (select max(s1) from x) as max, (select count(*) from x) as count from l
    union all select 's2', round(m2, 6), round(sqrt(v2), 6), least(1.0, (select min(s2) from x)),
      greatest(9.0, (select max(s2) from x)), 3 + (select count(*) from x) from l""",
)
def moving(spark: SparkSession, sf: str) -> DataFrame:
    start = {
        "s1": {"mean": 0.0, "std": 1.0, "min": float("inf"), "max": float("-inf"), "count": 0},
        "s2": {"mean": 5.0, "std": 2.0, "min": 1.0, "max": 9.0, "count": 3},
    }
    stats = moving_statistics(numbers(spark, sf), ["s1", "s2"], start=start)
    return stats.select("feature", r6("mean").alias("mean"), r6("std").alias("std"), "min", "max", "count")


@query(
    "raw_split_o60",
    """select event_id as row_id, case when event_id < (select floor(count(*) * 0.85) from events)
      then 'train' else 'inference' end as part from events""",
)
def split_raw(spark: SparkSession, sf: str) -> DataFrame:
    train, infer = raw_split(numbers(spark, sf).select("row_id"))
    return train.withColumn("part", F.lit("train")).unionByName(infer.withColumn("part", F.lit("inference")))


@query(
    "train_test_split_o61",
    """select event_id as row_id, case when event_id < (select count(*) - ceil(count(*) * 0.15) from events)
      then 'train' else 'test' end as part from events""",
)
def split_test(spark: SparkSession, sf: str) -> DataFrame:
    train, test = train_test_split(numbers(spark, sf).select("row_id"))
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query(
    "latest_predictions_o62",
    "select event_id as seq, event_type from events order by event_id desc limit 100",
)
def newest(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").selectExpr("event_id as seq", "event_type")
    return latest_predictions(rows)


@query("latest_prediction_o63", "select event_id as seq, event_type from events order by event_id desc limit 1")
def newest_one(spark: SparkSession, sf: str) -> DataFrame:
    return latest_prediction(table(spark, sf, "events").selectExpr("event_id as seq", "event_type"))


@query(
    "board_o63",
    f"""with {RAW_SQL} select row_id as seq, t_text as time, coalesce(machine, 'N/A') as machine, line,
      case reason when 'No_Machine_Failure' then 'green' when 'Power_Failure' then 'yellow'
        when 'Machine_Failure' then 'red' else 'blue' end as icon, {GROUP_SQL} as "group"
      from raw order by row_id desc limit 20""",
)
def newest_board(spark: SparkSession, sf: str) -> DataFrame:
    rows = machine_events(spark, sf).select(
        F.col("row_id").alias("seq"),
        F.col("Machine_ID").alias("machine_id"),
        F.col("Assembly_Line_No").alias("assembly_line_no"),
        downtime_group(F.col("Downtime")).alias("predicted_downtime"),
        F.concat(F.lit("2024-01-01 "), "Timestamp").alias("timestamp"),
    )
    return board(rows).select("seq", "time", "machine", "line", "icon", "group")


@query(
    "sample_rows_o64",
    f"select event_id, value from events order by {hash_sql(42, 'event_id')}, event_id limit 1000",
)
def sample(spark: SparkSession, sf: str) -> DataFrame:
    return sample_rows(table(spark, sf, "events"), order="event_id").select("event_id", "value")


@query(
    "stratified_folds_o75",
    f"""select event_id, event_type, ((row_number() over (partition by event_type order by
      {hash_sql(42, 'event_id')}, event_id) - 1) % 3)::int as fold from events""",
)
def folds(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select("event_id", "event_type")
    return stratified_folds(rows, "event_type", "event_id", bucket_rows=BUCKET_ROWS)
