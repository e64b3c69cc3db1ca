"""Queries of the whole feature jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linewatch.catalog.base import (
    GROUP_SQL,
    MACHINES,
    RAW_SQL,
    SENSORS,
    machine_events,
    query,
    r6,
)
from linewatch.catalog.windows import SENSOR_COLUMNS, TEMPORAL_SQL, short_names
from linewatch.operators.encode import fit_one_hot
from linewatch.plans.features import POSITION, feature_table, serving_features, with_history
from linewatch.schema import TARGET
from linewatch.session import materialise

MACHINE_NAMES = [f"M{i}" for i in range(6)]
LINE_NAMES = [f"L{i}" for i in range(3)]
DUMMIES = [f"Machine_ID_{m}" for m in MACHINE_NAMES] + [f"Assembly_Line_No_{n}" for n in LINE_NAMES]
DUMMY_SQL = ", ".join(
    [f"(machine = '{m}')::int::double as Machine_ID_{m}" for m in MACHINE_NAMES]
    + [f"(line = '{n}')::int::double as Assembly_Line_No_{n}" for n in LINE_NAMES]
)
CALENDAR = ["hour", "dayofweek", "month", "is_weekend"]

# Rows with a time, their group id, and the group id ten rows ahead.
KEPT_SQL = f"""{RAW_SQL}, timed as (select * from raw where d_text <> 'nan'),
  coded as (select *, (dense_rank() over (order by {GROUP_SQL}) - 1)::int as c from timed),
  ahead as (select *, lead(c, 10) over (order by row_id) as label,
    hour(ts)::double as hour, (isodow(ts) - 1)::double as dayofweek, month(ts)::double as month,
    (case when isodow(ts) >= 6 then 1 else 0 end)::double as is_weekend from coded),
  kept as (select * from ahead where label is not null)"""


@query(
    "feature_table_o82",
    f"with {KEPT_SQL}, {TEMPORAL_SQL.format(source='kept')} select t.row_id::double as row_id, label, "
    + ", ".join(CALENDAR)
    + ", "
    + ", ".join(f"round(t.{c}, 6) + 0.0 as {c}" for c in SENSOR_COLUMNS)
    + f", {DUMMY_SQL.replace('machine =', 't.machine =').replace('line =', 't.line =')}"
    + " from temporal t join kept k on k.row_id = t.row_id",
)
def features(spark: SparkSession, sf: str) -> DataFrame:
    made = feature_table(machine_events(spark, sf), SENSORS, MACHINES)
    named = short_names(made.frame.drop(POSITION))
    return named.select(
        "row_id",
        F.col(TARGET).alias("label"),
        *CALENDAR,
        *[r6(c).alias(c) for c in SENSOR_COLUMNS],
        *DUMMIES,
    )


@query(
    "serving_features_o83",
    f"""with {RAW_SQL}, n as (select row_id, coalesce(try_cast(torque as double), 0) as torque,
        coalesce(try_cast(voltage as double), 0) as voltage, coalesce(machine, '-') as machine, line,
        case when d_text = 'nan' then null else ts end as moment from raw)
      select row_id::double as row_id, coalesce(hour(moment), 12)::double as hour, coalesce(isodow(moment) - 1, 1)::double as dayofweek,
        coalesce(month(moment), 1)::double as month, (case when isodow(moment) >= 6 then 1 else 0 end)::double as is_weekend,
        torque, torque as torque_lag1, torque as torque_mean5, 0.0::double as torque_std5,
        voltage, voltage as voltage_lag1, voltage as voltage_mean5, 0.0::double as voltage_std5, {DUMMY_SQL},
        0.0::double as absent from n""",
)
def serving(spark: SparkSession, sf: str) -> DataFrame:
    """Each row scored alone: no history, a feature the message lacks is 0."""
    raw = machine_events(spark, sf)
    categories = fit_one_hot(raw, MACHINES)
    categories["Machine_ID"].remove("nan")
    sensors = [f"{s}{e}" for s in SENSORS for e in ("", "_lag1", "_mean5", "_std5")]
    wanted = ["row_id", *CALENDAR, *sensors, *DUMMIES, "absent"]
    return short_names(serving_features(raw, SENSORS, categories, wanted))


@query(
    "serving_features_history_o83",
    f"""with {RAW_SQL}, n as (select row_id, machine, coalesce(try_cast(torque as double), 0) as torque,
        coalesce(try_cast(voltage as double), 0) as voltage from raw)
      select row_id::double as row_id, torque, coalesce(lag(torque) over g, torque) as torque_lag1,
        round(avg(torque) over h, 6) + 0.0 as torque_mean5, round(coalesce(stddev_samp(torque) over h, 0), 6) + 0.0 as torque_std5,
        voltage, coalesce(lag(voltage) over g, voltage) as voltage_lag1,
        round(avg(voltage) over h, 6) + 0.0 as voltage_mean5, round(coalesce(stddev_samp(voltage) over h, 0), 6) + 0.0 as voltage_std5
      from n window g as (partition by machine order by row_id), h as (partition by machine order by row_id rows 4 preceding)""",
)
def serving_history(spark: SparkSession, sf: str) -> DataFrame:
    """Three runs of rows, each with the readings that the run before has left of its machine."""
    raw = machine_events(spark, sf)
    n = raw.count()
    sensors = [f"{s}{e}" for s in SENSORS for e in ("", "_lag1", "_mean5", "_std5")]
    history, out = None, None
    for low, high in ((0, n // 3), (n // 3, n // 3 + 7), (n // 3 + 7, n)):
        rows = raw.where(F.col("row_id").between(low, high - 1))
        featured, history = with_history(rows, history, SENSORS, "row_id")
        history = materialise(spark, history, "history")
        made = serving_features(featured, SENSORS, {}, ["row_id", *sensors])
        out = made if out is None else out.unionByName(made)
    named = short_names(out)
    return named.select("row_id", *[r6(c).alias(c) for c in SENSOR_COLUMNS])
