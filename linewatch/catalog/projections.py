"""Queries of the row-wise operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linewatch.catalog.base import (
    GROUP_SQL,
    RAW_SQL,
    SENSORS,
    TORQUE,
    VOLTAGE,
    machine_events,
    query,
    table,
)
from linewatch.functions.labels import downtime_group, fill_label
from linewatch.functions.numbers import finite_or_zero, metric_name, number_of
from linewatch.functions.times import parse_clock, parse_mixed_date
from linewatch.operators.board import status_rows
from linewatch.operators.calendar import add_calendar_features, reconstruct_datetime
from linewatch.operators.columns import align, drop_unused
from linewatch.operators.encode import label_encode, one_hot
from linewatch.operators.temporal import add_temporal_features, create_future_target

GENERIC_SQL = (
    "['%Y-%m-%d', '%m/%d/%Y', '%d/%m/%Y', '%m-%d-%Y', '%d-%m-%Y', '%Y/%m/%d', '%Y%m%d', "
    "'%b %d %Y', '%d %b %Y']"
)


@query(
    "parse_mixed_date_o10",
    f"""with texts as (select o_orderkey, case o_orderkey % 11
      when 0 then strftime(o_orderdate, '%Y-%m-%d') when 1 then strftime(o_orderdate, '%m/%d/%Y')
      when 2 then strftime(o_orderdate, '%d-%m-%Y') when 3 then strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
      when 4 then ' NaN ' when 5 then '' when 6 then strftime(o_orderdate, '%-d/%-m/%Y')
      when 7 then strftime(o_orderdate, '%Y%m%d') when 8 then strftime(o_orderdate, '%b %-d %Y')
      when 9 then strftime(o_orderdate, '%d-%m-%Y %H:%M:%S') else null end as raw from orders),
    t as (select o_orderkey, trim(raw) as s from texts)
    select o_orderkey, cast(epoch(case
      when s is null or lower(s) in ('', 'nan', 'none', 'null') then null
      when contains(s, ' ') and contains(s, ':') then try_strptime(split_part(s, ' ', 1), {GENERIC_SQL})
      when contains(s, '/') then try_strptime(s, '%m/%d/%Y')
      when contains(s, '-') and length(split_part(s, '-', 1)) = 4 then try_strptime(s, '%Y-%m-%d')
      when contains(s, '-') then try_strptime(s, '%d-%m-%Y')
      else try_strptime(s, {GENERIC_SQL}) end) as bigint) as day from t""",
)
def parse_dates(spark: SparkSession, sf: str) -> DataFrame:
    text = F.expr(
        "case o_orderkey % 11 when 0 then date_format(o_orderdate, 'yyyy-MM-dd') "
        "when 1 then date_format(o_orderdate, 'MM/dd/yyyy') when 2 then date_format(o_orderdate, 'dd-MM-yyyy') "
        "when 3 then date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') when 4 then ' NaN ' when 5 then '' "
        "when 6 then date_format(o_orderdate, 'd/M/yyyy') when 7 then date_format(o_orderdate, 'yyyyMMdd') "
        "when 8 then date_format(o_orderdate, 'MMM d yyyy') "
        "when 9 then date_format(o_orderdate, 'dd-MM-yyyy HH:mm:ss') else null end"
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", F.unix_timestamp(parse_mixed_date(text)).alias("day")
    )


@query(
    "parse_clock_o11",
    """select event_id, case event_id % 4
      when 0 then hour(ts) * 3600 + minute(ts) * 60 + second(ts) when 1 then hour(ts) * 3600 + minute(ts) * 60 + second(ts)
      else null end::int as seconds from events""",
)
def parse_clocks(spark: SparkSession, sf: str) -> DataFrame:
    text = F.expr(
        "case event_id % 4 when 0 then date_format(ts, 'HH:mm:ss') when 1 then date_format(ts, 'H:m:s') "
        "when 2 then date_format(ts, 'HH:mm') else 'late' end"
    )
    return table(spark, sf, "events").select("event_id", parse_clock(text).alias("seconds"))


@query(
    "reconstruct_datetime_o12",
    f"""with {RAW_SQL} select row_id, machine, cast(epoch(date_trunc('second', ts)) as bigint) as event_time
      from raw where d_text <> 'nan'""",
)
def reconstruct(spark: SparkSession, sf: str) -> DataFrame:
    timed = reconstruct_datetime(machine_events(spark, sf))
    return timed.select(
        "row_id", F.col("Machine_ID").alias("machine"), F.unix_timestamp("event_time").alias("event_time")
    )


@query(
    "reconstruct_datetime_none_valid_o12",
    "select o_orderkey as row_id, 12 as hour, 1 as dayofweek, 1 as month, 0 as is_weekend from orders",
)
def reconstruct_none(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "orders").selectExpr(
        "o_orderkey as row_id", "o_orderpriority as Date", "'10:00:00' as Timestamp"
    )
    return add_calendar_features(reconstruct_datetime(raw))


@query(
    "calendar_features_o13",
    f"""with {RAW_SQL} select row_id, hour(ts)::int as hour, (isodow(ts) - 1)::int as dayofweek,
      month(ts)::int as month, (case when isodow(ts) >= 6 then 1 else 0 end)::int as is_weekend
      from raw where d_text <> 'nan'""",
)
def calendar(spark: SparkSession, sf: str) -> DataFrame:
    timed = add_calendar_features(reconstruct_datetime(machine_events(spark, sf)))
    return timed.select("row_id", "hour", "dayofweek", "month", "is_weekend")


@query(
    "default_calendar_o14",
    "select event_id as row_id, 12 as hour, 1 as dayofweek, 1 as month, 0 as is_weekend from events",
)
def default_calendar(spark: SparkSession, sf: str) -> DataFrame:
    untimed = machine_events(spark, sf).drop("Date")
    return add_calendar_features(reconstruct_datetime(untimed)).select(
        "row_id", "hour", "dayofweek", "month", "is_weekend"
    )


@query("downtime_groups_o15", f'with {RAW_SQL} select row_id, {GROUP_SQL} as "group" from raw')
def groups(spark: SparkSession, sf: str) -> DataFrame:
    return machine_events(spark, sf).select("row_id", downtime_group(F.col("Downtime")).alias("group"))


@query("drop_unused_o16", f"with {RAW_SQL} select row_id, machine, line from raw")
def drop(spark: SparkSession, sf: str) -> DataFrame:
    left = drop_unused(
        machine_events(spark, sf), ["Downtime", "Downtime_Group", "Date", "Timestamp", *SENSORS]
    )
    return left.withColumnsRenamed({"Machine_ID": "machine", "Assembly_Line_No": "line"})


@query("align_columns_o17", "select event_id, 0.0::double as absent, value from events")
def align_columns(spark: SparkSession, sf: str) -> DataFrame:
    return align(table(spark, sf, "events"), ["event_id", "absent", "value"])


@query(
    "to_number_o18",
    f"""with {RAW_SQL} select row_id, try_cast(torque as double) as torque,
      try_cast(voltage as double) as voltage from raw""",
)
def coerce(spark: SparkSession, sf: str) -> DataFrame:
    raw = machine_events(spark, sf)
    return raw.select(
        "row_id", number_of(raw, TORQUE).alias("torque"), number_of(raw, VOLTAGE).alias("voltage")
    )


@query(
    "finite_or_zero_o19",
    "select event_id, case when event_id % 5 < 4 then 0.0 else value end as x from events",
)
def cleanup(spark: SparkSession, sf: str) -> DataFrame:
    odd = F.expr(
        "case event_id % 5 when 0 then null when 1 then double('NaN') when 2 then double('infinity') "
        "when 3 then double('-infinity') else value end"
    )
    return table(spark, sf, "events").select("event_id", finite_or_zero(odd).alias("x"))


@query(
    "fill_label_o20",
    "select event_id, case when event_id % 7 = 0 then 'Unknown' else user_id::varchar end as label from events",
)
def fill(spark: SparkSession, sf: str) -> DataFrame:
    label = F.expr("case when event_id % 7 = 0 then null else user_id end")
    return table(spark, sf, "events").select("event_id", fill_label(label).alias("label"))


@query("absent_columns_o21", "select event_id, value, 'ValueError' as missing_target from events")
def absent_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Operators leave a table without their columns as it is; only a missing
    class column is an error."""
    df = table(spark, sf, "events").select("event_id", "value")
    df = reconstruct_datetime(df)
    df = create_future_target(df, order="event_id")
    df = add_temporal_features(df, order="event_id")
    df = drop_unused(one_hot(df, {"Machine_ID": ["M1"]}), ["Downtime"])
    try:
        label_encode(df)
        outcome = "none"
    except ValueError as e:
        outcome = type(e).__name__
    return df.withColumn("missing_target", F.lit(outcome))


@query(
    "status_rows_o22",
    f"""with {RAW_SQL}, p as (select row_id, case when row_id % 8 = 0 then 'soon' else strftime(ts, '%Y-%m-%d %H:%M:%S') end as t,
      case when row_id % 9 = 0 then null else {GROUP_SQL} end as g, machine, line from raw)
    select row_id as seq, case when t = 'soon' then t else substr(t, 12) end as time,
      coalesce(machine, 'N/A') as machine, line,
      case g when 'Normal' then 'green' when 'Infrastructure' then 'yellow' when 'Machine_Issue' then 'red' else 'blue' end as icon,
      coalesce(g, 'N/A') as "group" from p""",
)
def status(spark: SparkSession, sf: str) -> DataFrame:
    raw = machine_events(spark, sf)
    events = table(spark, sf, "events").selectExpr(
        "event_id as row_id",
        "case when event_id % 8 = 0 then 'soon' else date_format(ts, 'yyyy-MM-dd HH:mm:ss') end as timestamp",
    )
    predictions = raw.drop("Timestamp").join(events, "row_id").select(
        F.col("row_id").alias("seq"),
        F.col("Machine_ID").alias("machine_id"),
        F.col("Assembly_Line_No").alias("assembly_line_no"),
        F.when(F.col("row_id") % 9 != 0, downtime_group(F.col("Downtime"))).alias("predicted_downtime"),
        "timestamp",
    )
    return status_rows(predictions).select("seq", "time", "machine", "line", "icon", "group")


@query(
    "metric_names_o23",
    "select event_id, translate(concat(event_type, '(?', user_id, ')'), '()?', '___') as name from events",
)
def metric_names(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id", metric_name(F.expr("concat(event_type, '(?', user_id, ')')")).alias("name")
    )


