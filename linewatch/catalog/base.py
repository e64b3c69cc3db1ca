"""Registration and the tables the queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linewatch.schema import quoted

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TORQUE, VOLTAGE = "Torque(Nm)", "Voltage(volts)"
SENSORS = [TORQUE, VOLTAGE]
MACHINES = ["Machine_ID", "Assembly_Line_No"]
LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def r6(c: Column | str, digits: int = 6) -> Column:
    """Rounded, with a negative zero made plain."""
    c = F.col(quoted(c)) if isinstance(c, str) else c
    return F.round(c, digits) + F.lit(0.0)


def plain_names(df: DataFrame) -> DataFrame:
    """Column names without the brackets SQL would have to quote."""
    return df.toDF(*[c.replace("(", "_").replace(")", "").replace("?", "") for c in df.columns])


def machine_events(spark: SparkSession, sf: str) -> DataFrame:
    """``events`` in the role of the raw sensor table: junk text in one sensor,
    gaps in the other and in the machine, unreadable dates now and then."""
    return table(spark, sf, "events").selectExpr(
        "event_id as row_id",
        "case when event_id % 31 = 5 then 'nan' else date_format(ts, 'yyyy-MM-dd') end as Date",
        "date_format(ts, 'HH:mm:ss') as Timestamp",
        "case when event_id % 29 < 2 then null else concat('M', user_id % 6) end as Machine_ID",
        "concat('L', user_id % 3) as Assembly_Line_No",
        f"case when event_id % 13 = 0 then 'bad' else cast(value as string) end as `{TORQUE}`",
        "case when event_id % 17 = 0 then null else get_json_object(props, '$.k') end "
        f"as `{VOLTAGE}`",
        "case event_type when 'error' then 'Machine_Failure' when 'purchase' then 'Planned_Stop' "
        "when 'signup' then 'Power_Failure' when 'view' then 'No_Machine_Failure' "
        "else event_type end as Downtime",
    )


RAW_SQL = """raw as (
  select event_id as row_id, ts,
    case when event_id % 31 = 5 then 'nan' else strftime(ts, '%Y-%m-%d') end as d_text,
    strftime(ts, '%H:%M:%S') as t_text,
    case when event_id % 29 < 2 then null else concat('M', user_id % 6) end as machine,
    concat('L', user_id % 3) as line,
    case when event_id % 13 = 0 then 'bad' else cast(value as varchar) end as torque,
    case when event_id % 17 = 0 then null else json_extract_string(props, '$.k') end as voltage,
    case event_type when 'error' then 'Machine_Failure' when 'purchase' then 'Planned_Stop'
      when 'signup' then 'Power_Failure' when 'view' then 'No_Machine_Failure'
      else event_type end as reason
  from events)"""

# Group of a downtime reason, as far as the test tables use it.
GROUP_SQL = """case reason when 'Machine_Failure' then 'Machine_Issue' when 'Planned_Stop' then 'Operations'
  when 'Power_Failure' then 'Infrastructure' when 'No_Machine_Failure' then 'Normal' else 'Unknown' end"""


def numbers(spark: SparkSession, sf: str) -> DataFrame:
    """``events`` as an ordered table of clean numbers."""
    return table(spark, sf, "events").selectExpr(
        "event_id as row_id",
        "value as s1",
        "cast(get_json_object(props, '$.k') as double) as s2",
        "event_type",
        "user_id",
    )


NUMBERS_SQL = """numbers as (
  select event_id as row_id, value as s1, json_extract_string(props, '$.k')::double as s2,
    event_type, user_id from events)"""


def hash_sql(seed: int, *parts: str) -> str:
    """The stable hash of the library as SQL."""
    text = ", ".join([f"'{seed}'", *[f"cast({p} as varchar)" for p in parts]])
    return f"cast(concat('0x', substr(md5(concat_ws('|', {text})), 1, 15)) as bigint)"
