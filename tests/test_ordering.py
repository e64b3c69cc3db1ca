"""Order-dependent operators: invariant under buckets and partitions, and planned
without a single-task window over the rows."""

import io
from contextlib import redirect_stdout

import pandas as pd
import pytest
from pyspark.sql import functions as F

from linewatch.operators.ordering import (
    carry_fill,
    dense_from,
    dense_index,
    drop_repeats,
    halo_select,
    ordered_index,
    rising_edge,
)
from linewatch.operators.temporal import SensorFit, add_temporal_features, create_future_target, fit_sensors
from linewatch.schema import GROUP, TARGET

N = 300


@pytest.fixture(autouse=True, scope="module")
def compiled(spark):
    """Windows and features are tested as they run: with code generation."""
    keys = {"spark.sql.codegen.wholeStage": "true", "spark.sql.codegen.factoryMode": "FALLBACK"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def frame(spark, parts=4):
    return spark.range(N, numPartitions=parts).selectExpr(
        "id as row_id",
        "case when id % 7 in (2, 3) or id < 12 then null else cast(id * 37 % 101 as double) end as x",
        "case when id % 41 = 40 then concat('t', id) end as t",
        "cast(id * 13 % 5 as int) as Downtime_Group",
    )


def pandas_of(df):
    return df.orderBy("row_id").toPandas()


@pytest.mark.parametrize("bucket_rows", [10, 37, 1000])
@pytest.mark.parametrize("parts", [1, 4, 37])
def test_future_target(spark, bucket_rows, parts):
    got = pandas_of(create_future_target(frame(spark, parts), bucket_rows=bucket_rows))
    want = pandas_of(frame(spark))
    want[TARGET] = want[GROUP].shift(-10)
    want = want.dropna(subset=[TARGET])
    assert list(got[TARGET]) == [int(v) for v in want[TARGET]]
    assert list(got["row_id"]) == list(want["row_id"])


def test_future_target_short_table(spark):
    df = frame(spark).where("row_id < 8")
    got = pandas_of(create_future_target(df))
    assert len(got) == 8 and got[TARGET].isna().all()


@pytest.mark.parametrize("bucket_rows", [7, 1000])
def test_temporal_features(spark, bucket_rows):
    df = frame(spark).withColumnRenamed("x", "Torque(Nm)")
    got = pandas_of(add_temporal_features(df, bucket_rows=bucket_rows))
    want = pandas_of(df)
    x = pd.to_numeric(want["Torque(Nm)"], errors="coerce")
    median = x.median()
    x = x.fillna(median)
    pd.testing.assert_series_equal(got["Torque(Nm)"], x, check_names=False)
    pd.testing.assert_series_equal(got["Torque(Nm)_lag1"], x.shift(1).fillna(median), check_names=False)
    roll = x.rolling(window=5, min_periods=1)
    pd.testing.assert_series_equal(got["Torque(Nm)_mean5"], roll.mean(), check_names=False)
    pd.testing.assert_series_equal(got["Torque(Nm)_std5"], roll.std().fillna(0), check_names=False)
    assert list(got["t"]) == list(want["t"].ffill().bfill().fillna("0"))


def test_temporal_features_with_infinities(spark):
    """Infinities stay in the value and the lag; rolling values leave them out."""
    values = [1.0, 2.0, float("inf"), float("inf"), float("inf"), float("inf"), float("inf"), 4.0]
    df = spark.createDataFrame(list(enumerate(values)), "row_id bigint, `Torque(Nm)` double")
    fit = fit_sensors(df, ["Torque(Nm)"])
    assert fit.infinite == ("Torque(Nm)",)
    got = pandas_of(add_temporal_features(df, fit=fit, bucket_rows=5))
    assert list(got["Torque(Nm)"]) == values
    assert list(got["Torque(Nm)_mean5"]) == [1.0, 1.5, 1.5, 1.5, 1.5, 2.0, 2.0, 4.0]
    assert got["Torque(Nm)_std5"].iloc[-1] == 0.0


def test_all_null_sensor_has_median_zero(spark):
    df = spark.createDataFrame([(0, "bad"), (1, None)], "row_id bigint, `Torque(Nm)` string")
    got = pandas_of(add_temporal_features(df))
    assert list(got["Torque(Nm)"]) == [0.0, 0.0]


@pytest.mark.parametrize("bucket_rows", [3, 50, 10_000])
def test_carry_fill_across_empty_buckets(spark, bucket_rows):
    gappy = frame(spark).where("row_id < 20 or row_id > 190")
    got = pandas_of(carry_fill(gappy.withColumn("none", F.lit(None).cast("double")), bucket_rows=bucket_rows))
    want = pandas_of(gappy).ffill().bfill()
    assert list(got["x"]) == list(want["x"])
    assert list(got["t"]) == list(want["t"])
    assert list(got["none"]) == [0.0] * len(want)


@pytest.mark.parametrize("bucket_rows", [3, 10_000])
def test_dense_index(spark, bucket_rows):
    gappy = frame(spark).where("row_id % 3 = 1 and not row_id between 50 and 150")
    got = pandas_of(dense_index(gappy, bucket_rows=bucket_rows))
    assert list(got["dense_id"]) == list(range(len(got)))


def test_dense_index_with_null_group(spark):
    df = frame(spark).selectExpr("row_id", "case when row_id % 3 = 0 then null else row_id % 3 end as g")
    got = dense_index(df, by=["g"], bucket_rows=20).toPandas()
    for _, rows in got.groupby("g", dropna=False):
        assert sorted(rows["dense_id"]) == list(range(len(rows)))


def test_short_bucket_is_refused(spark):
    with pytest.raises(ValueError):
        halo_select(frame(spark), lambda w: ["*"], 0, 10, bucket_rows=5)
    assert halo_select(frame(spark), lambda w: ["*"], 0, 10, bucket_rows=50).columns == frame(spark).columns


def test_rising_edge_and_repeats(spark):
    df = spark.range(40).selectExpr("id as row_id", "id % 6 < 3 as f", "id div 4 as s")
    got = pandas_of(rising_edge(df, "f", "new", bucket_rows=4))
    assert list(got[got["new"]]["row_id"]) == list(range(0, 40, 6))
    kept = pandas_of(drop_repeats(df, "s", bucket_rows=3))
    assert list(kept["row_id"]) == list(range(0, 40, 4))


@pytest.mark.parametrize("bucket_rows", [12, 50, 10_000])
@pytest.mark.parametrize("rows", ["row_id % 3 = 0", "row_id % 90 < 25", "row_id < 15 or row_id > 260", "row_id > 7"])
def test_gaps_lose_no_rows(spark, bucket_rows, rows):
    df = frame(spark).where(rows)
    got = pandas_of(create_future_target(df, bucket_rows=bucket_rows))
    want = pandas_of(df)
    want[TARGET] = want[GROUP].shift(-10)
    want = want.dropna(subset=[TARGET])
    assert list(got["row_id"]) == list(want["row_id"]) and list(got[TARGET]) == [int(v) for v in want[TARGET]]
    flagged = df.selectExpr("row_id", "Downtime_Group > 2 as f", "Downtime_Group div 2 as s")
    plain = pandas_of(flagged)
    edge = pandas_of(rising_edge(flagged, "f", "new", bucket_rows=bucket_rows))
    assert list(edge["new"]) == list(plain["f"] & ~plain["f"].shift(1, fill_value=False))
    kept = pandas_of(drop_repeats(flagged, "s", bucket_rows=bucket_rows))
    assert list(kept["row_id"]) == list(plain[plain["s"] != plain["s"].shift(1)]["row_id"])


def test_dense_claims_are_checked(spark):
    df = spark.range(20).selectExpr("id as row_id", "id % 2 as g", "id % 3 = 0 as f")
    assert dense_from(df) == 0 and dense_from(df.where("row_id > 4")) == 5
    assert dense_from(df.where("row_id <> 4")) is None
    doubled = df.where("row_id <> 4").unionByName(df.where("row_id = 5"))
    assert dense_from(doubled) is None
    for wrong, by in ((df.where("row_id <> 4"), []), (doubled, []), (df, ["g"])):
        with pytest.raises(ValueError):
            rising_edge(wrong, "f", "new", by=by, dense=True)


@pytest.mark.parametrize("bucket_rows", [5, 10_000])
def test_fill_stays_within_a_group(spark, bucket_rows):
    df = frame(spark).where("row_id % 4 <> 1").selectExpr("row_id", "case when row_id % 5 = 0 then null else row_id % 3 end as g", "x", "t")
    got = pandas_of(carry_fill(df, ["x", "t"], bucket_rows=bucket_rows, by=["g"]))
    want = pandas_of(df)
    for c, none in (("x", 0.0), ("t", "0")):
        groups = want.groupby("g", dropna=False)[c]
        filled = groups.ffill()
        filled = filled.where(filled.notna(), want.assign(v=filled).groupby("g", dropna=False)["v"].bfill())
        assert list(got[c]) == list(filled.fillna(none))


def plan_of(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_windows_run_in_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    frame(spark).withColumnRenamed("x", "Torque(Nm)").write.parquet(path)
    df = spark.read.parquet(path)
    plans = [
        plan_of(create_future_target(df)),
        plan_of(add_temporal_features(df.drop("t", GROUP), fit=SensorFit({"Torque(Nm)": 0.0}))),
    ]
    for plan in plans:
        assert "SinglePartition" not in plan
        assert plan.count("Exchange hashpartitioning") == 1
        assert "unboundedfollowing" not in plan
        assert "Python" not in plan
    # The fill scans one row per bucket group in one task, and no table row.
    filled = plan_of(carry_fill(df))
    assert filled.count("Exchange SinglePartition") == 1


def test_scan_reads_only_what_is_used(spark, tmp_path):
    path = str(tmp_path / "t")
    frame(spark).write.parquet(path)
    plan = plan_of(create_future_target(spark.read.parquet(path)).select("row_id", TARGET))
    assert "ReadSchema: struct<row_id:bigint,Downtime_Group:int>" in plan


@pytest.mark.parametrize("rows_per_part", [40, 1_000])
def test_ordered_index_with_a_known_number_of_rows(spark, rows_per_part):
    """One part is numbered by a window, several as ever; nulls come first in both."""
    df = spark.range(N).selectExpr("id", "if(id % 9 = 0, null, id % 5) as a", "cast(id * 7 % 300 as string) as b")
    got = ordered_index(df, ["a", "b"], "at", rows_per_part, rows=N).orderBy("at").collect()
    assert [r["at"] for r in got] == list(range(N)) and got[0].asDict().keys() == {"id", "a", "b", "at"}
    key = lambda r: (r.a is not None, r.a or 0, r.b)
    assert [key(r) for r in got] == sorted(map(key, df.collect()))
