"""Edge cases of the row-wise operators, statistics and encoders."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from linewatch.functions.labels import class_probabilities, downtime_group, label_name
from linewatch.functions.numbers import finite_or_zero, number_of, unit_hash
from linewatch.functions.times import parse_clock, parse_mixed_date
from linewatch.operators.anomaly import AnomalyModel, fit_mahalanobis, mahalanobis_distance
from linewatch.operators.calendar import add_calendar_features, reconstruct_datetime
from linewatch.operators.columns import align, drop_unused
from linewatch.operators.encode import Scaler, fit_one_hot, label_encode, one_hot
from linewatch.operators.evaluate import classification_report, confusion, macro_recall
from linewatch.operators.quantiles import exact_percentiles, medians
from linewatch.operators.sketches import merge_sketches, percentile_sketches, rank_error, sketched_percentiles
from linewatch.operators.moments import CoMoments, co_moments, merged
from linewatch.operators.split import raw_split_point, sample_rows, stratified_folds
from linewatch.operators.split import test_split_point as split_point
from linewatch.operators.stats import fit_scaler, mean_and_covariance, reference_statistics
from linewatch.plans.features import serving_features
from linewatch.session import run_dir

DATES = [
    ("1/5/2024", "2024-01-05"),
    ("31/12/2024", None),
    ("2024-1-5", "2024-01-05"),
    ("05-01-2024", "2024-01-05"),
    ("2024-01-05 10:00:00", "2024-01-05"),
    ("05/01/2024 10:00", "2024-05-01"),
    ("31/12/2024 10:00", "2024-12-31"),
    (" NaN ", None),
    ("None", None),
    ("NULL", None),
    ("", None),
    ("   ", None),
    (None, None),
    ("20240105", "2024-01-05"),
    ("5 Jan 2024", "2024-01-05"),
    ("2024-13-01", None),
    ("05-13-2024", None),
    ("soon", None),
    ("2024-01", None),
]


def test_parse_mixed_date(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(DATES)], "i int, t string")
    got = df.select("i", F.date_format(parse_mixed_date(F.col("t")), "yyyy-MM-dd").alias("d")).orderBy("i")
    assert [r.d for r in got.collect()] == [d for _, d in DATES]


def test_parse_clock(spark):
    texts = ["10:20:30", "1:2:3", "24:00:00", "10:20", "x", None, "23:59:59"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.s for r in df.select("i", parse_clock(F.col("t")).alias("s")).orderBy("i").collect()]
    assert got == [37230, 3723, None, None, None, None, 86399]


def test_no_valid_date_keeps_all_rows(spark):
    df = spark.createDataFrame([("x", "10:00:00"), ("y", "z")], "Date string, Timestamp string")
    got = add_calendar_features(reconstruct_datetime(df)).collect()
    assert [tuple(r) for r in got] == [(12, 1, 1, 0)] * 2


def test_weekend(spark):
    df = spark.createDataFrame([("2024-01-06", "10:00:00"), ("2024-01-08", "10:00:00")], "Date string, Timestamp string")
    got = add_calendar_features(reconstruct_datetime(df)).orderBy("dayofweek").collect()
    assert [tuple(r) for r in got] == [(10, 0, 1, 0), (10, 5, 1, 1)]


def test_numbers(spark):
    texts = ["1.5", "bad", "nan", None, "inf", " -2e3 ", ".5", "5.", "1d", "0x10", "", "-Infinity", "1 2"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.x for r in df.select(number_of(df, "t").alias("x")).collect()]
    assert got == [1.5, None, None, None, math.inf, -2000.0, 0.5, 5.0, None, None, None, -math.inf, None]
    clean = df.select(finite_or_zero(number_of(df, "t")).alias("x"))
    assert [r.x for r in clean.collect()][:6] == [1.5, 0, 0, 0, 0, -2000.0]
    doubles = spark.createDataFrame([(1.0,), (math.nan,)], "x double")
    assert [r.x for r in doubles.select(number_of(doubles, "x").alias("x")).collect()] == [1.0, None]


def test_groups_and_names(spark):
    df = spark.createDataFrame([("Tool_Wear", 0), ("Material_Shortage", 9), (None, -1)], "d string, i int")
    got = df.select(downtime_group(F.col("d")).alias("g"), label_name(F.col("i"), ["a", "b"]).alias("n")).collect()
    assert [tuple(r) for r in got] == [
        ("Machine_Issue", "a"),
        ("Operations", "Unknown_Class_9"),
        ("Unknown", "Unknown_Class_-1"),
    ]
    p = spark.range(1).select(class_probabilities(F.array(F.lit(0.2), F.lit(0.8)), ["a"], 2).alias("p")).first().p
    assert p == {"a": 0.2, "Class_1": 0.8}


def test_align_and_unknown_category(spark):
    df = spark.createDataFrame([("M1", 1.0), ("M2", 2.0), (None, 3.0)], "Machine_ID string, x double")
    fitted = fit_one_hot(df, ["Machine_ID", "Assembly_Line_No"])
    assert fitted == {"Machine_ID": ["M1", "M2", "nan"]}
    new = spark.createDataFrame([("M9", 1.0)], "Machine_ID string, x double")
    row = align(one_hot(new, fitted), ["Machine_ID_M1", "Machine_ID_M2", "gone", "x"]).first()
    assert tuple(row) == (0.0, 0.0, 0.0, 1.0)
    assert drop_unused(new, ["x", "y"]).columns == ["Machine_ID"]


def test_missing_target_is_an_error(spark):
    with pytest.raises(ValueError):
        label_encode(spark.range(1), "Downtime_Group")


def test_many_categories(spark):
    """Any number of values, as a table and as one sparse vector."""
    from linewatch.operators.encode import encode_categories, fit_categories

    df = spark.range(60_000).selectExpr(
        "id as row_id", "concat('M', id % 50000) as Machine_ID", "case when id % 3 = 0 then null else concat('L', id % 3) end as Assembly_Line_No"
    )
    fitted = fit_categories(df)
    assert fitted.sizes == {"Machine_ID": 50_000, "Assembly_Line_No": 3}
    out = encode_categories(df, fitted, keep=True)
    rows = out.where("row_id % 20000 = 7").collect()
    assert {r.categories.size for r in rows} == {50_003} and {r.categories.numNonzeros() for r in rows} == {2}
    by_machine = {r.Machine_ID: int(r.categories.indices[0]) for r in rows}
    positions = {r.value: r.position for r in fitted.values.where("name = 'Machine_ID'").collect()}
    assert sorted(positions.values()) == list(range(50_000))
    assert all(positions[m] == at for m, at in by_machine.items())
    new = spark.createDataFrame([("M1", "L7")], "Machine_ID string, Assembly_Line_No string")
    assert encode_categories(new, fitted).first().categories.numNonzeros() == 1
    assert encode_categories(df, fitted).columns == ["row_id", "categories"]


def test_recorded_counts():
    """The row arithmetic of the recorded run."""
    assert raw_split_point(500_000) == 425_000
    assert split_point(424_990) == 361_241
    assert 424_990 - 361_241 == 63_749


def test_scaler_on_constant(spark):
    df = spark.range(100).selectExpr("cast(id as double) as x", "7.0D as c")
    scaler = Scaler.fit(df, ["x", "c"])
    rows = scaler.transform(df).toPandas()
    assert abs(rows["x"].std(ddof=0) - 1) < 1e-12 and (rows["c"] == 0).all()
    other = scaler.transform(spark.createDataFrame([(0.0, 9.0)], "x double, c double")).first()
    assert other.c == 2.0


def test_reference_statistics_without_finite_values(spark):
    df = spark.createDataFrame([(math.nan, 1.0), (math.inf, 1.0)], "a double, b double")
    got = {r.feature: tuple(r)[1:] for r in reference_statistics(df, ["a", "b"]).collect()}
    assert got["a"] == (0.0, 1.0, 0.0, 1.0, 0)
    assert got["b"] == (1.0, 1e-6, 1.0, 1.0, 2)


@pytest.mark.parametrize("share", [0.0, 0.25, 0.5, 0.99, 1.0])
def test_percentiles_by_narrowing(spark, share):
    """The narrowing search equals numpy, also on few, heavily repeated values."""
    rng = np.random.default_rng(7)
    data = {
        "a": rng.normal(size=4000),
        "b": np.repeat([1.0, 2.0], 2000),
        "c": np.concatenate([np.zeros(2600), rng.exponential(size=1400) * 1e6]),
        "d": np.arange(4000) % 5.0,
    }
    rows = [tuple(float(v[i]) for v in data.values()) for i in range(4000)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(4)
    got = exact_percentiles(df, list(data), share, exact_rows=50, accuracy=100)
    for name, values in data.items():
        assert got[name] == pytest.approx(np.percentile(values, 100 * share), rel=1e-12, abs=1e-12)


def test_covariance_and_mahalanobis(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 12)) @ rng.normal(size=(12, 12))
    x[:, 11] = 4.0
    names = [f"s.{i}(x)" for i in range(12)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"`{n}` double" for n in names))
    mean, cov = mean_and_covariance(df, names)
    assert np.allclose(mean, x.mean(axis=0)) and np.allclose(cov, np.cov(x, rowvar=False))
    model = fit_mahalanobis(df, names)
    inv = np.linalg.pinv(np.cov(x, rowvar=False))
    centred = x - x.mean(axis=0)
    want = np.sum(centred @ inv * centred, axis=1)
    assert model.threshold == pytest.approx(np.percentile(want, 99))
    columns = [F.col(f"`{n}`") for n in names]
    got = df.select(model.distance(columns).alias("d")).toPandas()["d"]
    assert np.allclose(sorted(got), sorted(want))
    flags = df.select(model.is_anomalous(columns).alias("f")).toPandas()["f"]
    assert flags.sum() == (want > np.percentile(want, 99)).sum()


def test_moments_merge_in_any_order(spark):
    """Far from zero, over empty and tiny parts, with rows that are not complete; a model of merged parts is that of the whole."""
    rng = np.random.default_rng(4)
    x = 1e6 + rng.normal(size=(300, 4)) @ rng.normal(size=(4, 4))
    rows = [(i, *map(float, r)) for i, r in enumerate(x)] + [(1000, None, 1.0, 1.0, 1.0), (1001, 1.0, float("nan"), 1.0, 1.0), (1002, 1.0, 1.0, float("inf"), 1.0)]
    df = spark.createDataFrame(rows, "id bigint, a double, b double, c double, d double").repartition(9)
    whole = co_moments(df, list("abcd"))
    assert whole.n == 300 and np.allclose(whole.covariance(), np.cov(x, rowvar=False), rtol=1e-7)
    parts = [co_moments(df.where(c), list("abcd")) for c in ("id < 1", "id >= 1 and id < 200", "id >= 200", "id < 0")]
    assert [p.n for p in parts] == [1, 199, 100, 0]
    for order in ((0, 1, 2, 3), (3, 2, 1, 0), (1, 3, 0, 2)):
        both = merged([CoMoments.from_json(parts[i].to_json()) for i in order], 4)
        assert both.n == 300 and np.allclose(both.mean, x.mean(axis=0)) and np.allclose(both.covariance(), whole.covariance(), rtol=1e-7)
    again = fit_mahalanobis(df, list("abcd"), moments=both)
    assert again.threshold == pytest.approx(fit_mahalanobis(df, list("abcd")).threshold, rel=1e-5)
    assert merged([], 2).covariance() == [[0.0, 0.0], [0.0, 0.0]] and parts[0].covariance() == [[0.0] * 4] * 4


def test_sketches_keep_their_rank_error(spark):
    """Ranks within the stated error, twice; merged from parts, with nulls, text that is no number, and a column without numbers."""
    rng = np.random.default_rng(5)
    values = {"even": rng.random(4000), "skewed": rng.exponential(1, 4000) ** 4, "few": rng.integers(0, 3, 4000).astype(float)}
    frame = pd.DataFrame(values).assign(id=np.arange(4000))
    df = spark.createDataFrame(frame).selectExpr("*", "if(id % 2 = 0, 'bad', cast(even as string)) as text", "cast(null as double) as none", "if(id % 3 = 0, double('NaN'), even) as holes")
    names = ["even", "skewed", "few", "text", "none", "holes"]
    parts = [percentile_sketches(df.where(f"id % 3 = {p}"), names, 400) for p in range(3)]
    whole = merge_sketches(*parts)
    held = df.toPandas()
    for share in (0.01, 0.5, 0.99):
        got = sketched_percentiles(whole, share)
        assert got["none"] is None
        for c in names[:4] + ["holes"]:
            x = pd.to_numeric(held[c], errors="coerce").dropna().to_numpy()
            assert (x < got[c]).mean() - 2 * rank_error(400) <= share <= (x <= got[c]).mean() + 2 * rank_error(400)
    near = medians(df, ["even", "none"], approximate=800)
    assert near["none"] == 0 and abs(near["even"] - 0.5) < 0.05
    exact, rough = fit_mahalanobis(df, ["even", "skewed"]), fit_mahalanobis(df, ["even", "skewed"], approximate=800)
    assert exact.mean == rough.mean and 0.5 * exact.threshold < rough.threshold < 2 * exact.threshold


def test_one_scan_before_the_distances(spark):
    df = spark.range(1000).selectExpr("cast(id as double) as a", "cast(id % 7 as double) as b")
    path = run_dir(spark, "scanned")
    df.write.parquet(path)
    done = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("moments", "")
    try:
        co_moments(spark.read.schema(df.schema).parquet(path), ["a", "b"])
        jobs = done.getJobIdsForGroup("moments")
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert 1 <= len(jobs) <= 2


def test_distance_needs_the_right_width(spark):
    with pytest.raises(ValueError):
        mahalanobis_distance([F.lit(1.0)], AnomalyModel([0.0, 0.0], [[1.0, 0.0], [0.0, 1.0]]))


def test_report_with_empty_classes(spark):
    pairs = [(0, 0)] * 8 + [(0, 2)] * 2 + [(1, 0)] * 5 + [(3, 3)] * 5
    counts = confusion(spark.createDataFrame(pairs, "label int, prediction int"))
    rows = {r.class_name: r for r in classification_report(counts).collect()}
    assert rows["0"].recall == 0.8 and rows["0"].precision == pytest.approx(8 / 13)
    assert (rows["1"].precision, rows["1"].recall, rows["1"].f1, rows["1"].support) == (0, 0, 0, 5)
    assert rows["2"].support == 0
    assert rows["accuracy"].f1 == pytest.approx(13 / 20)
    assert macro_recall(counts).first()[0] == pytest.approx((0.8 + 0 + 0 + 1) / 4)


def test_sample_and_folds(spark):
    df = spark.range(5000).selectExpr("id as row_id", "case when id % 10 = 0 then 'a' else 'b' end as c")
    taken = [r.row_id for r in sample_rows(df).collect()]
    assert len(set(taken)) == 1000 and taken != sorted(taken)
    assert {r.row_id for r in sample_rows(df.repartition(7)).collect()} == set(taken)
    folds = stratified_folds(df, "c", bucket_rows=300).groupBy("c", "fold").count().collect()
    assert sorted((r["c"], r["count"]) for r in folds) == [
        ("a", 166), ("a", 167), ("a", 167), ("b", 1500), ("b", 1500), ("b", 1500)
    ]


def test_unit_hash_is_even(spark):
    u = spark.range(4000).select(unit_hash(F.col("id"), seed=5).alias("u")).toPandas()["u"]
    assert 0 <= u.min() and u.max() < 1 and abs(u.mean() - 0.5) < 0.02


def test_serving_row_alone(spark):
    df = spark.createDataFrame(
        [("7", "5.5", None, "inf", "M1")],
        "row_id string, `Torque(Nm)` string, `Voltage(volts)` string, `Cutting(kN)` string, Machine_ID string",
    )
    wanted = [
        "row_id", "hour", "Torque(Nm)", "Torque(Nm)_lag1", "Torque(Nm)_mean5", "Torque(Nm)_std5",
        "Voltage(volts)", "Voltage(volts)_lag1", "Cutting(kN)", "Cutting(kN)_mean5", "Machine_ID_M1", "Machine_ID_M2",
    ]
    sensors = ["Torque(Nm)", "Voltage(volts)", "Cutting(kN)"]
    row = serving_features(df, sensors, {"Machine_ID": ["M1", "M2"]}, wanted).first()
    assert tuple(row) == (7.0, 12.0, 5.5, 5.5, 5.5, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0)


def test_stored_tables_lie_in_one_folder_and_can_go(spark):
    from linewatch.session import materialise, run_dir

    table = materialise(spark, spark.range(3), "t")
    folder = run_dir(spark, "x").rsplit("/", 1)[0]
    assert all(f.startswith(folder.replace("file:", "file://")) for f in table.inputFiles())
    assert spark.sparkContext.applicationId in folder


def test_statistics_of_many_features_are_one_narrow_aggregate(spark):
    names = [f"f({i})" for i in range(40)]
    df = spark.range(5).select(*[F.when(F.col("id") < 4, F.col("id") * i).cast("double").alias(n) for i, n in enumerate(names)])
    for made in (fit_scaler(df, names), reference_statistics(df, names)):
        assert made._jdf.queryExecution().optimizedPlan().toString().count("stddev_pop(") == 1
        rows = {r.feature: r for r in made.collect()}
        assert len(rows) == 40 and all(rows[n].mean == 1.5 * i for i, n in enumerate(names))
        assert all(abs(rows[n].std - max(1.25**0.5 * i, 1e-6)) < 1e-9 or i == 0 for i, n in enumerate(names))
    assert [tuple(r)[1:] for r in fit_scaler(df.where("false"), names[:2]).collect()] == [(None, None)] * 2
    assert [tuple(r)[1:] for r in reference_statistics(df.where("false"), names[:2]).collect()] == [(0.0, 1.0, 0.0, 1.0, 0)] * 2
