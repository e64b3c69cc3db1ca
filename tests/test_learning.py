"""Neighbours, resampling, classifiers, and the whole training job."""

from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from linewatch.config import Settings
from linewatch.operators import neighbours, pivots, softmax_trees
from linewatch.operators.neighbours import nearest_neighbours
from linewatch.operators.resample import neighbour_count, smote
from linewatch.operators.split import split_at
from linewatch.operators.train import assemble, boosted_trees, grid_search, predict
from linewatch.plans.features import feature_table
from linewatch.plans.training import training_job
from linewatch.schema import CATEGORIES, SENSORS, TARGET
from linewatch.session import run_dir
from linewatch.sources.bundle import load_bundle, save_bundle
from linewatch.sources.messages import to_messages
from linewatch.streaming.score import predictions, score


def brute_force(points, k):
    d2 = ((points[:, None, :] - points[None, :, :]) ** 2).sum(axis=2)
    np.fill_diagonal(d2, np.inf)
    return np.sort(d2, axis=1)[:, :k]


@pytest.mark.parametrize("chunk_rows", [16, 2048])
def test_nearest_neighbours_are_exact(spark, chunk_rows):
    """Clusters, outliers, and many copies of one row, in small chunks."""
    rng = np.random.default_rng(11)
    parts = [
        rng.normal(0, 1, (120, 3)),
        rng.normal(50, 0.1, (60, 3)),
        rng.exponential(1000, (10, 3)),
        np.tile([7.0, 7.0, 7.0], (70, 1)),
    ]
    points = np.concatenate(parts)
    rows = [("a", i, *map(float, p)) for i, p in enumerate(points)]
    rows += [("b", i, *map(float, p)) for i, p in enumerate(points[:9])]
    df = spark.createDataFrame(rows, "label string, id bigint, x double, y double, z double").repartition(5)
    found = nearest_neighbours(df, ["x", "y", "z"], 5, chunk_rows=chunk_rows).toPandas()
    for label, own in (("a", points), ("b", points[:9])):
        mine = found[found["label"] == label].sort_values(["id", "rank"])
        assert (mine["neighbour"] != mine["id"]).all()
        assert (mine.groupby("id")["neighbour"].nunique() == 5).all()
        assert np.allclose(mine["d2"].to_numpy().reshape(len(own), 5), brute_force(own, 5))


def test_nearest_neighbours_store_a_row_for_each_search(spark, monkeypatch):
    """No row for each neighbour, and no row with all bounds of its class; rows alone in the tail look through their segment first."""
    stored = {}

    def materialise(spark, df, name):
        made = original(spark, df, name)
        stored.setdefault(name, []).append(made)
        return made

    original = neighbours.materialise
    monkeypatch.setattr(neighbours, "materialise", materialise)
    rng = np.random.default_rng(3)
    points = np.concatenate([rng.normal(0, 1, (3000, 2)), rng.normal(0, 1, (40, 2)) ** 3 * 1e4])
    df = spark.createDataFrame([("a", i, *map(float, p)) for i, p in enumerate(points)], "label string, id bigint, x double, y double")
    found = nearest_neighbours(df, ["x", "y"], 5, chunk_rows=16).toPandas().sort_values(["id", "rank"])
    assert np.allclose(found["d2"].to_numpy().reshape(-1, 5), brute_force(points, 5))
    assert stored["nearest"][0].count() == len(points)
    assert "bounds" not in stored["cells"][0].columns
    again = stored["again"][0]
    assert 0 < again.count() < 100 and again.where("size(found) < 5").isEmpty()


def recall(found, points, k):
    d2 = (points**2).sum(1)[:, None] + (points**2).sum(1)[None, :] - 2 * points @ points.T
    np.fill_diagonal(d2, np.inf)
    true = np.argsort(d2, axis=1)[:, :k]
    mine = found.sort_values(["id", "rank"])["neighbour"].to_numpy().reshape(len(points), k)
    return np.mean([len(set(a) & set(b)) / k for a, b in zip(true, mine)])


def points_table(spark, points, label="a"):
    """Through a file of its own form: as many rows as the searches are made for."""
    frame = pd.DataFrame(points, columns=[f"f{i}" for i in range(points.shape[1])])
    return spark.createDataFrame(frame.assign(id=np.arange(len(points)), label=label)), list(frame.columns)


@pytest.mark.parametrize(("rows", "cell_rows", "least"), [(20_000, 800, 0.9), (3_000, pivots.CELL_ROWS, 1.0)])
def test_near_neighbours_recall(spark, monkeypatch, rows, cell_rows, least):
    """62 Gaussian features, which no cut can keep together: exact where a class has no more cells than a row may visit; with 25 cells, which are as many as
    200,000 rows have at the default size, 16 of them are enough."""
    met = []
    rng = np.random.default_rng(3)
    points = rng.normal(size=(rows, 62))
    df, names = points_table(spark, points)
    visits = pivots._other_cells

    def counted(asking, chunked, k, width):
        met.append(asking.count())
        return visits(asking, chunked, k, width)

    monkeypatch.setattr(pivots, "_other_cells", counted)
    found = pivots.near_neighbours(df, names, 5, chunk_rows=cell_rows).toPandas()
    assert (found.groupby("id").size() == 5).all() and (found["neighbour"] != found["id"]).all()
    assert recall(found, points, 5) >= least
    assert sum(met) <= (pivots.PROBES - 1) * len(points)


def test_near_neighbours_rule_out_cells(spark, monkeypatch):
    """Clusters far apart: rows visit no other cluster, and all is exact."""
    rng = np.random.default_rng(4)
    points = np.concatenate([rng.normal(size=(300, 8)) + 1000 * rng.normal(size=8) for _ in range(6)])
    df, names = points_table(spark, points)
    met = []
    visits = pivots._other_cells
    monkeypatch.setattr(pivots, "_other_cells", lambda asking, *a: met.append(asking.count()) or visits(asking, *a))
    found = pivots.near_neighbours(df, names, 3, chunk_rows=300).toPandas().sort_values(["id", "rank"])
    assert np.allclose(found["d2"].to_numpy().reshape(-1, 3), brute_force(points, 3))
    assert met[0] < 2 * len(points)


def test_near_neighbours_odd_rows(spark):
    """Copies, outliers, rare classes, rows that are not complete, and classes of one row."""
    rng = np.random.default_rng(6)
    points = np.concatenate([rng.normal(size=(200, 3)), np.tile([5.0, 5, 5], (150, 1)), [[1e7, 0, 0], [np.nan, 1, 1], [1, np.inf, 1]]])
    rows = [("a", i, *map(float, p)) for i, p in enumerate(points)] + [("a", 900, None, 1.0, 1.0)]
    rows += [("b", i, float(i), 0.0, 0.0) for i in range(4)] + [("c", 0, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "label string, id bigint, f0 double, f1 double, f2 double")
    found = pivots.near_neighbours(df, ["f0", "f1", "f2"], 3, chunk_rows=40).toPandas().sort_values(["id", "rank"])
    mine = found[found["label"] == "a"]
    assert sorted(mine["id"].unique()) == list(range(351))
    best = brute_force(points[:351], 3)
    got = mine["d2"].to_numpy().reshape(-1, 3)
    assert (got >= best - 1e-9).all() and np.allclose(got[200:350], 0) and np.median(got[:200] / best[:200]) < 1.01
    assert found[(found["label"] == "b") & (found["id"] == 0)]["neighbour"].tolist() == [1, 2, 3]
    assert "c" not in set(found["label"])
    assert pivots.near_neighbours(df.limit(0), ["f0", "f1", "f2"], 3).count() == 0


def test_compare_against_brute_force():
    rng = np.random.default_rng(8)
    b = np.round(rng.normal(size=(700, 4)), 1) + 1e6
    for k in (1, 3, 9):
        row, col, d2 = pivots.compare(b, b, k, np.arange(len(b)))
        full = ((b[:, None, :] - b[None, :, :]) ** 2).sum(-1)
        np.fill_diagonal(full, np.inf)
        want = np.argsort(full, axis=1, kind="stable")[:, :k]
        assert (row.reshape(-1, k) == np.arange(len(b))[:, None]).all()
        assert np.allclose(d2.reshape(-1, k), np.take_along_axis(full, want, 1))
        assert (col.reshape(-1, k) == want).mean() > 0.99
    row, _, _ = pivots.compare(b[:3], b[:2], 5, np.array([0, 1, 0]))
    assert row.tolist() == [0, 1, 2]


def test_neighbour_count():
    assert [neighbour_count(n) for n in (100, 6, 3, 1)] == [5, 5, 2, 1]


def classes(spark, sizes):
    rng = np.random.default_rng(2)
    rows = []
    for c, n in sizes.items():
        rows += [(c, *map(float, p)) for p in rng.normal(c * 10, 1, (n, 2))]
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row_id bigint, label int, x double, y double")


def test_smote_balances_on_segments(spark):
    df = classes(spark, {0: 90, 1: 30, 2: 6})
    grown = smote(df, ["x", "y"], "label").toPandas()
    assert grown.groupby("label").size().to_dict() == {0: 90, 1: 90, 2: 90}
    assert (~grown["synthetic"]).sum() == 126
    own = df.toPandas()
    for label in (1, 2):
        points = own[own["label"] == label][["x", "y"]].to_numpy()
        for made in grown[(grown["label"] == label) & grown["synthetic"]][["x", "y"]].to_numpy():
            a, b = points[:, None, :], points[None, :, :]
            off = np.linalg.norm(made - a, axis=2) + np.linalg.norm(made - b, axis=2) - np.linalg.norm(a - b, axis=2)
            assert off.min() < 1e-9
    again = smote(df.repartition(9), ["x", "y"], "label").toPandas()
    key = ["label", "x", "y"]
    assert np.allclose(again.sort_values(key)[key], grown.sort_values(key)[key])


def test_smote_loses_no_draw(spark):
    """Rare classes beside a growing one of many chunks, with an outlier in each: every draw is made."""
    rng = np.random.default_rng(5)
    rows = []
    for c, n in {0: 1500, 1: 1400, 2: 60, 3: 12}.items():
        points = rng.normal(c * 10, 1, (n, 3))
        points[-1] = 1e6
        rows += [(c, *map(float, p)) for p in points]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row_id bigint, label int, x double, y double, z double")
    grown = smote(df, ["x", "y", "z"], "label", chunk_rows=16)
    made = grown.groupBy("label").agg(F.count("*").alias("n"), F.count_distinct("draw").alias("draws")).collect()
    assert {r.label: (r.n, r.draws) for r in made} == {0: (1500, 0), 1: (1500, 100), 2: (1500, 1440), 3: (1500, 1488)}


@pytest.mark.parametrize("exact", [False, True])
def test_smote_with_incomplete_rows(spark, exact):
    """Rows with a null, NaN or infinite feature stay and count in their class, and no synthetic row is made from them."""
    rng = np.random.default_rng(7)
    rows = []
    for c, n in {0: 80, 1: 40, 2: 9}.items():
        rows += [(c, *map(float, p)) for p in rng.normal(c * 10, 1, (n, 2))]
    rows += [(1, None, 1.0), (1, float("nan"), 1.0), (1, 2.0, float("inf")), (0, None, None), (2, None, 3.0), (None, 1.0, 1.0)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row_id bigint, label int, x double, y double")
    grown = smote(df, ["x", "y"], "label", exact=exact).toPandas()
    assert grown.groupby("label").size().to_dict() == {0: 81, 1: 81, 2: 81}
    made = grown[grown["synthetic"]]
    assert np.isfinite(made[["x", "y"]].to_numpy()).all() and (~grown["synthetic"]).sum() == len(rows)
    # Too few complete rows: as it is.
    few = spark.createDataFrame([(i, i % 2, float(i) if i % 2 == 0 or i < 4 else None) for i in range(30)] + [(99, 0, 1.0)], "row_id bigint, label int, x double")
    assert smote(few, ["x"], "label", exact=exact).count() == 31


def test_smote_leaves_tiny_classes_alone(spark):
    df = classes(spark, {0: 20, 1: 5, 2: 1})
    assert smote(df, ["x", "y"], "label").count() == 26


def plain_boosting(x, label, classes, rounds, depth, rate=0.1, ridge=1.0, least=1.0):
    """Softmax boosting row by row and cut by cut, with the values of the features as bins: the margins of the rows."""
    margins = np.zeros((len(x), classes))

    def grow(rows, level, g, h, out):
        G, H = g[rows].sum(), h[rows].sum()
        best = (1e-6, None, None)
        for f in range(x.shape[1]) if level < depth else ():
            for edge in np.unique(x[rows, f])[:-1]:
                left = x[rows, f] <= edge
                a, b = rows[left], rows[~left]
                if min(h[a].sum(), h[b].sum()) >= least:
                    gain = g[a].sum() ** 2 / (h[a].sum() + ridge) + g[b].sum() ** 2 / (h[b].sum() + ridge) - G**2 / (H + ridge)
                    if gain > best[0] + 1e-9 * (1 + abs(gain)):
                        best = (gain, a, b)
        if best[1] is None:
            out[rows] -= rate * G / (H + ridge)
        else:
            for part in best[1:]:
                grow(part, level + 1, g, h, out)

    for _ in range(rounds):
        p = np.exp(margins) / np.exp(margins).sum(axis=1, keepdims=True)
        step = np.zeros_like(margins)
        for c in range(classes):
            grow(np.arange(len(x)), 0, p[:, c] - (label == c), 2 * p[:, c] * (1 - p[:, c]), step[:, c])
        margins += step
    return margins


@pytest.fixture(scope="module")
def three_classes(spark):
    rng = np.random.default_rng(12)
    x = rng.integers(0, 9, (600, 4)).astype(float)
    label = (x[:, 0] > 4).astype(int) + ((x[:, 1] + x[:, 2] > 8) & (rng.random(600) < 0.9))
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abcd")).assign(label=label, row_id=np.arange(600))).repartition(3)
    return x, label, df, plain_boosting(x, label, 3, 4, 3)


@pytest.mark.parametrize("local_cells", [4_000_000, 800, 1])
def test_softmax_trees_against_plain(spark, three_classes, local_cells):
    """As one task, level by level with small nodes finished alone, and level by level to the end."""
    x, label, df, want = three_classes
    model = softmax_trees.softmax_trees(df, list("abcd"), "label", 3, 4, softmax_trees.Shape(depth=3), local_cells=local_cells)
    assert np.allclose(model.margins(x), want, atol=1e-9)
    if local_cells == 1:
        path = run_dir(spark, "model")
        model.save(spark, path)
        again = softmax_trees.SoftmaxTrees.load(spark, path)
        out = predict(again, assemble(df, list("abcd"), ["row_id"])).toPandas().sort_values("row_id")
        e = np.exp(want)
        assert np.allclose(np.array(out["probabilities"].tolist()), e / e.sum(axis=1, keepdims=True))
        assert (out["prediction"] == want.argmax(axis=1)).all()


def test_search_by_levels_is_the_search_alone(spark, three_classes):
    _, _, df, _ = three_classes
    settings = Settings(trees=(2, 4), depths=(2, 3), folds=2)
    one, two = (grid_search(df, list("abcd"), "label", "row_id", settings, local_cells=n) for n in (4_000_000, 500))
    assert one.candidates == two.candidates and one.best == two.best and len(one.candidates) == 4
    assert all(np.array_equal(a.feature, b.feature) and np.allclose(a.value, b.value) for r, q in zip(one.model.trees, two.model.trees) for a, b in zip(r, q))


def test_softmax_trees_odd_tables(spark):
    """Null and NaN features, rows without a label, a constant feature, classes that no row has, an empty table."""
    rows = [(i % 2, float(i % 2) if i % 5 else None, float("nan") if i % 3 else 1.0, 7.0) for i in range(60)] + [(None, 1.0, 1.0, 1.0)] * 9
    df = spark.createDataFrame(rows, "label int, a double, b double, c double")
    model = softmax_trees.softmax_trees(df, ["a", "b", "c"], "label", 4, 30)
    p = predict(model, assemble(df.fillna(0), ["a", "b", "c"], ["label"])).where("a = 1").select("probabilities").first()[0]
    assert len(p) == 4 and p[1] > 0.9 and sum(p) == pytest.approx(1)
    nothing = softmax_trees.softmax_trees(df.limit(0), ["a", "b", "c"], "label", 3, 5)
    assert np.allclose(nothing.margins(np.ones((2, 3))), 0)


def test_classifier_and_search(spark):
    df = classes(spark, {0: 150, 1: 150, 2: 150, 3: 150})
    settings = Settings(trees=(2, 3), depths=(2,), folds=2)
    found = grid_search(df, ["x", "y"], "label", "row_id", settings)
    assert found.cv_recall > 0.95 and found.best["max_depth"] == 2
    out = predict(found.model, assemble(df, ["x", "y"], ["label"])).toPandas()
    assert (out["label"] == out["prediction"]).mean() > 0.95
    assert all(abs(sum(p) - 1) < 1e-9 and len(p) == 4 for p in out["probabilities"])
    model = boosted_trees("label", trees=2, depth=2).fit(assemble(df, ["x", "y"], ["label"]))
    theirs = model.transform(assemble(df, ["x", "y"], ["label"])).toPandas()["prediction"]
    ours = predict(model, assemble(df, ["x", "y"], ["label"])).toPandas()["prediction"]
    assert (theirs == ours).all()


def sensor_table(spark, n=400):
    sensors = [f"cast((id * {7 + i} % 53) + id % {3 + i} as string) as `{s}`" for i, s in enumerate(SENSORS)]
    return spark.range(n).selectExpr(
        "id as row_id",
        "date_format(timestamp_seconds(1704067200 + id * 600), 'M/d/yyyy') as Date",
        "date_format(timestamp_seconds(1704067200 + id * 600), 'HH:mm:ss') as Timestamp",
        "concat('M', id % 6) as Machine_ID",
        "concat('L', id % 3) as Assembly_Line_No",
        *sensors,
        "element_at(array('Tool_Wear', 'Maintenance', 'Power_Failure', 'No_Machine_Failure', 'Tool_Wear'), cast(id % 5 + 1 as int)) as Downtime",
    )


def test_feature_table_shape(spark):
    """62 features for 12 sensors and 9 category values, ten rows fewer."""
    made = feature_table(sensor_table(spark))
    assert len(made.features) == 62 and made.rows == 390
    assert made.classes == ["Infrastructure", "Machine_Issue", "Normal", "Operations"]
    assert made.frame.count() == 390
    assert made.frame.where(F.col(TARGET).isNull()).count() == 0


def test_feature_table_of_a_short_table(spark):
    made = feature_table(sensor_table(spark, 8))
    rows = made.frame.collect()
    assert len(rows) == 8 and all(r[TARGET] is None for r in rows)


def test_training_job(spark):
    raw = sensor_table(spark)
    settings = Settings(trees=(2,), depths=(2,), folds=2, drift_sample_rows=100)
    path, runs = run_dir(spark, "bundle"), run_dir(spark, "runs")
    result = training_job(raw.unionByName(raw.withColumn("row_id", F.col("row_id") + 400).limit(71)), path, runs, "r1", settings=settings)
    assert result.metrics["train_size"] + result.metrics["test_size"] == 390
    assert result.metrics["test_size"] == 59
    assert result.params["final_columns_after_encoding"] == 65
    assert sum(v for k, v in result.params.items() if k.startswith("target_class_")) == 390
    assert sum(v for k, v in result.params.items() if k.startswith("downtime_group_")) == 400
    assert {r.class_name for r in result.report.collect()} >= {"accuracy", "macro avg", "weighted avg"}
    logged = {r.name: r.value for r in spark.read.parquet(runs).collect()}
    assert logged["initial_rows"] == "471" and logged["train_rows_after_split"] == "400" and logged["train_size"] == "331"
    assert {"Normal_precision", "Normal_recall", "Normal_f1", "test_recall_score"} <= set(logged)
    save_bundle(spark, replace(result.bundle, model=None), path)
    with pytest.raises(FileNotFoundError):
        load_bundle(spark, path)  # no older model under a newer bundle
    save_bundle(spark, result.bundle, path)
    loaded = load_bundle(spark, path)
    assert loaded.features == result.bundle.features
    assert loaded.drift_states == result.bundle.drift_states
    assert len(loaded.anomaly.mean) == 62 and len(loaded.reference_stats) == 62
    _, held_out = split_at(raw, 340)
    scored = score(to_messages(held_out).select("value"), loaded)
    records = predictions(scored, loaded).collect()
    assert len(records) == 60
    for r in records:
        assert r.predicted_downtime in loaded.classes
        assert set(r.probabilities) == set(loaded.classes)
        assert r.confidence == max(r.probabilities.values())
    assert set(CATEGORIES) == {"Machine_ID", "Assembly_Line_No"}


def test_rows_stay_as_they_are_if_resampling_fails(spark, monkeypatch):
    from linewatch.plans import training

    df = classes(spark, {0: 20, 1: 12}).withColumnRenamed("row_id", training.POSITION).withColumnRenamed("label", TARGET)
    grown, refused = training.balanced_rows(df, ["x", "y"], Settings())
    assert refused is None and grown.count() == 40

    def fails(frame, *_):
        return frame.select(F.raise_error(F.lit("no")).cast("int").alias(TARGET), "x", "y", F.lit(True).alias("synthetic"), F.lit(0).alias("draw"))

    monkeypatch.setattr(training, "smote", fails)
    kept, refused = training.balanced_rows(df, ["x", "y"], Settings())
    assert refused and sorted(map(tuple, kept.select(TARGET, "x", "y").collect())) == sorted(map(tuple, df.select(TARGET, "x", "y").collect()))
    assert kept.columns == grown.columns


def test_missing_bundle_part(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_bundle(spark, "file:" + str(tmp_path / "none"))
