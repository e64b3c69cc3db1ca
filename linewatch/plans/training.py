"""The training job."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewatch.config import DEFAULTS, Settings
from linewatch.functions.numbers import stable_hash
from linewatch.operators.anomaly import fit_mahalanobis
from linewatch.operators.drift import detector_states, warm_detectors
from linewatch.operators.encode import Scaler
from linewatch.operators.evaluate import classification_report, confusion, macro_recall
from linewatch.operators.resample import smote
from linewatch.operators.ordering import dense_from, dense_index
from linewatch.operators.split import raw_split_point, split_at, test_split_point
from linewatch.operators.stats import reference_statistics, value_counts
from linewatch.operators.train import SearchResult, assemble, grid_search, predict
from linewatch.plans.features import POSITION, feature_table
from linewatch.schema import CATEGORIES, GROUP, ROW_ID, SENSORS, TARGET, quoted
from linewatch.session import materialise
from linewatch.sources.bundle import Bundle, save_bundle
from linewatch.sources.runlog import append_run, run_rows


@dataclass
class TrainingResult:
    bundle: Bundle
    search: SearchResult
    report: DataFrame
    test_recall: float
    params: dict[str, object]
    metrics: dict[str, float]


def numbered_rows(grown: DataFrame, features: Sequence[str], label: str, seed: int) -> DataFrame:
    """A number for each row of a resampled table that depends on the row alone, so that the folds do not depend on
    partitions: a hash of class and draw, or of the values of an original row. Equal rows may share one; folds settle
    ties by it too, and such rows are interchangeable."""
    values = F.concat_ws("|", *[F.col(quoted(f)).cast("string") for f in features])
    name = F.col(quoted(label)).cast("string")
    number = F.when(F.col("synthetic"), stable_hash(name, F.lit("draw"), F.col("draw"), seed=seed))
    return grown.withColumn(POSITION, number.otherwise(stable_hash(name, values, seed=seed))).drop("draw")


def balanced_rows(scaled: DataFrame, features: Sequence[str], settings: Settings) -> tuple[DataFrame, str | None]:
    """The stored table that is learned from: resampled, or as it is if resampling fails on it, and then why. The run log gets the reason."""
    spark = scaled.sparkSession
    try:
        grown = smote(scaled, features, TARGET, POSITION, settings.seed)
        return materialise(spark, numbered_rows(grown, features, TARGET, settings.seed), "balanced"), None
    except PySparkException as e:
        plain = scaled.select(*[F.col(quoted(c)) for c in (TARGET, *features)]).withColumns({"synthetic": F.lit(False), "draw": F.lit(None).cast("bigint")})
        reason = e.getCondition() or type(e).__name__
        return materialise(spark, numbered_rows(plain, features, TARGET, settings.seed), "balanced"), reason


def training_job(
    raw: DataFrame,
    bundle_path: str,
    runs_path: str,
    run_id: str,
    sensors: Sequence[str] = SENSORS,
    categories: Sequence[str] = CATEGORIES,
    settings: Settings = DEFAULTS,
    groups: dict[str, list[str]] | None = None,
) -> TrainingResult:
    """Split, train, log and save. The first ``raw_train_share`` of the rows are trained on; the run log gets all params and
    metrics, and the bundle becomes visible last."""
    spark = raw.sparkSession
    point = raw_split_point(raw.count(), settings.raw_train_share)
    low = dense_from(raw, ROW_ID)
    if low is not None:
        train_part, _ = split_at(raw, point + low)
    else:
        ranked = materialise(spark, dense_index(raw, ROW_ID, out="_rank"), "ranked")
        train_part = split_at(ranked, point, "_rank")[0].drop("_rank")
    result = train(train_part, sensors, categories, settings, groups)
    result.params = {"initial_rows": raw.count(), "initial_columns": len(raw.columns), "train_rows_after_split": point, **result.params}
    append_run(run_rows(spark, run_id, "param", result.params), runs_path)
    append_run(run_rows(spark, run_id, "metric", result.metrics), runs_path)
    save_bundle(spark, result.bundle, bundle_path)
    return result


def train(
    raw: DataFrame,
    sensors: Sequence[str] = SENSORS,
    categories: Sequence[str] = CATEGORIES,
    settings: Settings = DEFAULTS,
    groups: dict[str, list[str]] | None = None,
) -> TrainingResult:
    """Raw training rows to a fitted bundle, scores and the run's log values.

    The feature table and the resampled table are written once to the shared
    folder; every fit reads them from there.
    """
    spark = raw.sparkSession
    made = feature_table(raw, sensors, categories, settings, groups)
    frame = materialise(spark, made.frame, "features")
    rows = frame.count()
    point = test_split_point(rows, settings.test_share)
    train_part, test_part = split_at(frame, point, POSITION)

    scaler = Scaler.fit(train_part, made.features)
    scaled = materialise(spark, scaler.transform(train_part), "scaled")
    states = detector_states(
        warm_detectors(
            scaled, made.features, settings.drift_sample_rows, POSITION, settings.seed, settings.drift_delta
        )
    )
    stats = {
        r["feature"]: {s: r[s] for s in ("mean", "std", "min", "max", "count")}
        for r in reference_statistics(scaled, made.features).collect()
    }
    anomaly = fit_mahalanobis(scaled, made.features, settings.contamination)

    balanced, refused = balanced_rows(scaled, made.features, settings)
    search = grid_search(balanced, made.features, TARGET, POSITION, settings)

    tested = predict(search.model, assemble(scaler.transform(test_part), made.features, [TARGET]))
    counts = confusion(tested, TARGET, "prediction")
    counts = materialise(spark, counts.withColumn("prediction", F.col("prediction").cast("int")), "confusion")
    recall = macro_recall(counts).first()[0]

    bundle = Bundle(
        sensors=list(made.sensor_fit.medians),
        categories=made.categories,
        features=made.features,
        classes=made.classes,
        sensor_fit=made.sensor_fit,
        scaler=scaler,
        anomaly=anomaly,
        drift_states=states,
        reference_stats=stats,
        model=search.model,
    )
    groups_found = {f"downtime_group_{r[GROUP]}": r.n for r in value_counts(made.labelled, GROUP).collect()}
    targets = {f"target_class_{r[TARGET]}": r.n for r in value_counts(frame, TARGET).collect()}
    params = {
        "final_rows_after_target_shift": rows,
        # Features plus the target and the two label columns dropped at the end.
        "final_columns_after_encoding": len(made.features) + 3,
        **groups_found,
        **targets,
        **search.best,
        **({"resampling_refused": refused} if refused else {}),
    }
    metrics = {
        "train_size": point,
        "test_size": rows - point,
        "cv_recall_score": search.cv_recall,
        "cv_recall_mean": search.cv_mean,
        "cv_recall_std": search.cv_std,
        "test_recall_score": recall,
    }
    report = materialise(spark, classification_report(counts), "report")
    named = {str(i): c for i, c in enumerate(made.classes)}
    for r in report.collect():  # a row per class and average
        name = named.get(r.class_name, r.class_name).replace(" ", "_")
        metrics |= {f"{name}_{m}": r[m] for m in ("precision", "recall", "f1") if r[m] is not None}
    return TrainingResult(bundle, search, report, recall, params, metrics)
