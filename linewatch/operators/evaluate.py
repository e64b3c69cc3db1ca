"""Classification scores from one confusion table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import keyword_only
from pyspark.ml.evaluation import Evaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linewatch.schema import quoted


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(
        F.col(quoted(label)).alias("label"), F.col(quoted(prediction)).alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def class_scores(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support for each class seen as label or
    prediction; 0 where a ratio has no denominator."""
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(zero)
    as_label = F.struct(
        F.col("label").alias("class"), F.col("n").alias("support"), zero.alias("predicted"), hit.alias("hits")
    )
    as_prediction = F.struct(
        F.col("prediction").alias("class"), zero.alias("support"), F.col("n").alias("predicted"), zero.alias("hits")
    )
    totals = (
        counts.select(F.inline(F.array(as_label, as_prediction)))
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )
    scored = totals.withColumns(
        {
            "precision": _ratio(F.col("hits"), F.col("predicted")),
            "recall": _ratio(F.col("hits"), F.col("support")),
        }
    )
    p, r = F.col("precision"), F.col("recall")
    return scored.withColumn("f1", _ratio(F.lit(2.0) * p * r, p + r))


def classification_report(counts: DataFrame) -> DataFrame:
    """Class rows, then accuracy, macro and weighted averages."""
    scores = class_scores(counts)
    measures = ["precision", "recall", "f1"]
    rows = scores.select(
        F.col("class").cast("string").alias("class_name"), *measures, "support"
    )
    total = F.sum("support")

    def weighted(m: str) -> Column:
        return _ratio(F.sum(F.col(m) * F.col("support")), total)

    def average(name: str, of: Callable[[str], Column]) -> Column:
        return F.struct(
            F.lit(name).alias("class_name"), *[of(m).alias(m) for m in measures], total.alias("support")
        )

    none = F.lit(None).cast("double")
    averages = scores.agg(
        F.array(
            F.struct(
                F.lit("accuracy").alias("class_name"),
                none.alias("precision"),
                none.alias("recall"),
                _ratio(F.sum("hits"), total).alias("f1"),
                total.alias("support"),
            ),
            average("macro avg", F.avg),
            average("weighted avg", weighted),
        ).alias("rows")
    ).select(F.inline("rows"))
    return rows.unionByName(averages)


def macro_recall(counts: DataFrame) -> DataFrame:
    """Unweighted mean of the class recalls."""
    return class_scores(counts).agg(F.avg("recall").alias("macro_recall"))


class MacroRecallEvaluator(Evaluator):
    """Macro recall for model selection; larger is better."""

    @keyword_only
    def __init__(self, label: str = "label", prediction: str = "prediction"):
        super().__init__()
        self.label, self.prediction = label, prediction

    def _evaluate(self, dataset: DataFrame) -> float:
        return macro_recall(confusion(dataset, self.label, self.prediction)).first()[0] or 0.0

    def isLargerBetter(self) -> bool:
        return True
