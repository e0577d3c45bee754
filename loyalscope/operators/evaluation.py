"""Classifier metrics over rows of (label, prediction, score), for one or many models in one plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from loyalscope.functions import finite
from loyalscope.session import written


def confusion(scored: DataFrame, by: Sequence[str] = (), label: str = "label",
              predicted: str = "prediction") -> DataFrame:
    """tn, fp, fn, tp per model."""
    cell = lambda actual, guess: F.count_if((F.col(label) == actual) & (F.col(predicted) == guess))
    return scored.groupBy(*by).agg(cell(0, 0).alias("tn"), cell(0, 1).alias("fp"),
                                   cell(1, 0).alias("fn"), cell(1, 1).alias("tp"))


def confusion_rows(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The matrix as (by..., actual, predicted, count), four rows per model."""
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    structs = [F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(c).alias("count")) for a, p, c in cells]
    return counts.select(*by, F.inline(F.array(*structs)))


def class_metrics(counts: DataFrame, digits: int = 4) -> DataFrame:
    """Add accuracy, precision, recall and F1; a zero denominator gives 0."""
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    share = lambda part, whole: F.round(F.coalesce(F.try_divide(part, whole), F.lit(0.0)), digits)
    return counts.withColumns({
        "accuracy": share(tp + tn, tp + tn + fp + fn),
        "precision": share(tp, tp + fp),
        "recall": share(tp, tp + fn),
        "f1": share(2 * tp, 2 * tp + fp + fn),
    })


def roc_auc(scored: DataFrame, by: Sequence[str] = (), label: str = "label", score: str = "score",
            digits: int | None = 4) -> DataFrame:
    """Exact area under the ROC curve, tied scores counting one half.

    The probability that a positive outranks a negative needs an ordering of all scores, but not in
    one place: equal scores are one row before the shuffle, those rows are cut into ranges by Spark's own
    sampling and written once, each range is ordered on its own, and only the ranges' totals are
    accumulated. There are as many ranges as the planner makes partitions, so they grow with the data.
    Starts that writing job when it is called. Null when a model has only one class.
    """
    by = list(by)
    rows = scored.select(*by, F.col(label).alias("label"), finite(F.col(score).cast("double")).alias("score"))
    rows = rows.where(F.col("score").isNotNull() & F.col("label").isNotNull())
    positive, negative = F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)
    ties = rows.groupBy(*by, "score").agg(positive.alias("pos"), negative.alias("neg"))
    ties = written(ties.repartitionByRange(*by, "score").withColumn("range", F.spark_partition_id()), "ties")
    inside = Window.partitionBy(*by, "range").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    beaten = F.coalesce(F.sum("neg").over(inside), F.lit(0)) + F.col("neg") / 2
    ranges = ties.withColumn("won", F.col("pos") * beaten).groupBy(*by, "range").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("won").alias("won"))
    every = [F.col("range") < 0]  # a partition for the ranges, a few rows, of a single model
    earlier = Window.partitionBy(*(by or every)).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = F.col("pos").cast("double") * F.coalesce(F.sum("neg").over(earlier), F.lit(0))
    area = F.try_divide(F.sum("won"), F.sum("pos").cast("double") * F.sum("neg"))
    return ranges.withColumn("won", F.col("won") + carried).groupBy(*by).agg(
        (area if digits is None else F.round(area, digits)).alias("roc_auc"))


def evaluate(scored: DataFrame, by: Sequence[str] = ("model",), label: str = "label",
             predicted: str = "prediction", score: str = "score") -> DataFrame:
    """Counts, class metrics and AUC: one row per model."""
    by = list(by)
    counts = class_metrics(confusion(scored, by, label, predicted))
    areas = roc_auc(scored, by, label, score)
    if not by:
        return counts.withColumn("roc_auc", areas.scalar())
    return counts.join(areas, by, "left")


def select_best(metrics: DataFrame, order: Sequence[str], model: str = "model") -> DataFrame:
    """The model with the largest AUC; of equal ones the first in the given order."""
    place = F.array_position(F.array(*[F.lit(m) for m in order]), F.col(model))
    return metrics.orderBy(F.desc("roc_auc"), place).limit(1)


def comparison(metrics: DataFrame, order: Sequence[str], model: str = "model") -> DataFrame:
    """All models with a flag on the best one, in the given order. Reads the metrics twice, so give written ones."""
    best = select_best(metrics, order, model).select(model).scalar()
    place = F.array_position(F.array(*[F.lit(m) for m in order]), F.col(model))
    return metrics.select(model, "accuracy", "precision", "recall", "f1", "roc_auc",
                          (F.col(model) == best).alias("is_best")).orderBy(place)
