"""Saved models and the metrics document."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loyalscope.sources.files import path_exists, require_path

_MEASURES = ["accuracy", "precision", "recall", "f1", "roc_auc"]
_COUNTS = ["tn", "fp", "fn", "tp"]


def save_model(model: PipelineModel, path: str) -> None:
    """The assembler stage keeps the feature list, so nothing else has to be stored."""
    model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str) -> PipelineModel:
    require_path(spark, path, "Train a model first.")
    return PipelineModel.load(path)


def metrics_document(metrics: DataFrame, importance: DataFrame, best: Column | str) -> DataFrame:
    """One nested row: best model, importance by feature, results by model."""
    matrix = F.array(F.array("tn", "fp"), F.array("fn", "tp")).alias("confusion_matrix")
    results = metrics.agg(F.map_from_entries(F.collect_list(  # one entry per model
        F.struct("model", F.struct(*_MEASURES, matrix)))).alias("model_results"))
    weights = importance.agg(F.map_from_entries(F.collect_list(  # one entry per feature
        F.struct("feature", "importance")))).scalar()
    chosen = F.lit(best) if isinstance(best, str) else best
    return results.select(chosen.alias("best_model"), weights.alias("feature_importance"), "model_results")


def write_metrics(document: DataFrame, path: str) -> None:
    document.write.mode("overwrite").json(path)


class Metrics(NamedTuple):
    models: DataFrame
    importance: DataFrame


_DOCUMENT = (
    "best_model string, feature_importance map<string,double>, model_results map<string,struct<"
    "accuracy:double,precision:double,recall:double,f1:double,roc_auc:double,confusion_matrix:array<array<bigint>>>>"
)


def read_metrics(spark: SparkSession, path: str) -> Metrics | None:
    """Model rows and importance rows of a stored document, or None when there is none."""
    if not path_exists(spark, path):
        return None
    document = spark.read.schema(_DOCUMENT).option("multiLine", True).json(path)
    cells = [F.col("r.confusion_matrix")[i][j].alias(name) for name, (i, j) in
             zip(_COUNTS, [(0, 0), (0, 1), (1, 0), (1, 1)])]
    models = document.select("best_model", F.explode("model_results").alias("model", "r")).select(
        "model", *[f"r.{m}" for m in _MEASURES], *cells, (F.col("model") == F.col("best_model")).alias("is_best"))
    weights = document.select(F.explode("feature_importance").alias("feature", "importance"))
    return Metrics(models, weights)


def top_features(importance: DataFrame, k: int, among: Sequence[str] | None = None) -> DataFrame:
    rows = importance if among is None else importance.where(F.col("feature").isin(list(among)))
    return rows.orderBy(F.desc("importance"), "feature").limit(k)
