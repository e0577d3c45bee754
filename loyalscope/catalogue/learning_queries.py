"""Preparation, splitting, evaluation and the three learners."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from loyalscope import schema
from loyalscope.catalogue.base import (
    RISK_SQL, TRIAL_MODELS, _state, cleaned, offer_sql, query, raw, scored, trial_predictions)
from loyalscope.operators import distributions, evaluation, learning
from loyalscope.plans import churn
from loyalscope.session import scratch_path, written
from loyalscope.sources import artifacts, versions

_AS_DOUBLE = ", ".join(f"round(CAST({c} AS DOUBLE), 4) AS {c}" for c in schema.FEATURES)


@query("m1_prepared_features", f"SELECT customerID, {_AS_DOUBLE}, Churn AS label FROM feat")
def prepared_features(spark, sf_dir):
    rows = learning.prepare(cleaned(spark, sf_dir)).rows
    return rows.withColumns({c: F.round(c, 4) for c in schema.FEATURES})


_QUOTA = """quota AS (SELECT n0, n1, wanted, floor(e0) + CASE WHEN e0 - floor(e0) >= e1 - floor(e1) THEN wanted - floor(e0) - floor(e1) ELSE 0 END AS q0
    FROM (SELECT *, wanted * n0 / (n0 + n1) AS e0, wanted * n1 / (n0 + n1) AS e1 FROM (SELECT *, ceil((n0 + n1) * 0.2::DOUBLE) AS wanted FROM (
        SELECT CAST(count(*) FILTER (WHERE Churn = 0) AS DOUBLE) AS n0, CAST(count(*) FILTER (WHERE Churn = 1) AS DOUBLE) AS n1 FROM feat))))
"""


@query("m2_stratified_split", f""", {_QUOTA} SELECT 'test' AS side, 0 AS label, CAST(q0 AS BIGINT) AS count, 0::BIGINT AS also_elsewhere FROM quota
    UNION ALL SELECT 'test', 1, CAST(wanted - q0 AS BIGINT), 0 FROM quota UNION ALL SELECT 'train', 0, CAST(n0 - q0 AS BIGINT), 0 FROM quota
    UNION ALL SELECT 'train', 1, CAST(n1 - wanted + q0 AS BIGINT), 0 FROM quota
    UNION ALL SELECT 'missing', NULL, 0, 0 FROM quota""")
def stratified_split(spark, sf_dir):
    """Rows per side and class, those that are on both sides, and those on neither."""
    rows = learning.prepare(cleaned(spark, sf_dir)).rows
    train, test = learning.stratified_split(rows)
    both = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    sides = both.groupBy("customerID").agg(F.count_distinct("side").alias("sides"))
    counts = both.join(sides, "customerID").groupBy("side", "label").agg(
        F.count("*").alias("count"), F.count_if(F.col("sides") > 1).alias("also_elsewhere"))
    absent = rows.join(both.select("customerID"), "customerID", "left_anti").agg(
        F.lit("missing").alias("side"), F.lit(None).cast("int").alias("label"), F.count("*").alias("count"), F.lit(0).cast("bigint").alias("also_elsewhere"))
    return counts.unionByName(absent)


@query("m5w_balanced_weights", """SELECT Churn AS label, count(*) AS count,
    round((SELECT count(*) FROM feat) / (2.0 * count(*)), 6) AS weight FROM feat GROUP BY Churn""")
def balanced_weights(spark, sf_dir):
    rows = learning.balanced_weights(learning.prepare(cleaned(spark, sf_dir)).rows)
    return rows.groupBy("label").agg(F.count("*").alias("count"), F.round(F.max("weight"), 6).alias("weight"))


@query("m6_class_metrics", 'SELECT model, tn, fp, fn, tp, accuracy, "precision", recall, f1 FROM measured')
def class_metrics(spark, sf_dir):
    return evaluation.class_metrics(evaluation.confusion(trial_predictions(spark, sf_dir), ["model"]))


@query("m7_roc_auc", "SELECT model, roc_auc FROM areas")
def roc_auc(spark, sf_dir):
    return evaluation.roc_auc(trial_predictions(spark, sf_dir), ["model"])


@query("m8_confusion_matrix", """SELECT model, 0 AS actual, 0 AS predicted, tn AS count FROM confused UNION ALL SELECT model, 0, 1, fp FROM confused
    UNION ALL SELECT model, 1, 0, fn FROM confused UNION ALL SELECT model, 1, 1, tp FROM confused""")
def confusion_matrix(spark, sf_dir):
    return evaluation.confusion_rows(evaluation.confusion(trial_predictions(spark, sf_dir), ["model"]), ["model"])


_PLACE = "list_position(['Formula', 'Mirrored', 'Charge'], model)"


@query("m9_best_model", f"SELECT model, roc_auc FROM areas ORDER BY roc_auc DESC, {_PLACE} LIMIT 1")
def best_model(spark, sf_dir):
    areas = evaluation.roc_auc(trial_predictions(spark, sf_dir), ["model"])
    return evaluation.select_best(areas, TRIAL_MODELS)


@query("m14_model_comparison", f"""SELECT model, accuracy, "precision", recall, f1, roc_auc, model = (SELECT model FROM measured
    ORDER BY roc_auc DESC, {_PLACE} LIMIT 1) AS is_best FROM measured""")
def model_comparison(spark, sf_dir):
    metrics = written(evaluation.evaluate(trial_predictions(spark, sf_dir)), "metrics")
    return evaluation.comparison(metrics, TRIAL_MODELS)


@query("s9_metrics_document", f"""SELECT model, accuracy, "precision", recall, f1, roc_auc, tn, fp, fn, tp,
    model = 'Formula' AS is_best FROM measured""")
def stored_metrics(spark, sf_dir):
    metrics = evaluation.evaluate(trial_predictions(spark, sf_dir))
    weights = spark.range(1).select(F.lit("tenure").alias("feature"), F.lit(1.0).alias("importance"))
    path = scratch_path(spark, "metrics")
    artifacts.write_metrics(artifacts.metrics_document(metrics, weights, "Formula"), path)
    return artifacts.read_metrics(spark, path).models


# The learners ----------------------------------------------------------------------------------

# Models can't be expected to agree with an SQL engine digit by digit. These queries state facts about
# them that SQL can state without a model; the operators that list scores are called all the same.

_TRAINED: dict[tuple, churn.Training] = {}


def trained(spark, sf_dir: str) -> churn.Training:
    """All three learners at their reference settings, from preparation to choice in one call, once per session and
    state of the inputs."""
    key = _state(spark, sf_dir)
    if key not in _TRAINED:
        _TRAINED[key] = churn.train(cleaned(spark, sf_dir))
    return _TRAINED[key]


def _held_out_facts(spark, sf_dir: str, name: str) -> DataFrame:
    """Per class: rows scored, scores outside 0 to 1, and whether the scores order the classes better than chance."""
    _, test = learning.stratified_split(learning.prepare(cleaned(spark, sf_dir)).rows)
    scores = written(learning.probability(test, trained(spark, sf_dir).models[name]).select("label", "score"), "scores")
    area = evaluation.roc_auc(scores, digits=None).select(F.col("roc_auc") > 0.5).scalar()
    return scores.withColumn("_better", area).groupBy("label").agg(
        F.count("*").alias("count"), F.count_if(~F.coalesce(F.col("score").between(0, 1), F.lit(False))).alias("outside"),
        F.first("_better").alias("better_than_chance"))


_HELD_OUT = f""", {_QUOTA} SELECT 0 AS label, CAST(q0 AS BIGINT) AS count, 0::BIGINT AS outside, true AS better_than_chance FROM quota
    UNION ALL SELECT 1, CAST(wanted - q0 AS BIGINT), 0, true FROM quota"""


@query("m3_random_forest", _HELD_OUT)
def random_forest(spark, sf_dir):
    return _held_out_facts(spark, sf_dir, "RandomForest")


@query("m4_gradient_boosting", _HELD_OUT)
def gradient_boosting(spark, sf_dir):
    return _held_out_facts(spark, sf_dir, "GradientBoosting")


@query("m5_logistic_regression", _HELD_OUT)
def logistic_regression(spark, sf_dir):
    return _held_out_facts(spark, sf_dir, "LogisticRegression")


_FEATURE_LIST = "[" + ", ".join(f"'{c}'" for c in schema.FEATURES) + "]"


@query("m10_feature_importance", f"SELECT unnest({_FEATURE_LIST}) AS feature, false AS negative")
def feature_importance(spark, sf_dir):
    return trained(spark, sf_dir).importance.select("feature", (F.col("importance") < 0).alias("negative"))


def _band(value: str) -> str:
    return RISK_SQL.format(value)


def score_facts(rows: DataFrame, closed: str = "right") -> DataFrame:
    """One row: rows scored, scores outside 0 to 1, classes and bands that disagree with the score.

    The class of a score that rounds to the threshold, and the band of one that rounds to an edge if bands are taken from
    the unrounded score, can't be told from the rounded one, so these count as agreeing.
    """
    p = F.col("ChurnProbability")
    wrong = ((p > 0.5) & (F.col("WillChurn_Predicted") != 1)) | ((p < 0.5) & (F.col("WillChurn_Predicted") != 0))
    other = F.col("ChurnRisk") != F.expr(_band("ChurnProbability"))
    if closed == "left":
        other = other & ~p.isin(0.35, 0.65)
    return rows.agg(
        F.count("*").alias("rows"), F.count_if(~F.coalesce(p.between(0, 1), F.lit(False))).alias("outside"),
        F.count_if(F.coalesce(wrong, F.lit(True))).alias("wrong_class"), F.count_if(F.coalesce(other, F.lit(True))).alias("wrong_band"))


def _scored_facts(view: str) -> str:
    return f"SELECT count(*) AS rows, 0::BIGINT AS outside, 0::BIGINT AS wrong_class, 0::BIGINT AS wrong_band FROM {view}"


@query("m11_batch_scores", _scored_facts("feat"))
def batch_scores(spark, sf_dir):
    return score_facts(learning.score(cleaned(spark, sf_dir), trained(spark, sf_dir).model))


@query("m11_score_columns", "SELECT customerID, ChurnProbability, WillChurn_Predicted, ChurnRisk FROM scored")
def score_columns(spark, sf_dir):
    """What a batch run makes of an unrounded score, with the stand-in score as the model."""
    return scored(spark, sf_dir).select("customerID", "ChurnProbability", "WillChurn_Predicted", "ChurnRisk")


@query("m13_profile_scores", _scored_facts("sub"))
def profile_scores(spark, sf_dir):
    return score_facts(churn.score_profiles(raw(spark, sf_dir), trained(spark, sf_dir).model), closed="left")


@query("m15_training_run", f""", {_QUOTA} SELECT unnest({list(learning.MODELS)}) AS model, CAST(wanted AS BIGINT) AS held_out, true AS shares_valid,
    true AS flag_agrees FROM quota""")
def training_run(spark, sf_dir):
    """Prepare, split, fit, evaluate and choose in one call: per model, the rows that its confusion counts add up to, whether
    its measures are shares, and whether it is flagged as best just if no model has a larger area."""
    metrics = trained(spark, sf_dir).metrics
    shares = [F.col(c).between(0, 1) for c in ("accuracy", "precision", "recall", "f1", "roc_auc")]
    flags = evaluation.comparison(metrics, learning.MODELS).select("model", "is_best")
    top = metrics.agg(F.max("roc_auc")).scalar()
    best = metrics.where(F.col("roc_auc") == top).agg(F.min(F.array_position(F.array(*[F.lit(m) for m in learning.MODELS]), F.col("model")))).scalar()
    place = F.array_position(F.array(*[F.lit(m) for m in learning.MODELS]), F.col("model"))
    rows = metrics.withColumn("_best", best).join(flags, "model")
    return rows.select("model", (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("held_out"),
                       reduce(lambda a, b: a & b, shares).alias("shares_valid"), ((place == F.col("_best")) == F.col("is_best")).alias("flag_agrees"))


@query("r4_profile_offers", "SELECT count(*) AS rows, 0::BIGINT AS wrong_offer, 0::BIGINT AS without_title FROM sub")
def profile_offers(spark, sf_dir):
    """Profiles whose offer disagrees with the rules, written as SQL over the score and band that they were given."""
    rows = churn.score_profiles(raw(spark, sf_dir), trained(spark, sf_dir).model)
    # the first rule looks at the score the rows carry
    rule = F.expr(offer_sql("ChurnProbability", "ChurnRisk"))
    return rows.agg(F.count("*").alias("rows"), F.count_if(F.col("OfferID") != rule).alias("wrong_offer"),
                    F.count_if(F.col("OfferTitle").isNull()).alias("without_title"))


@query("s12_model_reload", "SELECT count(*) AS rows, 0::BIGINT AS different FROM feat")
def model_reload(spark, sf_dir):
    """Rows whose score changes when the model is saved and loaded again."""
    path = scratch_path(spark, "model")
    artifacts.save_model(trained(spark, sf_dir).model, path)
    rows = learning.prepare(cleaned(spark, sf_dir)).rows
    both = learning.probability(learning.probability(rows, trained(spark, sf_dir).model, "before"), artifacts.load_model(spark, path), "after")
    return both.agg(F.count("*").alias("rows"), F.count_if(~F.col("before").eqNullSafe(F.col("after"))).alias("different"))


@query("t7_top_correlations", """SELECT feature, importance FROM (SELECT unnest(['tenure', 'MonthlyCharges', 'TotalCharges', 'SeniorCitizen']) AS feature,
    unnest([c1, c2, c3, c4]) AS importance FROM (SELECT abs(round(corr(tenure, Churn), 4)) AS c1, abs(round(corr(MonthlyCharges, Churn), 4)) AS c2,
    abs(round(corr(TotalCharges, Churn), 4)) AS c3, abs(round(corr(SeniorCitizen, Churn), 4)) AS c4 FROM feat))
    ORDER BY importance DESC, feature LIMIT 3""")
def top_correlations(spark, sf_dir):
    found = distributions.label_correlations(cleaned(spark, sf_dir), ["tenure", "MonthlyCharges", "TotalCharges", "SeniorCitizen"], "Churn")
    return artifacts.top_features(found.select("feature", F.abs("correlation").alias("importance")), 3)


@query("t7_top_features", f"SELECT unnest([1, 2, 3]) AS place, true AS known, true AS in_order")
def top_features(spark, sf_dir):
    """The three most important features: whether each is one, and no less important than the next."""
    rows = artifacts.top_features(trained(spark, sf_dir).importance, 3)
    order = Window.orderBy(F.desc("importance"), "feature")  # three rows
    after = F.lead("importance").over(order)
    return rows.select(F.row_number().over(order).alias("place"), F.col("feature").isin(schema.FEATURES).alias("known"),
                       F.coalesce(F.col("importance") >= after, F.lit(True)).alias("in_order"))


#: Learners that are quick to fit: the whole run is the subject, m15 covers the learners at their own settings.
QUICK = {"RandomForest": {"numTrees": 20, "maxDepth": 4}, "GradientBoosting": {"maxIter": 5, "maxDepth": 3}, "LogisticRegression": {"maxIter": 50}}


@query("r5_full_run", """SELECT 'backup' AS output, count(*) AS rows, 0::BIGINT AS wrong FROM sub UNION ALL SELECT 'raw table', count(*), 0 FROM sub
    UNION ALL SELECT 'processed', count(*), 0 FROM feat UNION ALL SELECT 'cleaned table', count(*), 0 FROM feat
    UNION ALL SELECT 'scored', count(*), 0 FROM feat UNION ALL SELECT 'light', count(*), 0 FROM sub
    UNION ALL SELECT 'metrics', 3, 0 UNION ALL SELECT 'report', 3, 0""")
def full_run(spark, sf_dir):
    """Every stage of a run, training and table load included: the rows of each output, and those without an offer or with a
    score outside 0 to 1."""
    config = churn.RunConfig(scratch_path(spark, "run"), with_light_run=True, model_settings=QUICK, table_prefix=f"r{uuid.uuid4().hex[:8]}_")
    final = churn.run(spark, config, raw(spark, sf_dir)).final
    wrong = F.count_if(F.col("OfferID").isNull() | ~F.coalesce(F.col("ChurnProbability").between(0, 1), F.lit(False)))
    parts = [versions.read(spark, config.path("backup")), spark.table(config.table_prefix + schema.RAW_TABLE), spark.read.parquet(config.path("processed")),
             spark.table(config.table_prefix + schema.CLEANED_TABLE), spark.read.option("header", True).csv(config.path("light")),
             artifacts.read_metrics(spark, config.path("metrics")).models, spark.read.parquet(config.path("report"))]
    names = ["backup", "raw table", "processed", "cleaned table", "light", "metrics", "report"]
    out = final.agg(F.lit("scored").alias("output"), F.count("*").alias("rows"), wrong.alias("wrong"))
    for name, rows in zip(names, parts):
        out = out.unionByName(rows.agg(F.lit(name).alias("output"), F.count("*").alias("rows"), F.lit(0).cast("bigint").alias("wrong")))
    return out
