"""Feature preparation, splitting, the three learners, scoring and importance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any, NamedTuple

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from loyalscope import schema
from loyalscope.functions import quoted, risk_band, round_even
from loyalscope.operators.cleaning import impute_median
from loyalscope.operators.formulas import Formula
from loyalscope.operators.quality import rows_of
from loyalscope.operators.segments import drop_incomplete
from loyalscope.session import checkpointing, written

SEED = 42
HOLDOUT = 0.2
WEIGHT = "weight"

# The learners' settings
# a row keeps its node in each tree, so that no level goes down from the root again: the same trees in less time
FOREST = {"numTrees": 200, "maxDepth": 8, "minInstancesPerNode": 5, "cacheNodeIds": True}
BOOSTING = {"maxIter": 150, "maxDepth": 4, "stepSize": 0.08, "checkpointInterval": 10}
LOGISTIC = {"C": 0.5, "maxIter": 1000}
MODELS = ["RandomForest", "GradientBoosting", "LogisticRegression"]


class Prepared(NamedTuple):
    rows: DataFrame
    features: list[str]
    absent: list[str]


def prepare(df: DataFrame, features: Sequence[str] = schema.FEATURES, label: str = schema.LABEL,
            key: str = schema.KEY) -> Prepared:
    """Key, features as double and an integer label, without incomplete rows. Absent features are skipped and named."""
    present = [c for c in features if c in df.columns]
    rows = df.select(key, *[F.col(c).cast("double").alias(c) for c in present], F.col(label).cast("int").alias("label"))
    return Prepared(drop_incomplete(rows, [*present, "label"]), present, [c for c in features if c not in df.columns])


def _spread(key: str, seed: int) -> Column:
    return F.xxhash64(F.col(key), F.lit(seed))


def _holdout_quota(counts: DataFrame, fraction: float) -> Column:
    """How many rows of classes 0 and 1 are held out: the rounded-up total, shared by largest remainder."""
    sizes = counts.agg(*[F.coalesce(F.sum(F.when(F.col("class") == k, F.col("n"))), F.lit(0)).alias(f"n{k}") for k in (0, 1)])
    shares = (
        sizes.withColumn("wanted", F.ceil((F.col("n0") + F.col("n1")) * F.lit(fraction)))
        .withColumns({f"exact{k}": F.try_divide(F.col("wanted") * F.col(f"n{k}"), F.col("n0") + F.col("n1")) for k in (0, 1)})
        .withColumns({f"rest{k}": F.col(f"exact{k}") - F.floor(f"exact{k}") for k in (0, 1)})
    )
    spare = F.col("wanted") - F.floor("exact0") - F.floor("exact1")
    q0 = F.floor("exact0") + F.when(F.col("rest0") >= F.col("rest1"), spare).otherwise(0)
    return shares.select(F.struct(q0.alias("q0"), (F.col("wanted") - q0).alias("q1"))).scalar()


def stratified_split(df: DataFrame, label: str = "label", key: str = schema.KEY, fraction: float = HOLDOUT,
                     seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(train, test): within each class of a 0/1 label the smallest key hashes are held out, an exact share.

    The cut in each class is found from counts per hash range (class sizes are their sums) and then
    among the rows of one range per class, so no class is ever ordered as a whole; that range grows with
    the data, at 1/65,536 of its class. Both scans run when this is called, and the two sides share the
    one-row table of cuts. Rows of one class with the same key stay on the same side, so a repeated key
    at the cut makes the held-out share that much larger.
    """
    hashed = df.where(F.col(label).isin(0, 1)).select(
        F.col(label).alias("class"), _spread(key, seed).alias("hash"), F.col(key).alias("key"))
    # 2**16 even ranges of the hash, in hash order
    ranged = hashed.withColumn("range", F.shiftright("hash", 48))
    counts = written(ranged.groupBy("class", "range").agg(F.count("*").alias("n")), "ranges")
    quotas = _holdout_quota(counts, fraction)
    quota = F.when(F.col("class") == 1, F.col("_quotas.q1")).otherwise(F.col("_quotas.q0"))

    upto = Window.partitionBy("class").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    crosses = (F.col("after") >= quota) & (F.col("after") - F.col("n") < quota)
    crossing = (  # one row per class
        counts.withColumn("after", F.sum("n").over(upto.orderBy("range"))).withColumn("_quotas", quotas).where(crosses)
        .select(F.col("class").alias("_class"), F.col("range").alias("_range"),
                (F.col("after") - F.col("n")).alias("before"), "_quotas")
    )
    edge = (
        ranged.join(F.broadcast(crossing), (F.col("class") == F.col("_class")) & (F.col("range") == F.col("_range")))
        .groupBy("class", "before", "_quotas", "hash", "key").agg(F.count("*").alias("n"))
        .withColumn("after", F.col("before") + F.sum("n").over(upto.orderBy("hash", "key"))).where(crosses)
    )
    cuts = written(edge.agg(F.map_from_entries(F.collect_list(F.struct("class", F.struct("hash", "key")))).alias("cuts")), "cuts").scalar()
    mark = F.struct(_spread(key, seed).alias("hash"), F.col(key).alias("key"))
    held_out = F.coalesce(mark <= cuts[F.col(label)], F.lit(False))
    return df.where(~held_out), df.where(held_out)


def balanced_weights(df: DataFrame, label: str = "label", out: str = WEIGHT) -> DataFrame:
    """n / (2 * class size) for each row of a 0/1 label."""
    total = df.agg(F.struct(F.count("*").alias("n"), F.count_if(F.col(label) == 1).alias("ones"))).scalar()
    n, ones = F.col("_total.n"), F.col("_total.ones")
    size = F.when(F.col(label) == 1, ones).otherwise(n - ones)
    return df.withColumn("_total", total).withColumn(out, n.cast("double") / (2.0 * size.cast("double"))).drop("_total")


def estimators(features: Sequence[str], train_rows: int, settings: Mapping[str, Mapping[str, Any]] | None = None,
               seed: int = SEED) -> dict[str, Pipeline]:
    """The three learners, each behind its own assembler so a saved model knows its features.

    ``settings`` overrides parameters per model name.
    """
    settings = settings or {}
    take = lambda name, base: {**base, **settings.get(name, {})}
    gather = lambda out="features": VectorAssembler(inputCols=list(features), outputCol=out)

    forest = RandomForestClassifier(labelCol="label", weightCol=WEIGHT, seed=seed,
                                    **take("RandomForest", FOREST))
    boosting = GBTClassifier(labelCol="label", seed=seed, **take("GradientBoosting", BOOSTING))
    logistic = take("LogisticRegression", LOGISTIC)
    # the balanced weights sum to the number of rows, so this is the same penalty per row as C
    penalty = 1.0 / (logistic.pop("C") * train_rows)
    line = LogisticRegression(labelCol="label", weightCol=WEIGHT, regParam=penalty, elasticNetParam=0.0,
                              standardization=False, **logistic)
    scale = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
    return {
        "RandomForest": Pipeline(stages=[gather(), forest]),
        "GradientBoosting": Pipeline(stages=[gather(), boosting]),
        "LogisticRegression": Pipeline(stages=[gather("raw_features"), scale, line]),
    }


def fit_models(train: DataFrame, features: Sequence[str], models: Sequence[str] = MODELS,
               settings: Mapping[str, Mapping[str, Any]] | None = None, seed: int = SEED,
               partitions: int | None = None) -> dict[str, PipelineModel]:
    """Fit the named learners side by side on one cached, weighted training set.

    Each has a thread of its own on the driver, which only waits for its jobs, and a scheduler pool of its name where the
    session schedules fairly; what one learner leaves idle between its many short jobs the others use.

    Trees shuffle a block of statistics per partition and level, so a very large set with far more
    partitions than tasks that run at once should be dealt to ``partitions``, by a shuffle, so that the
    scan before it keeps its own tasks.
    """
    if not models:
        return {}
    checkpointing(train.sparkSession)
    weighted = balanced_weights(train if partitions is None else train.repartition(partitions)).persist()
    try:
        plans = estimators(features, weighted.count(), settings, seed)
        with ThreadPoolExecutor(len(models)) as threads:
            fits = {name: threads.submit(inheritable_thread_target(train.sparkSession)(_fitted), plans[name], weighted, name) for name in models}
            return {name: fit.result() for name, fit in fits.items()}
    finally:
        weighted.unpersist()


def _fitted(plan: Pipeline, rows: DataFrame, pool: str) -> PipelineModel:
    rows.sparkSession.sparkContext.setLocalProperty("spark.scheduler.pool", pool)
    return _without_summary(plan.fit(rows))


def _without_summary(model: PipelineModel) -> PipelineModel:
    """Forget the training summary: it holds the session, which can't go to the tasks once it observes something."""
    for stage in model.stages:
        if getattr(stage, "hasSummary", False):
            stage._java_obj.setSummary(SparkSession.active()._jvm.scala.Option.empty())
    return model


def probability(df: DataFrame, model: PipelineModel | Formula, out: str = "score") -> DataFrame:
    """Add the unrounded probability of churn; the model's own columns are dropped again.

    A formula is an expression over the feature columns, without vectors; it suits models of up to some ten thousand splits.
    """
    if isinstance(model, Formula):
        return df.withColumn(out, model.column())
    scored = model.transform(df)
    return scored.select(*[F.col(quoted(c)) for c in df.columns], vector_to_array(F.col("probability"))[1].alias(out))


def predictions(models: Mapping[str, PipelineModel], test: DataFrame) -> DataFrame:
    """(model, label, prediction, score) of every model on the same rows, which are read once."""
    rows = test
    for i, model in enumerate(models.values()):
        rows = probability(rows, model, f"_score_{i}")
    each = [F.struct(F.lit(name).alias("model"), F.col("label"), (F.col(f"_score_{i}") >= schema.CHURN_THRESHOLD).cast("int").alias("prediction"),
                     F.col(f"_score_{i}").alias("score")) for i, name in enumerate(models)]
    return rows.select(F.inline(F.array(*each)))


def model_features(model: PipelineModel | Formula) -> list[str]:
    """The input columns of a fitted model, in order."""
    if isinstance(model, Formula):
        return model.features
    return next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()


def importance(model: PipelineModel, spark: SparkSession, digits: int = 4) -> DataFrame:
    """(feature, importance), largest first: tree importances or absolute coefficients, else no rows."""
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        values = last.featureImportances.toArray()
    elif hasattr(last, "coefficients"):
        values = abs(last.coefficients.toArray())
    else:
        return spark.createDataFrame([], "feature string, importance double")
    rows = [(name, round(float(v), digits)) for name, v in zip(model_features(model), values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def add_risk(df: DataFrame, score: str = "score", closed: str = "right", digits: int = 4) -> DataFrame:
    """ChurnProbability, WillChurn_Predicted and ChurnRisk from an unrounded score.

    The class comes from the unrounded score. Batches band the rounded score (right-closed);
    single profiles band the unrounded one (left-closed).
    """
    rounded = round_even(F.col(score), digits)
    banded = rounded if closed == "right" else F.col(score)
    return df.withColumns({
        "ChurnProbability": rounded,
        "WillChurn_Predicted": (F.col(score) >= schema.CHURN_THRESHOLD).cast("int"),
        "ChurnRisk": risk_band(banded, closed),
    }).drop(score)


def score(df: DataFrame, model: PipelineModel | Formula, fill: str = "median", approx: bool = False) -> DataFrame:
    """Score every row; the input columns come back unchanged, with the three score columns added.

    ``fill="median"`` fills missing features with the batch median (whole batches), ``fill="zero"``
    fills with 0 and adds absent features as 0 (single profiles, banded left-closed).
    """
    features = model_features(model)
    if fill not in ("median", "zero"):
        raise ValueError("fill is 'median' or 'zero'")
    absent = [c for c in features if c not in df.columns]
    if absent and fill == "median":
        raise ValueError(f"features missing from the batch: {absent}")
    original = F.struct(*[F.col(quoted(c)) for c in df.columns]).alias("_row")
    inputs = [(F.col(c) if c in df.columns else F.lit(0)).cast("double").alias(c) for c in features]
    rows = df.select(original, *inputs)
    rows = impute_median(rows, features, approx) if fill == "median" else rows.select(
        "_row", *[F.coalesce(F.nanvl(c, F.lit(0.0)), F.lit(0.0)).alias(c) for c in features])
    scored = probability(rows, model).select("_row.*", "score")
    return add_risk(scored, closed="right" if fill == "median" else "left")
