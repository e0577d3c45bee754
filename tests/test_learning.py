import pytest
from pyspark.sql import functions as F

from loyalscope import schema
from loyalscope.catalogue.base import cleaned as staged_rows
from loyalscope.operators import evaluation, learning
from loyalscope.plans import churn
from loyalscope.sources import artifacts

SF_DIR = "/root/testdata/sf0.01"
SMALL = {"RandomForest": {"numTrees": 12, "maxDepth": 5}, "GradientBoosting": {"maxIter": 5}, "LogisticRegression": {"maxIter": 60}}


@pytest.fixture(scope="module")
def subscribers(spark):
    return staged_rows(spark, SF_DIR)


@pytest.fixture(scope="module")
def training(subscribers):
    return churn.train(subscribers, settings=SMALL)


def test_prepare_skips_absent_features_and_incomplete_rows(subscribers):
    rows = subscribers.drop("gender_encoded").withColumn("tenure", F.when(F.col("tenure") > 5, F.col("tenure")))
    prepared = learning.prepare(rows)
    assert prepared.absent == ["gender_encoded"]
    assert prepared.features == [c for c in schema.FEATURES if c != "gender_encoded"]
    assert prepared.rows.count() == subscribers.where("tenure > 5").count()


def counts(df):
    return {r["label"]: r["count"] for r in df.groupBy("label").count().collect()}


def test_split_sizes_follow_the_classes(spark):
    rows = spark.range(7043).select(F.col("id").cast("string").alias("customerID"), (F.col("id") < 1869).cast("int").alias("label"))
    train, test = learning.stratified_split(rows)
    assert counts(test) == {0: 1035, 1: 374}
    assert counts(train) == {0: 4139, 1: 1495}
    assert train.join(test, "customerID").count() == 0


def test_split_is_the_same_for_any_partitioning_but_not_for_any_seed(spark):
    rows = spark.range(500).select(F.col("id").cast("string").alias("customerID"), (F.col("id") % 3 == 0).cast("int").alias("label"))
    held_out = lambda df, **kw: {r["customerID"] for r in learning.stratified_split(df, **kw)[1].collect()}
    reference = held_out(rows)
    assert len(reference) == 100
    assert held_out(rows.repartition(7).orderBy(F.rand(3))) == reference
    assert held_out(rows, seed=7) != reference


def test_split_with_a_repeated_key_keeps_its_rows_together(spark):
    keys = F.when(F.col("id") < 300, F.lit("hot")).otherwise(F.col("id").cast("string"))
    rows = spark.range(900).select(keys.alias("customerID"), (F.col("id") % 2).cast("int").alias("label"))
    train, test = learning.stratified_split(rows)
    assert train.count() + test.count() == 900
    assert train.select("customerID").distinct().join(test.select("customerID").distinct(), "customerID").count() <= 1


@pytest.mark.parametrize("labels", [[1], [0, 1], [0, 0, 1]])
def test_split_of_very_few_rows(spark, labels):
    rows = spark.createDataFrame([(str(i), v) for i, v in enumerate(labels)], "customerID string, label int")
    train, test = learning.stratified_split(rows)
    assert test.count() == 1 and train.count() == len(labels) - 1


def test_balanced_weights(spark):
    rows = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "label int")
    out = {r["label"]: r["weight"] for r in learning.balanced_weights(rows).distinct().collect()}
    assert out == {0: 8 / 12, 1: 8 / 4}


def test_training_beats_chance_and_names_the_best(training):
    rows = {r["model"]: r for r in training.metrics.collect()}
    assert set(rows) == set(learning.MODELS)
    assert all(r["roc_auc"] > 0.6 for r in rows.values())
    assert all(r["tn"] + r["fp"] + r["fn"] + r["tp"] == 300 for r in rows.values())
    assert rows[training.best]["roc_auc"] == max(r["roc_auc"] for r in rows.values())
    table = evaluation.comparison(training.metrics, learning.MODELS).collect()
    assert [r["model"] for r in table] == learning.MODELS
    assert [r["model"] for r in table if r["is_best"]] == [training.best]


def test_importance(spark, training):
    for name, model in training.models.items():
        rows = learning.importance(model, spark).collect()
        assert {r["feature"] for r in rows} == set(schema.FEATURES)
        values = [r["importance"] for r in rows]
        assert values == sorted(values, reverse=True) and min(values) >= 0
        if name != "LogisticRegression":
            assert sum(values) == pytest.approx(1, abs=0.001)
    assert artifacts.top_features(training.importance, 3).count() == 3


def test_logistic_penalty_counts_rows(training):
    line = training.models["LogisticRegression"].stages[-1]
    assert line.getRegParam() == pytest.approx(1 / (0.5 * 1200))
    assert line.getOrDefault("standardization") is False


def test_narrowed_training_set_gives_the_same_model(spark):
    rows = spark.range(400).select(F.col("id").cast("string").alias("customerID"), (F.col("id") % 7).cast("double").alias("a"),
                                   (F.col("id") % 3 == 0).cast("int").alias("label")).repartition(6)
    fit = lambda n: learning.fit_models(rows, ["a"], ["LogisticRegression"], partitions=n)["LogisticRegression"].stages[-1]
    assert fit(2).coefficients.toArray() == pytest.approx(fit(None).coefficients.toArray(), abs=1e-6)


def test_default_settings():
    plans = learning.estimators(schema.FEATURES, 100)
    forest, boosting, line = (plans[m].getStages()[-1] for m in learning.MODELS)
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getMinInstancesPerNode(), forest.getSeed()) == (200, 8, 5, 42)
    assert (boosting.getMaxIter(), boosting.getMaxDepth(), boosting.getStepSize()) == (150, 4, 0.08)
    assert (line.getMaxIter(), line.getRegParam()) == (1000, 0.02)
    assert not boosting.isDefined("weightCol") and forest.getWeightCol() == "weight"


def test_forest_does_not_go_down_from_the_root_at_every_level(subscribers):
    prepared = learning.prepare(subscribers)
    assert learning.estimators(prepared.features, 100)["RandomForest"].getStages()[-1].getCacheNodeIds()
    trees = []
    for kept in (True, False):
        settings = {"RandomForest": {"numTrees": 15, "cacheNodeIds": kept}}
        forest = learning.fit_models(prepared.rows, prepared.features, ["RandomForest"], settings)["RandomForest"].stages[-1]
        trees.append([t.toDebugString.split("\n", 1)[1] for t in forest.trees])
    assert trees[0] == trees[1] and len(trees[0]) == 15


def test_batch_scores(subscribers, training):
    scored = learning.score(subscribers, training.model)
    assert scored.columns == [*subscribers.columns, "ChurnProbability", "WillChurn_Predicted", "ChurnRisk"]
    rows = scored.select("customerID", "ChurnProbability", "WillChurn_Predicted", "ChurnRisk").collect()
    assert len(rows) == 1500
    for r in rows:
        assert 0 <= r["ChurnProbability"] <= 1 and r["ChurnRisk"] in schema.RISK_LABELS
        assert round(r["ChurnProbability"], 4) == r["ChurnProbability"]
        if abs(r["ChurnProbability"] - 0.5) > 1e-4:
            assert r["WillChurn_Predicted"] == int(r["ChurnProbability"] >= 0.5)


def test_batch_gaps_are_scored_as_the_median(subscribers, training):
    holes = subscribers.withColumn("MonthlyCharges", F.when(F.col("customerID") > "Customer#000000100", F.col("MonthlyCharges")))
    middle = holes.agg(F.median("MonthlyCharges")).first()[0]
    filled = holes.withColumn("MonthlyCharges", F.coalesce("MonthlyCharges", F.lit(middle)))
    pick = lambda df: sorted(map(tuple, learning.score(df, training.model).select("customerID", "ChurnProbability").collect()))
    assert pick(holes) == pick(filled)
    assert learning.score(holes, training.model).where("MonthlyCharges is null").count() == 101
    with pytest.raises(ValueError, match="tenure"):
        learning.score(subscribers.drop("tenure"), training.model)


def test_profiles_are_padded_with_zero(spark, training):
    given = spark.createDataFrame([(1, 6, 90.0)], "SeniorCitizen int, tenure int, MonthlyCharges double")
    zeros = given.withColumns({c: F.lit(0) for c in schema.FEATURES if c not in given.columns})
    pick = lambda df: tuple(learning.score(df, training.model, fill="zero").select("ChurnProbability", "ChurnRisk").first())
    assert pick(given) == pick(zeros)


def test_bands_of_batches_and_single_profiles(spark):
    df = spark.createDataFrame([(0.65,), (0.35,), (0.64996,), (0.4999999,)], "score double")
    batch = [tuple(r) for r in learning.add_risk(df).collect()]
    assert batch == [(0.65, 1, "Medium"), (0.35, 0, "Low"), (0.65, 1, "Medium"), (0.5, 0, "Medium")]
    single = [tuple(r) for r in learning.add_risk(df, closed="left").collect()]
    assert single == [(0.65, 1, "High"), (0.35, 0, "Medium"), (0.65, 1, "Medium"), (0.5, 0, "Medium")]


def test_saved_model_scores_the_same(spark, subscribers, training, tmp_path):
    path = str(tmp_path / "model")
    artifacts.save_model(training.model, path)
    loaded = artifacts.load_model(spark, path)
    assert learning.model_features(loaded) == schema.FEATURES
    pick = lambda model: sorted(map(tuple, learning.probability(learning.prepare(subscribers).rows, model).select("customerID", "score").collect()))
    assert pick(loaded) == pick(training.model)
    with pytest.raises(FileNotFoundError, match="Train"):
        artifacts.load_model(spark, path + "-absent")


def test_profile_run_gives_offers(spark, training):
    form = spark.createDataFrame(
        [("Yes", 6, 90.0, "Male", "No", "No", "Yes", "Yes", "Month-to-month", "DSL", "Mailed check")],
        "SeniorCitizen string, tenure int, MonthlyCharges double, gender string, Partner string, Dependents string, "
        "PhoneService string, PaperlessBilling string, Contract string, InternetService string, PaymentMethod string")
    row = churn.score_profiles(form, training.model).first()
    assert row["ChurnRisk"] in schema.RISK_LABELS and row["OfferID"] in {o[0] for o in schema.OFFERS}


def test_scoring_plan_has_no_python(subscribers, training):
    from loyalscope.operators import offers
    plan = offers.recommend(learning.score(subscribers, training.model))._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan


def test_learners_are_fitted_side_by_side_with_equal_results(spark, subscribers):
    import threading

    prepared = learning.prepare(subscribers)
    alone = {name: learning.fit_models(prepared.rows, prepared.features, [name], SMALL)[name] for name in learning.MODELS}
    seen = []
    plain = learning._fitted
    learning._fitted = lambda *given: seen.append(threading.current_thread().name) or plain(*given)
    try:
        together = learning.fit_models(prepared.rows, prepared.features, settings=SMALL)
    finally:
        learning._fitted = plain
    assert list(together) == learning.MODELS and len(set(seen)) == 3
    for name in learning.MODELS:
        both = learning.probability(learning.probability(prepared.rows, alone[name], "a"), together[name], "b")
        assert both.where(F.abs(F.col("a") - F.col("b")) > 1e-9).count() == 0


def test_scores_after_something_was_observed(spark, training, subscribers, tmp_path):
    from loyalscope.operators import quality
    from loyalscope.sources import files

    rows, seen = quality.watched(subscribers)
    copy = files.snapshot(rows, str(tmp_path / "copy"))
    assert seen.rows() == 1500
    assert all(learning.probability(learning.prepare(copy).rows, m).where("score between 0 and 1").count() == 1500 for m in training.models.values())
