"""Fitted models as formulas: the same probabilities as column, SQL text, function and model."""

import duckdb
import pytest
from pyspark.sql import functions as F

from loyalscope import schema
from loyalscope.catalogue.base import cleaned as staged_rows
from loyalscope.operators import formulas, learning
from loyalscope.operators.formulas import Formula

SF_DIR = "/root/testdata/sf0.01"
SMALL = {"RandomForest": {"numTrees": 15, "maxDepth": 6}, "GradientBoosting": {"maxIter": 8}, "LogisticRegression": {"tol": 1e-13}}


@pytest.fixture(scope="module")
def prepared(spark):
    return learning.prepare(staged_rows(spark, SF_DIR))


@pytest.fixture(scope="module")
def models(prepared):
    return learning.fit_models(prepared.rows, prepared.features, settings=SMALL)


@pytest.fixture(scope="module")
def made(spark, models):
    return {name: formulas.formula(model, spark) for name, model in models.items()}


@pytest.mark.parametrize("name", learning.MODELS)
def test_column_text_and_function_give_the_model_s_probability(spark, prepared, models, made, name):
    rows = learning.probability(learning.probability(prepared.rows, models[name], "by_model"), made[name], "by_column").toPandas()
    assert (rows.by_model - rows.by_column).abs().max() < 1e-12
    assert rows.by_model.nunique() > 20
    by_text = duckdb.sql(f"SELECT customerID, {made[name].sql()} AS p FROM rows").df().set_index("customerID").p
    assert (rows.set_index("customerID").by_model - by_text).abs().max() < 1e-12
    for row in rows.head(40).to_dict("records"):
        assert made[name].value(row) == pytest.approx(row["by_model"], abs=1e-12)


@pytest.mark.parametrize("name", learning.MODELS)
def test_batches_score_alike_and_without_vectors(spark, models, made, name):
    rows = staged_rows(spark, SF_DIR)
    pick = lambda model: sorted(map(tuple, learning.score(rows, model).select("customerID", "ChurnProbability", "WillChurn_Predicted", "ChurnRisk").collect()))
    assert pick(models[name]) == pick(made[name])
    plan = learning.score(rows, made[name])._jdf.queryExecution().executedPlan().toString()
    assert "UDF" not in plan and "vector" not in plan.lower()
    assert "UDF" in learning.score(rows, models[name])._jdf.queryExecution().executedPlan().toString()


def test_formulas_survive_being_stored(made):
    for formula in made.values():
        again = Formula.loads(formula.dumps())
        assert again == formula and again.sql() == formula.sql()


def test_swapped_features_are_noticed(prepared, models, made):
    line = made["LogisticRegression"]
    swapped = Formula([line.features[1], line.features[0], *line.features[2:]], line.intercept, line.linear, slope=1.0)
    rows = learning.probability(learning.probability(prepared.rows, swapped, "a"), line, "b")
    assert rows.where(F.abs(F.col("a") - F.col("b")) > 1e-4).count() > 1000


def test_odd_values(spark):
    tree = Formula(["a b", "c`d"], trees=[[0.5, [0, 1.5, 0.25, [1, -2.0, 0.75, 1.0]]], [0.5, 0.5]])
    rows = spark.createDataFrame([(1.5, 0.0), (1.6, -2.0), (1.6, -1.9), (float("nan"), float("nan")), (float("-inf"), 0.0), (None, -2.0)], "`a b` double, `c``d` double")
    assert [r[0] for r in rows.select(tree.column()).collect()] == [0.375, 0.625, 0.75, 0.75, 0.375, 0.625]
    steep = Formula(["x"], 0.0, [[1.0, 0.0, 1.0]], slope=1.0)
    got = [r[0] for r in spark.createDataFrame([(-2000.0,), (0.0,), (2000.0,), (None,)], "x double").select(steep.column()).collect()]
    assert got == [0.0, 0.5, 1.0, None] and [steep.value({"x": v}) for v in (-2000, 0, 2000)] == [0.0, 0.5, 1.0]
    assert Formula([], 0.25).value({}) == 0.25 and tree.splits() == 2


def test_gradient_is_zero_at_the_optimum_only(spark, prepared, made):
    line = made["LogisticRegression"]
    rows = learning.balanced_weights(prepared.rows).cache()
    penalty = 1 / (learning.LOGISTIC["C"] * rows.count())
    at = {r["component"]: r["gradient"] for r in formulas.gradient(rows, line, penalty, weight=learning.WEIGHT).collect()}
    assert list(at) == [*schema.FEATURES, "(intercept)"]
    assert max(map(abs, at.values())) < 1e-6
    wrong = [formulas.gradient(rows, line, 2 * penalty, weight=learning.WEIGHT), formulas.gradient(rows, line, penalty),
             formulas.gradient(rows, Formula(line.features, line.intercept + 0.01, line.linear, slope=1.0), penalty, weight=learning.WEIGHT)]
    assert all(max(abs(r["gradient"]) for r in w.collect()) > 1e-4 for w in wrong)
    frame = rows.toPandas()  # noqa: F841  (read by the SQL)
    by_sql = dict(duckdb.sql(formulas.gradient_sql("frame", line, penalty, weight=learning.WEIGHT)).fetchall())
    assert by_sql == pytest.approx(at, abs=1e-12) and max(map(abs, by_sql.values())) < 1e-6
    plan = formulas.gradient(rows, line, penalty, weight=learning.WEIGHT)._jdf.queryExecution().executedPlan().toString()
    assert "UDF" not in plan
    assert [r["gradient"] for r in formulas.gradient(rows.where("1 = 0"), line, penalty).collect()] == [None] * 12
    rows.unpersist()


def test_models_without_a_formula_are_refused(spark, models):
    from pyspark.ml import PipelineModel
    with pytest.raises(ValueError, match="no formula"):
        formulas.formula(PipelineModel(models["LogisticRegression"].stages[:-1]), spark)
