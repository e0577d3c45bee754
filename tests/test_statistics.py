import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from loyalscope.operators import distributions, evaluation, quantiles as q, reports

SLOW = dict(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
PROBS = [0.0, 0.25, 0.5, 0.9, 1.0]


def exact(spark, numbers, **kw):
    df = spark.createDataFrame([(float(n),) for n in numbers], "v double")
    row = q.quantiles(df, ["v"], PROBS, **kw).first()
    return [row[q.quantile_name(p)] for p in PROBS]


@settings(**SLOW)
@given(st.lists(st.one_of(st.integers(-5, 5), st.floats(-1e6, 1e6)), min_size=1, max_size=60))
def test_quantiles_equal_linear_interpolation(spark, numbers):
    assert exact(spark, numbers) == pytest.approx(list(np.quantile(numbers, PROBS)), rel=1e-12, abs=1e-9)


@pytest.mark.parametrize("accuracy", [20, 100, 100_000])
def test_quantiles_stay_exact_when_the_sketch_is_coarse(spark, accuracy):
    generator = np.random.default_rng(3)
    numbers = np.concatenate([generator.lognormal(3, 2, 40_000), np.full(30_000, 7.5), generator.normal(0, 1e-3, 20_000)])
    df = spark.createDataFrame(pd.DataFrame({"v": numbers})).repartition(13)
    row = q.quantiles(df, ["v"], PROBS, accuracy=accuracy).first()
    assert [row[q.quantile_name(p)] for p in PROBS] == pytest.approx(list(np.quantile(numbers, PROBS)), rel=1e-12)


def test_quantiles_by_group_with_a_hot_group(spark):
    generator = np.random.default_rng(5)
    frame = pd.DataFrame({"g": ["hot"] * 9000 + ["cold"] * 50 + ["single"] + [None] * 20, "v": generator.normal(size=9071).round(2)})
    out = {r["g"]: r for r in q.quantiles(spark.createDataFrame(frame), ["v"], [0.25, 0.5], ["g"]).collect()}
    expected = frame.groupby("g", dropna=False)["v"].quantile([0.25, 0.5]).unstack()
    for g, row in expected.iterrows():
        got = out[None if isinstance(g, float) else g]
        assert (got["q25"], got["q50"]) == pytest.approx((row[0.25], row[0.5]))


def test_quantiles_leave_out_null_and_nan(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (float("nan"), None), (4.0, None)], "a double, b double")
    rows = {r["feature"]: r["median"] for r in q.medians(df, ["a", "b"]).collect()}
    assert rows == {"a": 2.5}


def test_approximate_quantiles(spark):
    df = spark.range(1, 1002).select(F.col("id").alias("v"))
    assert q.quantiles(df, ["v"], [0.25, 0.5], approx=True).first()["q50"] == 501.0


@pytest.mark.parametrize("numbers", [
    [1e300, -1e300, 5e-324, -5e-324, 0.0, float("inf"), float("-inf"), float("inf")], [0.1] * 7 + [0.1 + 1e-16 * k for k in range(9)],
    [1.0, np.nextafter(1.0, 2), np.nextafter(1.0, 0)], [2.0 ** k for k in range(-60, 60)], [1e15 + k for k in range(99)]])
def test_quantiles_of_extreme_values(spark, numbers):
    expected = [float(v) for v in sorted(numbers)]
    row = q.quantiles(spark.createDataFrame([(float(v),) for v in numbers], "v double"), ["v"], [0.0, 0.5, 1.0]).first()
    assert (row["q0"], row["q100"]) == (expected[0], expected[-1])
    middle = expected[(len(expected) - 1) // 2], expected[len(expected) // 2]
    assert middle[0] <= row["q50"] <= middle[1]


@pytest.mark.parametrize("partitions", [4, 16])
def test_no_task_gathers_what_all_partitions_have_seen(spark, monkeypatch, partitions):
    """Rows that one partition sends for counting are bounded by buckets, spread over the tasks, and nothing is raised."""
    monkeypatch.setattr(q, "ORDERED", -1)  # by counting
    df = spark.range(0, 40_000, 1, partitions).select((F.rand(3) * 1000 + 1).alias("v"))
    plan = q.quantiles(df, ["v"], [0.25, 0.5])._jdf.queryExecution().executedPlan().toString()
    assert "raise_error" not in plan and "percentile" not in plan
    counted = df.groupBy(q._bucket(F.col("v")).alias("b")).count()
    assert counted.count() < 22 * np.log(1001) + 2
    # every window has a bucket or slice among its keys, or runs over bucket counts alone
    assert all(k in plan for k in ("hashpartitioning(feature", "bucket", "slice"))


def test_buckets_and_slices_never_fall(spark):
    generator = np.random.default_rng(2)
    numbers = np.sort(np.concatenate([generator.normal(size=2000) * 10.0 ** generator.integers(-300, 300, 2000), [0.0, np.inf, -np.inf], generator.normal(size=500)]))
    rows = spark.createDataFrame(pd.DataFrame({"v": numbers})).select(q._bucket(F.col("v")).alias("b")).toPandas()["b"].to_numpy()
    assert (np.diff(rows) >= 0).all()


def test_auc_ranges_follow_the_planner(spark):
    df = spark.range(5000).select((F.col("id") % 3 == 0).cast("int").alias("label"), F.rand(1).alias("score"))
    plan = evaluation.roc_auc(df)._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "range" in plan


def test_quantile_plan_has_no_full_sort(spark, monkeypatch):
    monkeypatch.setattr(q, "ORDERED", -1)  # by counting
    df = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    plan = q.quantiles(df, ["v"], [0.5])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


# Distributions


@pytest.fixture(scope="module")
def frame():
    generator = np.random.default_rng(11)
    return pd.DataFrame({
        "g": generator.choice(["a", "b"], 500), "x": generator.gamma(2, 30, 500).round(2),
        "y": generator.normal(size=500), "t": generator.choice(["p", "q", "r"], 500, p=[.5, .3, .2])})


def test_describe_equals_pandas(spark, frame):
    rows = {r["feature"]: r for r in distributions.describe_numeric(spark.createDataFrame(frame), ["x", "y"]).collect()}
    expected = frame[["x", "y"]].describe().round(2)
    for c in ("x", "y"):
        got = [rows[c][n] for n in ("count", "mean", "std", "min", "q25", "median", "q75", "max")]
        assert got == pytest.approx(list(expected[c]), abs=1e-9)


def test_categorical_describe(spark, frame):
    rows = {r["feature"]: tuple(r)[1:] for r in distributions.describe_categorical(spark.createDataFrame(frame), ["g", "t"]).collect()}
    for c in ("g", "t"):
        expected = frame[c].describe()
        assert rows[c] == (expected["count"], expected["unique"], expected["top"], expected["freq"])
    tie = spark.createDataFrame([("z",), ("b",), ("z",), ("b",), (None,)], "c string")
    assert tuple(distributions.describe_categorical(tie, ["c"]).first()) == ("c", 4, 2, "b", 2)


def test_correlations_are_pairwise_complete(spark, frame):
    holes = frame[["x", "y"]].copy()
    holes.loc[:50, "y"] = np.nan
    holes["z"] = holes["x"] * 2 + holes["y"].fillna(1)
    rows = {(r[0], r[1]): r[2] for r in distributions.correlations(spark.createDataFrame(holes), ["x", "y", "z"]).collect()}
    expected = holes.corr()
    assert len(rows) == 9
    for (a, b), value in rows.items():
        assert value == pytest.approx(expected.loc[a, b], abs=6e-5)
    ordered = [r["correlation"] for r in distributions.label_correlations(spark.createDataFrame(holes), ["x", "y"], "z").collect()]
    assert ordered == sorted(ordered)


def test_histogram_equals_numpy(spark, frame):
    df = spark.createDataFrame(frame)
    rows = distributions.histogram(df, "x", 30).orderBy("bin").collect()
    counts, edges = np.histogram(frame["x"], bins=30)
    assert [r["count"] for r in rows] == list(counts)
    assert [r["bin_start"] for r in rows] == pytest.approx(list(edges[:-1]))
    grouped = distributions.histogram(df, "x", 10, ["g"])
    for g, part in frame.groupby("g"):
        assert [r["count"] for r in grouped.where(F.col("g") == g).orderBy("bin").collect()] == list(np.histogram(part["x"], bins=10)[0])


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(5.0,)] * 4, "v double")
    rows = distributions.histogram(df, "v", 4).orderBy("bin").collect()
    assert [r["count"] for r in rows] == list(np.histogram([5.0] * 4, bins=4)[0])
    assert (rows[0]["bin_start"], rows[-1]["bin_end"]) == (4.5, 5.5)


def test_box_numbers(spark, frame):
    rows = {r["g"]: r for r in distributions.box_stats(spark.createDataFrame(frame), "x", ["g"]).collect()}
    for g, part in frame.groupby("g"):
        x, r = part["x"], rows[g]
        q1, median, q3 = x.quantile([.25, .5, .75])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        assert (r["q25"], r["median"], r["q75"]) == pytest.approx((q1, median, q3))
        assert (r["whisker_low"], r["whisker_high"]) == (x[x >= low].min(), x[x <= high].max())
        assert r["outliers"] == int(((x < low) | (x > high)).sum())
        assert r["notch_high"] - r["median"] == pytest.approx(1.57 * (q3 - q1) / np.sqrt(len(x)))


def test_density_is_close_to_the_unbinned_one(spark, frame):
    for by in (["g"], []):
        rows = distributions.density(spark.createDataFrame(frame), "x", by).orderBy(*by, "point").collect()
        for g, part in (frame.groupby("g") if by else [(None, frame)]):
            x = part["x"].to_numpy()
            h = x.std(ddof=1) * len(x) ** -0.2
            mine = [(r["x"], r["density"]) for r in rows if not by or r["g"] == g]
            assert len(mine) == 100
            for at, height in mine[::9]:
                true = np.exp(-0.5 * ((at - x) / h) ** 2).sum() / (len(x) * h * np.sqrt(2 * np.pi))
                assert height == pytest.approx(true, rel=0.01, abs=1e-6)


# Reports


def test_rates_of_groups_add_up(spark, frame):
    df = spark.createDataFrame(frame).withColumn("Churn", (F.col("x") > 60).cast("int")).withColumn("tenure", F.col("y")).withColumn("MonthlyCharges", F.col("x"))
    whole = reports.kpis(df).first()
    groups = reports.rate_by(df, ["g", "t"]).collect()
    assert sum(r["total"] for r in groups) == whole["total_customers"] == 500
    assert sum(r["churned"] for r in groups) == whole["churned"]


def test_empty_input_is_safe(spark):
    empty = spark.createDataFrame([], "Churn int, MonthlyCharges double, tenure int, ChurnRisk string, Contract string")
    row = reports.kpis(empty).first()
    assert (row["total_customers"], row["churn_rate_pct"], row["lost_monthly_revenue"]) == (0, 0.0, 0.0)
    assert reports.rate_by(empty, "Contract").count() == 0


def test_listed_groups_keep_empty_ones(spark):
    df = spark.createDataFrame([("b", 1, 5.0), ("b", 0, 6.0), (None, 1, 7.0), ("a", 0, 2.0)], "seg string, Churn int, MonthlyCharges double")
    rows = [tuple(r) for r in reports.rate_by(df, "seg", order_labels=["c", "b", "a"]).orderBy("position").collect()]
    assert rows == [("c", 0, 0, 0, None), ("b", 1, 2, 1, 50.0), ("a", 2, 1, 0, 0.0)]
    lost = [tuple(r) for r in reports.loss_by(df, "seg", order_labels=["c", "b", "a"]).orderBy("position").collect()]
    assert lost == [("c", 0, None, None), ("b", 1, 5.0, 1), ("a", 2, None, None)]


def test_value_counts(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "v string")
    assert [tuple(r) for r in reports.value_counts(df, "v", normalise=True).collect()] == [("a", 2, 40.0), ("b", 2, 40.0), ("c", 1, 20.0)]


# Evaluation


def pairwise_auc(labels, scores):
    positive = [s for l, s in zip(labels, scores) if l == 1]
    negative = [s for l, s in zip(labels, scores) if l == 0]
    if not positive or not negative:
        return None
    return sum((p > n) + (p == n) / 2 for p in positive for n in negative) / (len(positive) * len(negative))


@settings(**SLOW)
@given(st.lists(st.tuples(st.integers(0, 1), st.one_of(st.sampled_from([0.0, 0.5, 1.0]), st.floats(0, 1))), min_size=1, max_size=50))
def test_auc_is_the_pairwise_probability(spark, pairs):
    df = spark.createDataFrame(pairs, "label int, score double")
    got = evaluation.roc_auc(df, digits=None).first()["roc_auc"]
    assert got == (None if (want := pairwise_auc(*zip(*pairs))) is None else pytest.approx(want))


def test_auc_of_many_clustered_scores(spark):
    generator = np.random.default_rng(2)
    label = generator.integers(0, 2, 60_000)
    score = np.where(generator.random(60_000) < 0.4, 0.25, 0.5 + 1e-9 * (generator.normal(size=60_000) + label))
    ranks = pd.Series(score).rank()
    n1, n0 = label.sum(), (1 - label).sum()
    want = (ranks[label == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)
    df = spark.createDataFrame(pd.DataFrame({"label": label, "score": score})).repartition(9)
    assert evaluation.roc_auc(df, digits=None).first()["roc_auc"] == pytest.approx(want, rel=1e-12)


def test_auc_agrees_with_spark_ml(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    df = spark.range(3000).select((F.rand(1) < 0.3).cast("double").alias("label"), F.round(F.rand(2), 3).alias("score"))
    df = spark.createDataFrame(df.toPandas())
    other = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0).evaluate(df)
    assert evaluation.roc_auc(df, digits=None).first()["roc_auc"] == pytest.approx(other, abs=1e-9)


def test_class_metrics_without_positive_guesses(spark):
    df = spark.createDataFrame([("m", 1, 0, 0.1), ("m", 0, 0, 0.2)], "model string, label int, prediction int, score double")
    row = evaluation.evaluate(df).first()
    assert (row["precision"], row["recall"], row["f1"], row["accuracy"], row["roc_auc"]) == (0.0, 0.0, 0.0, 0.5, 0.0)
    matrix = {(r["actual"], r["predicted"]): r["count"] for r in evaluation.confusion_rows(evaluation.confusion(df)).collect()}
    assert matrix == {(0, 0): 1, (0, 1): 0, (1, 0): 1, (1, 1): 0}


def test_best_model_prefers_the_first_of_equals(spark):
    df = spark.createDataFrame([("c", 0.8), ("b", 0.9), ("a", 0.9)], "model string, roc_auc double")
    assert evaluation.select_best(df, ["c", "b", "a"]).first()["model"] == "b"
    assert evaluation.select_best(df, ["a", "b", "c"]).first()["model"] == "a"


def test_large_group_tables_are_shuffled_with_the_same_result(spark, frame):
    df = spark.createDataFrame(frame).withColumn("label", (F.col("y") > 0).cast("int")).withColumn("Churn", F.col("label"))
    trials = {
        "quantiles": lambda: q.quantiles(df, ["x", "y"], [0.25, 0.5], ["g", "t"]),
        "box": lambda: distributions.box_stats(df, "x", ["g"]),
        "histogram": lambda: distributions.histogram(df, "x", 7, ["t"]),
        "density": lambda: distributions.density(df, "x", ["g"], grid=9),
    }
    collect = lambda run: sorted(map(tuple, run.collect()), key=repr)
    small = {name: collect(trial()) for name, trial in trials.items()}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", before)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        for name, trial in trials.items():
            run = trial()
            assert "SortMergeJoin" in run._jdf.queryExecution().executedPlan().toString()
            for a, b in zip(collect(run), small[name], strict=True):
                assert a == pytest.approx(b, nan_ok=True)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", adaptive)


def test_value_on_a_bin_edge_is_counted_where_the_edges_say(spark):
    numbers = [i / 10 for i in range(31)]
    rows = distributions.histogram(spark.createDataFrame([(n,) for n in numbers], "v double"), "v", 30).orderBy("bin").collect()
    assert [r["count"] for r in rows] == list(np.histogram(numbers, bins=30)[0])
    for r in rows:
        inside = [n for n in numbers if r["bin_start"] <= n and (n < r["bin_end"] or r["bin"] == 29)]
        assert r["count"] == len(inside)


def test_whisker_never_ends_inside_the_box(spark):
    df = spark.createDataFrame([("a", v) for v in (0.0, 0.0, 0.0, 10.0, 100.0)], "g string, v double")
    row = distributions.box_stats(df, "v", ["g"]).first()
    assert (row["q25"], row["q75"], row["whisker_low"], row["whisker_high"], row["outliers"]) == (0.0, 10.0, 0.0, 10.0, 1)


def test_quantiles_of_infinities(spark):
    df = spark.createDataFrame([(float("-inf"),), (float("-inf"),), (1.0,), (float("inf"),), (float("inf"),)], "v double")
    row = q.quantiles(df, ["v"], [0.1, 0.5, 0.9]).first()
    assert (row["q10"], row["q50"], row["q90"]) == (float("-inf"), 1.0, float("inf"))


def by_numpy(values, probs):
    return pytest.approx(list(np.quantile(values, probs)), rel=1e-12, abs=1e-300)


@pytest.mark.parametrize("change", [{}, {"ORDERED": -1}, {"WIDTH": 0}, {"SKETCH": 8, "WIDTH": 0.01}, {"MERGED": 1}])
def test_bracketed_quantiles_are_exact_whatever_the_brackets(spark, monkeypatch, change):
    """Brackets that miss, or are too wide to order, cost a count and change no result."""
    for name, value in change.items():
        monkeypatch.setattr(q, name, value)
    rng = np.random.default_rng(3)
    columns = {
        "even": rng.random(20_000), "steep": rng.lognormal(0, 6, 20_000), "tied": rng.integers(0, 4, 20_000).astype(float),
        "two far ends": np.where(rng.random(20_000) < 0.5, -1e300, 1e300), "almost one": np.where(rng.random(20_000) < 0.999, 7.0, rng.random(20_000)),
        "rising": np.arange(20_000.0), "signed": rng.normal(0, 1, 20_000) ** 3}
    df = spark.createDataFrame(pd.DataFrame(columns)).repartition(6)
    rows = {r["feature"]: r for r in q.quantiles(df, list(columns), PROBS).collect()}
    for name, values in columns.items():
        assert [rows[name][q.quantile_name(p)] for p in PROBS] == by_numpy(values, PROBS), name


def test_bracketed_quantiles_read_the_rows_twice(spark):
    read = spark.sparkContext.accumulator(0)

    def passing(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = spark.range(50_000).selectExpr("cast(id as double) as a", "cast(if(id % 10 = 0, null, id * id) as double) as b").mapInArrow(passing, "a double, b double")
    rows = {r["feature"]: tuple(r)[1:] for r in q.quantiles(df, ["a", "b"], [0.25, 0.5]).collect()}
    assert read.value == 100_000
    b = [i * i for i in range(50_000) if i % 10]
    assert rows == {"a": by_numpy(range(50_000), [0.25, 0.5]), "b": by_numpy(b, [0.25, 0.5])}
    assert [r["feature"] for r in q.medians(df, ["a", "b"], gappy=True).collect()] == ["b"]


def test_bracketed_quantiles_of_few_or_no_values(spark):
    df = spark.createDataFrame([(1.0, None, -0.0), (None, None, 0.0), (float("nan"), None, 5e-324)], "a double, b double, c double")
    assert [tuple(r) for r in q.quantiles(df, ["a", "b", "c"], [0.0, 0.5, 1.0]).collect()] == [("a", 1.0, 1.0, 1.0), ("c", 0.0, 0.0, 5e-324)]
    assert q.quantiles(df.where("1 = 0"), ["a", "b"], [0.5]).count() == 0


def test_correlations_of_many_columns_come_from_one_matrix(spark, monkeypatch):
    rng = np.random.default_rng(6)
    base = rng.normal(1000, 3, (3000, 1))
    frame = pd.DataFrame(np.hstack([base + rng.normal(0, s, (3000, 12)) for s in (0.1, 2, 30)]), columns=[f"c{i}" for i in range(36)])
    frame = frame.mask(rng.random(frame.shape) < 0.2)
    frame["c3"], frame.loc[5:, "c4"], frame["c5"] = 7.0, np.nan, np.nan
    df = spark.createDataFrame(frame).repartition(5)
    cols = list(frame.columns)
    rows = lambda cols: {(r["feature_a"], r["feature_b"]): r["correlation"] for r in distributions.correlations(df, cols).collect()}
    matrix = rows(cols)
    assert len(matrix) == 36 * 36 and all(matrix["c3", c] is None and matrix[c, "c3"] is None for c in cols)
    monkeypatch.setattr(distributions, "PAIRS", 10**6)
    plain = rows([c for c in cols if c != "c3"])  # one by one a column that does not vary is an error
    assert len(plain) == 35 * 35
    for pair, r in plain.items():
        known = r is not None and not math.isnan(r)
        assert (matrix[pair] == pytest.approx(r, abs=2e-4)) if known else (matrix[pair] is None or math.isnan(matrix[pair])), pair


def test_correlations_of_two_hundred_columns(spark):
    df = spark.range(400).select(*[(F.sin(F.col("id") * (i + 1)) + F.col("id") / 100).alias(f"c{i}") for i in range(200)])
    rows = distributions.correlations(df, df.columns)
    assert rows.count() == 40_000 and rows.where("feature_a = feature_b and correlation <> 1").count() == 0
    frame = df.toPandas().corr()
    got = rows.toPandas().pivot(index="feature_a", columns="feature_b", values="correlation").loc[frame.index, frame.columns]
    assert np.abs(got.to_numpy() - frame.to_numpy()).max() < 1e-4
