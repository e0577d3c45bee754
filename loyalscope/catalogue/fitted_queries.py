"""Learners whose result SQL can reach on its own: one split, boosted single splits, and the one optimum of the logistic
regression. The SQL fits as well, over all prepared rows, so that scores can be compared row by row."""

from __future__ import annotations

from pyspark.sql import functions as F

from loyalscope import schema
from loyalscope.catalogue.base import RISK_SQL, _state, cleaned, query, raw
from loyalscope.operators import evaluation, formulas, learning
from loyalscope.operators.formulas import Formula
from loyalscope.plans import churn
from loyalscope.session import written

BINS = 1 << 20  # every distinct value is a bin of its own, so that thresholds are exact
STEP, TURNS = 0.08, 5
SINGLE = {"RandomForest": {"numTrees": 1, "maxDepth": 1, "bootstrap": False, "featureSubsetStrategy": "all", "maxBins": BINS}}
STUMPS = {"GradientBoosting": {"maxIter": TURNS, "maxDepth": 1, "stepSize": STEP, "maxBins": BINS}}
EXACT = {"LogisticRegression": {"tol": 1e-13}}

_FITTED: dict[tuple, Formula] = {}


def fitted(spark, sf_dir: str, settings: dict) -> Formula:
    """The formula of one learner fitted on all prepared rows, once per session and state of the inputs."""
    (name, _), = settings.items()
    key = (name, *_state(spark, sf_dir))
    if key not in _FITTED:
        prepared = learning.prepare(cleaned(spark, sf_dir))
        _FITTED[key] = formulas.formula(learning.fit_models(prepared.rows, prepared.features, [name], settings)[name], spark)
    return _FITTED[key]


def _scores(spark, sf_dir: str, settings: dict, digits: int = 4):
    rows = learning.probability(learning.prepare(cleaned(spark, sf_dir)).rows, fitted(spark, sf_dir, settings))
    return rows.select("customerID", F.round("score", digits).alias("score"))


# The same fits in SQL ------------------------------------------------------------------------------

_FEATURES = ", ".join(f"CAST({c} AS DOUBLE)" for c in schema.FEATURES)
_NUMBERS = ", ".join(map(str, range(len(schema.FEATURES))))
_PREP = f"""prep AS MATERIALIZED (SELECT customerID, Churn AS y, [{_FEATURES}] AS x,
    (SELECT count(*) FROM feat) / (2.0 * (SELECT count(*) FROM feat AS o WHERE o.Churn = feat.Churn)) AS w FROM feat),
long AS MATERIALIZED (SELECT customerID, unnest([{_NUMBERS}]) AS j, unnest(x) AS v FROM prep)"""


def _best_split(at: str, score: str, sums: dict[str, str], rows: str, where: str = "") -> str:
    """CTEs that find the best split of ``rows`` (customerID and what ``sums`` aggregate): c holds sums up to a value, t all."""
    grouped = ", ".join(f"{value} AS {name}" for name, value in sums.items())
    running = ", ".join(f"sum({name}) OVER (PARTITION BY j ORDER BY v) AS {name}" for name in sums)
    totals = ", ".join(f"sum({name}) AS t{name}" for name in sums)
    return f"""g{at} AS MATERIALIZED (SELECT j, v, {grouped} FROM long JOIN {rows} USING (customerID) GROUP BY j, v),
b{at} AS MATERIALIZED (SELECT j, (v + nv) / 2 AS threshold, * EXCLUDE (j, v, nv) FROM (SELECT j, v, lead(v) OVER (PARTITION BY j ORDER BY v) AS nv, {running} FROM g{at}),
    (SELECT {totals} FROM g{at} WHERE j = 0) WHERE nv IS NOT NULL {where} ORDER BY round({score}, 9) DESC, j, v LIMIT 1)"""


_SINGLE = _best_split("0", "(a * a + b * b) / (a + b) + ((ta - a) * (ta - a) + (tb - b) * (tb - b)) / (ta - a + tb - b)",
                      {"n": "count(*)", "a": "sum(CASE WHEN y = 0 THEN w ELSE 0 END)", "b": "sum(CASE WHEN y = 1 THEN w ELSE 0 END)"}, "prep", "AND n >= 5 AND tn - n >= 5")


def _boosted(turns: int, step: float) -> str:
    """CTEs m0 to m<turns>: the margin of every row after so many splits."""
    parts = ["m0 AS MATERIALIZED (SELECT customerID, 2 * y - 1 AS s, 0e0 AS m, CAST(2 * y - 1 AS DOUBLE) AS r FROM prep)"]
    for i in range(1, turns + 1):
        weight = "1e0" if i == 1 else f"{step:e}"
        parts.append(_best_split(str(i), "q * q / n + (tq - q) * (tq - q) / (tn - n)", {"n": "count(*)", "q": "sum(r)"}, f"m{i - 1}"))
        parts.append(f"""m{i} AS MATERIALIZED (SELECT customerID, s, m, 4 * s / (1 + exp(2 * s * m)) AS r FROM (SELECT customerID, s,
    m + {weight} * CASE WHEN v <= threshold THEN q / n ELSE (tq - q) / (tn - n) END AS m FROM m{i - 1} JOIN long USING (customerID) JOIN b{i} USING (j)))""")
    return ",\n".join(parts)


def _logistic(rounds: int = 1500) -> str:
    """CTEs scaled (x with a leading 1) and fit (one row, b): accelerated descent on the weighted, penalised log loss."""
    k = len(schema.FEATURES)
    parts = ", ".join(f"(x[{i + 1}] - (SELECT avg(x[{i + 1}]) FROM prep)) / (SELECT stddev_samp(x[{i + 1}]) FROM prep)" for i in range(k))
    penalty = f"(1 / ({learning.LOGISTIC['C']} * n))"
    speed, drag = 0.4, 0.955
    ahead = ", ".join(f"b[{i}] + {drag} * (b[{i}] - p[{i}])" for i in range(1, k + 2))
    sums = ", ".join(f"sum(e * z[{i}])" for i in range(1, k + 2))
    after = ", ".join(f"a[{i}] - {speed} * (g[{i}] / n" + (f" + {penalty} * a[{i}])" if i > 1 else ")") for i in range(1, k + 2))
    zeros = "[" + ", ".join(["0e0"] * (k + 1)) + "]"
    return f"""scaled AS MATERIALIZED (SELECT customerID, y, w, [1e0, {parts}] AS z FROM prep),
fit AS MATERIALIZED (SELECT b FROM (WITH RECURSIVE it(i, b, p) AS (SELECT 0, {zeros}, {zeros} UNION ALL
    SELECT i + 1, [{after}], b FROM (SELECT i, b, a, n, [{sums}] AS g FROM (SELECT i, b, a, n, z, w * (1 / (1 + exp(-list_dot_product(z, a))) - y) AS e
        FROM (SELECT i, b, [{ahead}] AS a FROM it WHERE i < {rounds}), scaled, (SELECT CAST(count(*) AS DOUBLE) AS n FROM scaled)) GROUP BY i, b, a, n))
    SELECT * FROM it) WHERE i = {rounds})"""


@query("m3_single_split", f""", {_PREP}, {_SINGLE}
    SELECT customerID, round(CASE WHEN v <= threshold THEN b / (a + b) ELSE (tb - b) / (ta - a + tb - b) END, 4) AS score FROM long JOIN b0 USING (j)""")
def single_split(spark, sf_dir):
    """A forest of one tree of one split, on balanced weights."""
    return _scores(spark, sf_dir, SINGLE)


_MARGINS = f""", {_PREP}, {_boosted(TURNS, STEP)}"""
_P = "1 / (1 + exp(-2 * m))"


@query("m4_boosted_splits", f"{_MARGINS} SELECT customerID, round({_P}, 4) AS score FROM m{TURNS}")
def boosted_splits(spark, sf_dir):
    """Boosted trees of one split each, at the reference's step."""
    return _scores(spark, sf_dir, STUMPS)


@query("m5_logistic_scores", f""", {_PREP}, {_logistic()}
    SELECT customerID, round(1 / (1 + exp(-list_dot_product(z, b))), 4) AS score FROM scaled, fit""")
def logistic_scores(spark, sf_dir):
    """The logistic regression at the reference's penalty, run until nothing changes."""
    return _scores(spark, sf_dir, EXACT)


@query("m5_penalised_gradient", f""", {_PREP}, {_logistic()},
    shifted AS (SELECT [{", ".join(f"b[{i}] + {i} * 0.1e0" for i in range(1, len(schema.FEATURES) + 2))}] AS b FROM fit),
    g AS (SELECT [{", ".join(f"sum(w * e * z[{i}]) / count(*)" for i in range(1, len(schema.FEATURES) + 2))}] AS g, 1 / ({learning.LOGISTIC["C"]} * count(*)) AS penalty
        FROM (SELECT w, z, 1 / (1 + exp(-list_dot_product(z, b))) - y AS e FROM scaled, shifted))
    SELECT unnest({["(intercept)", *schema.FEATURES]}) AS component, unnest([round(g[1], 4), {", ".join(f"round(g[{i}] + penalty * b[{i}], 4)" for i in range(2, len(schema.FEATURES) + 2))}]) AS gradient
    FROM g, shifted""")
def penalised_gradient(spark, sf_dir):
    """The gradient where every coefficient is off the optimum by a tenth of its number, so that no component is 0."""
    prepared = learning.prepare(cleaned(spark, sf_dir))
    line = fitted(spark, sf_dir, EXACT)
    moved = Formula(line.features, line.intercept + 0.1, [[c + 0.1 * (i + 2), m, s] for i, (c, m, s) in enumerate(line.linear)], slope=1.0)
    rows = learning.balanced_weights(prepared.rows)
    found = formulas.gradient(rows, moved, 1 / (learning.LOGISTIC["C"] * rows.count()), weight=learning.WEIGHT)
    return found.withColumn("gradient", F.round("gradient", 4))


@query("m10_split_importance", f""", {_PREP}, {_boosted(TURNS, STEP)},
    gains AS ({" UNION ALL ".join(f"SELECT j, q * q / n + (tq - q) * (tq - q) / (tn - n) - tq * tq / tn AS gain FROM b{i}" for i in range(1, TURNS + 1))}),
    names AS (SELECT unnest([{_NUMBERS}]) AS j, unnest({list(schema.FEATURES)}) AS feature)
    SELECT feature, round(coalesce(sum(gain), 0) / (SELECT sum(gain) FROM gains), 4) AS importance FROM names LEFT JOIN gains USING (j) GROUP BY feature""")
def split_importance(spark, sf_dir):
    """Importance of the boosted splits: what each feature's splits take off the squared error."""
    prepared = learning.prepare(cleaned(spark, sf_dir))
    return learning.importance(learning.fit_models(prepared.rows, prepared.features, list(STUMPS), STUMPS)["GradientBoosting"], spark)


@query("m11_boosted_batch", f"""{_MARGINS}, rated AS (SELECT customerID, m, round({_P}, 4) AS ChurnProbability FROM m{TURNS})
    SELECT customerID, ChurnProbability, CAST({_P} >= 0.5 AS INTEGER) AS WillChurn_Predicted, {RISK_SQL.format("ChurnProbability")} AS ChurnRisk FROM rated""")
def boosted_batch(spark, sf_dir):
    """What a batch run makes of a fitted model: probability, class and band of every row."""
    scored = learning.score(cleaned(spark, sf_dir), fitted(spark, sf_dir, STUMPS))
    return scored.select("customerID", "ChurnProbability", "WillChurn_Predicted", "ChurnRisk")


@query("m15_boosted_quality", f"""{_MARGINS}, rated AS (SELECT y AS label, {_P} AS p FROM m{TURNS} JOIN prep USING (customerID)),
    placed AS (SELECT label, p, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS place FROM rated)
    SELECT count(*) FILTER (label = 0 AND p < 0.5) AS tn, count(*) FILTER (label = 0 AND p >= 0.5) AS fp, count(*) FILTER (label = 1 AND p < 0.5) AS fn,
    count(*) FILTER (label = 1 AND p >= 0.5) AS tp, round((CAST(sum(place) FILTER (label = 1) AS DOUBLE) - n1 * (n1 + 1) / 2.0) / (n1 * n0), 4) AS roc_auc
    FROM placed, (SELECT CAST(sum(y) AS DOUBLE) AS n1, CAST(sum(1 - y) AS DOUBLE) AS n0 FROM prep) GROUP BY n1, n0""")
def boosted_quality(spark, sf_dir):
    """Confusion counts and area of the boosted splits on the rows they were fitted to."""
    rows = learning.probability(learning.prepare(cleaned(spark, sf_dir)).rows, fitted(spark, sf_dir, STUMPS))
    scored = written(rows.select("label", "score", (F.col("score") >= schema.CHURN_THRESHOLD).cast("int").alias("prediction")), "scores")
    return evaluation.confusion(scored).withColumn("roc_auc", evaluation.roc_auc(scored).scalar())


def _form(feature: str) -> str:
    """A feature as the form gives it, over the raw rows."""
    yes = {f"{c}_encoded": f"CASE WHEN {c} = 'Yes' THEN 1 ELSE 0 END" for c in schema.YES_NO_COLUMNS}
    other = {"gender_encoded": "CASE WHEN gender = 'Male' THEN 1 ELSE 0 END", "AnnualRevenue": "MonthlyCharges * 12",
             "TotalCharges": "coalesce(try_cast(TotalCharges AS DOUBLE), MonthlyCharges * tenure)",
             "LoyaltyScore": f"round_even(CAST(tenure AS DOUBLE) / {schema.FORM_MAX_TENURE}, 3)"}
    return f"CAST({ {**yes, **other}.get(feature, feature) } AS DOUBLE)"


_STEPS = " + ".join(("" if i == 1 else f"{STEP:e} * ") + f"(SELECT CASE WHEN x[j + 1] <= threshold THEN q / n ELSE (tq - q) / (tn - n) END FROM b{i})" for i in range(1, TURNS + 1))


@query("m13_boosted_profiles", f"""{_MARGINS}, form AS (SELECT customerID, [{", ".join(map(_form, schema.FEATURES))}] AS x FROM sub),
    rated AS (SELECT customerID, {_P} AS p FROM (SELECT customerID, {_STEPS} AS m FROM form))
    SELECT customerID, round(p, 4) AS ChurnProbability, CAST(p >= 0.5 AS INTEGER) AS WillChurn_Predicted,
    CASE WHEN p < 0.35 THEN 'Low' WHEN p < 0.65 THEN 'Medium' ELSE 'High' END AS ChurnRisk FROM rated""")
def boosted_profiles(spark, sf_dir):
    """Probability, class and band that raw profiles get from the boosted splits."""
    scored = churn.score_profiles(raw(spark, sf_dir), fitted(spark, sf_dir, STUMPS))
    return scored.select("customerID", "ChurnProbability", "WillChurn_Predicted", "ChurnRisk")
