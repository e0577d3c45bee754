"""The registry, the staged tables the queries read, and the matching SQL views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from loyalscope import schema
from loyalscope.operators import learning, offers
from loyalscope.plans import churn
from loyalscope.session import scratch_path
from loyalscope.sources.subscribers import stand_in_score, subscriber_sql, subscribers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``oracle`` is the body of a SELECT over the views below."""
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = VIEWS + oracle
        return function
    return register


# Staged tables ---------------------------------------------------------------------------------
# Reports read a cleaned table that a load run has written, so the queries share one as well. It is
# written once per session and state of the inputs, into the shared folder.

_STAGED: dict[tuple, str] = {}


def _state(spark: SparkSession, sf_dir: str) -> tuple:
    path = spark._jvm.org.apache.hadoop.fs.Path
    out = []
    for name in ("customer", "orders"):
        place = path(f"{sf_dir}/{name}.parquet")
        status = place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place)
        out += [status.getModificationTime(), status.getLen()]
    return (spark.sparkContext.applicationId, sf_dir, *out)


def staged(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    key = (name, *_state(spark, sf_dir))
    if key not in _STAGED:
        path = scratch_path(spark, name)
        build().write.mode("overwrite").parquet(path)
        _STAGED[key] = path
    return spark.read.parquet(_STAGED[key])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, sf_dir, "raw", lambda: subscribers(spark, sf_dir))


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, sf_dir, "cleaned", lambda: churn.transform(raw(spark, sf_dir), schema.LEVELS))


def scored(spark: SparkSession, sf_dir: str, mirrored: bool = False) -> DataFrame:
    """Cleaned rows with the stand-in score, as a batch run would band it."""
    score = stand_in_score()
    rows = cleaned(spark, sf_dir).withColumn("score", 1 - score if mirrored else score)
    return learning.add_risk(rows, "score")


def offered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offers.recommend(scored(spark, sf_dir))


def trial_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model, label, prediction, score) of three formula models on every customer."""
    score = stand_in_score()
    rows = cleaned(spark, sf_dir).select(
        F.col("Churn").alias("label"), score.alias("Formula"), (1 - score).alias("Mirrored"),
        (F.col("MonthlyCharges") / 120).alias("Charge"))
    long = rows.unpivot(["label"], TRIAL_MODELS, "model", "score")
    return long.withColumn("prediction", (F.col("score") >= schema.CHURN_THRESHOLD).cast("int"))


TRIAL_MODELS = ["Formula", "Mirrored", "Charge"]

# SQL views -------------------------------------------------------------------------------------


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_rate(part: str, whole: str, digits: int) -> str:
    return f"round(CAST({part} AS DOUBLE) * 100.0 / nullif(CAST({whole} AS DOUBLE), 0), {digits})"


TENURE_GROUP_SQL = """CASE WHEN tenure > 0 AND tenure <= 12 THEN '0-1 Year' WHEN tenure > 12 AND tenure <= 24 THEN '1-2 Years'
    WHEN tenure > 24 AND tenure <= 48 THEN '2-4 Years' WHEN tenure > 48 AND tenure <= 72 THEN '4-6 Years' END"""
REVENUE_SQL = "CASE WHEN MonthlyCharges < 35 THEN 'Low' WHEN MonthlyCharges < 70 THEN 'Medium' ELSE 'High' END"
RISK_SQL = "CASE WHEN {0} <= 0.35 THEN 'Low' WHEN {0} <= 0.65 THEN 'Medium' ELSE 'High' END"
SCORE_SQL = """cast(least(9900, greatest(100, 4500 + cast(floor((round(MonthlyCharges * 100, 0) - 6800) / 2) AS int)
     - cast(floor(cast(tenure * 10000 AS double) / 160) AS int)
     + CASE Contract WHEN 'Month-to-month' THEN 2500 WHEN 'One year' THEN 500 ELSE -1000 END)) AS double) / 10000"""


def _code(col: str) -> str:
    one = "Male" if col == "gender" else "Yes"
    return f"CASE WHEN {col} = '{one}' THEN 1 ELSE 0 END AS {col}_encoded"


def offer_sql(score: str, risk: str) -> str:
    hm = f"{risk} IN ('High','Medium')"
    return f"""CASE WHEN {score} >= 0.80 THEN 'RETENTION_CALL'
        WHEN SeniorCitizen = 1 AND {hm} THEN 'SENIOR_PLAN'
        WHEN Contract LIKE '%Month-to-month%' AND {hm} THEN 'CONTRACT_UPGRADE'
        WHEN InternetService LIKE '%Fiber%' AND {hm} THEN 'TECHSUPPORT_BUNDLE'
        WHEN PaymentMethod LIKE '%Electronic check%' AND {hm} THEN 'AUTOPAY_CASHBACK'
        WHEN tenure > 36 AND {risk} = 'High' THEN 'LOYALTY_UPGRADE'
        WHEN MonthlyCharges > 70 AND {hm} THEN 'STREAMING_BUNDLE'
        ELSE 'STANDARD_LOYALTY' END"""


_DUCK_DAYS = "date_diff('day', cast({a} as date), cast({b} as date))"
_SUB = subscriber_sql(_DUCK_DAYS).format(customer="customer", orders="orders")
_CODES = ", ".join(_code(c) for c in ["gender", *schema.YES_NO_COLUMNS])
_OFFERS = ", ".join("(" + ", ".join(text(v) if isinstance(v, str) else str(v) for v in o) + ")" for o in schema.OFFERS)

VIEWS = f"""WITH sub AS ({_SUB}),
num AS (SELECT * REPLACE (try_cast(trim(TotalCharges) AS DOUBLE) AS TotalCharges) FROM sub),
clean AS (SELECT DISTINCT * REPLACE (coalesce(TotalCharges,
    (SELECT quantile_cont(TotalCharges, 0.5) FROM num)) AS TotalCharges) FROM num),
feat AS (SELECT * REPLACE (CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS Churn), {_CODES},
    {TENURE_GROUP_SQL} AS tenure_group, {REVENUE_SQL} AS RevenueCategory,
    MonthlyCharges * 12 AS AnnualRevenue,
    CAST(tenure AS DOUBLE) / (SELECT max(tenure) FROM sub) AS LoyaltyScore FROM clean),
scored AS (SELECT *, score AS ChurnProbability, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS WillChurn_Predicted,
    {RISK_SQL.format("score")} AS ChurnRisk FROM (SELECT *, {SCORE_SQL} AS score FROM feat)),
catalogue(OfferID, OfferTitle, OfferDescription, OfferDiscount, OfferAction, priority) AS (VALUES {_OFFERS}),
offered AS (SELECT s.*, c.OfferTitle, c.OfferDescription, c.OfferDiscount, c.OfferAction, c.priority
    FROM (SELECT *, {offer_sql("ChurnProbability", "ChurnRisk")} AS OfferID FROM scored) s JOIN catalogue c USING (OfferID)),
trial AS (SELECT model, label, p AS score, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS prediction FROM (
    SELECT 'Formula' AS model, Churn AS label, score AS p FROM scored
    UNION ALL SELECT 'Mirrored', Churn, 1 - score FROM scored
    UNION ALL SELECT 'Charge', Churn, MonthlyCharges / 120 FROM scored)),
confused AS (SELECT model, count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
    count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp, count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
    count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp FROM trial GROUP BY model),
ranked AS (SELECT model, label, rank() OVER (PARTITION BY model ORDER BY score)
    + (count(*) OVER (PARTITION BY model, score) - 1) / 2.0 AS place FROM trial),
areas AS (SELECT model, round((CAST(sum(place) FILTER (WHERE label = 1) AS DOUBLE) - n1 * (n1 + 1) / 2.0) / (n1 * n0), 4) AS roc_auc
    FROM ranked JOIN (SELECT model, CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) AS n1,
        CAST(count(*) FILTER (WHERE label = 0) AS DOUBLE) AS n0 FROM trial GROUP BY model) USING (model) GROUP BY model, n1, n0),
measured AS (SELECT model, tn, fp, fn, tp,
    round((tp + tn) / CAST(tp + tn + fp + fn AS DOUBLE), 4) AS accuracy,
    round(coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0), 4) AS "precision",
    round(coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0), 4) AS recall,
    round(coalesce(2 * tp / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0), 4) AS f1, roc_auc
    FROM confused JOIN areas USING (model))
"""
