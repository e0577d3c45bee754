import pytest
from pyspark.sql import functions as F

from loyalscope import schema
from loyalscope.operators import offers, segments

COLUMNS = ("ChurnProbability double, ChurnRisk string, Contract string, InternetService string, PaymentMethod string, "
           "SeniorCitizen int, tenure int, MonthlyCharges double")
CASES = [
    ((0.66, "High", "Month-to-month", "No", "Credit card (automatic)", 0, 11, 24.5), "CONTRACT_UPGRADE"),
    ((0.83, "High", "Two year", "DSL", "Bank transfer (automatic)", 1, 44, 61.0), "RETENTION_CALL"),
    ((0.41, "Medium", "Two year", "Fiber optic", "Electronic check", 1, 50, 99.0), "SENIOR_PLAN"),
    ((0.74, "High", "Two year", "No", "Electronic check", 0, 40, 80.0), "AUTOPAY_CASHBACK"),
    ((0.12, "Low", "Month-to-month", "Fiber optic", "Electronic check", 0, 3, 88.0), "STANDARD_LOYALTY"),
    ((0.55, "Medium", "One year", "Fiber optic", "Electronic check", 0, 18, 50.0), "TECHSUPPORT_BUNDLE"),
    ((0.70, "High", "Two year", "DSL", "Mailed check", 0, 37, 50.0), "LOYALTY_UPGRADE"),
    ((0.70, "High", "Two year", "DSL", "Mailed check", 0, 36, 50.0), "STANDARD_LOYALTY"),
    ((0.55, "Medium", "Two year", "DSL", "Mailed check", 0, 60, 70.01), "STREAMING_BUNDLE"),
    ((0.55, "Medium", "Two year", "DSL", "Mailed check", 0, 60, 70.0), "STANDARD_LOYALTY"),
    ((0.80, "Low", "Two year", "No", "Mailed check", 1, 60, 20.0), "RETENTION_CALL"),
    ((0.7999, "Low", "Month-to-month", "Fiber optic", "Electronic check", 1, 60, 90.0), "STANDARD_LOYALTY"),
    ((None, "High", None, None, None, None, None, None), "STANDARD_LOYALTY"),
    ((float("nan"), "High", "Two year", "DSL", "Mailed check", 0, 10, float("nan")), "STANDARD_LOYALTY"),
]


@pytest.mark.parametrize("profile, offer", CASES)
def test_rules(spark, profile, offer):
    assert offers.recommend(spark.createDataFrame([profile], COLUMNS)).first()["OfferID"] == offer


def test_details_and_row_count(spark, featured):
    scored = featured.withColumn("ChurnProbability", F.lit(0.5)).withColumn("ChurnRisk", F.lit("Medium"))
    out = offers.recommend(scored)
    assert out.columns == [*scored.columns, "OfferID", "OfferTitle", "OfferDescription", "OfferDiscount", "OfferAction"]
    rows = out.collect()
    assert len(rows) == 5 and all(r["OfferTitle"] for r in rows)
    assert offers.recommend(scored, with_priority=True).where("priority is null").count() == 0
    assert sum(r["count"] for r in offers.offer_distribution(out).collect()) == 5


def test_absent_columns_have_defaults(spark):
    monthly = spark.createDataFrame([("Month-to-month",), ("Two year",)], "Contract string")
    assert [r["OfferID"] for r in offers.recommend(monthly).collect()] == ["CONTRACT_UPGRADE", "STANDARD_LOYALTY"]


def test_catalogue_covers_every_rule(spark):
    ids = {r["OfferID"] for r in offers.catalogue(spark).collect()}
    assert ids == {o[0] for o in schema.OFFERS}
    assert {r.offer for r in offers.RULES} | {offers.FALLBACK} == ids


def test_rules_are_data(spark):
    rules = [offers.Rule("SENIOR_PLAN", lambda c: c["tenure"] > 100), offers.Rule("RETENTION_CALL", lambda c: c["tenure"] > 1)]
    df = spark.createDataFrame([(200,), (50,), (0,)], "tenure int")
    assert [r[0] for r in df.select(offers.offer_id(df, rules)).collect()] == ["SENIOR_PLAN", "RETENTION_CALL", "STANDARD_LOYALTY"]


# Segments


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [("a", "High", 0.9, "x", 10), ("b", "Medium", 0.5, "y", 20), ("c", "Medium", 0.4999, "x", 30), ("d", "Low", 0.6, "x", 40), ("e", "High", 0.9, None, 50)],
        "customerID string, ChurnRisk string, ChurnProbability double, OfferTitle string, tenure int")


def ids(df):
    return [r["customerID"] for r in df.collect()]


def test_at_risk(people):
    assert ids(segments.at_risk(people)) == ["a", "b", "e"]
    assert ids(segments.at_risk(people, offers=["y"])) == ["b"]
    assert ids(segments.at_risk(people, risks=[])) == []
    assert ids(segments.at_risk(people, risks=["Low"], min_score=0.0)) == ["d"]


def test_filters(people):
    assert ids(segments.filter_segment(people, equals={"ChurnRisk": "All", "OfferTitle": None})) == list("abcde")
    assert ids(segments.filter_segment(people, equals={"ChurnRisk": "High"}, ranges={"tenure": (10, 20)})) == ["a"]


def test_ranked_lists(people):
    assert ids(segments.top_n(people, "ChurnProbability", 3, "customerID")) == ["a", "e", "d"]
    assert ids(segments.first_n(people, ["tenure"], 2)) == ["a", "b"]
    assert ids(segments.last_n(people, ["tenure"], 2)) == ["d", "e"]
    assert ids(segments.latest_n(people, "tenure", "customerID", 2)) == ["e", "d"]
    assert [r[0] for r in segments.distinct_values(people, "OfferTitle").collect()] == ["x", "y"]
    assert segments.keep_columns(people, ["nope", "tenure"]).columns == ["tenure"]
    assert ids(segments.drop_incomplete(people, ["OfferTitle"])) == list("abcd")


def test_ranked_limit_does_not_sort_everything(people):
    plan = segments.top_n(people, "ChurnProbability", 3, "customerID")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
