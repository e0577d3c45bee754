"""Risk bands and retention offers."""

from __future__ import annotations

from pyspark.sql import functions as F

from loyalscope.catalogue.base import RISK_SQL, cleaned, offer_sql, offered, query, raw, scored
from loyalscope.functions import risk_band
from loyalscope.operators import features, learning, offers, reports, segments
from loyalscope.sources.subscribers import stand_in_score

_LEFT = "CASE WHEN score >= 0.65 THEN 'High' WHEN score >= 0.35 THEN 'Medium' ELSE 'Low' END"


@query("m12_risk_bands", f"SELECT customerID, score, {RISK_SQL.format('score')} AS batch_risk, {_LEFT} AS single_risk FROM scored")
def risk_bands(spark, sf_dir):
    rows = cleaned(spark, sf_dir).select("customerID", stand_in_score().alias("score"))
    return rows.withColumns({"batch_risk": risk_band(F.col("score")), "single_risk": risk_band(F.col("score"), "left")})


@query("r1_offer_rules", "SELECT customerID, ChurnProbability, ChurnRisk, OfferID FROM offered")
def offer_rules(spark, sf_dir):
    rows = scored(spark, sf_dir)
    return rows.select("customerID", "ChurnProbability", "ChurnRisk", offers.offer_id(rows).alias("OfferID"))


@query("r1_offer_rules_mirrored", f"""SELECT customerID, p AS ChurnProbability, risk AS ChurnRisk, {offer_sql('p', 'risk')} AS OfferID
    FROM (SELECT *, {RISK_SQL.format('p')} AS risk FROM (SELECT *, round_even(1 - score, 4) AS p FROM scored))""")
def offer_rules_mirrored(spark, sf_dir):
    """With the score mirrored the loyalty rule is reached too."""
    rows = scored(spark, sf_dir, mirrored=True)
    return rows.select("customerID", "ChurnProbability", "ChurnRisk", offers.offer_id(rows).alias("OfferID"))


@query("r1d_offer_defaults", f"""SELECT customerID, CASE WHEN contains(Contract, 'Month-to-month') THEN 'CONTRACT_UPGRADE'
    ELSE 'STANDARD_LOYALTY' END AS OfferID FROM feat""")
def offer_defaults(spark, sf_dir):
    """Only the contract is known: medium risk, short tenure and a modest charge are assumed."""
    rows = cleaned(spark, sf_dir).select("customerID", "Contract")
    return rows.select("customerID", offers.offer_id(rows).alias("OfferID"))


@query("r2_offer_details", """SELECT customerID, OfferID, OfferTitle, OfferDescription, OfferDiscount, OfferAction,
    CAST(priority AS INT) AS priority FROM offered""")
def offer_details(spark, sf_dir):
    rows = offers.recommend(scored(spark, sf_dir), with_priority=True)
    return rows.select("customerID", "OfferID", "OfferTitle", "OfferDescription", "OfferDiscount", "OfferAction", "priority")


@query("r4_single_profile_rules", f"""SELECT customerID, score AS ChurnProbability, risk AS ChurnRisk, {offer_sql('score', 'risk')} AS OfferID
    FROM (SELECT *, {_LEFT} AS risk FROM scored)""")
def single_profile_rules(spark, sf_dir):
    """Raw profiles to features, a left-closed risk band and an offer, with the stand-in score as the model."""
    profiles = features.profile_features(raw(spark, sf_dir)).withColumn("score", stand_in_score())
    rows = learning.add_risk(profiles, "score", closed="left")
    return rows.select("customerID", "ChurnProbability", "ChurnRisk", offers.offer_id(rows).alias("OfferID"))


@query("r3_offer_distribution", "SELECT OfferTitle, count(*) AS count FROM offered GROUP BY OfferTitle")
def offer_distribution(spark, sf_dir):
    return offers.offer_distribution(offered(spark, sf_dir))


@query("r3_offers_among_at_risk", """SELECT OfferTitle, count(*) AS count FROM offered
    WHERE ChurnRisk IN ('High', 'Medium') AND ChurnProbability >= 0.5 GROUP BY OfferTitle""")
def offers_among_at_risk(spark, sf_dir):
    return reports.value_counts(segments.at_risk(offered(spark, sf_dir)), "OfferTitle")
