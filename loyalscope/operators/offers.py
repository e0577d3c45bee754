"""Retention offers: an ordered rule list, the first rule that holds wins."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from loyalscope import schema
from loyalscope.functions import finite, quoted, zero_if_missing
from loyalscope.operators.reports import value_counts

# What an absent column counts as, and the rules in order of precedence
DEFAULTS = {
    "ChurnProbability": 0.5, "ChurnRisk": "Medium", "Contract": "", "InternetService": "",
    "PaymentMethod": "", "SeniorCitizen": 0, "tenure": 12, "MonthlyCharges": 50,
}
NUMERIC = ["ChurnProbability", "tenure", "MonthlyCharges"]


class Rule(NamedTuple):
    offer: str
    holds: Callable[[Mapping[str, Column]], Column]
    risks: tuple[str, ...] = ()  # empty: any risk


AT_RISK = ("High", "Medium")
RULES = [
    Rule("RETENTION_CALL", lambda c: c["ChurnProbability"] >= 0.80),
    Rule("SENIOR_PLAN", lambda c: c["SeniorCitizen"] == 1, AT_RISK),
    Rule("CONTRACT_UPGRADE", lambda c: c["Contract"].contains("Month-to-month"), AT_RISK),
    Rule("TECHSUPPORT_BUNDLE", lambda c: c["InternetService"].contains("Fiber"), AT_RISK),
    Rule("AUTOPAY_CASHBACK", lambda c: c["PaymentMethod"].contains("Electronic check"), AT_RISK),
    Rule("LOYALTY_UPGRADE", lambda c: c["tenure"] > 36, ("High",)),
    Rule("STREAMING_BUNDLE", lambda c: c["MonthlyCharges"] > 70, AT_RISK),
]
FALLBACK = "STANDARD_LOYALTY"


def _inputs(df: DataFrame) -> dict[str, Column]:
    found = {name: F.col(name) if name in df.columns else F.lit(default) for name, default in DEFAULTS.items()}
    found.update({name: finite(found[name].cast("double")) for name in NUMERIC})
    found["SeniorCitizen"] = zero_if_missing(found["SeniorCitizen"].cast("int"))
    return found


def offer_id(df: DataFrame, rules: list[Rule] = RULES, fallback: str = FALLBACK) -> Column:
    """The id of the offer each row gets, as one expression."""
    c = _inputs(df)
    chosen = []
    for rule in rules:
        holds = rule.holds(c)
        if rule.risks:
            holds = holds & c["ChurnRisk"].isin(list(rule.risks))
        chosen.append(F.when(holds, F.lit(rule.offer)))
    return F.coalesce(*chosen, F.lit(fallback))


def catalogue(spark) -> DataFrame:
    """The offer catalogue: eight rows."""
    names = ["OfferID", "OfferTitle", "OfferDescription", "OfferDiscount", "OfferAction", "priority"]
    rows = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, offer)]) for offer in schema.OFFERS])
    return spark.range(1).select(F.inline(rows))


def recommend(df: DataFrame, rules: list[Rule] = RULES, with_priority: bool = False) -> DataFrame:
    """Add the offer columns. Every row gets exactly one offer."""
    offers = catalogue(df.sparkSession)
    if not with_priority:
        offers = offers.drop("priority")
    chosen = df.withColumn("OfferID", offer_id(df, rules))
    return chosen.join(F.broadcast(offers), "OfferID", "left").select(
        *[F.col(quoted(c)) for c in df.columns], *offers.columns)


def offer_distribution(df: DataFrame) -> DataFrame:
    return value_counts(df, "OfferTitle")
