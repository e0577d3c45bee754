"""Encoding, binning, arithmetic and text."""

from __future__ import annotations

from pyspark.sql import functions as F

from loyalscope import schema
from loyalscope.catalogue.base import REVENUE_SQL, TENURE_GROUP_SQL, cleaned, query, raw, scored, table
from loyalscope.functions import ascii_only, binary_code, flag, percent_text, relabel, revenue_category, round_even
from loyalscope.operators import cleaning, features

_CODED = ["gender", *schema.YES_NO_COLUMNS]


@query("f1_strict_codes", "SELECT customerID, Churn, " + ", ".join(f"{c}_encoded" for c in _CODED) + " FROM feat")
def strict_codes(spark, sf_dir):
    codes = {"gender": schema.GENDER, **{c: schema.YES_NO for c in schema.YES_NO_COLUMNS}}
    rows = features.encode_binary(raw(spark, sf_dir), codes).withColumn("Churn", binary_code(F.col("Churn"), schema.YES_NO))
    return rows.select("customerID", "Churn", *[f"{c}_encoded" for c in _CODED])


@query("f2_lenient_flags", """SELECT customerID, CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS ChurnFlag,
    CASE WHEN gender = 'Male' THEN 1 ELSE 0 END AS gender_encoded FROM sub""")
def lenient_flags(spark, sf_dir):
    return raw(spark, sf_dir).select("customerID", flag(F.col("Churn"), "Yes").alias("ChurnFlag"),
                                     flag(F.col("gender"), "Male").alias("gender_encoded"))


_DUMMIES = [(c, v) for c, values in schema.LEVELS.items() for v in values]


@query("f3_one_hot", "SELECT customerID, " + ", ".join(f"{c} = '{v}' AS \"{c}_{v}\"" for c, v in _DUMMIES) + " FROM sub")
def one_hot(spark, sf_dir):
    """The values of each column are found in the data."""
    rows = raw(spark, sf_dir).select("customerID", *schema.LEVELS)
    return features.one_hot(rows, list(schema.LEVELS))


_DOTTED = "CASE WHEN PaymentMethod = 'Mailed check' THEN 'Co. card' ELSE PaymentMethod END"
_DOTTED_LEVELS = sorted(["Co. card"] + [v for v in schema.LEVELS["PaymentMethod"] if v != "Mailed check"])


@query("f3_one_hot_dotted", f"SELECT customerID, Contract, " + ", ".join(f"p = '{v}' AS \"PaymentMethod_{v}\"" for v in _DOTTED_LEVELS)
       + ", " + ", ".join(f"Contract = '{v}' AS \"Contract_{v}\"" for v in schema.LEVELS["Contract"]) + f" FROM (SELECT *, {_DOTTED} AS p FROM sub)")
def one_hot_dotted(spark, sf_dir):
    """A value with a dot in it gives a column with a dot in its name, which later steps take as it is."""
    rows = raw(spark, sf_dir).select("customerID", "Contract", F.expr(_DOTTED).alias("PaymentMethod"))
    return features.one_hot(cleaning.trim_strings(features.one_hot(rows, ["PaymentMethod"])), ["Contract"], keep=["Contract"])


@query("f3_one_hot_long", " UNION ALL ".join(f"SELECT customerID, '{c}' AS \"column\", {c} AS level FROM sub" for c in schema.LEVELS))
def one_hot_long(spark, sf_dir):
    return features.one_hot_long(raw(spark, sf_dir), "customerID", list(schema.LEVELS))


@query("f4_reverse_one_hot", "SELECT customerID, Contract, InternetService, PaymentMethod FROM sub")
def reverse_one_hot(spark, sf_dir):
    rows = features.one_hot(raw(spark, sf_dir), schema.LABEL_COLUMNS, schema.LEVELS)
    for label in schema.LABEL_COLUMNS:
        rows = features.decode_one_hot(rows, label, schema.LEVELS[label])
    return rows.select("customerID", *schema.LABEL_COLUMNS)


@query("f5_tenure_group", f"SELECT customerID, tenure, {TENURE_GROUP_SQL} AS tenure_group FROM sub")
def tenure_group(spark, sf_dir):
    rows = features.bin_column(raw(spark, sf_dir), "tenure", schema.TENURE_EDGES, schema.TENURE_LABELS, "tenure_group")
    return rows.select("customerID", "tenure", "tenure_group")


@query("f6_open_tenure_group", """SELECT customerID, tenure, CASE WHEN tenure <= 12 THEN '0-1 Year' WHEN tenure <= 24 THEN '1-2 Years'
    WHEN tenure <= 48 THEN '2-4 Years' ELSE '4-6 Years' END AS tenure_group FROM sub""")
def open_tenure_group(spark, sf_dir):
    rows = features.bin_column(raw(spark, sf_dir), "tenure", schema.TENURE_EDGES, schema.TENURE_LABELS, "tenure_group", open_ends=True)
    return rows.select("customerID", "tenure", "tenure_group")


@query("f7_revenue_category", f"SELECT customerID, MonthlyCharges, {REVENUE_SQL} AS RevenueCategory FROM sub")
def revenue_categories(spark, sf_dir):
    return raw(spark, sf_dir).select("customerID", "MonthlyCharges", revenue_category(F.col("MonthlyCharges")).alias("RevenueCategory"))


@query("f8_annual_revenue", "SELECT customerID, MonthlyCharges * 12 AS AnnualRevenue FROM sub")
def annual_revenue(spark, sf_dir):
    return raw(spark, sf_dir).select("customerID", (F.col("MonthlyCharges") * 12).alias("AnnualRevenue"))


@query("f9_loyalty_score", """SELECT customerID, CAST(tenure AS DOUBLE) / (SELECT max(tenure) FROM sub) AS by_longest,
    round_even(CAST(tenure AS DOUBLE) / 72, 3) AS by_form FROM sub""")
def loyalty_score(spark, sf_dir):
    rows = features.normalise_by_max(raw(spark, sf_dir), "tenure", "by_longest")
    rows = features.normalise_by_max(rows, "tenure", "by_form", schema.FORM_MAX_TENURE, digits=3)
    return rows.select("customerID", "by_longest", "by_form")


@query("f10_relabel", "SELECT customerID, CASE Churn WHEN 0 THEN 'Retained' WHEN 1 THEN 'Churned' END AS Status FROM feat")
def status(spark, sf_dir):
    return cleaned(spark, sf_dir).select("customerID", relabel(F.col("Churn"), {0: "Retained", 1: "Churned"}).alias("Status"))


@query("f11_ascii_only", """SELECT doc_id, trim(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g'),
    chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(32)) AS text FROM documents""")
def ascii_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", ascii_only(F.col("text")).alias("text"))


@query("f12_percent_text", "SELECT customerID, CAST(round_even(ChurnProbability * 100, 1) AS VARCHAR) || '%' AS risk_text FROM scored")
def percent(spark, sf_dir):
    return scored(spark, sf_dir).select("customerID", percent_text(F.col("ChurnProbability")).alias("risk_text"))


@query("f13_rounding", "SELECT customerID, round_even(LoyaltyScore, 3) AS LoyaltyScore, round(MonthlyCharges / 7, 2) AS weekly FROM feat")
def rounding(spark, sf_dir):
    return cleaned(spark, sf_dir).select("customerID", round_even(F.col("LoyaltyScore"), 3).alias("LoyaltyScore"),
                                         F.round(F.col("MonthlyCharges") / 7, 2).alias("weekly"))


@query("f14_profile_features", """SELECT customerID, SeniorCitizen, tenure, MonthlyCharges,
    round(coalesce(try_cast(trim(TotalCharges) AS DOUBLE), MonthlyCharges * tenure), 4) AS TotalCharges,
    CASE WHEN gender = 'Male' THEN 1 ELSE 0 END AS gender_encoded, CASE WHEN Partner = 'Yes' THEN 1 ELSE 0 END AS Partner_encoded,
    CASE WHEN Dependents = 'Yes' THEN 1 ELSE 0 END AS Dependents_encoded, CASE WHEN PhoneService = 'Yes' THEN 1 ELSE 0 END AS PhoneService_encoded,
    CASE WHEN PaperlessBilling = 'Yes' THEN 1 ELSE 0 END AS PaperlessBilling_encoded, MonthlyCharges * 12 AS AnnualRevenue,
    round_even(CAST(tenure AS DOUBLE) / 72, 3) AS LoyaltyScore FROM sub""")
def profile_features(spark, sf_dir):
    rows = features.profile_features(raw(spark, sf_dir)).withColumn("TotalCharges", F.round("TotalCharges", 4))
    return rows.select("customerID", *schema.FEATURES)


@query("f15_text_tests", """SELECT customerID, contains(PaymentMethod, 'Electronic check') AS pays_by_check,
    contains(Contract, 'Month-to-month') AS is_monthly, starts_with(InternetService, 'Fiber') AS has_fiber FROM sub""")
def text_tests(spark, sf_dir):
    return raw(spark, sf_dir).select(
        "customerID", F.col("PaymentMethod").contains("Electronic check").alias("pays_by_check"),
        F.col("Contract").contains("Month-to-month").alias("is_monthly"),
        F.col("InternetService").startswith("Fiber").alias("has_fiber"))
