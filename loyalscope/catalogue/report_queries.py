"""Churn, revenue and score reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from loyalscope import schema
from loyalscope.catalogue.base import cleaned, offered, query, raw, scored, sql_rate, table, text
from loyalscope.operators import evaluation, reports, segments
from loyalscope.sources.eventlog import as_access_log

_CHURNED = "count(*) FILTER (WHERE Churn = 1)"


@query("a1_overall_kpis", f"""SELECT count(*) AS total_customers, {_CHURNED} AS churned,
    count(*) FILTER (WHERE Churn = 0) AS retained, {sql_rate(_CHURNED, 'count(*)', 2)} AS churn_rate_pct,
    round(sum(MonthlyCharges), 2) AS total_monthly_revenue, round(avg(MonthlyCharges), 2) AS avg_monthly_charge,
    round(avg(tenure), 1) AS avg_tenure_months,
    round(sum(MonthlyCharges) FILTER (WHERE Churn = 1), 2) AS lost_monthly_revenue,
    round(sum(MonthlyCharges) FILTER (WHERE Churn = 1) * 12, 2) AS lost_annual_revenue,
    count(*) FILTER (WHERE ChurnRisk = 'High') AS high_risk FROM scored""")
def overall_kpis(spark, sf_dir):
    return reports.kpis(scored(spark, sf_dir))


def _rate_sql(dim: str) -> str:
    return (f"SELECT {dim}, count(*) AS total, {_CHURNED} AS churned, "
            f"{sql_rate(_CHURNED, 'count(*)', 2)} AS churn_rate_pct FROM feat GROUP BY {dim}")


@query("a2a_churn_by_contract", _rate_sql("Contract"))
def churn_by_contract(spark, sf_dir):
    return reports.rate_by(cleaned(spark, sf_dir), "Contract")


@query("a2b_churn_by_internet", _rate_sql("InternetService"))
def churn_by_internet(spark, sf_dir):
    return reports.rate_by(cleaned(spark, sf_dir), "InternetService")


@query("a2c_churn_by_payment", _rate_sql("PaymentMethod"))
def churn_by_payment(spark, sf_dir):
    return reports.rate_by(cleaned(spark, sf_dir), "PaymentMethod")


_TENURE_LABELS = ", ".join(f"({text(v)}, {i})" for i, v in enumerate(schema.TENURE_LABELS))


@query("a2d_churn_by_tenure_group", f"""SELECT l.tenure_group, l.position, count(f.customerID) AS total,
    count(f.customerID) FILTER (WHERE f.Churn = 1) AS churned,
    {sql_rate('count(f.customerID) FILTER (WHERE f.Churn = 1)', 'count(f.customerID)', 2)} AS churn_rate_pct
    FROM (VALUES {_TENURE_LABELS}) l(tenure_group, position) LEFT JOIN feat f USING (tenure_group) GROUP BY ALL""")
def churn_by_tenure_group(spark, sf_dir):
    rows = reports.rate_by(cleaned(spark, sf_dir), "tenure_group", order_labels=schema.TENURE_LABELS)
    return rows.orderBy("position")


@query("a2d_churn_by_tenure_group_all", _rate_sql("tenure_group"))
def churn_by_tenure_group_all(spark, sf_dir):
    return reports.rate_by(cleaned(spark, sf_dir), "tenure_group")


@query("a2e_churn_by_revenue_category", _rate_sql("RevenueCategory"))
def churn_by_revenue_category(spark, sf_dir):
    return reports.rate_by(cleaned(spark, sf_dir), "RevenueCategory")


@query("a2f_churn_by_each_dimension", " UNION ALL ".join(
    f"SELECT {text(d)} AS feature, CAST({d} AS VARCHAR) AS value, count(*) AS total, {_CHURNED} AS churned, "
    f"round_even({_CHURNED} * 100.0::DOUBLE / count(*), 1) AS churn_rate_pct FROM feat GROUP BY {d}" for d in schema.CHURN_DIMENSIONS))
def churn_by_each_dimension(spark, sf_dir):
    return reports.rate_by_each(cleaned(spark, sf_dir), schema.CHURN_DIMENSIONS)


@query("a3_revenue_at_risk", """SELECT round(sum(MonthlyCharges), 2) AS lost_monthly_revenue,
    round(sum(AnnualRevenue), 2) AS lost_annual_revenue FROM feat WHERE Churn = 1""")
def revenue_at_risk(spark, sf_dir):
    return reports.revenue_at_risk(cleaned(spark, sf_dir))


_REVENUE_LABELS = ", ".join(f"({text(v)}, {i})" for i, v in enumerate(schema.REVENUE_LABELS))


@query("a4_revenue_lost_by_segment", f"""SELECT l.RevenueCategory, l.position, round(sum(f.MonthlyCharges), 2) AS revenue_lost,
    nullif(count(f.MonthlyCharges), 0) AS customers FROM (VALUES {_REVENUE_LABELS}) l(RevenueCategory, position)
    LEFT JOIN (SELECT * FROM feat WHERE Churn = 1) f USING (RevenueCategory) GROUP BY ALL""")
def revenue_lost_by_segment(spark, sf_dir):
    return reports.loss_by(cleaned(spark, sf_dir), "RevenueCategory", order_labels=schema.REVENUE_LABELS)


@query("a5_revenue_loss_share", f"""SELECT RevenueCategory, lost AS revenue_lost, customers,
    {sql_rate('lost', '(sum(lost) OVER ())', 1)} AS share_pct FROM (SELECT RevenueCategory, round(sum(MonthlyCharges), 2) AS lost,
    count(*) AS customers FROM feat WHERE Churn = 1 GROUP BY RevenueCategory)""")
def revenue_loss_share(spark, sf_dir):
    return reports.with_share(reports.loss_by(cleaned(spark, sf_dir), "RevenueCategory"), "revenue_lost")


@query("a6_offer_counts", "SELECT OfferTitle, count(*) AS count FROM offered GROUP BY OfferTitle")
def offer_counts(spark, sf_dir):
    return reports.value_counts(offered(spark, sf_dir), "OfferTitle")


@query("a7_churn_share", f"""SELECT Churn, count(*) AS count, {sql_rate('count(*)', '(sum(count(*)) OVER ())', 1)} AS percent
    FROM sub GROUP BY Churn""")
def churn_share(spark, sf_dir):
    return reports.value_counts(raw(spark, sf_dir), "Churn", normalise=True)


@query("a15_at_risk_kpis", """SELECT count(*) AS at_risk, round(sum(MonthlyCharges), 2) AS monthly_revenue_at_risk,
    round(avg(ChurnProbability), 4) AS avg_probability, round(avg(tenure), 1) AS avg_tenure_months
    FROM scored WHERE ChurnRisk IN ('High', 'Medium') AND ChurnProbability >= 0.5""")
def at_risk_kpis(spark, sf_dir):
    return reports.at_risk_kpis(segments.at_risk(scored(spark, sf_dir)))


_EVENTS = {"views": "view", "clicks": "click", "errors": "error", "signups": "signup", "purchases": "purchase"}


@query("a18_event_counters", "SELECT count(*) AS total_events, " + ", ".join(
    f"count(*) FILTER (WHERE event_type = '{v}') AS {k}" for k, v in _EVENTS.items()) + " FROM events")
def event_counters(spark, sf_dir):
    return reports.event_counters(as_access_log(table(spark, sf_dir, "events")), _EVENTS)


_HITS = "count(*) FILTER (WHERE WillChurn_Predicted = 1)"


@query("a19_score_summary", f"""SELECT count(*) AS scored, {_HITS} AS predicted_churn,
    {sql_rate(_HITS, 'count(*)', 1)} AS predicted_churn_pct, count(*) FILTER (WHERE ChurnRisk = 'High') AS high_risk,
    count(*) FILTER (WHERE ChurnRisk = 'Medium') AS medium_risk, count(*) FILTER (WHERE ChurnRisk = 'Low') AS low_risk FROM scored""")
def score_summary(spark, sf_dir):
    return reports.score_summary(scored(spark, sf_dir))


_BOUNDED = ["tenure", "MonthlyCharges", "TotalCharges"]


@query("a20_bounds", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM feat" for c in _BOUNDED))
def bounds(spark, sf_dir):
    return reports.bounds(cleaned(spark, sf_dir), _BOUNDED)


@query("a21_churn_split", f"SELECT {_CHURNED} AS churned, count(*) FILTER (WHERE Churn = 0) AS retained FROM feat")
def churn_split(spark, sf_dir):
    return reports.split_by(cleaned(spark, sf_dir))


@query("a21_churn_split_by_contract", f"""SELECT Contract, {_CHURNED} AS churned,
    count(*) FILTER (WHERE Churn = 0) AS retained FROM feat GROUP BY Contract""")
def churn_split_by_contract(spark, sf_dir):
    return reports.split_by(cleaned(spark, sf_dir), ["Contract"])


@query("t2_contracts_by_rate", _rate_sql("Contract") + " ORDER BY churn_rate_pct DESC")
def contracts_by_rate(spark, sf_dir):
    return reports.rate_by(cleaned(spark, sf_dir), "Contract").orderBy(F.desc("churn_rate_pct"), "Contract")


@query("t2_payments_by_rate", _rate_sql("PaymentMethod") + " ORDER BY churn_rate_pct")
def payments_by_rate(spark, sf_dir):
    return reports.rate_by(cleaned(spark, sf_dir), "PaymentMethod").orderBy("churn_rate_pct", "PaymentMethod")
