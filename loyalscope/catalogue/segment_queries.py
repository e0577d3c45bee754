"""Filters, projections, ranked lists and the event log."""

from __future__ import annotations

from pyspark.sql import functions as F

from loyalscope import schema
from loyalscope.catalogue.base import cleaned, offered, query, raw, scored, table
from loyalscope.functions import percent_text
from loyalscope.operators import quality, segments
from loyalscope.session import scratch_path
from loyalscope.sources.eventlog import as_access_log, read_access_log


@query("p1_keep_columns", "SELECT customerID, Contract, MonthlyCharges, tenure, Churn FROM feat")
def keep_columns(spark, sf_dir):
    return segments.keep_columns(cleaned(spark, sf_dir), ["customerID", "NoSuchColumn", "Contract", "MonthlyCharges", "tenure", "Churn"])


@query("p2_equality_filter", "SELECT customerID, Contract, InternetService FROM feat WHERE Contract = 'One year'")
def equality_filter(spark, sf_dir):
    rows = segments.filter_segment(cleaned(spark, sf_dir), equals={"Contract": "One year", "InternetService": segments.ALL})
    return rows.select("customerID", "Contract", "InternetService")


@query("p3_tenure_range", "SELECT customerID, tenure FROM feat WHERE tenure BETWEEN 12 AND 36")
def tenure_range(spark, sf_dir):
    return segments.filter_segment(cleaned(spark, sf_dir), ranges={"tenure": (12, 36)}).select("customerID", "tenure")


_CALL = "'Priority Retention Call', 'Contract Upgrade Discount'"


@query("p4_at_risk_with_offer", f"""SELECT customerID, ChurnRisk, ChurnProbability, OfferTitle FROM offered
    WHERE ChurnRisk IN ('High', 'Medium') AND ChurnProbability >= 0.5 AND OfferTitle IN ({_CALL})""")
def at_risk_with_offer(spark, sf_dir):
    rows = segments.at_risk(offered(spark, sf_dir), offers=["Priority Retention Call", "Contract Upgrade Discount"])
    return rows.select("customerID", "ChurnRisk", "ChurnProbability", "OfferTitle")


_VALUABLE = "Contract = 'Month-to-month' AND MonthlyCharges > 70 AND Churn = 1"


def _valuable(df):
    rows = segments.filter_segment(df, equals={"Contract": "Month-to-month", "Churn": 1})
    return rows.where(F.col("MonthlyCharges") > 70).select("customerID", "MonthlyCharges", "TotalCharges", "tenure")


@query("p5_valuable_churned", f"SELECT customerID, MonthlyCharges, round(TotalCharges, 4) AS TotalCharges, tenure FROM feat WHERE {_VALUABLE}")
def valuable_churned(spark, sf_dir):
    return _valuable(cleaned(spark, sf_dir)).withColumn("TotalCharges", F.round("TotalCharges", 4))


@query("p6_churned_only", "SELECT customerID, MonthlyCharges FROM feat WHERE Churn = 1")
def churned_only(spark, sf_dir):
    return segments.churned_only(cleaned(spark, sf_dir)).select("customerID", "MonthlyCharges")


@query("p7_distinct_contracts", "SELECT DISTINCT Contract FROM feat ORDER BY 1")
def distinct_contracts(spark, sf_dir):
    return segments.distinct_values(cleaned(spark, sf_dir), "Contract")


@query("p8_blank_totals", "SELECT customerID, tenure, TotalCharges FROM sub WHERE trim(TotalCharges) = ''")
def blank_totals(spark, sf_dir):
    return quality.blank_rows(raw(spark, sf_dir), "TotalCharges").select("customerID", "tenure", "TotalCharges")


@query("p8_blank_total_count", "SELECT 'TotalCharges' AS \"column\", count(*) AS blanks FROM sub WHERE trim(TotalCharges) = ''")
def blank_total_count(spark, sf_dir):
    return quality.blank_count(raw(spark, sf_dir), ["TotalCharges"])


@query("p9_labels_beside_dummies", """SELECT customerID, Contract, Contract = 'Month-to-month' AS "Contract_Month-to-month",
    Contract = 'One year' AS "Contract_One year", Contract = 'Two year' AS "Contract_Two year" FROM feat""")
def labels_beside_dummies(spark, sf_dir):
    return cleaned(spark, sf_dir).select("customerID", "Contract", *[f"Contract_{v}" for v in schema.LEVELS["Contract"]])


@query("p10_complete_rows", """SELECT customerID, tenure_group, LoyaltyScore FROM feat
    WHERE tenure_group IS NOT NULL AND LoyaltyScore IS NOT NULL""")
def complete_rows(spark, sf_dir):
    return segments.drop_incomplete(cleaned(spark, sf_dir), ["tenure_group", "LoyaltyScore"]).select(
        "customerID", "tenure_group", "LoyaltyScore")


@query("t1_high_value_churned", f"""SELECT customerID, MonthlyCharges, round(TotalCharges, 4) AS TotalCharges, tenure
    FROM feat WHERE {_VALUABLE} ORDER BY MonthlyCharges DESC, customerID LIMIT 20""")
def high_value_churned(spark, sf_dir):
    top = segments.top_n(_valuable(cleaned(spark, sf_dir)), "MonthlyCharges", 20, "customerID")
    return top.withColumn("TotalCharges", F.round("TotalCharges", 4))


@query("t3_at_risk_list", """SELECT customerID, CAST(round_even(ChurnProbability * 100, 1) AS VARCHAR) || '%' AS ChurnProbability, ChurnRisk,
    Contract, InternetService, PaymentMethod, MonthlyCharges, tenure, OfferTitle, OfferDiscount FROM offered
    WHERE ChurnRisk IN ('High', 'Medium') AND ChurnProbability >= 0.5 ORDER BY offered.ChurnProbability DESC""")
def at_risk_list(spark, sf_dir):
    rows = segments.at_risk(offered(spark, sf_dir)).orderBy(F.desc("ChurnProbability"), "customerID")
    return segments.keep_columns(rows, schema.AT_RISK_COLUMNS).withColumn("ChurnProbability", percent_text(F.col("ChurnProbability")))


@query("t4_top_high_risk", """SELECT customerID, ChurnProbability, MonthlyCharges FROM scored WHERE ChurnRisk = 'High'
    ORDER BY ChurnProbability DESC, customerID LIMIT 8""")
def top_high_risk(spark, sf_dir):
    high = segments.filter_segment(scored(spark, sf_dir), equals={"ChurnRisk": "High"})
    return segments.top_n(high.select("customerID", "ChurnProbability", "MonthlyCharges"), "ChurnProbability", 8, "customerID")


@query("t5_first_rows", "SELECT * FROM sub ORDER BY customerID LIMIT 10")
def first_rows(spark, sf_dir):
    return segments.first_n(raw(spark, sf_dir), ["customerID"], 10)


@query("t5_last_rows", "SELECT * FROM sub ORDER BY customerID DESC LIMIT 5")
def last_rows(spark, sf_dir):
    return segments.last_n(raw(spark, sf_dir), ["customerID"], 5)


_LOG = """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, CAST(user_id AS VARCHAR) AS username,
    event_type AS event, regexp_replace(props, '[^\\x00-\\x7F]', '', 'g') AS detail FROM events"""


@query("s11_event_log", _LOG)
def event_log(spark, sf_dir):
    return as_access_log(table(spark, sf_dir, "events"))


@query("s11_log_file", f"""SELECT timestamp, username, 'user' AS role, event, detail, 'localhost' AS ip FROM ({_LOG})""")
def log_file(spark, sf_dir):
    """The events written as a log file, and scanned like one."""
    path = scratch_path(spark, "log")
    log = as_access_log(table(spark, sf_dir, "events")).select(
        "timestamp", "username", F.lit("user").alias("role"), "event", "detail", F.lit("localhost").alias("ip"))
    log.write.option("header", True).option("escape", '"').csv(path)
    scanned = read_access_log(spark, path)
    return scanned.withColumn("timestamp", F.date_format("timestamp", schema.LOG_TIME_FORMAT))


# every seventh event reports late: its time lies three days before that of its arrival
_LATE = _LOG.replace("strftime(ts,", "strftime(CASE WHEN event_id % 7 = 0 THEN ts - INTERVAL 3 DAY ELSE ts END,")


@query("t6_latest_events", f"""SELECT * FROM (SELECT * FROM ({_LATE}) WHERE event = 'error' ORDER BY event_id DESC LIMIT 100)
    ORDER BY timestamp DESC, event_id DESC""")
def latest_events(spark, sf_dir):
    """The last rows to arrive, late ones included, by their own time."""
    late = F.when(F.col("event_id") % 7 == 0, F.col("ts") - F.expr("INTERVAL 3 DAYS")).otherwise(F.col("ts"))
    events = table(spark, sf_dir, "events").withColumn("ts", late)
    log = segments.filter_segment(as_access_log(events), equals={"event": "error", "username": segments.ALL})
    return segments.latest_n(log, "timestamp", "event_id", 100)
