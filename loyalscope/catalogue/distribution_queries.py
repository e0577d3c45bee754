"""Describe, correlate, histogram, box and density."""

from __future__ import annotations

from pyspark.sql import functions as F

from loyalscope import schema
from loyalscope.catalogue.base import cleaned, query, raw, scored
from loyalscope.functions import flag
from loyalscope.operators import cleaning, distributions, quality
from loyalscope.operators.quantiles import medians

_NUMBERS = ["tenure", "MonthlyCharges", "TotalCharges"]


def _numeric(spark, sf_dir):
    return cleaning.coerce_number(raw(spark, sf_dir), "TotalCharges")


def describe_sql(source: str, cols: list[str]) -> str:
    return " UNION ALL ".join(f"""SELECT '{c}' AS feature, count({c}) AS count, round_even(avg({c}), 2) AS mean,
        round_even(stddev_samp({c}), 2) AS std, round_even(CAST(min({c}) AS DOUBLE), 2) AS min, round_even(quantile_cont(CAST({c} AS DOUBLE), 0.25), 2) AS q25,
        round_even(quantile_cont(CAST({c} AS DOUBLE), 0.5), 2) AS median, round_even(quantile_cont(CAST({c} AS DOUBLE), 0.75), 2) AS q75,
        round_even(CAST(max({c}) AS DOUBLE), 2) AS max FROM {source}""" for c in cols)


@query("a8_describe_numeric", describe_sql("num", _NUMBERS))
def describe_numeric(spark, sf_dir):
    return distributions.describe_numeric(_numeric(spark, sf_dir), _NUMBERS)


_WORDS = ["customerID", "gender", "Contract", "InternetService", "PaymentMethod", "TotalCharges", "Churn"]


@query("a9_describe_categorical", " UNION ALL ".join(f"""SELECT '{c}' AS feature, CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique",
    min_by(v, (-n, v)) AS top, max(n) AS freq FROM (SELECT {c} AS v, count(*) AS n FROM sub GROUP BY {c})""" for c in _WORDS))
def describe_categorical(spark, sf_dir):
    return distributions.describe_categorical(raw(spark, sf_dir), _WORDS)


_CORRELATED = [*_NUMBERS, "Churn_flag"]


def correlation_sql(source: str, cols: list[str]) -> str:
    cell = lambda a, b: f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 4) AS correlation FROM {source}"
    return " UNION ALL ".join(cell(a, b) for a in cols for b in cols)


@query("a10_correlation_matrix", correlation_sql(
    "(SELECT *, CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS Churn_flag FROM num)", _CORRELATED))
def correlation_matrix(spark, sf_dir):
    rows = _numeric(spark, sf_dir).withColumn("Churn_flag", flag(F.col("Churn"), "Yes"))
    return distributions.correlations(rows, _CORRELATED)


_WITH_LABEL = ["tenure", "MonthlyCharges", "TotalCharges", "AnnualRevenue", "LoyaltyScore", "SeniorCitizen"]


@query("a11_label_correlations", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(corr({c}, Churn), 4) AS correlation FROM feat" for c in _WITH_LABEL))
def label_correlations(spark, sf_dir):
    return distributions.label_correlations(cleaned(spark, sf_dir), _WITH_LABEL, schema.LABEL)


def histogram_sql(source: str, col: str, bins: int, by: str | None = None) -> str:
    group, same = (f"{by}, ", f"v.{by} = g.{by} AND") if by else ("", "")
    edge = lambda b: f"CASE WHEN {b} = {bins} THEN high ELSE low + (high - low) / {bins} * ({b}) END"
    return f"""SELECT {"g." + group if by else ""}g.bin, bin_start, bin_end, count(v.{col}) AS count
        FROM (SELECT {group}bin, {edge("bin")} AS bin_start, {edge("bin + 1")} AS bin_end FROM (
            SELECT *, CAST(unnest(range({bins})) AS INT) AS bin FROM (SELECT {group}min({col}) AS low, max({col}) AS high
            FROM {source} {"GROUP BY " + by if by else ""}))) g
        LEFT JOIN {source} v ON {same} v.{col} >= bin_start AND (v.{col} < bin_end OR (g.bin = {bins - 1} AND v.{col} = bin_end))
        GROUP BY {"g." + group if by else ""}g.bin, bin_start, bin_end"""


@query("a12_histogram_totals", histogram_sql("num", "TotalCharges", 40))
def histogram_totals(spark, sf_dir):
    return distributions.histogram(_numeric(spark, sf_dir), "TotalCharges", 40)


@query("a12_histogram_by_churn", histogram_sql("scored", "ChurnProbability", 30, "Churn"))
def histogram_by_churn(spark, sf_dir):
    return distributions.histogram(scored(spark, sf_dir), "ChurnProbability", 30, ["Churn"])


def box_sql(source: str, col: str, by: str, digits: int = 4) -> str:
    r = lambda e, name: f"round({e}, {digits}) AS {name}"
    return f"""SELECT {by}, n, {r('q25', 'q25')}, {r('q50', 'median')}, {r('q75', 'q75')},
        {r('whisker_low', 'whisker_low')}, {r('whisker_high', 'whisker_high')}, outliers,
        {r('q50 - 1.57 * (q75 - q25) / sqrt(n)', 'notch_low')}, {r('q50 + 1.57 * (q75 - q25) / sqrt(n)', 'notch_high')}
        FROM (SELECT {by}, q25, q50, q75, count(*) AS n,
            least(q25, min(x) FILTER (WHERE x BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25))) AS whisker_low,
            greatest(q75, max(x) FILTER (WHERE x BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25))) AS whisker_high,
            count(*) FILTER (WHERE NOT x BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25)) AS outliers
            FROM (SELECT {by}, {col} AS x FROM {source}) JOIN (SELECT {by}, quantile_cont({col}, 0.25) AS q25,
                quantile_cont({col}, 0.5) AS q50, quantile_cont({col}, 0.75) AS q75 FROM {source} GROUP BY {by}) USING ({by})
            GROUP BY {by}, q25, q50, q75)"""


def rounded_box(box, digits: int = 4):
    marks = ["q25", "median", "q75", "whisker_low", "whisker_high", "notch_low", "notch_high"]
    return box.withColumns({c: F.round(c, digits) for c in marks})


@query("a13_box_charges_by_churn", box_sql("feat", "MonthlyCharges", "Churn"))
def box_charges_by_churn(spark, sf_dir):
    return rounded_box(distributions.box_stats(cleaned(spark, sf_dir), "MonthlyCharges", ["Churn"]))


@query("a14_density_by_churn", """SELECT Churn, point, round(x, 6) AS x,
    round(sum(m * exp(-0.5 * pow((x - mid) / h, 2))) / (n * h * sqrt(2 * pi())), 6) AS density
    FROM (SELECT Churn, n, h, point, low - 2 * h + (high - low + 4 * h) / 99 * point AS x FROM (
            SELECT Churn, count(*) AS n, stddev_samp(MonthlyCharges) * pow(count(*), -0.2) AS h, min(MonthlyCharges) AS low,
                max(MonthlyCharges) AS high, CAST(unnest(range(100)) AS INT) AS point FROM feat GROUP BY Churn)) p
    JOIN (SELECT Churn, low + (high - low) / 512 * (bin + 0.5) AS mid, count(*) AS m FROM (
            SELECT Churn, low, high, least(511, floor((MonthlyCharges - low) * 512 / (high - low))) AS bin FROM feat
            JOIN (SELECT Churn, min(MonthlyCharges) AS low, max(MonthlyCharges) AS high FROM feat GROUP BY Churn) USING (Churn))
        GROUP BY Churn, low, high, bin) b USING (Churn) GROUP BY Churn, point, x, n, h""")
def density_by_churn(spark, sf_dir):
    curve = distributions.density(cleaned(spark, sf_dir), "MonthlyCharges", ["Churn"])
    return curve.withColumns({c: F.round(c, 6) for c in ("x", "density")})


@query("a16_median_by_churn", """SELECT Churn, 'MonthlyCharges' AS feature, round(quantile_cont(MonthlyCharges, 0.5), 4) AS median
    FROM feat GROUP BY Churn""")
def median_by_churn(spark, sf_dir):
    return medians(cleaned(spark, sf_dir), ["MonthlyCharges"], ["Churn"]).withColumn("median", F.round("median", 4))


@query("a17_mean_and_median", "SELECT round(avg(TotalCharges), 2) AS mean, round(quantile_cont(TotalCharges, 0.5), 4) AS median FROM num")
def mean_and_median(spark, sf_dir):
    rows = _numeric(spark, sf_dir)
    middle = medians(rows, ["TotalCharges"]).select("median").scalar()
    return rows.agg(F.round(F.avg("TotalCharges"), 2).alias("mean")).withColumn("median", F.round(middle, 4))


_TYPES = ", ".join(f"({i}, '{f.name}', '{f.dataType.simpleString()}')" for i, f in enumerate(schema.RAW, 1))


@query("a22_dataset_profile", f"""SELECT position, name AS "column", type, (SELECT count(*) FROM sub) AS total_rows,
    21 AS total_columns FROM (VALUES {_TYPES}) t(position, name, type)""")
def dataset_profile(spark, sf_dir):
    return quality.dataset_profile(raw(spark, sf_dir))
