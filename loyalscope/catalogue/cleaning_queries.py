"""Cleaning and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from loyalscope import schema
from loyalscope.catalogue.base import cleaned, query, raw, table
from loyalscope.operators import cleaning, duplicates, quality
from loyalscope.session import written

_MEDIAN = "(SELECT quantile_cont(TotalCharges, 0.5) FROM num)"


def _total(df):
    return df.select("customerID", F.round("TotalCharges", 4).alias("TotalCharges"))


@query("c1_text_to_number", "SELECT customerID, round(TotalCharges, 4) AS TotalCharges FROM num")
def text_to_number(spark, sf_dir):
    return _total(cleaning.coerce_number(raw(spark, sf_dir), "TotalCharges"))


@query("c2_median_imputation", f"SELECT customerID, round(coalesce(TotalCharges, {_MEDIAN}), 4) AS TotalCharges FROM num")
def median_imputation(spark, sf_dir):
    return _total(cleaning.impute_median(cleaning.coerce_number(raw(spark, sf_dir), "TotalCharges"), ["TotalCharges"]))


@query("c2_median_imputation_many", f"""SELECT customerID, round(coalesce(TotalCharges, {_MEDIAN}), 4) AS TotalCharges,
    CAST(tenure AS DOUBLE) AS tenure, MonthlyCharges FROM num""")
def median_imputation_many(spark, sf_dir):
    numeric = cleaning.coerce_number(raw(spark, sf_dir), "TotalCharges")
    filled = cleaning.impute_median(numeric, ["TotalCharges", "tenure", "MonthlyCharges"])
    return filled.select("customerID", F.round("TotalCharges", 4).alias("TotalCharges"), "tenure", "MonthlyCharges")


@query("c3_blank_to_zero", """SELECT customerID, CASE WHEN trim(TotalCharges) = '' THEN 0.0
    ELSE round(try_cast(TotalCharges AS DOUBLE), 4) END AS TotalCharges FROM sub""")
def blank_to_zero(spark, sf_dir):
    return _total(cleaning.blank_to(raw(spark, sf_dir), "TotalCharges", 0.0))


@query("c4_zero_filled_features", """SELECT customerID, tenure, coalesce(TotalCharges, 0) AS TotalCharges, 0 AS NewFeature FROM num""")
def zero_filled_features(spark, sf_dir):
    numeric = cleaning.coerce_number(raw(spark, sf_dir), "TotalCharges")
    return cleaning.zero_fill(numeric, ["tenure", "TotalCharges", "NewFeature"], keep=["customerID"])


_TWICE = "(SELECT * FROM sub UNION ALL SELECT * FROM sub WHERE Churn = 'Yes' UNION ALL SELECT * FROM sub WHERE Contract = 'One year')"


def _twice(spark, sf_dir):
    rows = raw(spark, sf_dir)
    return rows.unionAll(rows.where(F.col("Churn") == "Yes")).unionAll(rows.where(F.col("Contract") == "One year"))


@query("c5_drop_duplicates", "SELECT * FROM sub")
def drop_duplicates(spark, sf_dir):
    return duplicates.drop_duplicates(_twice(spark, sf_dir))


@query("c6_duplicate_count", f"""SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_rows
    FROM (SELECT count(*) AS n FROM {_TWICE} GROUP BY {", ".join(schema.RAW.fieldNames())})""")
def duplicate_count(spark, sf_dir):
    return quality.duplicate_count(_twice(spark, sf_dir))


@query("c6_duplicate_rows", "SELECT * FROM sub WHERE Churn = 'Yes' UNION ALL SELECT * FROM sub WHERE Contract = 'One year'")
def duplicate_rows(spark, sf_dir):
    return quality.duplicate_rows(_twice(spark, sf_dir))


@query("c7_trim_strings", """SELECT doc_id, trim(text, chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(32)
    ||chr(133)||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)||chr(8200)
    ||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)) AS text, trim(lang) AS lang FROM documents""")
def trim_strings(spark, sf_dir):
    return cleaning.trim_strings(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


@query("c8_null_report", f"""SELECT * FROM (
    SELECT 'TotalCharges' AS "column", count(*) FILTER (WHERE TotalCharges IS NULL) AS missing_count,
    round(count(*) FILTER (WHERE TotalCharges IS NULL) * 100.0 / CAST(count(*) AS DOUBLE), 2) AS missing_pct FROM num
    UNION ALL SELECT 'tenure', count(*) FILTER (WHERE tenure IS NULL), 0.0 FROM num) WHERE missing_count > 0""")
def null_report(spark, sf_dir):
    return quality.null_report(cleaning.coerce_number(raw(spark, sf_dir), "TotalCharges"))


@query("c9_validation", """SELECT 'no_missing_values' AS "check", n = 0 AS passed,
        CASE WHEN n > 0 THEN 'tenure_group=' || n ELSE '' END AS detail
        FROM (SELECT count(*) FILTER (WHERE tenure_group IS NULL) AS n FROM feat)
    UNION ALL SELECT 'no_duplicate_rows', count(*) = count(DISTINCT customerID), CAST(count(*) - count(DISTINCT customerID) AS VARCHAR) FROM feat
    UNION ALL SELECT 'label_is_integer', true, 'int'""")
def validation(spark, sf_dir):
    return quality.validate(cleaned(spark, sf_dir), schema.LABEL)


@query("c10_before_after", """SELECT 'Total Rows' AS metric, CAST((SELECT count(*) FROM sub) AS VARCHAR) AS before,
        CAST((SELECT count(*) FROM clean) AS VARCHAR) AS after
    UNION ALL SELECT 'Null Values', CAST((SELECT count(*) FROM sub WHERE trim(TotalCharges) = '') AS VARCHAR),
        CAST((SELECT count(*) FROM clean WHERE TotalCharges IS NULL) AS VARCHAR)
    UNION ALL SELECT 'Duplicate Rows', CAST((SELECT count(*) - count(DISTINCT customerID) FROM sub) AS VARCHAR), '0'
    UNION ALL SELECT 'TotalCharges dtype', 'string', 'double'""")
def before_after(spark, sf_dir):
    rows = raw(spark, sf_dir)
    return quality.compare(rows, cleaning.clean(rows), "TotalCharges")


@query("c11_key_uniqueness", """SELECT count(*) AS total_rows, count(DISTINCT customerID) AS distinct_keys,
    count(*) = count(DISTINCT customerID) AS is_unique FROM sub""")
def key_uniqueness(spark, sf_dir):
    return quality.key_report(raw(spark, sf_dir), "customerID")


@query("c1_c7_clean", "SELECT * REPLACE (round(TotalCharges, 4) AS TotalCharges) FROM clean")
def clean_rows(spark, sf_dir):
    return cleaning.clean(raw(spark, sf_dir)).withColumn("TotalCharges", F.round("TotalCharges", 4))


_INTAKE = """SELECT 'rows' AS topic, 'total' AS name, count(*) AS count FROM num
    UNION ALL SELECT 'missing', 'TotalCharges', count(*) FILTER (WHERE TotalCharges IS NULL) FROM num
    UNION ALL SELECT 'duplicates', 'rows', count(*) - count(DISTINCT customerID) FROM num
    UNION ALL SELECT 'Churn', Churn, count(*) FROM num GROUP BY Churn"""


@query("c8_intake_report", _INTAKE)
def intake_report(spark, sf_dir):
    return quality.intake_report(cleaning.coerce_number(raw(spark, sf_dir), "TotalCharges"), "Churn")


@query("c8_watched_intake", _INTAKE)
def watched_intake(spark, sf_dir):
    """The same from what was watched while the rows were written."""
    rows, seen = quality.watched(cleaning.coerce_number(raw(spark, sf_dir), "TotalCharges"), "Churn", list(schema.YES_NO))
    return quality.intake_report(written(rows, "snapshot"), "Churn", seen)
