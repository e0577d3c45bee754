"""Round trips through files and tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from loyalscope import schema
from loyalscope.catalogue.base import cleaned, offered, query, raw
from loyalscope.operators import cleaning, segments
from loyalscope.plans import churn
from loyalscope.session import scratch_path
from loyalscope.sources import files, tables


@query("s1_csv_scan", "SELECT * FROM sub")
def csv_scan(spark, sf_dir):
    path = scratch_path(spark, "raw-csv")
    files.write_csv(raw(spark, sf_dir), path)
    return files.read_raw(spark, path)


@query("s2_required_columns", "SELECT * FROM sub")
def required_columns(spark, sf_dir):
    names = schema.RAW.fieldNames()
    return files.require_columns(raw(spark, sf_dir), names).select(*names)


@query("s3_raw_snapshot", "SELECT * FROM sub")
def raw_snapshot(spark, sf_dir):
    return files.snapshot(raw(spark, sf_dir), scratch_path(spark, "backup"))


_SHOWN = ["customerID", "Churn", "gender_encoded", "tenure_group", "RevenueCategory", "AnnualRevenue", "LoyaltyScore", "Contract"]


@query("s4_processed_csv", f"SELECT {', '.join(_SHOWN)}, Contract = 'Two year' AS \"Contract_Two year\" FROM feat")
def processed_csv(spark, sf_dir):
    path = scratch_path(spark, "processed")
    files.write_csv(cleaned(spark, sf_dir), path)
    return files.read_stage(spark, path).select(*_SHOWN, "Contract_Two year")


_TABLE = ", ".join("round(TotalCharges, 4) AS TotalCharges" if f.name == "TotalCharges" else f.name for f in schema.CLEANED)


def _loaded(spark, sf_dir) -> str:
    prefix = f"t{uuid.uuid4().hex[:8]}_"
    tables.load_tables(cleaned(spark, sf_dir), raw(spark, sf_dir), prefix, scratch_path(spark, "tables"))
    return prefix


@query("s5_table_replace", f"SELECT {_TABLE} FROM feat")
def table_replace(spark, sf_dir):
    rows = spark.table(_loaded(spark, sf_dir) + schema.CLEANED_TABLE)
    return rows.withColumn("TotalCharges", F.round("TotalCharges", 4))


@query("s6_table_definitions", "SELECT * REPLACE (round(TotalCharges, 4) AS TotalCharges) FROM num")
def table_definitions(spark, sf_dir):
    """Rows go into a defined table by its column types, and defining it again leaves them there."""
    prefix, folder = f"t{uuid.uuid4().hex[:8]}_", scratch_path(spark, "tables")
    tables.create_tables(spark, prefix, folder)
    cleaning.coerce_number(raw(spark, sf_dir), "TotalCharges").write.insertInto(prefix + schema.RAW_TABLE)
    tables.create_tables(spark, prefix, folder)
    return spark.table(prefix + schema.RAW_TABLE).withColumn("TotalCharges", F.round("TotalCharges", 4))


@query("s7_table_read", "SELECT * FROM sub")
def table_read(spark, sf_dir):
    return spark.table(_loaded(spark, sf_dir) + schema.RAW_TABLE)


@query("s8_first_source", f"SELECT {_TABLE}, 'processed' AS source FROM feat")
def first_source(spark, sf_dir):
    path = scratch_path(spark, "processed")
    files.write_parquet(cleaned(spark, sf_dir), path)
    rows, name = tables.resolve_source(spark, [
        tables.Source("scored", "csv", path + "-absent"), tables.Source("processed", "parquet", path),
        tables.Source("table", "table", schema.CLEANED_TABLE)])
    return tables.cleaned_table_rows(rows).withColumn("TotalCharges", F.round("TotalCharges", 4)).withColumn("source", F.lit(name))


@query("s10_at_risk_export", f"""SELECT {', '.join(schema.AT_RISK_COLUMNS)} FROM offered
    WHERE ChurnRisk IN ('High', 'Medium') AND ChurnProbability >= 0.5""")
def at_risk_export(spark, sf_dir):
    path = scratch_path(spark, "export")
    files.export(segments.at_risk(offered(spark, sf_dir)), schema.AT_RISK_COLUMNS, path)
    return files.read_stage(spark, path)


_HIGH_RISK = ["customerID", "ChurnProbability", "ChurnRisk", "Contract", "MonthlyCharges", "tenure", "OfferTitle", "OfferDiscount"]


@query("s10_high_risk_export", f"SELECT {', '.join(_HIGH_RISK)} FROM offered WHERE ChurnRisk = 'High'")
def high_risk_export(spark, sf_dir):
    path = scratch_path(spark, "export")
    files.export(segments.filter_segment(offered(spark, sf_dir), equals={"ChurnRisk": "High"}), _HIGH_RISK, path)
    return files.read_stage(spark, path)


@query("r6_light_run", """SELECT customerID, CASE WHEN trim(TotalCharges) = '' THEN 0.0 ELSE round(CAST(TotalCharges AS DOUBLE), 4) END AS TotalCharges,
    CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS ChurnFlag, CASE WHEN gender = 'Male' THEN 1 ELSE 0 END AS gender_encoded,
    CASE WHEN MonthlyCharges < 35 THEN 'Low' WHEN MonthlyCharges < 70 THEN 'Medium' ELSE 'High' END AS RevenueCategory,
    CASE WHEN tenure <= 12 THEN '0-1 Year' WHEN tenure <= 24 THEN '1-2 Years' WHEN tenure <= 48 THEN '2-4 Years' ELSE '4-6 Years' END AS tenure_group
    FROM sub""")
def light_run(spark, sf_dir):
    source, target = scratch_path(spark, "light-in"), scratch_path(spark, "light-out")
    files.write_csv(raw(spark, sf_dir), source)
    churn.light_run(spark, source, target)
    written = spark.read.option("header", True).csv(target)
    return written.select(
        "customerID", F.round(F.col("TotalCharges").cast("double"), 4).alias("TotalCharges"), F.col("ChurnFlag").cast("int").alias("ChurnFlag"),
        F.col("gender_encoded").cast("int").alias("gender_encoded"), "RevenueCategory", "tenure_group")
