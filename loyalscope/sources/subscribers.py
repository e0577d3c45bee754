"""Subscribers derived from a customer and an orders table.

The same 21 columns as a raw subscriber file. Amounts are worked out in whole cents, so that every
SQL engine gets the same numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SUBSCRIBER_SQL = """
WITH h AS (SELECT max(o_orderdate) AS mx FROM {orders}),
o AS (SELECT o_custkey, min(o_orderdate) AS f, max(o_orderdate) AS l,
             sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS nf
      FROM {orders} GROUP BY o_custkey),
s AS (SELECT c.c_custkey AS k, c.c_name, c.c_nationkey AS nk, c.c_mktsegment AS seg, coalesce(o.nf, 0) AS nf,
             coalesce(%(idle)s, 9999) AS idle,
             cast(coalesce(least(72, greatest(0, cast(floor(cast(%(span)s AS double) / 30) AS int)
                  - cast(c.c_custkey %% 60 AS int))), 0) AS int) AS tenure,
             1800 + cast(floor((cast(round(c.c_acctbal * 100, 0) AS double) + 100000) / 110) AS int) AS cents
      FROM {customer} c LEFT JOIN o ON o.o_custkey = c.c_custkey)
SELECT c_name AS customerID,
       CASE WHEN k %% 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
       CASE WHEN k %% 6 = 0 THEN 1 ELSE 0 END AS SeniorCitizen,
       CASE WHEN nk %% 2 = 0 THEN 'Yes' ELSE 'No' END AS Partner,
       CASE WHEN k %% 10 < 3 THEN 'Yes' ELSE 'No' END AS Dependents,
       tenure,
       CASE WHEN k %% 11 = 0 THEN 'No' ELSE 'Yes' END AS PhoneService,
       CASE WHEN k %% 11 = 0 THEN 'No phone service' WHEN k %% 3 = 0 THEN 'Yes' ELSE 'No' END AS MultipleLines,
       CASE WHEN seg IN ('BUILDING','HOUSEHOLD') THEN 'DSL' WHEN seg = 'FURNITURE' THEN 'No'
            ELSE 'Fiber optic' END AS InternetService,
       CASE WHEN seg = 'FURNITURE' THEN 'No internet service' WHEN k %% 4 = 0 THEN 'Yes' ELSE 'No' END AS OnlineSecurity,
       CASE WHEN seg = 'FURNITURE' THEN 'No internet service' WHEN k %% 5 = 0 THEN 'Yes' ELSE 'No' END AS OnlineBackup,
       CASE WHEN seg = 'FURNITURE' THEN 'No internet service' WHEN k %% 7 = 0 THEN 'Yes' ELSE 'No' END AS DeviceProtection,
       CASE WHEN seg = 'FURNITURE' THEN 'No internet service' WHEN k %% 8 < 3 THEN 'Yes' ELSE 'No' END AS TechSupport,
       CASE WHEN seg = 'FURNITURE' THEN 'No internet service' WHEN k %% 9 < 4 THEN 'Yes' ELSE 'No' END AS StreamingTV,
       CASE WHEN seg = 'FURNITURE' THEN 'No internet service' WHEN k %% 13 < 6 THEN 'Yes' ELSE 'No' END AS StreamingMovies,
       CASE WHEN nf >= 5 THEN 'Two year' WHEN nf >= 3 THEN 'One year' ELSE 'Month-to-month' END AS Contract,
       CASE WHEN k %% 5 < 3 THEN 'Yes' ELSE 'No' END AS PaperlessBilling,
       CASE nk %% 4 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check'
                   WHEN 2 THEN 'Bank transfer (automatic)' ELSE 'Credit card (automatic)' END AS PaymentMethod,
       cast(cents AS double) / 100 AS MonthlyCharges,
       CASE WHEN tenure = 0 THEN '  ' ELSE cast(cast(cents * tenure AS double) / 100 AS varchar(30)) END AS TotalCharges,
       CASE WHEN idle > 270 THEN 'Yes' ELSE 'No' END AS Churn
FROM s
"""

_SPARK_DAYS = "datediff(cast({b} as date), cast({a} as date))"
_LATEST = "(SELECT mx FROM h)"


def subscriber_sql(days: str) -> str:
    """The query with a dialect's day difference from {a} to {b}; tables stay as {customer} and {orders}."""
    return SUBSCRIBER_SQL % {"idle": days.format(a="o.l", b=_LATEST), "span": days.format(a="o.f", b="o.l")}


def subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw subscriber rows of a data folder. Orders are counted per customer before the join."""
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spark.sql(subscriber_sql(_SPARK_DAYS), customer=read("customer"), orders=read("orders"))


def stand_in_score() -> Column:
    """A fixed formula in place of a model's score, in whole ten-thousandths before the last division."""
    contract = F.when(F.col("Contract") == "Month-to-month", 2500).when(F.col("Contract") == "One year", 500).otherwise(-1000)
    charge = F.floor((F.round(F.col("MonthlyCharges") * 100, 0) - 6800) / 2).cast("int")
    months = F.floor((F.col("tenure") * 10000).cast("double") / 160).cast("int")
    return F.least(F.lit(9900), F.greatest(F.lit(100), 4500 + charge - months + contract)).cast("double") / 10000
