"""The append-only access log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from loyalscope import schema
from loyalscope.functions import ascii_only
from loyalscope.sources.files import path_exists


def read_access_log(spark: SparkSession, path: str) -> DataFrame:
    """All log rows; no rows when nothing has been logged yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema.ACCESS_LOG)
    return (spark.read.schema(schema.ACCESS_LOG).option("header", True).option("escape", '"')
            .option("timestampFormat", schema.LOG_TIME_FORMAT).csv(path))


def as_access_log(events: DataFrame) -> DataFrame:
    """An events table (event_id, ts, user_id, event_type, props) in the shape of the access log.

    The event id stays, as the order of arrival.
    """
    return events.select(
        "event_id", F.date_format("ts", schema.LOG_TIME_FORMAT).alias("timestamp"),
        F.col("user_id").cast("string").alias("username"), F.col("event_type").alias("event"),
        ascii_only(F.col("props")).alias("detail"))
