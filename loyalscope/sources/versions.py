"""Data that is replaced whole: each write makes a version of its own, and readers see the last one that is complete.

A version is a folder below the data's own, with a name that sorts by time. Spark puts a mark into it when all its rows are
there, and that one file is the switch: until then, and for good if the write fails, the version before stays the current one.
"""

from __future__ import annotations

import re
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

_NAME = re.compile("version-[0-9]{20}-[0-9a-f]{12}")
_COMPLETE = "_SUCCESS"
KEPT = 1  # complete versions beside the current one: readers may still be at the last


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def versions(spark: SparkSession, path: str) -> list[str]:
    """Paths of the complete versions, the oldest first."""
    system, place = _folder(spark, path)
    if not system.exists(place):
        return []
    names = sorted(s.getPath().getName() for s in system.listStatus(place) if s.isDirectory())
    made = [f"{path.rstrip('/')}/{name}" for name in names if _NAME.fullmatch(name)]
    return [v for v in made if system.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{v}/{_COMPLETE}"))]


def write(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write a new version, make it the current one, and return its path. Fails without touching the versions there are.

    Of two writers the one that began last wins. Old versions beyond KEPT are removed afterwards; what a failed write has left
    is removed with them once it is older than a complete version.
    """
    spark = df.sparkSession
    made = f"{path.rstrip('/')}/version-{time.time_ns():020d}-{uuid.uuid4().hex[:12]}"
    df.write.format(fmt).option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").save(made)
    _forget(spark, path)
    return made


def _forget(spark: SparkSession, path: str, kept: int = KEPT) -> None:
    complete = versions(spark, path)
    oldest = complete[-1 - kept:][0]
    system, place = _folder(spark, path)
    for status in system.listStatus(place):
        name = status.getPath().getName()
        if status.isDirectory() and _NAME.fullmatch(name) and f"{path.rstrip('/')}/{name}" < oldest:
            system.delete(status.getPath(), True)


def current(spark: SparkSession, path: str) -> str:
    """The path of the current version; the path itself if it holds plain files."""
    complete = versions(spark, path)
    return complete[-1] if complete else path


def read(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The current version, which stays what it is while later ones are written."""
    return spark.read.format(fmt).load(current(spark, path))
