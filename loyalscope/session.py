"""Session settings and the shared folder for written intermediate data."""

from __future__ import annotations

import tempfile
import uuid
import warnings
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "loyalscope", memory: str = "8g") -> SparkSession:
    """A session for tests and the benchmark; on a cluster the caller brings its own."""
    partitions = "8" if cores == "*" else str(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Only a local session may do without one."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if folder:
        _warn_if_local(context, folder)
        return folder.rstrip("/")
    if not (context.master == "local" or context.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="loyalscope-")
    context.setCheckpointDir(folder)
    return folder


def _warn_if_local(context, folder: str) -> None:
    """A folder of the driver's machine serves a cluster only if it is mounted on all of its machines."""
    if not context.master.startswith("local"):
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        if path.getFileSystem(context._jsc.hadoopConfiguration()).getUri().getScheme() == "file":
            warnings.warn(f"{folder} is in a local file system; every executor has to see the same files there", stacklevel=3)


_WRITTEN: list[str] = []


def cleanup(spark: SparkSession, start: int = 0, keep: Sequence[str] = ()) -> None:
    """Remove the tables that `written` has written, from the one numbered `start` on, but for the paths in ``keep``.

    Frames that read them can't be used any more.
    """
    for path in [p for p in _WRITTEN[start:] if p not in keep]:
        remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove one written table, or a folder of it."""
    if path in _WRITTEN:
        _WRITTEN.remove(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def written_so_far() -> int:
    """How many written tables there are: what `cleanup` takes as ``start``."""
    return len(_WRITTEN)


def last_written() -> str:
    return _WRITTEN[-1]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/loyalscope/{name}-{uuid.uuid4().hex[:12]}"


def checkpointing(spark: SparkSession) -> None:
    """Make sure iterative learners have somewhere to cut their lineage."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))


def written(table: DataFrame, name: str = "table") -> DataFrame:
    """Write a table to the shared folder and go on from there: later steps need not compute it again,
    not even when an executor is lost."""
    path = scratch_path(table.sparkSession, name)
    table.write.parquet(path)
    _WRITTEN.append(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Jobs run in here remove their shuffle files as they end: for steps whose results are written and read again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def written_apart(table: DataFrame, name: str, column: str) -> str:
    """As `written`, with a folder for each value of a column; gives the path. `remove` may take a folder that no step reads any more."""
    path = scratch_path(table.sparkSession, name)
    table.write.partitionBy(column).parquet(path)
    _WRITTEN.append(path)
    return path


def measured(table: DataFrame) -> DataFrame:
    """Write a per-group table that will be joined back to the rows it came from.

    Read from files its true size is known, so the planner broadcasts it below
    spark.sql.autoBroadcastJoinThreshold and shuffles (with AQE skew splitting) above it.
    """
    return written(table, "measured")
