"""Catalog tables and JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, types as T

from loyalscope import schema
from loyalscope.functions import quoted
from loyalscope.operators.features import decode_one_hot
from loyalscope.operators.segments import keep_columns
from loyalscope.sources import versions
from loyalscope.sources.files import path_exists, read_stage

BATCH_ROWS = 5_000


def create_table(spark: SparkSession, name: str, columns: T.StructType, path: str | None = None) -> None:
    """Create the table if it does not exist; with a path it is kept there."""
    fields = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in columns)
    place = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({fields}) USING parquet{place}")


def create_tables(spark: SparkSession, prefix: str = "", folder: str | None = None) -> None:
    """The raw and the cleaned table. Raw amounts are numbers here, blanks null."""
    raw = T.StructType([T.StructField("TotalCharges", T.DoubleType()) if f.name == "TotalCharges" else f for f in schema.RAW])
    for name, columns in ((schema.RAW_TABLE, raw), (schema.CLEANED_TABLE, schema.CLEANED)):
        create_table(spark, prefix + name, columns, f"{folder}/{name}" if folder else None)


def replace_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replace a table's rows: they are written to a folder of their own, and the table is then pointed to it.

    The table's entry in the catalog is the switch, so a write that fails leaves the table as it was. A table with other columns
    than the rows is defined anew, after they are written. Without a path the versions go to ``<name>.versions`` in the
    warehouse. A query that began before keeps the folder that it reads until the table is replaced a second time.
    """
    spark = df.sparkSession
    home = path or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name}.versions"
    place = versions.write(df, home)
    if spark.catalog.tableExists(name):
        same = [(f.name, f.dataType) for f in spark.table(name).schema] == [(f.name, f.dataType) for f in df.schema]
        if same:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{place}'")
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"DROP TABLE {name}")
    create_table(spark, name, df.schema, place)


def raw_table_rows(df: DataFrame) -> DataFrame:
    return keep_columns(df, schema.RAW.fieldNames())


def cleaned_table_rows(df: DataFrame) -> DataFrame:
    """The analytical columns only; labels lost to one-hot encoding are rebuilt."""
    for label in schema.LABEL_COLUMNS:
        df = decode_one_hot(df, label)
    return keep_columns(df, schema.CLEANED.fieldNames())


def load_tables(cleaned: DataFrame, raw: DataFrame | None = None, prefix: str = "", folder: str | None = None) -> None:
    """Replace the cleaned table, and the raw one when raw rows are given."""
    create_tables(cleaned.sparkSession, prefix, folder)
    place = lambda name: f"{folder}/{name}" if folder else None
    if raw is not None:
        replace_table(raw_table_rows(raw), prefix + schema.RAW_TABLE, place(schema.RAW_TABLE))
    replace_table(cleaned_table_rows(cleaned), prefix + schema.CLEANED_TABLE, place(schema.CLEANED_TABLE))


def jdbc_options(url: str, table: str, properties: Mapping[str, str] | None = None, **options) -> dict[str, str]:
    return {"url": url, "dbtable": table, **(properties or {}), **{k: str(v) for k, v in options.items()}}


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None,
               batch_rows: int = BATCH_ROWS, connections: int | None = None) -> None:
    """Replace a database table; every task sends its rows in batches over its own connection.

    ``connections`` deals the rows to so many tasks, behind a shuffle, for a database that takes no more
    at once; the stages before keep their own tasks.
    """
    rows = df if connections is None else df.repartition(connections)
    _save(rows.write.mode("overwrite").format("jdbc").options(**jdbc_options(url, table, properties, batchsize=batch_rows)))


def _save(writer) -> None:
    writer.save()


class Slices(NamedTuple):
    """A numeric, date or timestamp column that a table is read by, in so many even slices between two values."""

    column: str
    low: int | str
    high: int | str
    count: int


def slice_options(url: str, table: str, slices: Slices, properties: Mapping[str, str] | None = None) -> dict[str, str]:
    return jdbc_options(url, table, properties, partitionColumn=slices.column, lowerBound=slices.low,
                        upperBound=slices.high, numPartitions=slices.count)


def read_jdbc(spark: SparkSession, url: str, table: str, slices: Slices | str | None,
              properties: Mapping[str, str] | None = None, count: int | None = None) -> DataFrame:
    """A whole database table in parallel slices.

    ``slices`` as a column's name asks the database for its smallest and largest value first, and makes
    ``count`` slices (as many as tasks run at once, if not given). None reads the table in one task, and
    has to be said: it suits small tables only.
    """
    if slices is None:
        return spark.read.format("jdbc").options(**jdbc_options(url, table, properties)).load()
    if isinstance(slices, str):
        ends = f"(SELECT min({slices}) AS low, max({slices}) AS high FROM {table}) ends"
        row = spark.read.format("jdbc").options(**jdbc_options(url, ends, properties)).load().first()
        slices = Slices(slices, row["low"] or 0, row["high"] or 0, count or spark.sparkContext.defaultParallelism)
    return spark.read.format("jdbc").options(**slice_options(url, table, slices, properties)).load()


class Database(NamedTuple):
    """Where a run's tables go, or where rows may come from."""

    url: str
    properties: Mapping[str, str] = {}
    connections: int | None = None  # at once, when writing
    slices: Slices | str | None = None  # when reading


def load_database(cleaned: DataFrame, raw: DataFrame | None, database: Database, prefix: str = "") -> None:
    """Replace the cleaned table in a database, and the raw one when raw rows are given."""
    parts = [(cleaned_table_rows(cleaned), schema.CLEANED_TABLE)]
    if raw is not None:
        parts.insert(0, (raw_table_rows(raw), schema.RAW_TABLE))
    for rows, name in parts:
        write_jdbc(rows, database.url, prefix + name, database.properties, connections=database.connections)


class Source(NamedTuple):
    name: str
    kind: str  # csv, parquet, table or jdbc
    place: str
    database: Database | None = None  # of kind jdbc


def resolve_source(spark: SparkSession, candidates: Sequence[Source]) -> tuple[DataFrame, str]:
    """The first source that exists, with its name. A database is asked when its turn comes; one that can't be reached,
    or lacks the table, does not exist."""
    for source in candidates:
        if source.kind == "jdbc":
            try:
                return read_jdbc(spark, source.database.url, source.place, source.database.slices, source.database.properties), source.name
            except (PySparkException, Py4JJavaError):
                continue
        if source.kind == "table":
            if spark.catalog.tableExists(source.place):
                return spark.table(source.place), source.name
        elif path_exists(spark, source.place):
            return read_stage(spark, source.place, source.kind), source.name
    raise FileNotFoundError(f"none of the sources exists: {[s.place for s in candidates]}")
