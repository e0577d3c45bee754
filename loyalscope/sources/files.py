"""CSV and Parquet files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from loyalscope import schema
from loyalscope.functions import finite, quoted
from loyalscope.sources import versions


def path_exists(spark: SparkSession, path: str) -> bool:
    """Ask the path's own file system, so remote storage works too."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def require_path(spark: SparkSession, path: str, hint: str) -> None:
    if not path_exists(spark, path):
        raise FileNotFoundError(f"nothing found at '{path}'. {hint}")


def _require_names(names: Sequence[str], required: Sequence[str]) -> None:
    missing = [c for c in required if c not in names]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """The frame itself, or an error that lists every absent column. Starts no job."""
    _require_names(df.columns, required)
    return df


def nan_to_null(df: DataFrame) -> DataFrame:
    return df.select(*[
        finite(F.col(quoted(f.name))).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(quoted(f.name))
        for f in df.schema])


def _header(spark: SparkSession, path: str) -> list[str]:
    return spark.read.option("header", True).csv(path).columns  # reads the first line only


def _read_typed(spark: SparkSession, path: str, kinds: Mapping[str, T.DataType]) -> DataFrame:
    columns = T.StructType([T.StructField(c, kinds[c]) for c in kinds])
    return spark.read.schema(columns).option("header", True).csv(path)


def read_raw(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Raw subscriber rows with the fixed schema: no inference pass, and blanks in TotalCharges survive."""
    require_path(spark, path, "Put the subscriber file there or name another path.")
    if fmt == "csv":
        head = _header(spark, path)
        _require_names(head, schema.RAW.fieldNames())
        known = {f.name: f.dataType for f in schema.RAW}
        rows = _read_typed(spark, path, {c: known.get(c, T.StringType()) for c in head})
    else:
        rows = require_columns(spark.read.format(fmt).load(path), schema.RAW.fieldNames())
    return nan_to_null(rows)


def stage_type(name: str) -> T.DataType:
    """The type of a column in a processed or scored file, known from its name."""
    if name in schema.CLEANED.fieldNames():
        return schema.CLEANED[name].dataType
    if name.endswith("_encoded") or name == "WillChurn_Predicted":
        return T.IntegerType()
    if name == "ChurnProbability":
        return T.DoubleType()
    if any(name.startswith(f"{c}_") for c in schema.LEVELS):
        return T.BooleanType()
    return T.StringType()


def read_stage(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """A processed or scored file; CSV is typed by column name, without an inference pass."""
    if fmt != "csv":
        return spark.read.format(fmt).load(path)
    return _read_typed(spark, path, {c: stage_type(c) for c in _header(spark, path)})


def write_csv(df: DataFrame, path: str) -> None:
    """Header, overwrite; leading and trailing blanks of a value are kept."""
    (df.write.mode("overwrite").option("header", True)
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def snapshot(df: DataFrame, path: str) -> DataFrame:
    """Keep a copy of the untouched input (replacing the last one once it is complete) and go on from the copy.

    ``versions.read`` gives the copy of a path.
    """
    return df.sparkSession.read.parquet(versions.write(df, path))


def export(df: DataFrame, columns: Sequence[str], path: str) -> DataFrame:
    """Write the listed columns that exist as CSV; returns what was written."""
    out = df.select(*[F.col(quoted(c)) for c in columns if c in df.columns])
    write_csv(out, path)
    return out
