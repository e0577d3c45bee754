"""Number repair, imputation, duplicates and white space."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from loyalscope.functions import finite, is_blank, number, quoted, strip, zero_if_missing
from loyalscope.operators.quantiles import medians


def coerce_number(df: DataFrame, col: str) -> DataFrame:
    """Text column to double; what is no number becomes null."""
    return df.withColumn(col, number(F.col(col)))


def blank_to(df: DataFrame, col: str, constant: float = 0.0) -> DataFrame:
    """Text column to double; blanks become the constant, other bad text null."""
    return df.withColumn(col, F.when(is_blank(F.col(col)), F.lit(float(constant))).otherwise(number(F.col(col))))


def impute_median(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Fill nulls and NaN of each numeric column with that column's median over the whole frame.

    Columns that cannot be null by their schema are left alone, and the median is only looked for in those that have
    gaps. The frame is read when this is called, unless ``approx``.
    """
    cols = [c for c in cols if df.schema[c].nullable]
    if not cols:
        return df
    values = df.select(*[finite(F.col(c).cast("double")).alias(c) for c in cols])
    pairs = F.collect_list(F.struct("feature", "median"))  # one per column
    middle = medians(values, cols, approx=approx, gappy=True).agg(F.map_from_entries(pairs)).scalar()
    filled = {c: F.coalesce(finite(F.col(c).cast("double")), F.col("_middle")[c]) for c in cols}
    return df.withColumn("_middle", middle).withColumns(filled).drop("_middle")


def zero_fill(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The columns in the given order, nulls as 0 and absent ones added as 0, behind the kept columns."""
    present = set(df.columns)
    filled = [(zero_if_missing(F.col(quoted(c))) if c in present else F.lit(0)).alias(c) for c in cols]
    return df.select(*[F.col(quoted(k)) for k in keep if k not in cols], *filled)


def trim_strings(df: DataFrame) -> DataFrame:
    """Strip every string column."""
    return df.select(*[
        strip(F.col(quoted(f.name))).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(quoted(f.name))
        for f in df.schema
    ])


def clean(df: DataFrame, amount: str = "TotalCharges", strategy: str = "median", approx: bool = False) -> DataFrame:
    """Repair the amount, drop whole-row duplicates, then strip text, in that order.

    The order matters: the median counts duplicates, and rows that differ only by white space stay.
    """
    if strategy == "median":
        repaired = impute_median(coerce_number(df, amount), [amount], approx)
    elif strategy == "zero":
        repaired = blank_to(df, amount, 0.0)
    else:
        raise ValueError("strategy is 'median' or 'zero'")
    return trim_strings(repaired.dropDuplicates())
