"""Encoding, binning and derived columns on whole frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from loyalscope import schema
from loyalscope.functions import binary_code, flag, from_dummies, labelled_bin, open_bin, quoted, round_even

MAX_LEVELS = 1_000


def encode_binary(df: DataFrame, codes: Mapping[str, Mapping[str, int]], suffix: str = "_encoded",
                  default: int | None = None) -> DataFrame:
    """Add a 0/1 column per source column; unmapped values fail unless a default is given."""
    return df.withColumns({f"{c}{suffix}": binary_code(F.col(c), m, default) for c, m in codes.items()})


def find_levels(df: DataFrame, cols: Sequence[str], max_levels: int = MAX_LEVELS) -> dict[str, list]:
    """Sorted distinct non-null values of each column, from one job.

    The values become column names, so there may be only ``max_levels`` of them in all; more is an error.
    """
    pairs = (
        df.select(*[F.col(quoted(c)).cast("string").alias(c) for c in cols])
        .unpivot([], [F.col(quoted(c)) for c in cols], "col", "level").where(F.col("level").isNotNull()).distinct()
        .limit(max_levels + 1).collect()
    )
    if len(pairs) > max_levels:
        raise ValueError(f"more than {max_levels} levels in {list(cols)}")
    return {c: sorted(p["level"] for p in pairs if p["col"] == c) for c in cols}


def one_hot(df: DataFrame, cols: Sequence[str], levels: Mapping[str, Sequence] | None = None,
            keep: Sequence[str] = (), max_levels: int = MAX_LEVELS) -> DataFrame:
    """Replace each column by a boolean ``column_level`` per level; null is false in all of them.

    Columns in ``keep`` also stay as text. Without given levels one extra job finds them, and fails
    beyond ``max_levels`` of them; ``one_hot_long`` has no such limit.
    """
    levels = levels or find_levels(df, cols, max_levels)
    plain = [F.col(quoted(c)) for c in df.columns if c not in cols or c in keep]
    dummies = [F.col(quoted(c)).cast("string").eqNullSafe(F.lit(str(v))).alias(f"{c}_{v}") for c in cols for v in levels[c]]
    return df.select(*plain, *dummies)


def one_hot_long(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Rows (key, column, level) for every non-null value: one-hot for columns of any number of values, in one scan."""
    values = df.select(F.col(quoted(key)).alias(key), *[F.col(quoted(c)).cast("string").alias(c) for c in cols])
    long = values.unpivot([F.col(quoted(key))], [F.col(quoted(c)) for c in cols], "column", "level")
    return long.where(F.col("level").isNotNull())


def decode_one_hot(df: DataFrame, prefix: str, levels: Sequence[str] | None = None,
                   strict: bool = False) -> DataFrame:
    """Rebuild the label column from its dummies; a label column that is already there is left alone."""
    if prefix in df.columns:
        return df
    start = f"{prefix}_"
    if levels is None:
        levels = [c[len(start):] for c in df.columns if c.startswith(start) and not c.endswith("_encoded")]
    dummies = [(v, F.col(quoted(f"{start}{v}"))) for v in levels if f"{start}{v}" in df.columns]
    return df.withColumn(prefix, from_dummies(dummies, strict)) if dummies else df


def bin_column(df: DataFrame, col: str, edges: Sequence[float], labels: Sequence[str], out: str,
               closed: str = "right", open_ends: bool = False) -> DataFrame:
    label = open_bin(F.col(col), edges, labels) if open_ends else labelled_bin(F.col(col), edges, labels, closed)
    return df.withColumn(out, label)


def normalise_by_max(df: DataFrame, col: str, out: str, max_value: float | None = None,
                     digits: int | None = None, max_from: DataFrame | None = None) -> DataFrame:
    """Divide by a fixed maximum, or by the column's maximum over the frame.

    ``max_from`` names another frame with the same maximum that is cheaper to scan.
    """
    if max_value is None:
        top = (df if max_from is None else max_from).agg(F.max(col)).scalar()
    else:
        top = F.lit(max_value)
    share = F.try_divide(F.col(col).cast("double"), top.cast("double"))
    return df.withColumn(out, share if digits is None else round_even(share, digits))


def profile_features(df: DataFrame) -> DataFrame:
    """Raw customer profiles to model features, as a prediction form would enter them.

    Yes/No answers become flags, TotalCharges defaults to charge times tenure, and loyalty is
    measured against the longest tenure of the form.
    """
    # an answer other than Yes (or Male) counts as 0
    flags = {f"{c}_encoded": flag(F.col(c), "Yes") for c in schema.YES_NO_COLUMNS}
    flags["gender_encoded"] = flag(F.col("gender"), "Male")
    if isinstance(df.schema["SeniorCitizen"].dataType, T.StringType):
        flags["SeniorCitizen"] = flag(F.col("SeniorCitizen"), "Yes")
    default_total = F.col("MonthlyCharges") * F.col("tenure")
    given = F.col("TotalCharges").try_cast("double") if "TotalCharges" in df.columns else F.lit(None).cast("double")
    flags["TotalCharges"] = F.coalesce(given, default_total)
    flags["AnnualRevenue"] = F.col("MonthlyCharges") * 12
    return normalise_by_max(df.withColumns(flags), "tenure", "LoyaltyScore", schema.FORM_MAX_TENURE, digits=3)
