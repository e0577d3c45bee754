"""Describe, correlate, histogram, box and density numbers."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, functions as F

from loyalscope.functions import finite, round_even
from loyalscope.operators.quality import rows_of
from loyalscope.operators.quantiles import quantiles
from loyalscope.session import measured


def _value(c: str) -> Column:
    return finite(F.col(c).cast("double"))


def describe_numeric(df: DataFrame, cols: Sequence[str], digits: int = 2, approx: bool = False) -> DataFrame:
    """count, mean, sample deviation, min, quartiles and max of each column."""
    values = df.select(*[_value(c).alias(c) for c in cols])
    moments = values.agg(*[F.struct(
        F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
        F.min(c).alias("min"), F.max(c).alias("max")).alias(c) for c in cols])
    rows = rows_of(moments, [
        [("feature", F.lit(c)), *[(s, F.col(c)[s]) for s in ("count", "mean", "std", "min", "max")]] for c in cols])
    marks = quantiles(values, cols, [0.25, 0.5, 0.75], approx=approx)  # one row per column
    rounded = lambda name, out=None: round_even(F.col(name), digits).alias(out or name)
    return rows.join(F.broadcast(marks), "feature", "left").select(
        "feature", "count", rounded("mean"), rounded("std"), rounded("min"),
        rounded("q25"), rounded("q50", "median"), rounded("q75"), rounded("max"))


def describe_categorical(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, distinct values, most frequent value and its count; equal counts go to the smaller value."""
    pairs = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "feature", "value")
    counts = pairs.where(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.count("*").alias("n"))
    order = F.struct(-F.col("n"), F.col("value"))
    return counts.groupBy("feature").agg(
        F.sum("n").alias("count"), F.count("*").alias("unique"),
        F.min_by("value", order).alias("top"), F.max("n").alias("freq"))


#: So many pairs are aggregated one by one in one plan; more come from one matrix of moments.
PAIRS = 500


def correlations(df: DataFrame, cols: Sequence[str], digits: int = 4) -> DataFrame:
    """Pearson correlation of every pair, on the rows where both are present; both triangles and the diagonal.

    Of many columns the rows are read twice when this is called, and the matrix is worked out from moments; a column that does
    not vary has no correlation then (null).
    """
    if len(cols) * (len(cols) + 1) // 2 > PAIRS:
        return _from_moments(df, cols, digits)
    values = df.select(*[_value(c).alias(c) for c in cols])
    pairs = list(combinations(cols, 2))
    found = values.agg(*[F.round(F.corr(a, b), digits).alias(f"{a}|{b}") for a, b in pairs],
                       *[F.round(F.corr(c, c), digits).alias(f"{c}|{c}") for c in cols])
    cell = lambda a, b, key: [("feature_a", F.lit(a)), ("feature_b", F.lit(b)), ("correlation", F.col(f"`{key}`"))]
    return rows_of(found, [
        *[cell(c, c, f"{c}|{c}") for c in cols],
        *[cell(x, y, f"{a}|{b}") for a, b in pairs for x, y in ((a, b), (b, a))]])


def _from_moments(df: DataFrame, cols: Sequence[str], digits: int) -> DataFrame:
    """The same from one matrix of second moments, however many columns.

    Every row becomes a vector of its standardised values (0 where missing), marks of those present, and squares of the values.
    The products of these vectors, summed over all rows, hold what every pair needs: rows with both, and the sums, squares and
    products on those. What the driver gets is three times the columns, squared.
    """
    k = len(cols)
    values = df.select(*[_value(c).alias(f"v{i}") for i, c in enumerate(cols)])
    first = values.agg(F.count("*").alias("n"), *[f(f"v{i}").alias(f"{name}{i}") for i in range(k) for name, f in (("c", F.count), ("m", F.avg), ("s", F.stddev_samp))]).first()
    n = first["n"]
    count = np.array([first[f"c{i}"] for i in range(k)], float)
    spread = [first[f"s{i}"] or 0.0 for i in range(k)]
    moving = np.array([math.isfinite(s) and s > 0 for s in spread])
    scaled = [F.coalesce((F.col(f"v{i}") - first[f"m{i}"]) / spread[i], F.lit(0.0)) if moving[i] else F.lit(0.0) for i in range(k)]
    present = [F.col(f"v{i}").isNotNull().cast("double") for i in range(k)]
    if n < 2:
        second = np.zeros((3 * k, 3 * k))
    else:
        rows = values.select(*[x.alias(f"x{i}") for i, x in enumerate(scaled)], *[x.alias(f"p{i}") for i, x in enumerate(present)])
        parts = [F.col(f"x{i}") for i in range(k)] + [F.col(f"p{i}") for i in range(k)] + [F.col(f"x{i}") * F.col(f"x{i}") for i in range(k)]
        vectors = MLUtils.convertVectorColumnsFromML(rows.select(array_to_vector(F.array(*parts)).alias("z")), "z")
        # the sums of the vectors' parts are known: 0, the counts, and the counts less one
        mean = np.concatenate([np.zeros(k), count, np.where(moving, np.maximum(count - 1, 0), 0)]) / n
        second = (n - 1) * RowMatrix(vectors).computeCovariance().toArray() + n * np.outer(mean, mean)
    both, sums, squares, products = second[k : 2 * k, k : 2 * k], second[:k, k : 2 * k], second[2 * k :, k : 2 * k], second[:k, :k]
    out = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            m = round(both[i, j])
            if m < 2:
                out.append((a, b, None))
                continue
            x, y = squares[i, j] - sums[i, j] ** 2 / m, squares[j, i] - sums[j, i] ** 2 / m
            flat = x <= 1e-12 * squares[i, j] or y <= 1e-12 * squares[j, i] or not (moving[i] and moving[j])
            r = None if flat else (products[i, j] - sums[i, j] * sums[j, i] / m) / math.sqrt(x * y)
            out.append((a, b, None if r is None else float(r)))
    found = df.sparkSession.createDataFrame(out, "feature_a string, feature_b string, correlation double")
    return found.withColumn("correlation", F.round(F.when(F.abs("correlation") > 1, F.signum("correlation")).otherwise(F.col("correlation")), digits))


def label_correlations(df: DataFrame, cols: Sequence[str], label: str, digits: int = 4) -> DataFrame:
    """Correlation of each feature with the label, smallest first."""
    values = df.select(*[_value(c).alias(c) for c in [*cols, label]])
    found = values.agg(*[F.round(F.corr(c, label), digits).alias(c) for c in cols])
    return rows_of(found, [[("feature", F.lit(c)), ("correlation", F.col(c))] for c in cols]).orderBy("correlation", "feature")


def with_group_stats(df: DataFrame, by: Sequence[str], stats: DataFrame) -> DataFrame:
    """Add a group's statistics to its rows; the size of the group table is measured first."""
    side = measured(stats.select(*[F.col(c).alias(f"_{c}") for c in by], *[c for c in stats.columns if c not in by]))
    return df.join(side, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]).drop(*[f"_{c}" for c in by])


def _edge(bin_: Column, bins: int) -> Column:
    """Lower edge of a bin between the columns low and high; the upper edge of the last one is high itself."""
    inner = F.col("low") + (F.col("high") - F.col("low")) / bins * bin_
    return F.when(bin_ == bins, F.col("high")).otherwise(inner)


def _binned(df: DataFrame, col: str, bins: int, by: Sequence[str]) -> DataFrame:
    """Non-empty bins with the group's own limits, size and deviation: (by..., low, high, n, std, bin, count)."""
    values = df.select(*by, _value(col).alias("value")).where(F.col("value").isNotNull())
    limits = [F.min("value").alias("low"), F.max("value").alias("high"), F.count("*").alias("n"), F.stddev_samp("value").alias("std")]
    if by:
        placed = with_group_stats(values, by, values.groupBy(*by).agg(*limits))
    else:
        placed = values.withColumn("_ends", values.agg(F.struct(*limits)).scalar()).select("value", "_ends.*")
    # equal limits get a unit range around the value, as plotting libraries do
    flat = F.col("low") == F.col("high")
    placed = placed.select(*by, "value", (F.col("low") - F.when(flat, 0.5).otherwise(0.0)).alias("low"),
                           (F.col("high") + F.when(flat, 0.5).otherwise(0.0)).alias("high"), "n", "std")
    # the quotient may miss by one at an edge, so it is checked against the edges that are reported
    spot = F.floor((F.col("value") - F.col("low")) * bins / (F.col("high") - F.col("low")))
    near = placed.withColumn("near", F.least(F.lit(bins - 1), spot).cast("int"))
    miss = F.when(F.col("value") < _edge(F.col("near"), bins), -1).when(
        (F.col("value") >= _edge(F.col("near") + 1, bins)) & (F.col("near") < bins - 1), 1).otherwise(0)
    return (
        near.withColumn("bin", F.col("near") + miss)
        .groupBy(*by, "low", "high", "n", "std", "bin").agg(F.count("*").alias("count"))
    )


def histogram(df: DataFrame, col: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width counts between the group's own minimum and maximum; empty bins stay, the last is closed."""
    by = list(by)
    filled = _binned(df, col, bins, by).groupBy(*by, "low", "high").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "count"))).alias("counts"))  # at most `bins` entries
    return (
        filled.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
        .select(*by, "bin", _edge(F.col("bin"), bins).alias("bin_start"), _edge(F.col("bin") + 1, bins).alias("bin_end"),
                F.coalesce(F.col("counts")[F.col("bin")], F.lit(0)).alias("count"))
    )


def box_stats(df: DataFrame, col: str, by: Sequence[str], approx: bool = False) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers, outlier count and the notch around the median, per group.

    A whisker ends at the last value within the fence, but never inside the box.
    """
    by = list(by)
    values = df.select(*by, _value(col).alias("value")).where(F.col("value").isNotNull())
    marks = quantiles(values, ["value"], [0.25, 0.5, 0.75], by, approx).drop("feature")
    iqr = F.col("q75") - F.col("q25")
    placed = with_group_stats(values, by, marks)
    inner = F.col("value").between(F.col("q25") - 1.5 * iqr, F.col("q75") + 1.5 * iqr)
    stats = placed.groupBy(*by, "q25", "q50", "q75").agg(
        F.count("*").alias("n"),
        F.least("q25", F.min(F.when(inner, F.col("value")))).alias("whisker_low"),
        F.greatest("q75", F.max(F.when(inner, F.col("value")))).alias("whisker_high"),
        F.count_if(~inner).alias("outliers"))
    notch = 1.57 * iqr / F.sqrt(F.col("n").cast("double"))
    return stats.select(*by, "n", "q25", F.col("q50").alias("median"), "q75", "whisker_low", "whisker_high",
                        "outliers", (F.col("q50") - notch).alias("notch_low"), (F.col("q50") + notch).alias("notch_high"))


def density(df: DataFrame, col: str, by: Sequence[str], grid: int = 100, bins: int = 512, cut: float = 2.0) -> DataFrame:
    """Gaussian density per group on an even grid, by binning first (Scott bandwidth).

    Rows are reduced to at most ``bins`` counts per group; the kernel sum then works on those alone.
    """
    by = list(by)
    values = df.select(*by, _value(col).alias("value")).where(F.col("value").isNotNull())
    width = (F.col("high") - F.col("low")) / bins
    joined = _binned(values, "value", bins, by).groupBy(*by, "low", "high", "n", "std").agg(F.array_sort(F.collect_list(F.struct(
        (F.col("low") + width * (F.col("bin") + 0.5)).alias("mid"), F.col("count").alias("n")))).alias("boxes"))
    h = F.col("std") * F.pow(F.col("n").cast("double"), F.lit(-0.2))
    points = joined.withColumn("h", h).withColumns({
        "start": F.col("low") - cut * F.col("h"),
        "step": (F.col("high") - F.col("low") + 2 * cut * F.col("h")) / (grid - 1),
        "point": F.explode(F.sequence(F.lit(0), F.lit(grid - 1))),
    }).withColumn("x", F.col("start") + F.col("step") * F.col("point"))
    near = lambda box: box["n"] * F.exp(-0.5 * F.pow((F.col("x") - box["mid"]) / F.col("h"), F.lit(2.0)))
    kernel = F.aggregate("boxes", F.lit(0.0), lambda total, box: total + near(box))
    height = F.try_divide(kernel, F.col("n") * F.col("h") * F.sqrt(2 * F.pi()))
    return points.select(*by, "point", "x", height.alias("density"))
