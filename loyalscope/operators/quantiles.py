"""Exact quantiles without a sort and without holding a column's values in one place.

Spark's own exact ``percentile`` keeps every distinct value of a group in the memory of one task, and
sketches of many partitions have to be merged in one. Here three passes narrow down on the wanted ranks
by counting: rows per bucket of the value's logarithm, then rows per even slice of the buckets that
hold a wanted rank, then rows per value in the slices that do. Counts are summed before the shuffle and
spread over the tasks by bucket, so a task gets at most one row per partition for each of its buckets;
running totals go over bucket counts alone, the values of one slice at most. Whatever the values are,
the ranks found are exact.

Without groups two passes do: sketches, merged in two steps, give a bracket of values around each wanted rank, and one more pass
counts what lies below, between and inside the brackets, there by value. A rank that turns up outside its bracket, against very long
odds, is found by counting as above; so are those of columns whose brackets would hold more than one task should order.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from loyalscope.functions import finite, quoted
from loyalscope.session import measured

ACCURACY = 100_000  # of the sketch that approximate answers come from
PER_E = 22  # buckets for each factor of e: about 33,000 for either sign cover all doubles
SLICES = 65_536  # even slices of a bucket
SKETCH = 4096  # size of the sketches behind the brackets
ERROR = 2.296 / SKETCH**0.9021  # of a rank that such a sketch gives, as a share of all: seldom exceeded
WIDTH = 4  # errors on either side of a wanted rank that a bracket spans
ORDERED = 4_000_000  # values that one task orders at most
MERGED = 64  # tasks that merge the sketches of all partitions before one merges theirs


def quantile_name(p: float) -> str:
    return f"q{p * 100:g}".replace(".", "_")


def _bucket(value: Column) -> Column:
    """A whole number that never falls as the value rises: the logarithm of its size, in steps. 0 is in the middle."""
    size = F.abs(value)
    step = F.when(size == float("inf"), F.lit(40_000)).otherwise(F.floor(F.log(size) * PER_E).cast("int") + 20_000)
    return F.when(value == 0, F.lit(0)).when(value > 0, step).otherwise(-step)


def _slice(value: Column) -> Column:
    """Which even slice between the columns least and most a value lies in; never falls as the value rises."""
    part = F.floor((value - F.col("least")) / (F.col("most") - F.col("least")) * SLICES).cast("int")
    return F.when(F.col("least") == F.col("most"), F.lit(0)).otherwise(part)


def _ranks(probs: Sequence[float], total: Column) -> Column:
    """The ranks just below and above each wanted position, from 0."""
    ends = [f(_position(p, total)).cast("bigint") for p in probs for f in (F.floor, F.ceil)]
    return F.array_distinct(F.array(*ends))


def _holding(counts: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Of counted parts, in order within the keys, those with wanted ranks; `before` rows come before each."""
    upto = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("before", F.col("before") + F.coalesce(F.sum("n").over(upto), F.lit(0)))
    here = F.filter("ranks", lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("n")))
    return placed.withColumn("here", here).where(F.size("here") > 0)


def _beside(values: DataFrame, parts: DataFrame, by: Sequence[str], on: Sequence[str]) -> DataFrame:
    """Values that lie in the parts. There are two parts at most for each wanted quantile and (by..., feature)."""
    side = parts.select(*[F.col(k).alias(f"_{k}") for k in [*by, *on]], *[c for c in parts.columns if c not in (*by, *on)])
    # without groups the parts are as many as the columns and quantiles asked for; with groups their size is measured
    side = measured(side) if by else F.broadcast(side)
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in by] + [F.col(k) == F.col(f"_{k}") for k in on]
    return values.join(side, same).drop(*[f"_{k}" for k in [*by, *on]])


def _ends(n: int, p: float) -> tuple[int, int]:
    """The ranks just below and above the position of a probability among n values."""
    position = (n - 1) * p
    return math.floor(position), math.ceil(position)


def _brackets(values: DataFrame, cols: Sequence[str], probs: Sequence[float], gappy: bool) -> tuple[dict, dict]:
    """(values, brackets) by column: how many values, and disjoint (low, high) that hold the wanted ranks, but for bad luck.

    Columns without values are left out, and with ``gappy`` those without a null.
    """
    spots = [(p, side) for p in probs for side in (-1, 1)]
    parts = values.groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGED)).alias("_part")).agg(
        F.count("*").alias("_rows"), *[F.count(F.col(quoted(c))).alias(f"n{i}") for i, c in enumerate(cols)],
        *[F.kll_sketch_agg_double(F.col(quoted(c)), F.lit(SKETCH)).alias(f"s{i}") for i, c in enumerate(cols)])
    whole = parts.agg(F.sum("_rows").alias("_rows"), *[F.sum(f"n{i}").alias(f"n{i}") for i in range(len(cols))],
                      *[F.kll_merge_agg_double(F.when(F.col(f"n{i}") > 0, F.col(f"s{i}")), F.lit(SKETCH)).alias(f"s{i}") for i in range(len(cols))])
    ranks = F.array(*[F.lit(min(1.0, max(0.0, p + side * WIDTH * ERROR))) for p, side in spots])
    row = whole.select("_rows", *[f"n{i}" for i in range(len(cols))], *[
        F.when(F.col(f"n{i}") > 0, F.kll_sketch_get_quantile_double(F.col(f"s{i}"), ranks)).alias(f"q{i}") for i in range(len(cols))]).first()
    counts = {c: row[f"n{i}"] for i, c in enumerate(cols) if row[f"n{i}"] and not (gappy and row[f"n{i}"] == row["_rows"])}
    found: dict[str, list[tuple[float, float]]] = {}
    for i, c in enumerate(cols):
        if c not in counts:
            continue
        pairs = []
        for j, p in enumerate(probs):
            low, high = row[f"q{i}"][2 * j : 2 * j + 2]
            # a rank near an end may lie outside all that a sketch tells
            pairs.append((-math.inf if p <= WIDTH * ERROR else low, math.inf if p >= 1 - WIDTH * ERROR else high))
        merged: list[tuple[float, float]] = []
        for low, high in sorted(pairs):
            if merged and low <= merged[-1][1]:
                merged[-1] = merged[-1][0], max(high, merged[-1][1])
            else:
                merged.append((low, high))
        found[c] = merged
    return counts, found


def _region(value: Column, brackets: Sequence[tuple[float, float]]) -> Column:
    """0 below the first bracket, 1 in it, 2 up to the second one, and so on."""
    out = F.lit(2 * len(brackets))
    for i, (low, high) in reversed(list(enumerate(brackets))):
        out = F.when(value < F.lit(low), F.lit(2 * i)).when(value <= F.lit(high), F.lit(2 * i + 1)).otherwise(out)
    return out


def _bracketed(values: DataFrame, cols: Sequence[str], probs: Sequence[float], gappy: bool = False) -> DataFrame:
    """Quantiles of whole columns, found when this is called: few numbers, one row per column."""
    counts, brackets = _brackets(values, cols, probs, gappy)
    wide = [c for c in counts if counts[c] * min(1.0, 2 * WIDTH * ERROR * len(probs)) > ORDERED]
    cols = [c for c in counts if c not in wide]
    rows: list[tuple] = []
    if cols:
        each = []
        for c in cols:
            value = F.col(quoted(c))
            region = _region(value, brackets[c])
            each.append(F.struct(F.lit(c).alias("feature"), F.when(value.isNotNull(), region).alias("region"), F.when(region % 2 == 1, value).alias("value")))
        cells = values.select(F.inline(F.array(*each))).where("region IS NOT NULL").groupBy("feature", "region", "value").agg(F.count("*").alias("n"))
        upto = Window.partitionBy("feature").orderBy("region", "value").rowsBetween(Window.unboundedPreceding, -1)
        placed = cells.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0)))
        wanted = F.create_map(*[F.lit(x) for c in cols for x in (c, sorted({r for p in probs for r in _ends(counts[c], p)}))])
        here = F.filter(wanted[F.col("feature")], lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("n")))
        at: dict[str, dict[int, float]] = defaultdict(dict)
        for row in placed.withColumn("here", here).where(F.size("here") > 0).collect():  # two a column and probability
            if row["region"] % 2:
                at[row["feature"]].update(dict.fromkeys(row["here"], row["value"]))
        for c in cols:
            ends = [(p, _ends(counts[c], p)) for p in probs]
            if all(r in at[c] for _, pair in ends for r in pair):
                rows.append((c, *[_interpolated(at[c][low], at[c][high], (counts[c] - 1) * p - low) for p, (low, high) in ends]))
            else:
                wide.append(c)
    schema = ", ".join(["feature string", *[f"{quoted(quantile_name(p))} double" for p in probs]])
    found = values.sparkSession.createDataFrame(rows, schema)
    return found.unionByName(_counted(_long(values, wide), [], probs)) if wide else found


def _interpolated(low: float, high: float, share: float) -> float:
    return low if low == high else low + (high - low) * share


def _long(values: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return values.unpivot(list(by), list(cols), "feature", "value").where(F.col("value").isNotNull())


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
              by: Sequence[str] = (), approx: bool = False, accuracy: int = ACCURACY, gappy: bool = False) -> DataFrame:
    """Linear-interpolated quantiles: a row per (by..., feature), a column per probability.

    Null and NaN values are left out; a group without values has no row, nor, with ``gappy``, a column without missing
    values. Exact ones read the rows when this is called: those of whole columns twice, grouped ones to write their two tables of
    parts. ``approx`` answers from a sketch, in one pass; its merge is one task per group and column.
    """
    by, probs = list(by), sorted(probs)
    values = df.select(*by, *[finite(F.col(c).cast("double")).alias(c) for c in cols])
    if not approx and not by:
        return _bracketed(values, list(cols), probs, gappy)
    long = _long(values, cols, by)
    if approx:
        keys = [*by, "feature"]
        picks = F.percentile_approx("value", list(probs), accuracy)
        sketch = long.groupBy(*keys).agg(picks.alias("picks"))
        return sketch.select(*keys, *[F.col("picks")[i].alias(quantile_name(p)) for i, p in enumerate(probs)])
    return _counted(long, by, probs)


def _counted(values: DataFrame, by: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Quantiles of rows (by..., feature, value) by counting alone, in three passes."""
    by = list(by)
    keys = [*by, "feature"]
    sums = [F.count("*").alias("n"), F.min("value").alias("least"), F.max("value").alias("most")]
    bucketed = values.withColumn("bucket", _bucket(F.col("value")))
    total = F.sum("n").over(Window.partitionBy(*keys))
    buckets = bucketed.groupBy(*keys, "bucket").agg(*sums).withColumns({"total": total, "before": F.lit(0)})
    buckets = _holding(buckets.withColumn("ranks", _ranks(probs, F.col("total"))), keys, "bucket")
    buckets = buckets.select(*keys, "bucket", "least", "most", "before", "total", "ranks")

    sliced = _beside(bucketed, buckets, by, ["feature", "bucket"]).withColumn("slice", _slice(F.col("value")))
    carried = ["before", "total", "ranks"]
    slices = sliced.groupBy(*keys, "bucket", "slice").agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in carried])
    slices = _holding(slices, [*keys, "bucket"], "slice").select(*keys, "bucket", "slice", *carried)

    valued = _beside(sliced.drop(*carried), slices, by, ["feature", "bucket", "slice"])
    exact = valued.groupBy(*keys, "bucket", "slice", "value").agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in carried])
    exact = _holding(exact, [*keys, "bucket", "slice"], "value")
    found = exact.select(*keys, "total", "value", F.explode("here").alias("rank")).groupBy(*keys).agg(
        F.first("total").alias("total"), F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at"))  # two per probability
    return found.select(*keys, *[_between(p).alias(quantile_name(p)) for p in probs])


def _position(p: float, total: Column) -> Column:
    return (total - 1).cast("double") * F.lit(float(p))


def _between(p: float) -> Column:
    position = _position(p, F.col("total"))
    low, high = (F.col("at")[f(position).cast("bigint")] for f in (F.floor, F.ceil))
    # equal neighbours, two infinities for instance, need no arithmetic
    return F.when(low == high, low).otherwise(low + (high - low) * (position - F.floor(position)))


def medians(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), approx: bool = False, gappy: bool = False) -> DataFrame:
    """(by..., feature, median)."""
    return quantiles(df, cols, [0.5], by, approx, gappy=gappy).withColumnRenamed(quantile_name(0.5), "median")
