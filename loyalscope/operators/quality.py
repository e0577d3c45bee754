"""Data-quality reports."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from loyalscope.functions import is_blank, is_missing, quoted
from loyalscope.operators import duplicates
from loyalscope.session import written

COPIES_PER_TASK = 100_000


def rows_of(df: DataFrame, rows: Sequence[Sequence[tuple[str, Column]]]) -> DataFrame:
    """Turn a one-row frame into several rows, each given as (name, expression) pairs."""
    structs = [F.struct(*[value.alias(name) for name, value in row]) for row in rows]
    return df.select(F.inline(F.array(*structs)))


def _missing_counts(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("_rows"), *[
        F.count_if(is_missing(F.col(quoted(f.name)), f.dataType)).alias(f.name) for f in df.schema])


class Watch(NamedTuple):
    """Counts that are taken while the rows of a frame go by on their way into a file: no scan of their own.

    ``facts`` waits for the first write (or other action) of the watched frame, so ask it after that.
    """

    observation: Observation
    columns: list[str]
    values: list

    def facts(self) -> dict:
        return self.observation.get

    def rows(self) -> int:
        return self.facts()["rows"]

    def missing(self) -> dict[str, int]:
        return {c: self.facts()[f"missing_{i}"] for i, c in enumerate(self.columns)}

    def labels(self) -> dict | None:
        """Rows by label value; None if the label had values beside the given ones."""
        facts = self.facts()
        return None if facts["other"] else {v: facts[f"value_{i}"] for i, v in enumerate(self.values) if facts[f"value_{i}"]}


def watched(df: DataFrame, label: str | None = None, values: Sequence = ()) -> tuple[DataFrame, Watch]:
    """The frame, to be written once, and what it tells by then: rows, missing values by column, rows by label value."""
    watch = Watch(Observation(), df.columns, list(values))
    counts = [F.count_if(is_missing(F.col(quoted(f.name)), f.dataType)).alias(f"missing_{i}") for i, f in enumerate(df.schema)]
    named = F.col(quoted(label)).isin(watch.values) if label else F.lit(False)
    labels = [F.count_if(F.col(quoted(label)) == v).alias(f"value_{i}") for i, v in enumerate(watch.values)]
    other = F.count_if(F.col(quoted(label)).isNotNull() & ~named) if label else F.count_if(F.lit(False))
    return df.observe(watch.observation, F.count("*").alias("rows"), *counts, *labels, other.alias("other")), watch


def null_report(df: DataFrame, watch: Watch | None = None) -> DataFrame:
    """Missing count and percent of every column that has any, from one pass, or from what was watched."""
    if watch is not None:
        n = watch.rows()
        found = [(c, k, n) for c, k in watch.missing().items() if k]
        rows = df.sparkSession.createDataFrame(found, "column string, missing_count long, n long")
        return rows.select("column", "missing_count", F.round(F.col("missing_count") * F.lit(100.0) / F.col("n").cast("double"), 2).alias("missing_pct"))
    percent = lambda c: F.round(F.try_divide(F.col(quoted(c)) * F.lit(100.0), F.col("_rows").cast("double")), 2)
    return rows_of(_missing_counts(df), [
        [("column", F.lit(c)), ("missing_count", F.col(quoted(c))), ("missing_pct", percent(c))] for c in df.columns
    ]).where(F.col("missing_count") > 0)


def blank_rows(df: DataFrame, col: str) -> DataFrame:
    """Rows whose text is empty once stripped."""
    return df.where(is_blank(F.col(col)))


def blank_count(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, blanks) for each text column."""
    counts = df.agg(*[F.count_if(is_blank(F.col(c))).alias(c) for c in cols])
    return rows_of(counts, [[("column", F.lit(c)), ("blanks", F.col(c))] for c in cols])


def duplicate_count(df: DataFrame) -> DataFrame:
    """One row: how many rows repeat an earlier one. Rows without a copy are not shuffled."""
    return duplicates.copies(df).agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Every row beyond the first of its kind.

    Copies are counted before the shuffle; a row with very many copies is then written out by
    several tasks, never by one.
    """
    surplus = duplicates.copies(df)
    last_slice = F.expr(f"(_copies - 2) div {COPIES_PER_TASK}")
    slices = surplus.withColumn("_slice", F.explode(F.sequence(F.lit(0).cast("bigint"), last_slice)))
    # a fixed number of partitions: the slices are tiny before they are written out, and adaptive
    # execution would otherwise put them all into one task
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    spread = slices.repartition(tasks, F.xxhash64("_slice", *[F.col(quoted(c)) for c in df.columns]))
    size = F.least(F.lit(COPIES_PER_TASK), F.col("_copies") - 1 - F.col("_slice") * COPIES_PER_TASK)
    return (
        spread.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), size.cast("bigint"))))
        .select(*[F.col(quoted(c)) for c in df.columns])
    )


def key_report(df: DataFrame, key: str) -> DataFrame:
    """One row: rows, distinct keys, and whether the key is unique and never null."""
    counts = df.groupBy(key).agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count(key).alias("distinct_keys"),
    )
    return counts.withColumn("is_unique", F.col("total_rows") == F.col("distinct_keys"))


def is_unique(df: DataFrame, key: str) -> bool:
    return key_report(df, key).first()["is_unique"]


def validate(df: DataFrame, label: str, watch: Watch | None = None) -> DataFrame:
    """Rows (check, passed, detail) for missing values, duplicates and the label's type."""
    if watch is None:
        counts = _missing_counts(df)
    else:
        counts = df.sparkSession.createDataFrame([tuple(watch.missing().values())], T.StructType([T.StructField(c, T.LongType()) for c in watch.columns]))
    named = F.concat_ws(", ", *[
        F.when(F.col(quoted(c)) > 0, F.concat(F.lit(f"{c}="), F.col(quoted(c)).cast("string"))) for c in df.columns])
    nulls = counts.select(F.lit("no_missing_values").alias("check"),
                          (named == "").alias("passed"), named.alias("detail"))
    repeats = duplicate_count(df).select(
        F.lit("no_duplicate_rows").alias("check"), (F.col("duplicate_rows") == 0).alias("passed"),
        F.col("duplicate_rows").cast("string").alias("detail"))
    kind = df.schema[label].dataType
    whole = isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    typed = df.sparkSession.range(1).select(F.lit("label_is_integer").alias("check"), F.lit(whole).alias("passed"),
                          F.lit(kind.simpleString()).alias("detail"))
    return nulls.unionByName(repeats).unionByName(typed)


def is_valid(df: DataFrame, label: str) -> bool:
    return all(row["passed"] for row in validate(df, label).collect())  # three rows


def compare(before: DataFrame, after: DataFrame, col: str) -> DataFrame:
    """(metric, before, after): rows, missing values (blank text of the column counts), duplicates, type."""
    sides = []
    # two counts read it, and it may have cost something to make
    for side, df in (("before", before), ("after", written(after, "after"))):
        kind = df.schema[col].dataType
        blanks = F.count_if(is_blank(F.col(col))) if isinstance(kind, T.StringType) else F.lit(0)
        missing = sum((F.count_if(is_missing(F.col(quoted(f.name)), f.dataType)) for f in df.schema), blanks)
        facts = df.agg(F.count("*").alias("rows"), missing.alias("missing"))
        facts = facts.withColumn("duplicates", duplicate_count(df).scalar())
        sides.append(rows_of(facts, [
            [("metric", F.lit("Total Rows")), ("number", F.col("rows").cast("string"))],
            [("metric", F.lit("Null Values")), ("number", F.col("missing").cast("string"))],
            [("metric", F.lit("Duplicate Rows")), ("number", F.col("duplicates").cast("string"))],
            [("metric", F.lit(f"{col} dtype")), ("number", F.lit(kind.simpleString()))],
        ]).withColumn("side", F.lit(side)))
    both = sides[0].unionByName(sides[1])
    pick = lambda side: F.max(F.when(F.col("side") == side, F.col("number"))).alias(side)
    return both.groupBy("metric").agg(pick("before"), pick("after"))


def dataset_profile(df: DataFrame, watch: Watch | None = None) -> DataFrame:
    """(position, column, type, total_rows, total_columns), one row per column."""
    total = df.agg(F.count("*").alias("total_rows")) if watch is None else df.sparkSession.createDataFrame([(watch.rows(),)], "total_rows long")
    return rows_of(total, [
        [("position", F.lit(i)), ("column", F.lit(f.name)), ("type", F.lit(f.dataType.simpleString())),
         ("total_rows", F.col("total_rows")), ("total_columns", F.lit(len(df.columns)))]
        for i, f in enumerate(df.schema, 1)
    ])


def intake_report(df: DataFrame, label: str, watch: Watch | None = None) -> DataFrame:
    """What is worth knowing about fresh input, as (topic, name, count): size, gaps, repeated rows, label values.

    With a watch only repeated rows need a scan, and label values if there were others than those watched for.
    """
    row = lambda topic, name, count: [F.lit(topic).alias("topic"), name.alias("name"), count.cast("bigint").alias("count")]
    repeats = duplicate_count(df).select(*row("duplicates", F.lit("rows"), F.col("duplicate_rows")))
    if watch is not None:
        known = [("rows", "total", watch.rows()), *(("missing", c, n) for c, n in watch.missing().items() if n)]
        known += [(label, str(v), n) for v, n in (watch.labels() or {}).items()]
        found = df.sparkSession.createDataFrame(known, "topic string, name string, count long").unionByName(repeats)
        if watch.labels() is not None:
            return found
    else:
        size = df.agg(F.count("*").alias("n")).select(*row("rows", F.lit("total"), F.col("n")))
        found = size.unionByName(null_report(df).select(*row("missing", F.col("column"), F.col("missing_count")))).unionByName(repeats)
    labels = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n")).select(
        *row(label, F.col(label).cast("string"), F.col("n")))
    return found.unionByName(labels)
