"""Filters, projections and ranked lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from loyalscope import schema
from loyalscope.functions import quoted

ALL = "All"


def keep_columns(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    return df.select(*[F.col(quoted(c)) for c in keep if c in df.columns])


def filter_segment(df: DataFrame, equals: Mapping | None = None, ranges: Mapping | None = None,
                   members: Mapping | None = None, at_least: Mapping | None = None) -> DataFrame:
    """Rows that meet every condition.

    ``equals`` skips values None and "All"; ``ranges`` are inclusive; an empty ``members`` list
    keeps everything.
    """
    conditions: list[Column] = []
    conditions += [F.col(c) == v for c, v in (equals or {}).items() if v is not None and v != ALL]
    conditions += [F.col(c).between(low, high) for c, (low, high) in (ranges or {}).items()]
    conditions += [F.col(c).isin(list(values)) for c, values in (members or {}).items() if values]
    conditions += [F.col(c) >= v for c, v in (at_least or {}).items()]
    for condition in conditions:
        df = df.where(condition)
    return df


def churned_only(df: DataFrame, label: str = schema.LABEL) -> DataFrame:
    return df.where(F.col(label) == 1)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct non-null values."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def at_risk(df: DataFrame, risks: Sequence[str] = ("High", "Medium"), min_score: float = 0.5,
            offers: Sequence[str] = ()) -> DataFrame:
    """Customers in the given risk bands with at least the given score, optionally only some offers.

    An empty list of bands selects nobody; an empty list of offers selects all of them.
    """
    df = df.where(F.col("ChurnRisk").isin(list(risks)) if risks else F.lit(False))
    members = {"OfferTitle": offers} if "OfferTitle" in df.columns else {}
    return filter_segment(df, at_least={"ChurnProbability": min_score}, members=members)


def top_n(df: DataFrame, by: str, n: int, key: str) -> DataFrame:
    """Largest first; the key settles ties, so the limit is reproducible."""
    return df.orderBy(F.desc(by), key).limit(n)


def first_n(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def last_n(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The last n rows in the order, still in that order."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(n).orderBy(*order)


def latest_n(df: DataFrame, time: str, arrival: str, n: int) -> DataFrame:
    """The n rows that arrived last, newest time first; a row that arrived late may be an old one."""
    return df.orderBy(F.desc(arrival)).limit(n).orderBy(F.desc(time), F.desc(arrival))


def drop_incomplete(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows with a null or NaN in any of the columns."""
    return df.dropna(subset=list(cols))
