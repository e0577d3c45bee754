"""Churn, revenue and score reports. The label is a 0/1 column throughout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from loyalscope import schema
from loyalscope.functions import rate, round_even
from loyalscope.operators.quality import rows_of


def _churned(label: str) -> Column:
    return F.count_if(F.col(label) == 1)


def kpis(df: DataFrame, label: str = schema.LABEL, amount: str = "MonthlyCharges", months: str = "tenure",
         risk: str = "ChurnRisk") -> DataFrame:
    """All headline numbers in one row, from one pass."""
    lost = F.coalesce(F.sum(F.when(F.col(label) == 1, F.col(amount))), F.lit(0.0))
    high = F.count_if(F.col(risk) == "High") if risk in df.columns else F.lit(0).cast("bigint")
    return df.agg(
        F.count("*").alias("total_customers"),
        _churned(label).alias("churned"),
        (F.count("*") - _churned(label)).alias("retained"),
        F.coalesce(rate(_churned(label), F.count("*"), 2), F.lit(0.0)).alias("churn_rate_pct"),
        F.round(F.sum(amount), 2).alias("total_monthly_revenue"),
        F.round(F.avg(amount), 2).alias("avg_monthly_charge"),
        F.round(F.avg(months), 1).alias("avg_tenure_months"),
        F.round(lost, 2).alias("lost_monthly_revenue"),
        F.round(lost * 12, 2).alias("lost_annual_revenue"),
        high.alias("high_risk"),
    )


def label_rows(df: DataFrame, dim: str, labels: Sequence[str]) -> DataFrame:
    """The listed labels as a frame with their position, one row each."""
    listed = F.array(*[F.struct(F.lit(v).alias(dim), F.lit(i).alias("position")) for i, v in enumerate(labels)])
    return df.sparkSession.range(1).select(F.inline(listed))


def _in_order(grouped: DataFrame, dim: str, labels: Sequence[str]) -> DataFrame:
    """Every listed label once and in order, with the group's numbers or nulls."""
    listed = grouped.where(F.col(dim).isin(list(labels)))  # at most one row per label, so safe to broadcast
    return label_rows(grouped, dim, labels).join(F.broadcast(listed), dim, "left")


def rate_by(df: DataFrame, dims: Sequence[str], label: str = schema.LABEL, digits: int | None = 2,
            order_labels: Sequence[str] | None = None) -> DataFrame:
    """total, churned and churn rate per group.

    With ``order_labels`` (one dimension only) exactly those groups appear, empty ones too, with
    their position; without, every group that occurs, null included.
    """
    dims = [dims] if isinstance(dims, str) else list(dims)
    grouped = df.groupBy(*dims).agg(F.count(label).alias("total"), _churned(label).alias("churned"))
    if order_labels is not None:
        if len(dims) > 1:
            raise ValueError("listed labels need a single dimension")
        zero = F.lit(0).cast("bigint")
        grouped = _in_order(grouped, dims[0], order_labels)
        grouped = grouped.withColumns({c: F.coalesce(F.col(c), zero) for c in ("total", "churned")})
    return grouped.withColumn("churn_rate_pct", rate(F.col("churned"), F.col("total"), digits))


def rate_by_each(df: DataFrame, dims: Sequence[str], label: str = schema.LABEL, digits: int = 1) -> DataFrame:
    """Churn rate by every value of many dimensions, absent ones skipped: one scan and one shuffle."""
    dims = [d for d in dims if d in df.columns]
    long = df.select(label, *[F.col(d).cast("string").alias(d) for d in dims]).unpivot([label], dims, "feature", "value")
    counts = rate_by(long.where(F.col("value").isNotNull()), ["feature", "value"], label, digits=None)
    return counts.withColumn("churn_rate_pct", round_even(F.col("churn_rate_pct"), digits))


def split_by(df: DataFrame, dims: Sequence[str] = (), label: str = schema.LABEL) -> DataFrame:
    """Churned and retained counts, overall or per group."""
    return df.groupBy(*dims).agg(
        _churned(label).alias("churned"), F.count_if(F.col(label) == 0).alias("retained"))


def revenue_at_risk(df: DataFrame, label: str = schema.LABEL, monthly: str = "MonthlyCharges",
                    annual: str = "AnnualRevenue") -> DataFrame:
    return df.where(F.col(label) == 1).agg(
        F.round(F.sum(monthly), 2).alias("lost_monthly_revenue"),
        F.round(F.sum(annual), 2).alias("lost_annual_revenue"))


def loss_by(df: DataFrame, dim: str, amount: str = "MonthlyCharges", label: str = schema.LABEL,
            order_labels: Sequence[str] | None = None) -> DataFrame:
    """Amount lost and customers lost per group; listed groups without churn have nulls."""
    grouped = df.where(F.col(label) == 1).groupBy(dim).agg(
        F.round(F.sum(amount), 2).alias("revenue_lost"), F.count(amount).alias("customers"))
    return grouped if order_labels is None else _in_order(grouped, dim, order_labels)


def with_share(grouped: DataFrame, amount: str, out: str = "share_pct", digits: int = 1) -> DataFrame:
    """Each group's percent of the total over all groups."""
    # the digest touches every column, so the total's plan equals the groups' and shares their scan and shuffle
    digest = F.bit_xor(F.xxhash64(*[F.col(c) for c in grouped.columns]))
    total = grouped.agg(F.struct(F.sum(amount).alias("total"), digest)).scalar()
    return grouped.withColumn(out, rate(F.col(amount), total["total"], digits))


def value_counts(df: DataFrame, col: str, normalise: bool = False, digits: int = 1) -> DataFrame:
    """Counts of the non-null values, largest first, ties by value; as percent too when normalised."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("count"))
    if normalise:
        counts = with_share(counts, "count", "percent", digits)
    return counts.orderBy(F.desc("count"), col)


def at_risk_kpis(at_risk: DataFrame, amount: str = "MonthlyCharges", score: str = "ChurnProbability",
                 months: str = "tenure") -> DataFrame:
    return at_risk.agg(
        F.count("*").alias("at_risk"),
        F.round(F.coalesce(F.sum(amount), F.lit(0.0)), 2).alias("monthly_revenue_at_risk"),
        F.round(F.avg(score), 4).alias("avg_probability"),
        F.round(F.avg(months), 1).alias("avg_tenure_months"))


def score_summary(df: DataFrame, predicted: str = "WillChurn_Predicted", risk: str = "ChurnRisk") -> DataFrame:
    hits = F.count_if(F.col(predicted) == 1)
    return df.agg(
        F.count("*").alias("scored"),
        hits.alias("predicted_churn"),
        rate(hits, F.count("*"), 1).alias("predicted_churn_pct"),
        *[F.count_if(F.col(risk) == band).alias(f"{band.lower()}_risk") for band in reversed(schema.RISK_LABELS)])


def bounds(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, min, max) of numeric columns."""
    ends = df.agg(*[f(c).cast("double").alias(f"{c}_{f.__name__}") for c in cols for f in (F.min, F.max)])
    return rows_of(ends, [
        [("column", F.lit(c)), ("min", F.col(f"{c}_min")), ("max", F.col(f"{c}_max"))] for c in cols])


def event_counters(log: DataFrame, counters: dict[str, str], event: str = "event") -> DataFrame:
    """Total rows and one counter per named event, in one row."""
    return log.agg(F.count("*").alias("total_events"),
                   *[F.count_if(F.col(event) == value).alias(name) for name, value in counters.items()])
