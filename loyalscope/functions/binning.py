"""Numbers to labelled bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from loyalscope import schema
from loyalscope.functions.values import finite


def labelled_bin(c: Column, edges: Sequence[float], labels: Sequence[str], closed: str = "right") -> Column:
    """Label of the interval that holds the value; null outside all intervals."""
    if len(edges) != len(labels) + 1:
        raise ValueError("need one more edge than labels")
    if closed not in ("left", "right"):
        raise ValueError("closed is 'left' or 'right'")
    c = finite(c)
    parts = []
    for low, high, label in zip(edges, edges[1:], labels):
        inside = (c > low) & (c <= high) if closed == "right" else (c >= low) & (c < high)
        parts.append(F.when(inside, F.lit(label)))
    return F.coalesce(*parts)


def open_bin(c: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bands without outer limits; whatever matches no earlier band, null too, gets the last."""
    parts = [F.when(c <= high, F.lit(label)) for high, label in zip(edges[1:-1], labels)]
    return F.coalesce(*parts, F.lit(labels[-1]))


def revenue_category(charge: Column, missing: str = "Low") -> Column:
    """Low / Medium / High by monthly charge."""
    charge = finite(charge)
    parts = [F.when(charge < cut, F.lit(label)) for label, cut in schema.REVENUE_CUTS]
    top = F.when(charge >= schema.REVENUE_CUTS[-1][1], F.lit("High"))
    return F.coalesce(*parts, top, F.lit(missing))


def risk_band(score: Column, closed: str = "right") -> Column:
    """Risk of a score: right-closed for whole batches of rounded scores, left-closed for single profiles."""
    return labelled_bin(score, schema.RISK_EDGES, schema.RISK_LABELS, closed)
