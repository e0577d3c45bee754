"""Column expressions: no function here starts a job or moves a row."""

from loyalscope.functions.encoding import binary_code, flag, from_dummies, relabel
from loyalscope.functions.binning import labelled_bin, open_bin, revenue_category, risk_band
from loyalscope.functions.values import (
    ascii_only, finite, is_blank, is_missing, number, percent_text, quoted, rate, round_even, strip, zero_if_missing)

__all__ = [
    "ascii_only", "binary_code", "finite", "flag", "from_dummies", "is_blank", "is_missing",
    "labelled_bin", "number", "open_bin", "percent_text", "quoted", "rate", "relabel", "revenue_category",
    "risk_band", "round_even", "strip", "zero_if_missing",
]
