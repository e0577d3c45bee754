"""Categories to numbers and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F


def _chain(pairs) -> Column:
    pairs = list(pairs)
    return reduce(lambda chain, pair: chain.when(*pair), pairs[1:], F.when(*pairs[0]))


def binary_code(c: Column, codes: Mapping[str, int], default: int | None = None) -> Column:
    """Map each value to its code. An unmapped or null value fails the query unless a default is given."""
    chain = _chain((c == value, F.lit(code)) for value, code in codes.items())
    if default is not None:
        return chain.otherwise(F.lit(default))
    message = F.concat(F.lit("no code for value "), F.coalesce(F.concat(F.lit("'"), c, F.lit("'")), F.lit("null")))
    return chain.otherwise(F.raise_error(message).cast("int"))


def flag(c: Column, value: str) -> Column:
    """1 where the column equals the value, 0 everywhere else, null included."""
    return F.when(c == value, 1).otherwise(0)


def relabel(c: Column, names: Mapping) -> Column:
    """Replace known values by names; others become null."""
    return _chain((c == value, F.lit(name)) for value, name in names.items())


def from_dummies(dummies: Sequence[tuple[str, Column]], strict: bool = False) -> Column:
    """Label of the first dummy that is set. With none set: the first label, or null when strict."""
    chain = _chain((dummy.cast("boolean"), F.lit(label)) for label, dummy in dummies)
    return chain if strict else chain.otherwise(F.lit(dummies[0][0]))
