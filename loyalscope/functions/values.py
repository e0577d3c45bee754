"""Numbers and text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

_SPACES = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def quoted(name: str) -> str:
    """A column's name as one part, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def strip(c: Column) -> Column:
    """Remove leading and trailing white space of any kind."""
    return F.btrim(c, F.lit(_SPACES))


def is_blank(c: Column) -> Column:
    """True for text that is empty once stripped; null stays null."""
    return strip(c) == ""


def finite(c: Column) -> Column:
    """NaN becomes null. Spark sorts NaN above every number, so comparisons need this."""
    return F.when(~F.isnan(c), c)


def number(c: Column) -> Column:
    """Text to double; anything that is no number, NaN included, becomes null."""
    text = strip(c.cast("string"))
    suffixed = text.rlike("[0-9.][dDfF]$")  # the JVM would read "1d" and "1f" as numbers
    return F.when(~suffixed, finite(text.try_cast("double")))


def is_missing(c: Column, data_type: T.DataType) -> Column:
    """Null, or NaN in a floating-point column."""
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def zero_if_missing(c: Column) -> Column:
    return F.coalesce(finite(c), F.lit(0))


def rate(part: Column, whole: Column, digits: int | None = None) -> Column:
    """100 * part / whole in double arithmetic, rounded as SQL does; null when whole is zero."""
    out = F.try_divide(part.cast("double") * 100.0, whole.cast("double"))
    return out if digits is None else F.round(out, digits)


def round_even(c: Column, digits: int) -> Column:
    """Round as numpy does: scale, round halves to even, scale back. SQL's ``round`` takes halves away from zero."""
    scale = float(10 ** digits)
    return F.rint(c * scale) / scale


def percent_text(c: Column, digits: int = 1) -> Column:
    """0.72 -> '72.0%'."""
    return F.concat(round_even(c * 100, digits).cast("string"), F.lit("%"))


def ascii_only(c: Column) -> Column:
    """Drop every non-ASCII character, then strip."""
    return strip(F.regexp_replace(c, r"[^\x00-\x7F]", ""))
