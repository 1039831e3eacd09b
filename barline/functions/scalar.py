"""Column helpers shared by all operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """``a / b``, NULL where ``b`` is zero, in ANSI mode too."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def missing(c: Column) -> Column:
    """NULL, or NaN in a floating-point column."""
    return c.isNull() | F.isnan(c)


def clamp(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def symbol_list(text: Column) -> Column:
    """Comma text to an array of trimmed upper-case symbols without blanks."""
    parts = F.transform(F.split(text, ","), lambda s: F.upper(F.trim(s)))
    return F.filter(parts, lambda s: s != "")


def rounded(df, places: dict[str, int]):
    return df.withColumns({c: F.round(c, n) for c, n in places.items()})
