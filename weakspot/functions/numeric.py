"""Numeric, formatting and scoring expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weakspot.functions.text import col

DOUBLE_MAX = 1.7976931348623157e308  # fixed value: largest finite double


def nan_to_null(c) -> Column:
    """NaN is not NULL to ``coalesce``; make it so."""
    c = col(c)
    return F.when(~F.isnan(c), c)


def number_or(c, fill: float) -> Column:
    """Value as a double, ``fill`` where it is no number."""
    return F.coalesce(nan_to_null(col(c).try_cast("double")), F.lit(float(fill)))


def finite(c) -> Column:
    """NULL and NaN to 0, infinities to the largest finite double."""
    c = number_or(c, 0.0)
    return F.greatest(F.least(c, F.lit(DOUBLE_MAX)), F.lit(-DOUBLE_MAX))


def finite_array(c) -> Column:
    """The same for every element of a numeric array.

    Built-in array functions find the rare rows that need it; only those
    pay for a lambda over their elements.
    """
    c = col(c).cast("array<double>")
    inf = F.lit(float("inf"))
    # NULL elements make array_contains NULL when it finds nothing
    gaps = F.coalesce(F.array_contains(c, F.lit(float("nan"))), F.lit(True))
    dirty = gaps | (F.array_max(c) == inf) | (F.array_min(c) == -inf)
    return F.when(dirty, F.transform(c, finite)).otherwise(c)


def is_missing(name: str, dtype: str) -> Column:
    """NULL, or NaN in a floating column."""
    c = F.col(f"`{name}`")
    return c.isNull() | F.isnan(c) if dtype in ("float", "double") else c.isNull()


def round_half_even(c, digits: int) -> Column:
    scale = 10.0 ** digits
    return F.rint(col(c) * scale) / scale


def percent_text(share) -> Column:
    """``12.34%`` with at most two decimals, half to even."""
    return F.concat(round_half_even(col(share) * 100, 2).cast("string"), F.lit("%"))


def ratio_or_zero(top, bottom) -> Column:
    return F.coalesce(F.try_divide(col(top).cast("double"), col(bottom).cast("double")), F.lit(0.0))


def large_enough(c, floor: float) -> Column:
    return (F.abs(col(c)) > floor).cast("int")


def weighted_mean(a, b, w_a: int, w_b: int) -> Column:
    return (col(a) * w_a + col(b) * w_b) / (w_a + w_b)


def argmax_binary(p0, p1) -> Column:
    """Class of the larger probability; a tie goes to class 0."""
    return (col(p1) > col(p0)).cast("int")


def improvement_percent(base, tuned) -> Column:
    """Relative change in percent; NULL when the base is not positive."""
    base = col(base)
    return F.when(base > 0, F.lit(100.0) * (col(tuned) - base) / base)
