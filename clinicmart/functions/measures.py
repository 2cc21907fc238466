"""Flags, rates, rounding and bands."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(condition: Column) -> Column:
    """0/1; an unknown condition counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def rate_decimal(part: Column, whole: Column) -> Column:
    """Percentage as DECIMAL(10,2), rounded half up; null when ``whole`` is 0."""
    share = F.lit(Decimal("100.0")) * part / F.nullif(whole, F.lit(0))
    return share.cast("decimal(10,2)")


def mean_decimal(total: Column, n: Column) -> Column:
    """Mean as DECIMAL(10,2); null when there is nothing to average."""
    return (total.cast("double") / F.nullif(n, F.lit(0))).cast("decimal(10,2)")


def round_half_even(value: Column, digits: int) -> Column:
    """Scale, round to the even neighbour, scale back: array-style rounding of doubles."""
    scale = float(10**digits)
    return F.rint(value.cast("double") * F.lit(scale)) / F.lit(scale)


def round_number(value: Column, digits: int) -> Column:
    """Round the stored binary value of a single number; only an exact tie goes to the even neighbour.

    Scaling can round a value that is no tie onto one. What the product lost, found by
    splitting both factors, then tells on which side the value lies.
    """
    x, scale = value.cast("double"), float(10**digits)
    split = float((1 << 27) + 1)
    wide = x * F.lit(split)
    high = wide - (wide - x)
    low = x - high
    top = scale * split - (scale * split - scale)
    rest = scale - top
    product = x * F.lit(scale)
    lost = ((high * F.lit(top) - product) + high * F.lit(rest) + low * F.lit(top)) + low * F.lit(rest)
    tie = product - F.floor(product) == F.lit(0.5)
    rounded = (
        F.when(tie & (lost > 0), F.ceil(product).cast("double"))
        .when(tie & (lost < 0), F.floor(product).cast("double"))
        .otherwise(F.rint(product))
    )
    return rounded / F.lit(scale)


def rate_number(part: Column, whole: Column, digits: int) -> Column:
    """Percentage as a single number, rounded by ``round_number``; null when ``whole`` is 0."""
    share = part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))
    return round_number(share * F.lit(100.0), digits)


def rate_float(part: Column, whole: Column, digits: int) -> Column:
    """Percentage as double, rounded half to even; null when ``whole`` is 0."""
    share = part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))
    return round_half_even(share * F.lit(100.0), digits)


def band(value: Column, limits: Sequence[tuple[float | None, str]]) -> Column:
    """Label of the first limit the value stays below; the last entry is open."""
    out = None
    for limit, label in limits:
        if limit is None:
            return F.lit(label) if out is None else out.otherwise(F.lit(label))
        test = value < F.lit(limit)
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return out
