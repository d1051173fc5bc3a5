"""Sums, division and rounding with fixed null, NaN and tie rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# From this magnitude on every double is a whole number, so rounding has nothing to do.
WHOLE_DOUBLES_FROM = 2.0**52


def sum_or_zero(c: Column, where: Column | None = None) -> Column:
    """Sum that is 0 when there is nothing to add; nulls are skipped, NaN carries through.

    ``where`` restricts the rows, so several restricted sums fit in one ``agg``. A row whose
    condition is null is left out, as a filter would leave it out.
    """
    term = c if where is None else F.when(where, c)
    return F.coalesce(F.sum(term), F.lit(0))


def divide_ieee(a: Column, b: Column) -> Column:
    """``a / b`` as doubles, where a zero divisor gives infinity or NaN instead of an error.

    A zero divisor of negative sign turns the infinity round, as in IEEE 754.
    """
    a, b = a.cast("double"), b.cast("double")
    negative_zero = b.cast("string").startswith("-")  # asked for zero divisors only
    over_zero = (
        F.when(F.isnan(a) | (a == 0), F.lit(float("nan")))
        .when((a > 0) != negative_zero, F.lit(float("inf")))
        .when(a.isNotNull(), F.lit(float("-inf")))
    )
    return F.when(b == 0, over_zero).otherwise(F.try_divide(a, b))


def ratio_above(a: Column, b: Column, threshold: float) -> Column:
    """``a / b > threshold``; infinity and NaN count as above, a null on either side is null."""
    return divide_ieee(a, b) > threshold


def round_half_even(c: Column, digits: int) -> Column:
    """Round a double to ``digits`` places, ties on the binary value going to the even digit."""
    x = c.cast("double")
    scale = F.lit(10.0**digits)
    return F.when(F.abs(x) < WHOLE_DOUBLES_FROM, F.rint(x * scale) / scale).otherwise(x)
