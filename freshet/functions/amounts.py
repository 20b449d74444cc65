"""Sums, means and deviations that do not depend on the order of addition.

Doubles added in another order differ in their last bits, so a task that is
run again, or another cluster size, would change a feature value. Amounts are
money, so they are added as whole units of ``10 ** -scale``, which is exact and
as cheap as adding doubles. A value that is no whole number of units stops the
query instead of being rounded, and so does a sum beyond 64 bits.
``scale=None`` turns all of this off and works on plain doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def units(column: Column | str, scale: int | None) -> Column:
    """The amount in whole units; fails on a value with more digits."""
    value = (F.col(column) if isinstance(column, str) else column).cast("double")
    if scale is None:
        return value
    factor = float(10**scale)
    whole = F.rint(value * factor).cast("bigint")
    return F.when(value.isNull() | (whole.cast("double") / factor == value), whole).otherwise(
        F.raise_error(F.concat(F.lit(f"amount does not fit {scale} decimals: "), value.cast("string")))
    )


def amount(total: Column, scale: int | None) -> Column:
    """A sum of units as a double."""
    return total.cast("double") if scale is None else total.cast("double") / float(10**scale)


def rounded_amount(total: Column, digits: int, scale: int | None) -> Column:
    if scale is None:
        return F.round(total, digits)
    if scale <= digits:
        return amount(total, scale)
    return F.round(total.cast("decimal(20,0)"), digits - scale).cast("double") / float(10**scale)


def mean(total: Column, n: Column, scale: int | None) -> Column:
    """Double mean, NULL for an empty group."""
    return F.try_divide(amount(total, scale), n.cast("double"))


def rounded_mean(total: Column, n: Column, digits: int, scale: int | None) -> Column:
    """Mean rounded half up; in decimals, so a tie is a tie."""
    if scale is None:
        return F.round(mean(total, n, scale), digits)
    quotient = F.try_divide(total.cast("decimal(20,0)"), n.cast("decimal(13,0)"))
    return F.round(quotient, digits - scale).cast("double") / float(10**scale)


def square_sum(value: Column, scale: int | None) -> Column:
    """Aggregate: sum of squared units."""
    if scale is None:
        return F.sum(value * value)
    wide = value.cast("decimal(19,0)")
    return F.sum(wide * wide)


def sample_std(n: Column, total: Column, squares: Column, scale: int | None) -> Column:
    """Sample deviation from count, sum and sum of squares; NULL below two rows.

    With a scale the numerator ``n * squares - total ** 2`` is exact as long
    as it fits 38 digits, so equal amounts give exactly zero; beyond that it
    is taken in doubles.
    """
    wide = total.cast("double")
    numerator = F.greatest(n.cast("double") * squares.cast("double") - wide * wide, F.lit(0.0))
    if scale is not None:
        t = total.try_cast("decimal(18,0)")
        exact = n.try_cast("decimal(12,0)") * squares.try_cast("decimal(25,0)") - t * t
        numerator = F.coalesce(exact.cast("double"), numerator) / float(10 ** (2 * scale))
    pairs = n.cast("double") * (n.cast("double") - 1.0)
    return F.when(n > 1, F.sqrt(numerator / pairs))
