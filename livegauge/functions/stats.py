"""Interval and gap arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sample_deviation(variance: Column, n: Column) -> Column:
    """Sample deviation of ``n`` values with population variance ``variance``; NULL below two values."""
    return F.when(n > 1, F.sqrt(variance * n / (n - 1)))


def margin_of_error(deviation: Column, n: Column, z: float) -> Column:
    return deviation / F.sqrt(n.cast("double")) * F.lit(z)


def diff_or_zero(current: Column, previous: Column) -> Column:
    return F.coalesce(current - previous, F.lit(0).cast("bigint"))


def rate_vs_mean(mean: Column, online: Column) -> Column:
    """Relative gap to the mean; NULL at zero viewers."""
    return F.lit(1) - F.try_divide(mean, online)


def rate_vs_upper(upper: Column, online: Column) -> Column:
    """Percent gap to the upper bound, rounded half away from zero; NULL at zero viewers or out of range."""
    percent = (F.lit(1) - F.try_divide(upper, online)) * F.lit(100)
    # Rounded as a decimal: a double a hair under .5 must not round down.
    return F.round(percent.try_cast("decimal(38,10)"), 0).try_cast("int")


def above_bound(upper: Column, online: Column) -> Column:
    return F.when(upper < online, 1).otherwise(0)


def fill_rate(rate: Column, missing: int) -> Column:
    return F.coalesce(rate, F.lit(missing)).cast("int")


def position_in_interval(online: Column, lower: Column, upper: Column) -> Column:
    """``above``, ``inside`` or ``below`` the interval; NULL without one."""
    return (
        F.when(online > upper, "above")
        .when(online < lower, "below")
        .when(online.between(lower, upper), "inside")
    )
