"""Column arithmetic with the missing-value rules of the domain."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(top: Column, bottom: Column) -> Column:
    """NULL where the bottom is zero or missing."""
    return top / F.nullif(bottom.cast("double"), F.lit(0.0))


def decimal_sum(value: Column) -> Column:
    """A sum of doubles as a decimal of twelve digits after the point. Such sums add up exactly."""
    return F.sum(value.cast("decimal(38,12)"))


def exact_sum(value: Column) -> Column:
    """A sum of doubles that does not depend on the order of the rows: terms count as decimals of
    twelve digits after the point."""
    return decimal_sum(value).cast("double")


def exact_avg(value: Column) -> Column:
    return ratio(exact_sum(value), F.count(value))


def unit_clip(value: Column) -> Column:
    """Into [0, 1]; a missing value stays missing, although least/greatest alone would fill it."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0)))


def cap_at_one(value: Column) -> Column:
    return F.when(value.isNotNull(), F.least(value, F.lit(1.0)))


def finite_sql(column: str) -> str:
    """SQL text of a number as double; NaN and infinities as NULL, so that statistics and learners
    see them as missing."""
    value = f"double({column})"
    return f"if(isnan({value}) OR abs({value}) = double('infinity'), NULL, {value})"


def blank_minus(left: Column, right: Column) -> Column:
    """Difference in which one missing side counts as zero and two missing sides stay missing."""
    zero = F.lit(0)
    both = left.isNull() & right.isNull()
    return F.when(~both, F.coalesce(left, zero) - F.coalesce(right, zero))


def expected_loss(pd: Column, lgd: Column, ead: Column) -> Column:
    return pd * lgd * ead
