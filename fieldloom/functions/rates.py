"""Response variables as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column, strict: bool = False) -> Column:
    """``part / whole`` as double; a zero ``whole`` gives NULL, or an error when strict."""
    value = F.try_divide(part.cast("double"), whole.cast("double"))
    if not strict:
        return value
    undefined = part.isNotNull() & (whole == 0)
    return F.when(undefined, F.raise_error(F.lit("division by zero in a response variable"))).otherwise(value)


def exact_sum(value: Column) -> Column:
    """Sum as a decimal of twelve places, the same whatever the order of the rows.

    Means that are rounded for a comparison must not differ in their last bit
    between two runs, nor fall below a tie.
    """
    return F.sum(value.cast("decimal(28,12)"))


def exact_mean(value: Column) -> Column:
    """Average of the values as decimals of twelve places."""
    return F.avg(value.cast("decimal(28,12)")).cast("double")


def mean_where(value: Column, condition: Column) -> Column:
    """Exact average of the values for which the condition holds."""
    return exact_mean(F.when(condition, value))


def share_of_years(first: Column, last: Column, sampled: Column) -> Column:
    """Sampled years as a percentage of the years spanned."""
    return 100.0 * sampled / (last - first + 1)
