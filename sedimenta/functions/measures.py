"""Guarded arithmetic for measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom, NULL where bottom is zero or NULL."""
    return top / F.nullif(bottom, F.lit(0))


def percent_change(now: Column, before: Column, digits: int = 2) -> Column:
    """Change from ``before`` to ``now`` in percent, NULL without a previous value or with a zero one.

    The division comes last: decimals keep only some digits of a quotient.
    """
    return F.round(ratio((now - before) * 100, before), digits)


def minutes_between(start: Column, end: Column, digits: int = 2) -> Column:
    seconds = F.unix_timestamp(end) - F.unix_timestamp(start)
    return F.round((seconds / F.lit(60.0)).cast("double"), digits)


def exact_sum(measure: str, digits: int = 2) -> Column:
    """The sum of a DOUBLE column of ``digits`` decimals, as a decimal: the same in whatever order rows are added."""
    return F.sum(F.col(measure).cast(f"decimal(18,{digits})"))


def hours(minutes: Column, digits: int = 1) -> Column:
    return F.round(minutes / F.lit(60), digits).cast("double")
