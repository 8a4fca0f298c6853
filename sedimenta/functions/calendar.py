"""Day keys and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sedimenta.functions.constants import UNKNOWN_KEY


def day_number(day: Column) -> Column:
    """A date as the integer yyyyMMdd, from arithmetic alone so that it stays in generated code."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def date_key(moment: Column) -> Column:
    """yyyyMMdd of a date or timestamp, -1 where it is NULL."""
    return F.coalesce(day_number(F.to_date(moment)), F.lit(UNKNOWN_KEY)).cast("int")


def months_of_key(key: Column) -> list[Column]:
    """Year and month (``ano``, ``mes``) read back from a yyyyMMdd key, NULL for the unknown day.

    The key says all a monthly total needs, so a fact does not have to meet the calendar for it.
    """
    known = F.when(key != UNKNOWN_KEY, key)
    return [F.floor(known / 10000).cast("int").alias("ano"), (F.floor(known / 100) % 100).cast("int").alias("mes")]


def month_name(day: Column) -> Column:
    return F.date_format(day, "MMMM")


def calendar_columns(day: Column) -> list[Column]:
    """The attributes of one calendar day; days of the week run from 1 (Sunday) to 7 (Saturday)."""
    weekday = F.dayofweek(day)
    return [
        day_number(day).cast("int").alias("sk_tempo"),
        day.alias("data"),
        F.year(day).alias("ano"),
        F.quarter(day).alias("trimestre"),
        F.month(day).alias("mes"),
        month_name(day).alias("nome_mes"),
        F.dayofmonth(day).alias("dia"),
        weekday.alias("dia_semana"),
        F.date_format(day, "EEEE").alias("nome_dia_semana"),
        weekday.isin(1, 7).alias("fim_de_semana"),
    ]
