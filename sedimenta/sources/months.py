"""Facts kept by month: one folder a month, of which a rerun replaces just those that changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.sources.tables import delete_path

MONTH = "mes_ref"
UNDATED = -1


def month_of_key(day: Column) -> Column:
    """20240131 to 202401; the unknown day, -1, to -1."""
    return F.when(day > 0, F.floor(day / 100)).otherwise(F.lit(UNDATED)).cast("int")


def write_months(fact: DataFrame, path: str, day: str = "sk_tempo", months: Sequence[int] | None = None) -> None:
    """Writes ``fact`` under ``path`` in a folder per month of the date key ``day``.

    Without ``months`` the table is replaced as a whole. With them only these months' rows are taken and only their
    folders replaced (one that has no rows any more goes); the files of all others stay as they are. Rows are dealt by
    month into files of about the size that adaptive execution aims at: a large month is split over tasks, small months
    share one, so there are no tiny files for each task and month.
    """
    spark = fact.sparkSession
    rows = fact.withColumn(MONTH, month_of_key(F.col(day)))
    writer = lambda df: df.hint("rebalance", MONTH).write.mode("overwrite").partitionBy(MONTH)
    if months is None:
        writer(rows).option("partitionOverwriteMode", "static").parquet(path)
        return
    wanted = sorted(set(months))
    chosen = rows.where(F.col(MONTH).isin(*wanted))
    writer(chosen).option("partitionOverwriteMode", "dynamic").parquet(path)
    # A dynamic overwrite leaves a month without new rows alone.
    there = {row[0] for row in chosen.select(MONTH).distinct().collect()}  # at most ``months``
    for month in set(wanted) - there:
        delete_path(spark, f"{path.rstrip('/')}/{MONTH}={month}")


def read_months(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """The rows from month ``first`` to month ``last`` (YYYYMM, both included; -1: without a date); other months' files
    are not listed as input."""
    rows = spark.read.parquet(path)
    if first is not None:
        rows = rows.where(F.col(MONTH) >= first)
    if last is not None:
        rows = rows.where(F.col(MONTH) <= last)
    return rows
