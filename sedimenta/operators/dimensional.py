"""Star schema building blocks: surrogate keys, unknown members, lookups, the calendar, drill-across."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sedimenta.functions.calendar import calendar_columns, date_key
from sedimenta.functions.constants import UNKNOWN_KEY, UNKNOWN_TEXT
from sedimenta.operators.joins import lookup_join
from sedimenta.operators.ordering import number_rows

# Bits of a 64-bit key: 20 within a block, 22 for the block within its group, 22 for the group.
BLOCK_BITS = 20
GROUP_BITS = 22


def add_surrogate_key(df: DataFrame, sk: str, order_by: str) -> DataFrame:
    """Numbers the rows 1..N by a key that is unique in ``df``: integers as told here, other types by ``number_rows``.

    Same numbers as row_number() over the whole table, without bringing the table to one task. Keys
    fall into blocks of 2^20 neighbouring values; a row's number is its place in its block plus the
    rows in all blocks before, which come from counts per block. A window over one block sees at
    most 2^20 rows, one over the counts at most 2^22. Nothing is sampled: a repeated task, or a
    rerun on the same rows, gives the same numbers.
    """
    if not isinstance(df.schema[order_by].dataType, T.IntegralType):
        return number_rows(df, sk, order_by)
    block = F.shiftright(F.col(order_by).cast("long"), BLOCK_BITS)
    rows = df.withColumn("_block", F.coalesce(block, F.lit(-1 << 62)))
    blocks = rows.groupBy("_block").agg(F.count(F.lit(1)).alias("_rows"))
    place = F.row_number().over(Window.partitionBy("_block").orderBy(F.col(order_by).asc_nulls_first()))
    numbered = rows.withColumn("_place", place).join(_rows_before(blocks), "_block")
    return numbered.select(*df.columns, (F.col("_before") + F.col("_place")).cast("long").alias(sk))


def _rows_before(blocks: DataFrame) -> DataFrame:
    """(_block, _rows) to (_block, _before), the number of rows in all lower blocks."""

    def running(window):
        earlier = window.rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_rows").over(earlier), F.lit(0))

    blocks = blocks.withColumn("_group", F.shiftright("_block", GROUP_BITS))
    groups = blocks.groupBy("_group").agg(F.sum("_rows").alias("_rows"))
    groups = groups.select("_group", running(Window.orderBy("_group")).alias("_base"))
    blocks = blocks.withColumn("_within", running(Window.partitionBy("_group").orderBy("_block")))
    return blocks.join(groups, "_group").select("_block", (F.col("_base") + F.col("_within")).alias("_before"))


def with_unknown_member(dim: DataFrame, sk: str) -> DataFrame:
    """Adds the row facts without a match point to: key -1, text '(desconhecido)', anything else NULL."""

    def value(name: str, dtype: T.DataType):
        if name == sk:
            return F.lit(UNKNOWN_KEY)
        return F.lit(UNKNOWN_TEXT if isinstance(dtype, T.StringType) else None)

    row = [value(f.name, f.dataType).cast(f.dataType).alias(f.name) for f in dim.schema.fields]
    return dim.sparkSession.range(0, 1, 1, numPartitions=1).select(*row).unionByName(dim)


def known_members(dim: DataFrame, sk: str) -> DataFrame:
    return dim.where(F.col(sk) != UNKNOWN_KEY)


def build_dimension(source: DataFrame, sk: str, key: str, renamed: dict[str, str]) -> DataFrame:
    """A dimension from silver columns (``renamed`` maps source to dimension names, in order)."""
    members = source.select(*[F.col(old).alias(new) for old, new in renamed.items()])
    numbered = add_surrogate_key(members, sk, key)
    return with_unknown_member(numbered.select(sk, *members.columns), sk)


def map_surrogate(
    fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, sk: str, out: str | None = None, **balance
) -> DataFrame:
    """Adds the surrogate key of ``fact_key`` as ``out``, -1 where it is NULL or not in the dimension.

    ``balance`` goes to ``lookup_join``: the dimension's counted size and how to spread hot keys.
    """
    keys = dim.where(F.col(dim_key).isNotNull()).select(dim_key, F.col(sk).alias("_sk"))
    found = lookup_join(fact, keys, fact_key, dim_key, **balance)
    return found.select(*fact.columns, or_unknown(F.col("_sk")).alias(out or sk))


def or_unknown(sk):
    return F.coalesce(sk, F.lit(UNKNOWN_KEY).cast("long"))


def map_date(fact: DataFrame, moment: str, out: str = "sk_tempo") -> DataFrame:
    return fact.withColumn(out, date_key(F.col(moment)))


def date_dimension(moments: list[tuple[DataFrame, str]]) -> DataFrame:
    """One row per day from the first to the last date in the given columns, and the unknown day.

    Built inside the plan from each table's own minimum and maximum. A run over it fails when no
    column holds a date.
    """
    spans = []
    for df, name in moments:
        day = F.to_date(F.col(name))
        spans.append(df.agg(F.min(day).alias("_first"), F.max(day).alias("_last")))
    span = reduce(DataFrame.unionByName, spans).agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"))
    first = F.coalesce(F.col("_first"), F.raise_error(F.lit("no valid dates to build the calendar from")).cast("date"))
    days = span.select(F.explode(F.sequence(first, F.col("_last"), F.expr("interval 1 day"))).alias("data"))
    return with_unknown_member(days.select(*calendar_columns(F.col("data"))), "sk_tempo")


def zero_fill(df: DataFrame, measures: list[str]) -> DataFrame:
    return df.select(
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) if c in measures else F.col(c) for c in df.columns]
    )


def drill_across(dim: DataFrame, key: str, *aggregates: DataFrame) -> DataFrame:
    """Joins aggregates, each already one row per ``key``, to a dimension; missing measures become 0."""
    joined = reduce(lambda left, right: left.join(right, key, "left"), aggregates, dim)
    return zero_fill(joined, [c for a in aggregates for c in a.columns if c != key])


def surrogate_columns(fact: DataFrame) -> list[str]:
    return [c for c in fact.columns if c.startswith("sk_")]


def has_unknown_key(fact: DataFrame):
    return reduce(or_, [F.col(c) == UNKNOWN_KEY for c in surrogate_columns(fact)], F.lit(False))


def unknown_key_counts(facts: dict[str, DataFrame]) -> DataFrame:
    """Per fact: rows, and rows with any surrogate key -1; one pass over each fact."""
    parts = [
        fact.agg(F.count(F.lit(1)).alias("linhas"), F.count_if(has_unknown_key(fact)).alias("fk_desconhecidas")).select(
            F.lit(name).alias("fato"), "linhas", "fk_desconhecidas"
        )
        for name, fact in facts.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def orphan_counts(facts: dict[str, DataFrame], pairs: list[tuple[str, str]]) -> DataFrame:
    """(fato, dim, orfas) for each (fact, key) pair; the keys of one fact are counted in one pass."""
    parts = []
    for name in dict.fromkeys(fact for fact, _ in pairs):
        keys = [sk for fact, sk in pairs if fact == name]
        counts = facts[name].agg(*[F.count_if(F.col(sk) == UNKNOWN_KEY).alias(sk) for sk in keys])
        parts.append(
            counts.unpivot([], keys, "dim", "orfas").select(F.lit(name).alias("fato"), "dim", "orfas")
        )
    return reduce(DataFrame.unionByName, parts)
