"""Numbering rows by keys of any type, without a sample and without a window over the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

# Rows that may share a prefix before it is made longer, and by how many characters (a byte has two).
MOST = 1 << 20
STEP = 2


def _ordered_text(name: str, kind: T.DataType) -> Column:
    """Text that sorts like the values, NULL first, and of which none is the beginning of another's."""
    col = F.col(name)
    if isinstance(kind, T.StringType):
        text = F.concat(F.hex(col), F.lit(" "))  # a blank comes before all digits, so a prefix before what it begins
    elif isinstance(kind, (T.IntegralType, T.DateType)):
        number = F.unix_date(col) if isinstance(kind, T.DateType) else col
        # With the sign bit turned, negative numbers come first.
        text = F.lpad(F.hex(number.cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    else:
        raise TypeError(f"{name}: rows cannot be numbered by {kind.simpleString()}")
    return F.when(col.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), text))


def number_rows(df: DataFrame, out: str, *order_by: str, most: int | None = None) -> DataFrame:
    """``df`` with ``out``, 1..N in the order of ``order_by`` (text by its bytes, integers and dates; NULL first).

    A histogram over prefixes of the ordered text tells how many rows come before each prefix; a prefix with more than
    ``most`` rows is made longer, past what all its rows have in common, until no such prefix is left that can be. A row's
    number is its place among the rows of its prefix plus the rows before. Rows that are equal in all of ``order_by``
    share a prefix and are numbered in any order, so the last column should be unique. Each round is one job, about as
    many as the logarithm of the rows to the base of the bytes in use.
    """
    most = most or MOST
    kinds = {f.name: f.dataType for f in df.schema.fields}
    key, block = "_order", "_block"
    rows = df.withColumn(key, F.concat(*[_ordered_text(name, kinds[name]) for name in order_by]))
    rows = rows.withColumn(block, F.substring(key, 1, 1 + STEP))

    def histogram(part: DataFrame) -> DataFrame:
        return part.groupBy(block).agg(F.count(F.lit(1)).alias("_rows"), F.min(key).alias("_low"), F.max(key).alias("_high"))

    def full(counts: DataFrame) -> DataFrame:
        """Prefixes to be made longer, and to which length."""
        differ = F.length(F.regexp_extract(F.concat_ws("\n", "_low", "_high"), "^(.*).*\n\\1", 1))
        found = counts.where((F.col("_rows") > most) & (F.col("_low") != F.col("_high")))
        return found.select(F.col(block).alias("_full"), (differ + STEP).alias("_length"))

    counts = histogram(rows)
    while True:
        longer = full(counts)
        if longer.isEmpty():
            break
        refined = F.when(F.col("_full").isNotNull(), F.expr(f"substring({key}, 1, _length)")).otherwise(F.col(block))
        rows = rows.join(longer, F.col(block) == F.col("_full"), "left").withColumn(block, refined).drop("_full", "_length")
        counts = histogram(rows)
    earlier = Window.orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(block, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy(block).orderBy(key))
    numbered = rows.withColumn("_place", place).join(before, block)
    return numbered.select(*df.columns, (F.col("_before") + F.col("_place")).cast("long").alias(out))
