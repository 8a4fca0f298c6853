"""Text to typed values. Bad input gives NULL, never an error, under ANSI mode as well."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Accepted spellings of booleans.
TRUE_WORDS = ("true", "t", "1", "yes", "y")
FALSE_WORDS = ("false", "f", "0", "no", "n")


def clean_text(col: Column) -> Column:
    """Trimmed text; blank becomes NULL."""
    return F.nullif(F.trim(col), F.lit(""))


def clean_code(col: Column) -> Column:
    """Trimmed, lower-case text for columns with a list of allowed values."""
    return F.lower(clean_text(col))


def parse_boolean(col: Column) -> Column:
    word = F.lower(F.trim(col))
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))


def parse_integer(col: Column, dtype: T.DataType) -> Column:
    """Whole part of a decimal text ('12.9' is 12, '-1.9' is -1). Exponents and overflow give NULL.

    Plain integers are read directly; only what that does not accept goes the longer way.
    """
    text = F.trim(col)
    with_fraction = F.when(~text.rlike("[eE]"), text.try_cast("decimal(38,10)").try_cast(dtype))
    return F.coalesce(text.try_cast(dtype), with_fraction)


def parse_as(col: Column, dtype: T.DataType, coded: bool = False) -> Column:
    """Read a text column as ``dtype``; ``coded`` text is lower-cased too."""
    if isinstance(dtype, T.StringType):
        return clean_code(col) if coded else clean_text(col)
    if isinstance(dtype, T.BooleanType):
        return parse_boolean(col)
    if isinstance(dtype, T.IntegralType):
        return parse_integer(col, dtype)
    return F.trim(col).try_cast(dtype)


def as_text(col: Column, dtype: T.DataType) -> Column:
    """How a value is written to the landing files: 'True'/'False', 'yyyy-MM-dd HH:mm:ss', plain numbers."""
    if isinstance(dtype, T.BooleanType):
        return F.initcap(col.cast("string"))
    return col.cast("string")
