"""Landing files: one CSV folder per table under ``extraction_date=<day>/``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.operators.quality import as_bronze
from sedimenta.sources.tables import mark_path, path_exists

DEFAULT_SCHEMA = "public"
# Marks a folder of which the values are escaped.
ESCAPED = "_escaped"
# Of files written here: they take less than half the room. Compressed files are not split, so none gets more rows than
# one task should have. The level is the fastest, since the next one but a few saves little more.
COMPRESSION = "gzip"
FILE_ROWS = 1_000_000
# Types of which no value has a backslash or a line break as text.
PLAIN = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def landing_path(root: str, table: str, day: str, schema: str = DEFAULT_SCHEMA) -> str:
    return f"{root.rstrip('/')}/extraction_date={day}/{schema}__{table}"


def write_landing(
    df: DataFrame, root: str, table: str, day: str, schema: str = DEFAULT_SCHEMA, compression: str = COMPRESSION
) -> str:
    """All columns as text with a header; quotes inside a value are doubled, NULL and '' are both empty.

    Line breaks inside values are written as backslash and letter (and a backslash as backslash and s), so that a row is
    a line; a mark in the folder tells ``read_landing_csv`` to turn them back. Files are ``.csv.gz``, of at most
    ``FILE_ROWS`` rows; with ``compression`` "none" they are ``.csv``, for others that read them. A rerun for the same day replaces the folder. Readers see it only once the write is committed.
    """
    path = landing_path(root, table, day, schema)
    as_bronze(df).select(*[landed_text(field) for field in df.schema.fields]).write.mode("overwrite").options(
        **{"maxRecordsPerFile": FILE_ROWS, "zlib.compress.level": "BEST_SPEED"}
    ).csv(
        path,
        compression=compression,
        header=True,
        escape='"',
        emptyValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    mark_path(df.sparkSession, f"{path}/{ESCAPED}")
    return path


def landed_text(field: T.StructField) -> Column:
    """A column's text as landing files hold it: escaped unless its type leaves nothing to escape."""
    text = F.col(field.name)
    return text if isinstance(field.dataType, PLAIN) else escaped(text).alias(field.name)


def escaped(text: Column) -> Column:
    """Line breaks and backslashes as a backslash and a letter."""
    return F.replace(F.replace(F.replace(text, *_pair("\\", "\\s")), *_pair("\n", "\\n")), *_pair("\r", "\\r"))


def unescaped(text: Column) -> Column:
    """What ``escaped`` was given: backslashes come last, so none is taken for the beginning of a line break."""
    plain = F.replace(F.replace(F.replace(text, *_pair("\\n", "\n")), *_pair("\\r", "\r")), *_pair("\\s", "\\"))
    return F.when(F.contains(text, F.lit("\\")), plain).otherwise(text)


def _pair(search: str, replacement: str) -> tuple[Column, Column]:
    return F.lit(search), F.lit(replacement)


def landed_path(spark: SparkSession, root: str, table: str, day: str, schema: str = DEFAULT_SCHEMA) -> str:
    """The table's folder, or the single CSV file that another writer left in its place."""
    path = landing_path(root, table, day, schema)
    return next((f"{path}{end}" for end in ("", ".csv", ".csv.gz") if path_exists(spark, f"{path}{end}")), path)


def read_landing_csv(
    spark: SparkSession, path: str | list[str], infer: bool = False, multi_line: bool = False, escapes: bool | None = None
) -> DataFrame:
    """CSV with a header, every column a string, or with types inferred.

    ``escapes`` turns back what ``write_landing`` escaped; by default in the folders that it marked, so files of other
    writers are taken as they are. ``multi_line`` accepts line breaks inside quoted values of theirs, at the price that a
    file can no longer be split between tasks.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if escapes is None:
        marked = [path_exists(spark, f"{one}/{ESCAPED}") for one in paths]
        if any(marked) and not all(marked):
            kinds = [[one for one, own in zip(paths, marked) if own == kind] for kind in (True, False)]
            both = [read_landing_csv(spark, some, infer, multi_line, kind) for some, kind in zip(kinds, (True, False))]
            return both[0].unionByName(both[1])
        escapes = all(marked)
    rows = spark.read.csv(paths, header=True, escape='"', inferSchema=infer, multiLine=multi_line)
    if not escapes:
        return rows
    return rows.select(*[unescaped(rows[name]).alias(name) if kind == "string" else rows[name] for name, kind in rows.dtypes])


def table_name(path):
    """'.../public__streamers/part-0.csv' or '.../public__streamers.csv' to 'streamers'; '.gz' may follow."""
    return F.regexp_extract(path, "/[^/]*?__([^/.]+)(?:/[^/]*)?(?:[.]csv(?:[.]gz)?)?$", 1)


def discover_landing(
    spark: SparkSession, root: str, day: str, tables: list[str] | None = None
) -> DataFrame:
    """(tabela, path, bytes) of the CSV files of one extraction day; lists files without reading them."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.{csv,csv.gz}")
        .option("recursiveFileLookup", "true")
        .load(f"{root.rstrip('/')}/extraction_date={day}")
    )
    found = files.select(table_name(F.col("path")).alias("tabela"), "path", F.col("length").alias("bytes"))
    return found.where(F.col("tabela").isin(*tables)) if tables else found
