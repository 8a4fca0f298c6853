"""Relational tables as a source and as the export target, through Spark's JDBC connector."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FETCH_ROWS = 10_000
BATCH_ROWS = 10_000
#: Rows of one range when the number of ranges is taken from the table's size.
RANGE_ROWS = 1_000_000


def qualified(table: str, schema: str | None = "public") -> str:
    """Quoted 'schema.table'; a name that already has a schema keeps it."""
    if "." in table:
        schema, table = table.split(".", 1)
    parts = [schema, table] if schema else [table]
    if any('"' in part or not part for part in parts):
        raise ValueError(f"not a table name: {table!r}")
    return ".".join(f'"{part}"' for part in parts)


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    partition_on: str | None = None,
    partitions: int | None = None,
    schema: str | None = "public",
    **options: str,
) -> DataFrame:
    """A whole table. With ``partition_on`` (an integer key) executors read ranges of it in parallel.

    The database computes the range's ends and, unless ``partitions`` is given, counts the rows, of which a range gets
    about ``RANGE_ROWS``; one row comes back. Rows outside or with a NULL key are still read, by the first and last range.
    """
    name = qualified(table, schema)
    reader = spark.read.format("jdbc").options(url=url, fetchsize=FETCH_ROWS, **options)
    if partition_on is None:
        return reader.option("dbtable", name).load()
    counted = ", COUNT(*) AS n" if partitions is None else ""
    ends = f'SELECT MIN("{partition_on}") AS lo, MAX("{partition_on}") AS hi{counted} FROM {name}'
    span = reader.option("query", ends).load().first()
    lo, hi = span[0], span[1]
    if lo is None or lo == hi:
        return reader.option("dbtable", name).load()
    if partitions is None:
        partitions = -(-int(span[2]) // RANGE_ROWS)
    if partitions < 2:
        return reader.option("dbtable", name).load()
    return reader.options(
        dbtable=name,
        partitionColumn=f'"{partition_on}"',
        lowerBound=int(lo),
        upperBound=int(hi) + 1,
        numPartitions=partitions,
    ).load()


def extract_tables(
    spark: SparkSession,
    url: str,
    keys: dict[str, str],
    partitions: int | None = None,
    schema: str | None = "public",
    **options: str,
) -> dict[str, DataFrame]:
    """One lazy DataFrame per table; ``keys`` maps table names to the integer key to split the read on.

    The connector resolves each table's columns up front, so a missing table fails before any rows move.
    """
    return {
        table: read_jdbc_table(spark, url, table, key, partitions, schema, **options) for table, key in keys.items()
    }


def export_jdbc(df: DataFrame, url: str, table: str, connections: int = 8, **options: str) -> None:
    """Replaces the rows of ``table``, keeping its definition, over at most ``connections`` connections."""
    (
        df.write.format("jdbc")
        .options(url=url, dbtable=table, truncate="true", batchsize=BATCH_ROWS, numPartitions=connections, **options)
        .mode("overwrite")
        .save()
    )
