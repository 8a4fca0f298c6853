"""Layer tables in columnar files. ``fmt`` is 'parquet', or 'delta' where its package is installed."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.operators.audit import without_audit

QUARANTINE = "_quarentena"


def table_path(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name}"


def quarantine_path(root: str, name: str) -> str:
    return table_path(root, "silver", f"{QUARANTINE}/{name}")


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = (), compression: str | None = None
) -> None:
    """Replaces the table, its schema included. ``compression`` of the files is the session's by default.

    Files are written beside the table and take its place once all are there: a write that fails leaves the table as it
    was, and readers see the old one until then. The old one is kept until the next write has succeeded.
    """
    writer = df.write.format(fmt).mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "delta":
        writer.option("overwriteSchema", "true").save(path)
        return
    if compression:
        writer = writer.option("compression", compression)
    fresh = _beside(path, f"_writing-{uuid.uuid4().hex}")
    try:
        writer.save(fresh)
        _take_place(df.sparkSession, fresh, path)
    finally:
        delete_path(df.sparkSession, fresh)


def _beside(path: str, label: str) -> str:
    """A sibling that listings of the layer leave out."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/{label}-{name}"


def _files(spark: SparkSession, *paths: str):
    """The paths' file system, and the paths as it takes them."""
    own = [spark._jvm.org.apache.hadoop.fs.Path(path) for path in paths]
    return own[0].getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), own


def delete_path(spark: SparkSession, path: str) -> None:
    """Removes a folder and what is in it, if it is there."""
    files, (gone,) = _files(spark, path)
    files.delete(gone, True)


def _take_place(spark: SparkSession, fresh: str, path: str) -> None:
    files, (new, current, previous) = _files(spark, fresh, path, _beside(path, "_previous"))
    if files.exists(current):
        files.delete(previous, True)
        if not files.rename(current, previous):
            raise OSError(f"{path} cannot be replaced")
    if not files.rename(new, current):
        files.rename(previous, current)
        raise OSError(f"{path} cannot be written")


def _standing(spark: SparkSession, path: str) -> str:
    """The table's place, or where the one before stands if a replacement was cut short between its two moves."""
    before = _beside(path, "_previous")
    files, (current, previous) = _files(spark, path, before)
    return before if not files.exists(current) and files.exists(previous) else path


def read_table(
    spark: SparkSession, root: str, layer: str, name: str, drop_audit: bool = True, fmt: str = "parquet"
) -> DataFrame:
    path = table_path(root, layer, name)
    df = spark.read.format(fmt).load(path if fmt == "delta" else _standing(spark, path))
    return without_audit(df, layer) if drop_audit else df


def register_star(spark: SparkSession, tables: dict[str, DataFrame], prefix: str = "") -> None:
    """Temporary views, so that SQL can be run on the star and the marts. A ``prefix`` keeps them apart from the
    session's own views."""
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(tabela, linhas) per table, and their sum as TOTAL."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("linhas")).select(F.lit(name).alias("tabela"), "linhas")
        for name, df in tables.items()
    ]
    counts = reduce(DataFrame.unionByName, parts).rollup("tabela").agg(F.sum("linhas").alias("linhas"))
    return counts.withColumn("tabela", F.coalesce("tabela", F.lit("TOTAL")))


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application in which MIN, MAX and COUNT over stored parquet come from the files' footers."""
    session = spark.newSession()
    kept = ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions")
    footers = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}
    for name, value in {**{name: spark.conf.get(name) for name in kept}, **footers}.items():
        session.conf.set(name, value)
    return session


def stored_counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """``row_counts`` of stored parquet tables, from their footers alone."""
    counts = stored_bounds(spark, paths).rollup("tabela").agg(F.sum("linhas").alias("linhas"))
    return counts.withColumn("tabela", F.coalesce("tabela", F.lit("TOTAL")))


def stored_bounds(spark: SparkSession, paths: dict[str, str], *columns: str) -> DataFrame:
    """(tabela, linhas, and ``min_``/``max_`` of number and date columns) of stored parquet tables, from their footers
    alone."""
    session = footer_session(spark)
    # Files without a row group tell no count at all, although a count is never NULL by its type.
    linhas = F.greatest("linhas", F.lit(0)).alias("linhas")
    ends = [f(name).alias(f"{label}_{name}") for name in columns for label, f in (("min", F.min), ("max", F.max))]
    parts = [
        session.read.parquet(_standing(spark, path))
        .agg(F.count(F.lit(1)).alias("linhas"), *ends)
        .select(F.lit(name).alias("tabela"), linhas, *[f"{label}_{c}" for c in columns for label in ("min", "max")])
        for name, path in paths.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def stored_rows(spark: SparkSession, path: str, fmt: str = "parquet") -> int:
    """Rows of one stored table; parquet is not read for it."""
    if fmt != "parquet":
        return spark.read.format(fmt).load(path).count()
    return stored_bounds(spark, {"": path}).first()["linhas"]


def path_exists(spark: SparkSession, path: str) -> bool:
    files, (wanted,) = _files(spark, path)
    return files.exists(wanted)


def mark_path(spark: SparkSession, path: str) -> None:
    """An empty file; names that begin with an underscore are no data to any reader."""
    files, (mark,) = _files(spark, path)
    files.create(mark, True).close()


def folder_digest(spark: SparkSession, *paths: str) -> str | None:
    """What a listing tells of the files under the folders (names, lengths, modification times) as one value; None where
    a folder is missing."""
    if not all(path_exists(spark, path) for path in paths):
        return None
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    told = F.xxhash64("path", "length", F.unix_micros("modificationTime"))
    row = files.agg(F.count(F.lit(1)), F.sum("length"), F.bit_xor(told), F.sum(told.cast("decimal(38,0)"))).first()
    return ":".join(map(str, row))


def table_detail(spark: SparkSession, path: str) -> DataFrame:
    """(arquivos, bytes, modificado) of a stored table, from a file listing alone."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "part-*")
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    return files.agg(
        F.count(F.lit(1)).alias("arquivos"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("modificado")
    )
