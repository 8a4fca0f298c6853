"""Provenance columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EXTRACTION_DATE = "_extraction_date"
SOURCE_FILE = "_source_file"
INGESTED_AT = "_ingestion_timestamp"
SILVER_AT = "_silver_processed_at"
GOLD_AT = "_gold_processed_at"

# What a reader of each layer's tables leaves out.
AUDIT_COLUMNS = {
    "bronze": (SOURCE_FILE, INGESTED_AT),
    "silver": (SILVER_AT, EXTRACTION_DATE),
    "gold": (GOLD_AT,),
}


def stamp_bronze(df: DataFrame, extraction_date: str) -> DataFrame:
    """Extraction date, source file and load time; ``df`` has to come straight from a file scan."""
    return df.select(
        "*",
        F.lit(extraction_date).alias(EXTRACTION_DATE),
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.current_timestamp().alias(INGESTED_AT),
    )


def stamp(df: DataFrame, layer: str) -> DataFrame:
    return df.withColumn(SILVER_AT if layer == "silver" else GOLD_AT, F.current_timestamp())


def without_audit(df: DataFrame, layer: str) -> DataFrame:
    return df.drop(*AUDIT_COLUMNS[layer])
