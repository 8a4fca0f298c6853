"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import shutil
import tempfile
import threading
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from sedimenta.plans.lake import shared_folder


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder, one per call."""
    return f"{shared_folder(spark)}/sedimenta-llm-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once and read back: cuts the lineage, and a lost executor costs tasks of one write."""
    path = fresh_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns of these names in any case: operators replace a column that has their output's name."""
    taken = {name.lower() for name in names}
    return df.drop(*[name for name in df.columns if name.lower() in taken])


def unused(df: DataFrame, label: str) -> str:
    """A column name made from ``label`` that ``df`` does not have in any case."""
    taken = {name.lower() for name in df.columns}
    while label.lower() in taken:
        label += "_"
    return label


_sent: set[str] = set()
_sending = threading.Lock()


def send_package(spark: SparkSession) -> None:
    """Sends this package to the application's Python workers, once: they need not have it installed."""
    context = spark.sparkContext
    with _sending:
        if context.applicationId not in _sent:
            package = Path(__file__).resolve().parents[1]
            archive = shutil.make_archive(
                f"{tempfile.mkdtemp(prefix='sedimenta-')}/{package.name}", "zip", package.parent, package.name
            )
            context.addPyFile(archive)
            _sent.add(context.applicationId)
