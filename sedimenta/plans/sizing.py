"""Shuffle width from the size of the data."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
BYTES_PER_PARTITION = 256 << 20
# Up to so many partitions, one per so many stored bytes: a task then sorts under a million rows and nothing spills.
FINE_BYTES = 16 << 20
FINE_PARTITIONS = 4096
# Most bytes that one task is given of a shuffle or of files. Shuffled rows are about ten times as large in memory.
TASK_BYTES = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20,
    "spark.sql.files.maxPartitionBytes": 32 << 20,
}

# A plan made before any row is read takes the size of files for that of rows, which can be tens of times as large in the
# driver's memory. Above so many bytes a broadcast is left to adaptive execution, which has counted the rows' bytes.
PLANNED_BROADCAST = "spark.sql.autoBroadcastJoinThreshold"
COUNTED_BROADCAST = "spark.sql.adaptive.autoBroadcastJoinThreshold"
PLANNED_BROADCAST_BYTES = 256 << 10
# A broadcast's job waits behind the tasks of the tables made beside it, which is no reason to give up.
BROADCAST_WAIT = "spark.sql.broadcastTimeout"
BROADCAST_SECONDS = 3600


def partitions_for(data_bytes: int) -> int:
    return -(-data_bytes // BYTES_PER_PARTITION)


def fine_partitions_for(data_bytes: int) -> int:
    """A width at which a task's share stays the same as the data grows, to the point where it would mean too many."""
    return max(min(-(-data_bytes // FINE_BYTES), FINE_PARTITIONS), partitions_for(data_bytes))


def setting_bytes(text: str) -> int:
    """A size as Spark's settings have it: '64MB', '8m', '1024', or '-1' for none."""
    number, unit = re.fullmatch(r"(-?\d+)([kmgtp]?)i?b?", text.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def stored_bytes(spark: SparkSession, folder: str) -> int:
    """Bytes of all files under ``folder``, from a listing that reads none of them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.agg(F.sum("length")).first()[0] or 0


def shuffle_width(spark: SparkSession) -> int:
    """Partitions with which this session's shuffles start."""
    return int(spark.conf.get(INITIAL, None) or spark.conf.get("spark.sql.shuffle.partitions"))


def size_shuffles(spark: SparkSession, folder: str) -> None:
    """Makes shuffles of this session start wide enough for the data under ``folder``.

    It only ever widens: adaptive execution merges partitions that turn out small, but cannot start with more than it is
    given. What adaptive execution merges and a scan gives to one task is narrowed likewise (``TASK_BYTES``), and no more
    than ``PLANNED_BROADCAST_BYTES`` of files are broadcast before their rows are counted. It is for sessions that belong
    to the caller, such as a registered query's; library calls use ``kept_shuffles`` around it.
    """
    wanted = fine_partitions_for(stored_bytes(spark, folder))
    if wanted > shuffle_width(spark):
        spark.conf.set(INITIAL, str(wanted))
    for name, most in TASK_BYTES.items():
        if setting_bytes(spark.conf.get(name)) > most:
            spark.conf.set(name, str(most))
    planned = spark.conf.get(PLANNED_BROADCAST)
    if setting_bytes(planned) > PLANNED_BROADCAST_BYTES:
        if spark.conf.get(COUNTED_BROADCAST, None) is None:
            spark.conf.set(COUNTED_BROADCAST, planned)
        spark.conf.set(PLANNED_BROADCAST, str(PLANNED_BROADCAST_BYTES))
    if spark.conf.get(BROADCAST_WAIT, None) is None:
        spark.conf.set(BROADCAST_WAIT, str(BROADCAST_SECONDS))


@contextmanager
def kept_shuffles(spark: SparkSession) -> Iterator[None]:
    """Puts the session's shuffle width, and the other settings of ``size_shuffles``, back at the end."""
    names = (INITIAL, *TASK_BYTES, PLANNED_BROADCAST, COUNTED_BROADCAST, BROADCAST_WAIT)
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
