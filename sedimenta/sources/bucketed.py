"""Tables kept in buckets of a key, so that joins on it need no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.operators.joins import hot_keys


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> None:
    """Writes ``df`` under ``path`` in ``buckets`` files by a hash of ``key``, sorted by it, as table ``name`` of the
    session's catalog. Rows are dealt like the buckets first, so a bucket is one file."""
    dealt = df.repartition(buckets, key)
    dealt.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)


def bucketed_join(spark: SparkSession, left: str, right: str, key: str) -> DataFrame:
    """Left join of two tables of the session's catalog in as many buckets of ``key``, which is unique in ``right``.

    Buckets meet as they are stored, without an exchange. A key that dominates ``left`` would leave its bucket to one
    task: the hot keys (at most 1,024, from sketches of fixed size) are looked up by broadcast of just their members, in
    a scan that can be split, and taken out of the buckets before the join.
    """
    rows, members = spark.table(left), spark.table(right)
    hot = F.broadcast(hot_keys(rows, key).withColumnRenamed("_hot", key))
    cold = rows.join(hot, key, "left_anti").join(members, key, "left")
    settled = F.broadcast(members.join(hot, key, "left_semi"))
    often = rows.join(hot, key, "left_semi").join(settled, key, "left")
    return cold.unionByName(often)
