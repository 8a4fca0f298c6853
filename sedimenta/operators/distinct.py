"""Exact distinct counts that roll up: sets of dense integer keys, stored once and merged for any coarser grain.

A set is kept in containers of 32,768 neighbouring keys: as the positions in it while they are few, as a bitmap of fixed
size beyond that. Containers of the same range are merged by OR, so streamer, month, platform and total are answered from
one stored table, without the fact and without adding up overlapping counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A bitmap has 4,096 bytes, a position two.
FEW = 2048


def member_sets(df: DataFrame, member: str, *by: str) -> DataFrame:
    """``by``, ``bucket`` and either ``positions`` or ``bitmap``: who occurs in each group. ``member`` is a surrogate key
    from 1 on; NULL and the unknown member are nobody. Rows are reduced to distinct ones before their shuffle."""
    key = F.col(member).cast("long")
    seen = df.where(key > 0).select(
        *by, F.bitmap_bucket_number(key).alias("bucket"), F.bitmap_bit_position(key).alias("_position")
    )
    return _packed(_gathered(seen.distinct(), *by), *by)


def merged_sets(sets: DataFrame, *by: str) -> DataFrame:
    """``by``, ``bucket`` and either ``positions`` or ``bitmap``: the sets of finer groups as one. Positions move as such;
    they become a bitmap where many of a container's have come together, or meet one."""
    few = sets.where(F.col("positions").isNotNull()).select(
        *by, "bucket", F.explode(F.col("positions").cast("array<bigint>")).alias("_position")
    )
    many = sets.where(F.col("bitmap").isNotNull()).groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    sparse = _gathered(few.distinct(), *by).withColumn("bitmap", F.lit(None).cast("binary"))
    dense = many.select(*by, "bucket", F.lit(None).cast("array<smallint>").alias("positions"), "bitmap")
    # At most one row of either form a container.
    both = sparse.unionByName(dense).groupBy(*by, "bucket")
    return _packed(both.agg(F.max("positions").alias("positions"), F.max("bitmap").alias("bitmap")), *by)


def _gathered(seen: DataFrame, *by: str) -> DataFrame:
    """Distinct positions as one array a container."""
    return seen.groupBy(*by, "bucket").agg(F.collect_list(F.col("_position").cast("smallint")).alias("positions"))


def _packed(sets: DataFrame, *by: str) -> DataFrame:
    """Containers with few positions as they are, all others as one bitmap each. Bitmaps are made for those others alone:
    one takes 4 KB, however few its members."""
    mixed = sets if "bitmap" in sets.columns else sets.withColumn("bitmap", F.lit(None).cast("binary"))
    few = F.col("bitmap").isNull() & (F.size("positions") <= FEW)
    rest = mixed.where(~few)
    position = F.explode(F.col("positions").cast("array<bigint>")).alias("_position")
    made = rest.select(*by, "bucket", position).groupBy(*by, "bucket").agg(F.bitmap_construct_agg("_position").alias("bitmap"))
    given = rest.where(F.col("bitmap").isNotNull()).select(*by, "bucket", "bitmap")
    whole = made.unionByName(given).groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    sparse = mixed.where(few).select(*by, "bucket", F.array_sort("positions").alias("positions"), "bitmap")
    return sparse.unionByName(whole.select(*by, "bucket", F.lit(None).cast("array<smallint>").alias("positions"), "bitmap"))


def set_sizes(sets: DataFrame, out: str, *by: str) -> DataFrame:
    """Members of each group of ``by``, which the sets' own groups do not overlap (theirs, or merged before)."""
    size = F.bitmap_count("bitmap")
    if "positions" in sets.columns:
        size = F.coalesce(F.when(F.col("positions").isNotNull(), F.size("positions").cast("long")), size)
    return sets.groupBy(*by).agg(F.coalesce(F.sum(size), F.lit(0)).alias(out))
