"""Sharding by jump consistent hashing, in column expressions.

A row's shard follows from its key and the number of shards alone: no ring and no table. With one shard more, a key
either stays or goes to the new shard, and only the new shard's fair part goes.

The generator's 64-bit products are made of 32-bit halves, which neither overflow nor depend on the session's
arithmetic mode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sedimenta.llm.store import stored, without

SHARDS = 16
#: Parts of a shard that are numbered on their own, and copies of one row that are numbered as one chunk.
CELLS = 4096
CHUNK = 1 << 16
# The method's multiplier, 2862933555777941757, as halves.
_HIGH, _LOW = divmod(2862933555777941757, 1 << 32)
_HALF = (1 << 32) - 1


def _step(high: Column, low: Column) -> tuple[Column, Column]:
    """The generator's next state: (state * multiplier + 1) modulo 2^64, as halves."""
    a, b = F.shiftright(low, 16) * _LOW, low.bitwiseAND(0xFFFF) * _LOW
    small = b + F.shiftleft(a.bitwiseAND(0xFFFF), 16) + 1
    carried = F.shiftright(small, 32) + F.shiftright(a, 16)
    cross = F.shiftleft((F.shiftright(high, 16) * _LOW).bitwiseAND(0xFFFF), 16) + high.bitwiseAND(0xFFFF) * _LOW
    return (carried + cross.bitwiseAND(_HALF) + (low * _HIGH).bitwiseAND(_HALF)).bitwiseAND(_HALF), small.bitwiseAND(_HALF)


def _halves(key: Column) -> tuple[Column, Column]:
    return F.shiftrightunsigned(key, 32).bitwiseAND(_HALF), key.bitwiseAND(_HALF)


def jump(key: Column, shards: int) -> Column:
    """The shard of a long key, from 0 to ``shards`` - 1; NULL counts as key 0.

    The shard moves on while the next jump still lands below the number of shards, which it does at most that often.
    """
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    high, low = _halves(key)
    none = F.lit(-1).cast("long")

    def move(state, _):
        high, low = _step(state["high"], state["low"])
        # The next jump, from the state's upper 31 bits; a double holds it exactly as the method asks.
        reach = (state["next"] + 1).cast("double") * (F.lit(2.0**31) / (F.shiftright(high, 1) + 1).cast("double"))
        return F.when(
            state["next"] < shards,
            F.struct(
                state["next"].alias("shard"),
                F.floor(reach).cast("long").alias("next"),
                high.alias("high"),
                low.alias("low"),
            ),
        ).otherwise(state)

    start = F.struct(none.alias("shard"), F.lit(0).cast("long").alias("next"), high.alias("high"), low.alias("low"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, move, lambda state: state["shard"].cast("int"))


def cell(key: Column, crc: Column, size: Column, cells: int) -> Column:
    """A part of a shard, from the generator's first state and the content: even for keys with any regular pattern, and
    for one key with many texts."""
    high, _ = _step(*_halves(F.coalesce(key.cast("long"), F.lit(0).cast("long"))))
    return ((F.shiftright(high, 1) + crc + size) % cells).cast("int")


def assign(df: DataFrame, key: str = "doc_id", shards: int = SHARDS, into: str = "shard") -> DataFrame:
    """``df`` with each row's shard; a map without a shuffle. A column named like ``into`` is replaced."""
    return without(df, into).withColumn(into, jump(F.col(key), shards))


def placed(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS, cells: int = CELLS
) -> DataFrame:
    """One row per document: ``key``, ``size`` (bytes and 1), ``text_crc32``, ``shard``, ``grown_shard`` (with one shard
    more) and ``slot``, gapless from 0 in each shard.

    Slots follow cell, key, checksum and size. Rows that are equal in these are counted before the shuffle and numbered
    in chunks, and each cell is numbered on its own and shifted by the cells before it, so neither a hot key nor a shard
    is one task's work. A NULL text has size 1 and the checksum of no bytes, 0; a NULL key is placed like 0 and comes
    first; repeated rows each have a slot; extra columns play no part.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("key"),
        (F.octet_length(content).cast("long") + 1).alias("size"),
        F.crc32(content.cast("binary")).alias("crc"),
    )
    copies = rows.groupBy("key", "size", "crc").agg(F.count(F.lit(1)).alias("copies"))
    counted = stored(
        copies.select(
            "*",
            jump(F.col("key"), shards).alias("shard"),
            jump(F.col("key"), shards + 1).alias("grown_shard"),
            cell(F.col("key"), F.col("crc"), F.col("size"), cells).alias("cell"),
        ),
        "shards",
    )
    # At most shards times cells rows, from counts made before the shuffle.
    totals = counted.groupBy("shard", "cell").agg(F.sum("copies").alias("rows"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select("shard", "cell", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("shift"))
    order = ["key", "crc", "size"]
    within = Window.partitionBy("shard", "cell").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("copies").over(within), F.lit(0))
    numbered = counted.withColumn("first", first).join(shifts, ["shard", "cell"])
    chunks = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(CHUNK).cast("long")))
    each = F.explode(F.sequence("chunk", F.least(F.col("chunk") + CHUNK, F.col("copies")) - 1))
    return (
        numbered.withColumn("chunk", chunks)
        .withColumn("nth", each)
        .select(
            F.col("key").alias(key),
            "size",
            F.col("crc").alias("text_crc32"),
            "shard",
            (F.col("shift") + F.col("first") + F.col("nth")).alias("slot"),
            "grown_shard",
        )
    )
