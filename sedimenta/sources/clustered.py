"""Files clustered on two keys: rows near in either lie near each other, so scans for one value of either skip the rest."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 31


def interleaved(a: Column, b: Column, bits: int = BITS) -> Column:
    """The bits of two numbers from 0 to 2^``bits`` - 1 in turn (Morton order); larger ones count as the largest, NULL and
    smaller ones as 0."""

    def spread(value: Column, shift: int) -> Column:
        value = F.least(F.greatest(F.coalesce(value.cast("long"), F.lit(0)), F.lit(0)), F.lit((1 << bits) - 1))
        # Halves are moved apart step by step until a zero follows each bit.
        for step, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            value = value.bitwiseOR(F.shiftleft(value, step)).bitwiseAND(F.lit(mask))
        return F.shiftleft(value, shift)

    return spread(a, 1).bitwiseOR(spread(b, 0))


def rank_bits(df: DataFrame, *columns: str) -> dict[str, int]:
    """Bits that the largest value of each column takes."""
    largest = df.agg(*[F.max(name).alias(name) for name in columns]).first()
    return {name: int(largest[name] or 0).bit_length() for name in columns}


def write_clustered(
    df: DataFrame, path: str, a: str, b: str, files: int, group_bytes: int = 128 << 20, b_start: int = 0
) -> None:
    """Writes ``df`` in ``files`` files along the Morton order of ``a`` and ``b`` (numbers; ``b`` counted from
    ``b_start``), each sorted by it, so that footers bound both keys closely.

    The narrower key is scaled to the width of the wider one: otherwise its bits would only sort within the other's.
    """
    widths = rank_bits(df.select(F.col(a).cast("long").alias(a), (F.col(b).cast("long") - b_start).alias(b)), a, b)
    most = max(max(widths.values()), 1)
    scaled = [
        F.shiftleft(value, most - widths[name])
        for name, value in ((a, F.col(a).cast("long")), (b, F.col(b).cast("long") - b_start))
    ]
    ordered = df.withColumn("_place", interleaved(*scaled, bits=max(most, 1)))
    ranged = ordered.repartitionByRange(files, "_place").sortWithinPartitions("_place").drop("_place")
    ranged.write.mode("overwrite").option("parquet.block.size", group_bytes).parquet(path)
