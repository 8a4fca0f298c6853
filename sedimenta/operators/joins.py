"""Left joins to a table with unique keys that keep their balance when a few keys hold most rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side this small goes to every task: at most so many counted rows, and so many bytes at the width of its columns.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20
# Taken for a value of variable length; other types have their own size, 16 at most.
TEXT_BYTES = 64
# Hot keys are looked for in 64 groups of keys, 16 in each: at most 1,024 in all.
KEY_GROUPS = 64
HOT_PER_GROUP = 16
TRACKED_PER_GROUP = 256


def hot_keys(df: DataFrame, key: str) -> DataFrame:
    """The most frequent values of ``key``, at most 1,024 rows, from sketches of fixed size.

    Each task sends one small sketch per group of keys and each group is merged apart, so no task
    sees more than its groups' sketches. A key with 1/10,000 of all rows stands out in its group. A
    key named in error changes where rows are joined, never what comes out.
    """
    present = df.select(F.col(key).alias("_key")).where(F.col("_key").isNotNull())
    groups = present.groupBy(F.pmod(F.xxhash64("_key"), F.lit(KEY_GROUPS)).alias("_group"))
    top = groups.agg(F.expr(f"approx_top_k(_key, {HOT_PER_GROUP}, {TRACKED_PER_GROUP})").alias("_top"))
    return top.select(F.explode("_top").alias("_t")).select(F.col("_t.item").alias("_hot"))


def fits_everywhere(side: DataFrame, rows: int | None) -> bool:
    """Whether a side of so many counted rows is small enough to be broadcast."""
    width = sum(TEXT_BYTES if kind in ("string", "binary") else 16 for _, kind in side.dtypes)
    return rows is not None and rows <= BROADCAST_ROWS and rows * width <= BROADCAST_BYTES


def shuffled(side: DataFrame) -> DataFrame:
    """Keeps a side that is not counted as small from being broadcast after all: Spark would by the size of its files,
    and millions of rows of keys can take a few MB there but hundreds in the driver."""
    return side.hint("merge")


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    right_rows: int | None = None,
    spread_by: tuple[str, ...] = (),
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """``left`` with the other columns of ``right``, NULL where nothing matches.

    ``right`` has one row per ``right_key``; keys are integers. Where its counted ``right_rows``
    and its width make it small (``fits_everywhere``) it is broadcast. Otherwise both sides are shuffled, except for the hot
    keys: what they find is broadcast (nothing, for a hot key ``right`` does not have), and their
    rows, like rows without a key, are spread over all partitions by a hash of ``spread_by`` (the
    left side's own key; all its columns by default) instead of meeting in one.

    ``hot_from`` is a cheaper place to count ``left_key`` from, such as a stored table.
    """
    values = [name for name in right.columns if name != right_key]
    right = right.select(F.col(right_key).alias("_rk"), *[F.col(n).alias(f"_r_{n}") for n in values])
    if fits_everywhere(right, right_rows):
        joined = left.join(F.broadcast(right), left[left_key] == F.col("_rk"), "left")
        return joined.select(*left.columns, *[F.col(f"_r_{n}").alias(n) for n in values])

    # The few hot keys are looked up in the same shuffle of ``right`` as the rows of the main join.
    far = shuffled(right.withColumn("_rpart", F.col("_rk").cast("long")))
    hot = hot_keys(left if hot_from is None else hot_from, left_key).withColumn("_hpart", F.col("_hot").cast("long"))
    settled = hot.join(far, (F.col("_hot") == F.col("_rk")) & (F.col("_hpart") == F.col("_rpart")), "left").select(
        "_hot", *[F.col(f"_r_{n}").alias(f"_h_{n}") for n in values]
    )
    near = left.join(F.broadcast(settled), left[left_key] == F.col("_hot"), "left")
    # Rows settled above (found or not), and rows without a key, are dealt by the hash: they match nothing in the second
    # join (or, if the hash is the key itself, what they were settled with). The part is no column, so that the shuffle
    # carries no copy of the key, only ``_hot``, which is nearly always NULL.
    cold = F.when(F.col("_hot").isNull(), F.col(left_key).cast("long"))
    part = F.coalesce(cold, F.xxhash64(*(spread_by or left.columns)))
    joined = near.join(far, (F.col(left_key) == F.col("_rk")) & (part == F.col("_rpart")), "left")
    return joined.select(
        *left.columns, *[F.coalesce(F.col(f"_h_{n}"), F.col(f"_r_{n}")).alias(n) for n in values]
    )


def lookup_by(
    left: DataFrame,
    right: DataFrame,
    on: dict[str, str],
    right_rows: int | None = None,
    spread_by: tuple[str, ...] = (),
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """``lookup_join`` for keys of any type and any number of columns: ``on`` maps columns of ``left`` to those of
    ``right``, which has one row for each key without a NULL part.

    Rows are dealt, and hot keys counted in sketches, by a hash of the key's columns; the columns themselves are compared
    in every join, so keys with the same hash cost a comparison and change nothing. A key with a NULL part finds nothing.
    """
    names = list(on)
    values = [name for name in right.columns if name not in on.values()]
    right = right.where(_whole(on.values())).select(
        F.xxhash64(*on.values()).alias("_rh"),
        *[F.col(on[name]).alias(f"_k{i}") for i, name in enumerate(names)],
        *[F.col(name).alias(f"_r_{name}") for name in values],
    )

    def hashed(df: DataFrame, out: str) -> DataFrame:
        return df.withColumn(out, F.when(_whole(names), F.xxhash64(*names)))

    def same(hash_column: str):
        pairs = [F.col(name) == F.col(f"_k{i}") for i, name in enumerate(names)]
        return reduce(and_, pairs, F.col(hash_column) == F.col("_rh"))

    keyed = hashed(left, "_lh")
    if fits_everywhere(right, right_rows):
        joined = keyed.join(F.broadcast(right), same("_lh"), "left")
        return joined.select(*left.columns, *[F.col(f"_r_{n}").alias(n) for n in values])

    hot = hot_keys(keyed if hot_from is None else hashed(hot_from, "_lh"), "_lh")
    settled = hot.join(shuffled(right), F.col("_hot") == F.col("_rh"), "left").select(
        "_hot", *[F.col(f"_k{i}").alias(f"_hk{i}") for i in range(len(names))], *[F.col(f"_r_{n}").alias(f"_h_{n}") for n in values]
    )
    # A hot hash that ``right`` lacks has one row without a key, which settles all rows with that hash; rows of another
    # key with a hash that it has go on to the second join, like cold ones.
    equal = reduce(and_, [F.col(name) == F.col(f"_hk{i}") for i, name in enumerate(names)])
    near = keyed.join(F.broadcast(settled), (F.col("_lh") == F.col("_hot")) & (equal | F.col("_hk0").isNull()), "left")
    near = near.withColumn("_ch", F.when(F.col("_hot").isNull(), F.col("_lh")))
    near = near.withColumn("_part", F.coalesce("_ch", F.xxhash64(*(spread_by or left.columns))))
    far = shuffled(right.withColumn("_rpart", F.col("_rh")))
    joined = near.join(far, same("_ch") & (F.col("_part") == F.col("_rpart")), "left")
    return joined.select(*left.columns, *[F.coalesce(f"_h_{n}", f"_r_{n}").alias(n) for n in values])


def _whole(names):
    return reduce(and_, [F.col(name).isNotNull() for name in names])
