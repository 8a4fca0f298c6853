"""SimHash near-duplicates, found by anchor points of a covering code.

A fingerprint has 64 bits, in three parts of 21, 21 and 22. Two fingerprints that differ in at most 4 bits differ in at
most one bit of some part. Each part, filled up to 23 bits, is a word of the space that the binary Golay code covers
with radius 3. Its 4,096 code words are the anchors: a part's home is the one within the radius, and it is replicated to
every anchor within radius plus 1. The home of one fingerprint is then among the anchors of any other that differs in
one bit, so comparing an anchor's homes with all that came to it misses no link.

An anchor that more than ``MOST`` fingerprints come to is divided: the two other parts differ in at most 4 bits, one of
them in at most 2, so the anchors of either (radius plus 2) tell its members apart further. Fingerprints are compared,
not documents: copies have been united before. What leaves an anchor is a star per group of linked members, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.components import components
from sedimenta.llm.store import send_package, stored, unused, without

THRESHOLD = 4
WORDS = 4
SEED = 42
PARTS = ((0, 21), (21, 21), (42, 22))
#: Members of an anchor that are compared without dividing it.
MOST = 1 << 15
# The binary Golay code: words of 23 bits that this polynomial divides; covering radius 3.
_GENERATOR, _LENGTH, _RADIUS = 0b110001110101, 23, 3
_HASHES = 1 << 15
_CELLS = 1 << 22
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def hashes(text: bytes | None, words: int = WORDS) -> np.ndarray:
    """XXH64 of each run of ``words`` words, A-Z lower-cased; of all words if there are fewer; of nothing if none."""
    import xxhash

    parts = (text or b"").translate(_LOWER).split()  # splits at 09-0D and 20
    if not parts:
        return np.zeros(0, np.uint64)
    joined = b" ".join(parts)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(sizes + 1) - 1
    begins = (ends - sizes)[: max(len(parts) - words + 1, 1)].tolist()
    ends = ends[min(words, len(parts)) - 1 :].tolist()
    runs = map(joined.__getitem__, map(slice, begins, ends))
    return np.fromiter(map(xxhash.xxh64_intdigest, runs, repeat(SEED)), np.uint64, len(begins))


def fingerprints(texts: list[bytes | None], words: int = WORDS) -> np.ndarray:
    """Of each text the bits that are set in over half its hashes; zero without words."""
    out = np.zeros(len(texts), np.uint64)
    pieces: list[tuple[int, np.ndarray]] = []
    ones = np.zeros((len(texts), 64), np.int64)
    total = np.zeros(len(texts), np.int64)
    gathered = 0

    def count() -> None:
        """Bits by way of bytes: how often each byte value stands in each of the eight places, then its bits."""
        rows = [i for i, _ in pieces]
        slot = np.repeat(np.arange(len(pieces)), [len(h) for _, h in pieces])
        values = np.concatenate([h for _, h in pieces]).view(np.uint8).reshape(-1, 8)
        cells = (slot[:, None] * 8 + np.arange(8)) * 256 + values
        table = np.bincount(cells.ravel(), minlength=len(pieces) * 2048).reshape(-1, 256) @ _BITS
        np.add.at(ones, rows, table.reshape(-1, 64))
        pieces.clear()

    for i, text in enumerate(texts):
        found = hashes(text, words)
        total[i] = len(found)
        for at in range(0, len(found), _HASHES):
            pieces.append((i, found[at : at + _HASHES]))
            gathered += len(pieces[-1][1])
            if gathered >= _HASHES or len(pieces) >= 256:
                count()
                gathered = 0
    if pieces:
        count()
    bits = (2 * ones > total[:, None]).astype(np.uint8)
    out[:] = np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()
    return out


def with_fingerprint(
    df: DataFrame, text: str = "text", fingerprint: str = "fingerprint", words: int = WORDS, early: bool = True
) -> DataFrame:
    """``df`` with the SimHash of each whole text as a signed long; a column of that name is replaced.

    ``early``: whether the optimizer may hash rows that a join of ``df`` takes out.
    """
    send_package(df.sparkSession)

    @F.arrow_udf("long")
    def hashed(texts: pa.Array) -> pa.Array:
        # A few texts at a time: a whole batch of them as Python objects would be in memory twice.
        parts = [
            fingerprints(texts.slice(at, 256).cast(pa.binary()).to_pylist(), words) for at in range(0, len(texts), 256)
        ]
        return pa.array(np.concatenate([np.zeros(0, np.uint64), *parts]).view(np.int64))

    return without(df, fingerprint).withColumn(fingerprint, (hashed if early else hashed.asNondeterministic())(df[text]))


class Anchors:
    """The code's words near a word, by the syndrome of the word."""

    def __init__(self, slack: int):
        """``slack``: how far beyond the covering radius anchors count as near."""
        patterns = np.zeros(1, np.int64)
        levels = [patterns]
        for _ in range(_RADIUS + slack):
            more = np.unique((levels[-1][:, None] | (1 << np.arange(_LENGTH))).ravel())
            levels.append(np.setdiff1d(more, levels[-1]))
        patterns = np.concatenate(levels)
        weight = np.repeat(np.arange(len(levels)), [len(x) for x in levels])
        syndromes = self.syndrome(patterns)
        order = np.lexsort((weight, syndromes))
        self.patterns = patterns[order]
        self.count = np.bincount(syndromes, minlength=1 << 11)
        self.first = np.cumsum(self.count) - self.count

    @staticmethod
    def syndrome(word: np.ndarray) -> np.ndarray:
        """Remainder of the division by the generator."""
        rest = word.copy()
        for bit in range(_LENGTH - 1, 10, -1):
            rest ^= (rest >> bit & 1) * (_GENERATOR << bit - 11)
        return rest

    def near(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, anchor and whether it is the row's home, for all rows and all anchors near them."""
        syndrome = self.syndrome(word)
        n = self.count[syndrome]
        row = np.repeat(np.arange(len(word)), n)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        return row, word[row] ^ self.patterns[self.first[syndrome[row]] + nth], nth == 0


def _part(values: np.ndarray, part: int) -> np.ndarray:
    low, size = PARTS[part]
    return (values >> np.uint64(low) & np.uint64((1 << size) - 1)).astype(np.int64)


def _placed(values: np.ndarray, divided: frozenset[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket, row and whether at home, of fingerprints at their anchors; ``divided``: buckets to take apart."""
    one, two = Anchors(1), Anchors(2)
    out = []
    for part in range(len(PARTS)):
        row, anchor, home = one.near(_part(values, part))
        bucket = part << _LENGTH | anchor
        split = np.isin(bucket, list(divided))
        out.append((bucket[~split], row[~split], home[~split]))
        if split.any():
            above, row, at_home = bucket[split], row[split], home[split]
            for other in range(len(PARTS)):
                if other != part:
                    back, anchor, home = two.near(_part(values[row], other))
                    below = ((above[back] << 2 | other) << _LENGTH | anchor) | 1 << 62
                    out.append((below, row[back], home & at_home[back]))
    return tuple(np.concatenate(column) for column in zip(*out))


def linked(values: np.ndarray, home: np.ndarray) -> np.ndarray:
    """Of each member of an anchor the first one of its group: homes link to all within the threshold."""
    group = np.arange(len(values))
    homes = np.flatnonzero(home)
    step = max(_CELLS // len(values), 1)
    for at in range(0, len(homes), step):
        rows = homes[at : at + step]
        i, j = np.nonzero(np.bitwise_count(values[rows, None] ^ values) <= THRESHOLD)
        i = rows[i]
        while len(i):
            low, high = np.minimum(group[i], group[j]), np.maximum(group[i], group[j])
            apart = low != high
            i, j = i[apart], j[apart]
            np.minimum.at(group, high[apart], low[apart])
            while (up := group[group]).tobytes() != group.tobytes():
                group = up
    return group


def links(values: DataFrame) -> DataFrame:
    """Stars ``a``, ``b`` that connect what links of at most 4 bits connect, between the distinct longs in ``value``."""
    spark = values.sparkSession
    send_package(spark)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(PARTS) << _LENGTH, np.int64)
        for batch in batches:
            bucket, _, _ = _placed(batch.column(0).to_numpy().view(np.uint64), frozenset())
            total += np.bincount(bucket, minlength=len(total))
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], ["bucket", "n"])

    sizes = values.mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    # At most three times 4,096 anchors.
    divided = frozenset(row["bucket"] for row in sizes.where(F.col("n") > MOST).collect())

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0).to_numpy()
            for at in range(0, len(column), 2048):
                part = column[at : at + 2048]
                bucket, row, home = _placed(part.view(np.uint64), divided)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket), pa.array(part[row]), pa.array(home)], ["bucket", "value", "home"]
                )

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Anchors come one after another; the last one of a batch may go on in the next."""
        rest = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)]
        waiting: list[list[np.ndarray]] = []
        for batch in batches:
            columns = [column.to_numpy(zero_copy_only=False) for column in batch.columns]
            if not len(columns[0]):
                continue
            waiting.append(columns)
            if waiting[0][0][0] != columns[0][-1]:
                columns = [np.concatenate(c) for c in zip(rest, *waiting)]
                ready = np.searchsorted(columns[0], columns[0][-1])
                yield stars(*[c[:ready] for c in columns])
                rest, waiting = [np.zeros(0, c.dtype) for c in columns], [[c[ready:] for c in columns]]
        if waiting:
            yield stars(*[np.concatenate(c) for c in zip(rest, *waiting)])

    def stars(bucket: np.ndarray, value: np.ndarray, home: np.ndarray) -> pa.RecordBatch:
        edge = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        a, b = [value[:0]], [value[:0]]
        for begin, end in zip(edge, np.r_[edge[1:], len(bucket)]):
            if end - begin > 1 and home[begin:end].any():
                members = value[begin:end]
                group = linked(members.view(np.uint64), home[begin:end])
                other = np.flatnonzero(group != np.arange(len(group)))
                a.append(members[group[other]])
                b.append(members[other])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    return (
        values.mapInArrow(placed, "bucket long, value long, home boolean")
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(compared, "a long, b long")
    )


def groups(values: DataFrame) -> DataFrame:
    """``value`` and ``group``, one of the values that links lead to, the same for all of them."""
    group = components(stored(links(values), "links"), "a", "b")
    joined = values.join(group, values["value"] == group["node"], "left")
    return joined.select("value", F.coalesce("component", "value").alias("group"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its key, ``fingerprint`` (a signed long, over runs of ``WORDS`` words) and ``component_id``,
    the smallest key that links of at most ``THRESHOLD`` bits lead to.

    NULL, empty and blank texts have the fingerprint zero, and link like any other. Rows with the same key stay separate.
    NULL keys count as larger than any; a group of nothing else has a NULL component. Other columns play no part.
    """
    prints, grouped = _linked(docs, key, text)
    smallest = prints.groupBy("value").agg(F.min("key").alias("smallest"))
    joined = stored(smallest.join(grouped, "value"), "distinct")
    named = joined.groupBy("group").agg(F.min("smallest").alias("component_id"))
    of_value = joined.select("value", "group").join(named, "group").drop("group")
    return prints.join(of_value, "value").select(
        F.col("key").alias(key), F.col("value").alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of ``near_duplicates``: the one with the smallest key (NULL last); of repeated
    rows with that key and fingerprint any one. All columns stay, whatever their names."""
    prints, grouped = _linked(docs, key, text)
    first = F.min(F.struct(F.isnull("key").alias("last"), "key", "value")).alias("first")
    first = stored(prints.groupBy("value").agg(first), "first")
    chosen = first.join(grouped, "value").groupBy("group").agg(F.min("first").alias("first"))
    return _rows(docs, key, text, prints, chosen)


def _linked(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """``key`` and ``value`` of all documents, and ``value`` and ``group`` of all values."""
    given = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    prints = stored(with_fingerprint(given, "text", "value").select("key", "value"), "fingerprints")
    return prints, groups(stored(prints.select("value").distinct(), "distinct"))


def _rows(docs: DataFrame, key: str, text: str, prints: DataFrame, chosen: DataFrame) -> DataFrame:
    """One row of ``docs`` for each ``first`` in ``chosen``: of rows with its key and value any one.

    Keys decide what is kept. Texts move once, next to the small table of kept keys, so a large group does not meet in
    one task; only where a kept key has several rows are their values taken again and compared.
    """
    own, kept_key, kept_value = (unused(docs, label) for label in ("_fingerprint", "_kept_key", "_kept_value"))
    counts = prints.groupBy(F.col("key").alias("of")).agg(F.count(F.lit(1)).alias("rows"))
    kept = stored(
        chosen.select(F.col("first.key").alias(kept_key), F.col("first.value").alias(kept_value))
        .join(counts, F.col(kept_key).eqNullSafe(F.col("of")))
        .drop("of"),
        "kept",
    )
    once = kept.where("rows = 1").select(kept_key)
    alone = docs.join(once.hint("shuffle_hash"), docs[key].eqNullSafe(once[kept_key]), "left_semi")
    several = kept.where("rows > 1").select(kept_key, kept_value)
    if several.isEmpty():  # keys are unique: nothing to tell apart
        return alone
    same = F.col(key).eqNullSafe(F.col(kept_key))
    again = with_fingerprint(docs.join(several, same, "left_semi"), text, own, early=False)
    repeated = again.join(several, same & (F.col(own) == F.col(kept_value)), "left_semi")
    return alone.unionByName(repeated.dropDuplicates([key, own]).drop(own))
