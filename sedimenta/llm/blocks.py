"""Texts in stored blocks of a few megabytes, and hashes that blocks send out and get counts back for.

A block is one row: an Arrow stream of its documents, compressed. Operators that ask how often a hash occurs in all
blocks send each block's distinct hashes as one piece per bucket, so a frequent hash is one entry per block whatever its
rows, and rows of the shuffle are few. What comes back is a level per hash, in the order in which it was sent.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.store import send_package, stored

#: Bytes of text in a block (a longer text is a block by itself), and of text to a bucket.
BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 32 << 20
FEWEST_BUCKETS = 64
#: Bytes of a hash that are sent beside its bucket.
HASH_BYTES = 4


def packed(docs: DataFrame, *columns: str, text: str = "text") -> DataFrame:
    """Stored rows ``block`` (a number of its own), ``size`` (bytes of text) and ``payload``: the ``columns`` and, as
    ``text``, the whole texts of some documents in their order. NULL stays NULL; no rows give no blocks."""
    send_package(docs.sparkSession)
    names = [*columns, "text"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, n = TaskContext.get().partitionId() << 32, 0
        rows, size = [], 0

        def block() -> pa.RecordBatch:
            table = pa.Table.from_batches(rows).combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(table)
            payload = pa.array([sink.getvalue().to_pybytes()], pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array([first + n], pa.int64()), pa.array([size], pa.int64()), payload], ["block", "size", "payload"]
            )

        for batch in batches:
            batch = batch.rename_columns(names)
            batch = batch.set_column(len(columns), "text", batch.column("text").cast(pa.large_binary()))
            sizes = np.diff(offsets(batch.column("text")))
            at = 0
            while at < len(sizes):
                room = np.searchsorted(np.cumsum(sizes[at:]), BLOCK_BYTES - size, "right")
                take = max(int(room), 1 if not rows else 0)
                if take:
                    rows.append(batch.slice(at, take))
                    size += int(sizes[at : at + take].sum())
                    at += take
                if at < len(sizes):
                    yield block()
                    rows, size, n = [], 0, n + 1
        if rows:
            yield block()

    given = docs.select(*columns, text)
    return stored(given.mapInArrow(pack, "block long, size long, payload binary"), "blocks")


def opened(payload: pa.Scalar) -> pa.Table:
    """The documents of a block."""
    return pa.ipc.open_stream(pa.py_buffer(payload.as_py())).read_all().combine_chunks()


def offsets(texts: pa.Array) -> np.ndarray:
    """Where each text begins and the last one ends; NULL has no bytes."""
    return np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]


def text_bytes(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a block's texts, and where each text begins in them (and the last one ends)."""
    texts = pa.concat_arrays(table.column("text").chunks) if table.num_rows else pa.array([], pa.large_binary())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = offsets(texts)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def buckets_for(blocks: DataFrame) -> int:
    """Buckets in proportion to the bytes of text."""
    total = blocks.agg(F.sum("size")).first()[0] or 0
    return max(FEWEST_BUCKETS, -(-total // BUCKET_BYTES))


class Dealt:
    """Distinct hashes by bucket: of 64 bits the upper half chooses the bucket, of the lower half ``width`` bytes are
    sent."""

    def __init__(self, hashes: np.ndarray, buckets: int, width: int = HASH_BYTES):
        low = np.uint64((1 << 8 * width) - 1)
        keys = (hashes >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32) | hashes & low
        self.keys, self.inverse, self.counts = np.unique(keys, return_inverse=True, return_counts=True)
        bucket = (self.keys >> np.uint64(32)).astype(np.int64)
        self.begin = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, np.int64)
        self.end = np.r_[self.begin[1:], len(bucket)] if len(bucket) else self.begin
        self.bucket, self.width = bucket[self.begin], width

    def sent(self, block: int, most: int) -> pa.RecordBatch:
        """The hashes, and how often each occurs: ``most`` stands for more, too."""
        low = self.keys.astype("<u4").view(np.uint8).reshape(-1, 4)[:, : self.width]
        weight = np.minimum(self.counts, most).astype(weight_type(most))
        cut = list(zip(self.begin.tolist(), self.end.tolist()))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(self.bucket.astype(np.int32)),
                pa.array([block] * len(cut), pa.int64()),
                pa.array([low[a:b].tobytes() for a, b in cut], pa.binary()),
                pa.array([weight[a:b].tobytes() for a, b in cut], pa.binary()),
            ],
            ["bucket", "block", "hashes", "weights"],
        )

    def levels(self, notes: list[dict] | None) -> np.ndarray:
        """The level of each hash given, from the block's notes."""
        answers = sorted(notes or [], key=lambda note: note["bucket"])
        found = np.frombuffer(b"".join(note["levels"] for note in answers), np.uint8)
        return found[self.inverse]


def weight_type(most: int) -> str:
    return "<u1" if most < 1 << 8 else "<u4"


def with_levels(
    blocks: DataFrame,
    hashes: Callable[[pa.Table], np.ndarray],
    thresholds: Sequence[int],
    buckets: int,
    width: int = HASH_BYTES,
) -> DataFrame:
    """Stored ``block`` and ``notes`` of ``blocks``: for each distinct hash how many of the ``thresholds`` (ascending)
    its occurrences in all blocks reach. ``hashes`` gives a block's, as often as they occur.

    Hashes are told apart by their bucket and ``width`` bytes more; a level can only come out too high by that, never
    too low. The text to a bucket is the same at every size, so this does not become more frequent with more text.
    """
    reached = np.asarray(thresholds)
    most = max(thresholds)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, payload in zip(batch.column("block").to_pylist(), batch.column("payload")):
                yield Dealt(hashes(opened(payload)), buckets, width).sent(block, most)

    def settle(table: pa.Table) -> pa.Table:
        parts = table.column("hashes").to_pylist()
        weights = np.frombuffer(b"".join(table.column("weights").to_pylist()), weight_type(most)).astype(np.int64)
        given = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, width)
        wide = np.zeros((len(given), 4), np.uint8)
        wide[:, :width] = given
        values = wide.view("<u4").ravel()
        order = np.argsort(values)
        ordered = values[order]
        first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        total = np.add.reduceat(weights[order], first)
        level = np.searchsorted(reached, total, "right").astype(np.uint8)
        found = np.empty(len(values), np.uint8)
        found[order] = np.repeat(level, np.diff(np.r_[first, len(values)]))
        edge = np.cumsum([0] + [len(part) // width for part in parts])
        levels = [found[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:])]
        return pa.table(
            {"block": table.column("block"), "bucket": table.column("bucket"), "levels": pa.array(levels, pa.binary())}
        )

    asked = blocks.select("block", "payload").mapInArrow(send, "bucket int, block long, hashes binary, weights binary")
    answered = asked.groupBy("bucket").applyInArrow(settle, "block long, bucket int, levels binary")
    notes = answered.groupBy("block").agg(F.collect_list(F.struct("bucket", "levels")).alias("notes"))
    return stored(notes, "levels")


def noted(blocks: DataFrame, *notes: DataFrame) -> DataFrame:
    """``blocks`` with their notes, NULL where there are none. The blocks move next to the notes, not the other way."""
    for table in notes:
        blocks = blocks.join(table.hint("shuffle_hash"), "block", "left")
    return blocks
