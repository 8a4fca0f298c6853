"""Passages that an earlier document has too, by a sparse suffix array sorted deep and shallow.

A passage is a string of ``WINDOW`` bytes. Of the runs of ``GRAM`` bytes in it the one with the smallest hash is its
anchor; equal passages have the same anchor at the same place, so the suffix array needs only the suffixes that begin at
anchors, about one of 14. Anchors that occur once in the corpus are known from counts of their hashes and go no further.
What surrounds the others is dealt by anchor; in a bucket the suffixes are sorted

* shallow: multikey quicksort on characters of eight bytes, down to the anchor's length,
* deep: each group that is still together has a long common prefix, and a blind trie (branching depths and first bytes
  only, one look at a text per insertion) orders the rest.

The passages that begin ``o`` bytes before an anchor are equal where ``WINDOW - o`` bytes from the anchor on are common
to suffixes in the array and the ``o`` bytes before are equal; of each such class the smallest document keeps its bytes.

Equal surroundings are united per block, so what many copies share is one entry per block. An anchor with more than
``HOT`` occurrences, whose surroundings may all differ, is dealt by single passages instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.blocks import Dealt, buckets_for, noted, opened, packed, text_bytes, with_levels
from sedimenta.llm.store import stored

WINDOW = 50
GRAM = 24
#: Occurrences of an anchor beyond which it is dealt passage by passage.
HOT = 1 << 14
_BEFORE = WINDOW - GRAM
_TAIL = WINDOW - GRAM
_CHUNK = 1 << 16
_FACTOR = 0x100000001B3
_MIX = np.uint64(0x9E3779B97F4A7C15)
_LAST = np.iinfo(np.int64).max


def grams(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` bytes, put together from runs of powers of two."""
    part, length = data.astype(np.uint64) + np.uint64(1), 1
    whole, done = None, 0
    while True:
        if size & length:
            if whole is None:
                whole = part
            else:
                n = len(part) - done
                whole = whole[:n] * np.uint64(pow(_FACTOR, length, 1 << 64)) + part[done : done + n]
            done += length
        if done == size:
            break
        part = part[:-length] * np.uint64(pow(_FACTOR, length, 1 << 64)) + part[length:]
        length *= 2
    whole = (whole ^ whole >> np.uint64(32)) * _MIX
    return whole ^ whole >> np.uint64(29)


def _smallest(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The smallest of each ``width`` neighbours and where it is; the first one of equals."""
    at = np.arange(len(values))
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        left, right = values[:-step], values[step:]
        at = np.where(left <= right, at[:-step], at[step:])
        values = np.minimum(left, right)
        reach += step
    return values, at


class Regions:
    """Neighbouring passages of a text that have the same anchor: ``start`` of the first, ``n`` of them, ``before`` bytes
    from it to the anchor, and the anchor's ``hash``."""

    def __init__(self, data: np.ndarray, begin: np.ndarray):
        """``begin``: where each text begins, and the last one ends."""
        starts, anchors, hashes = [], [], []
        last = np.maximum(begin[1:] - WINDOW + 1, begin[:-1])  # one past the last passage of each text
        total = len(data) - WINDOW + 1
        previous = -1
        for at in range(0, max(total, 0), _CHUNK):
            stop = min(at + _CHUNK, total)
            smallest, place = _smallest(grams(data[at : stop + WINDOW - 1], GRAM), WINDOW - GRAM + 1)
            place += at
            new = np.flatnonzero(np.r_[previous, place[:-1]] != place)
            previous = place[-1]
            # A region also begins with each text, whatever the passages before it were.
            first = begin[:-1][(begin[:-1] >= at) & (begin[:-1] < stop)] - at
            new = np.union1d(new, first)
            starts.append(new + at)
            anchors.append(place[new])
            hashes.append(smallest[new])
        none = np.zeros(0, np.int64)
        start = np.concatenate([none, *starts]).astype(np.int64)
        text = np.searchsorted(begin, start, "right") - 1
        keep = start < last[text] if len(start) else np.zeros(0, bool)
        n = np.minimum(np.r_[start[1:], len(data)], last[text] if len(start) else none) - start
        self.start, self.n, self.text = start[keep], n[keep], text[keep]
        self.before = np.concatenate([none, *anchors]).astype(np.int64)[keep] - self.start
        self.hash = np.concatenate([np.zeros(0, np.uint64), *hashes])[keep]

    def chosen(self, data: np.ndarray, level: np.ndarray) -> Regions:
        """Those whose anchors occur again; hot ones (level 2) as single passages under their own hash."""
        hot = np.flatnonzero(level == 2)
        plain = np.flatnonzero(level == 1)
        out = Regions.__new__(Regions)
        row = np.repeat(hot, self.n[hot])
        nth = np.arange(len(row)) - np.repeat(np.cumsum(self.n[hot]) - self.n[hot], self.n[hot])
        single = self.start[row] + nth
        one = np.ones(len(row), np.int64)
        own = np.zeros(len(row), np.uint64)
        for at in range(0, len(row), _CHUNK):
            places = single[at : at + _CHUNK, None] + np.arange(WINDOW)
            for column in data[places].T:
                own[at : at + _CHUNK] = own[at : at + _CHUNK] * np.uint64(_FACTOR) + column
        own = (own ^ own >> np.uint64(32)) * _MIX
        out.start = np.r_[self.start[plain], single]
        out.n = np.r_[self.n[plain], one]
        out.text = np.r_[self.text[plain], self.text[row]]
        out.before = np.r_[self.before[plain], 0 * one]
        out.hash = np.r_[self.hash[plain], own ^ own >> np.uint64(29)]
        return out

    def united(self, data: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """Equal surroundings as one: of each region its entry, of each entry its first region, bucket and bytes.

        Entries are in order of their buckets, then of their first regions.
        """
        whole = data.tobytes()
        known: dict[tuple[bytes, int], int] = {}
        ends = self.start + self.n + WINDOW - 1
        entry = np.fromiter(
            (
                known.setdefault((whole[a:b], left), len(known))
                for a, b, left in zip(self.start.tolist(), ends.tolist(), self.before.tolist())
            ),
            np.int64,
            len(self.start),
        )
        _, first = np.unique(entry, return_index=True)
        bucket = ((self.hash[first] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        strings = [text for text, _ in known]
        return place[entry], first[order], bucket[order], [strings[i] for i in order.tolist()]


def shallow(characters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort, a character of all groups at a time: the order of the rows, and of each place in it the first
    place with the same characters."""
    n = len(characters)
    order, group, active = np.arange(n), np.zeros(n, np.int64), np.arange(n)
    for column in characters.T:
        key, within = column[order[active]], group[active]
        turn = np.lexsort((key, within))
        order[active] = order[active][turn]
        key, within = key[turn], within[turn]
        new = np.r_[True, (within[1:] != within[:-1]) | (key[1:] != key[:-1])][: len(key)]
        first = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
        group[active] = active[first]
        together = np.bincount(first, minlength=len(key))[first] > 1
        active = active[together]
        if not len(active):
            break
    return order, group


class BlindTrie:
    """Strings of one length in order. Inner nodes know the depth at which they branch and each branch's byte, no more;
    a string finds its leaf by these alone, and one comparison with that leaf tells where it belongs."""

    def __init__(self, first: bytes):
        self.root: list | bytes = first

    def insert(self, string: bytes) -> None:
        node = self.root
        while type(node) is list:  # blind: bytes between the branching depths are not looked at
            node = node[1].get(string[node[0]]) or next(iter(node[1].values()))
        apart = int.from_bytes(node) ^ int.from_bytes(string)
        if not apart:
            return
        depth = len(string) - 1 - (apart.bit_length() - 1 >> 3)
        parent, above = None, self.root
        while type(above) is list and above[0] < depth:
            parent, above = above, above[1][string[above[0]]]
        if type(above) is list and above[0] == depth:
            above[1][string[depth]] = string
            return
        split = [depth, {node[depth]: above, string[depth]: string}]
        if parent is None:
            self.root = split
        else:
            parent[1][string[parent[0]]] = split

    def ordered(self) -> Iterator[tuple[bytes, int]]:
        """Each string with the length that it has in common with the one before."""
        waiting: list[tuple[list | bytes, int]] = [(self.root, 0)]
        while waiting:
            node, common = waiting.pop()
            if type(node) is list:
                depth, below = node
                branches = sorted(below, reverse=True)
                waiting += [(below[c], common if c == branches[-1] else depth) for c in branches]
            else:
                yield node, common


def _windows(data: np.ndarray, begin: np.ndarray, size: np.ndarray, width: int) -> np.ndarray:
    """``width`` bytes from each beginning on; zeros beyond ``size``."""
    padded = np.r_[data, np.zeros(width, np.uint8)]
    rows = np.lib.stride_tricks.sliding_window_view(padded, width)[begin]
    rows[np.arange(width, dtype=np.uint8) >= size[:, None].astype(np.uint8)] = 0
    return rows


def _characters(rows: np.ndarray) -> np.ndarray:
    wide = -(-rows.shape[1] // 8) * 8
    padded = np.zeros((len(rows), wide), np.uint8)
    padded[:, : rows.shape[1]] = rows
    return padded.view(">u8").astype(np.uint64)


def _common(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Bytes that each row in ``order`` has in common with the one before."""
    differs = rows[order[1:]] != rows[order[:-1]]
    common = np.where(differs.any(axis=1), differs.argmax(axis=1), rows.shape[1])
    return np.r_[0, common][: len(order)]


def sorted_suffixes(heads: np.ndarray, tails: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes (their first ``GRAM`` bytes and the rest) in order, and how much each has in common with the one
    before: 0 for the first with its head."""
    order, group = shallow(_characters(heads))
    n = len(order)
    common = np.full(n, WINDOW)
    common[group == np.arange(n)] = 0
    ordered = tails[order]
    new = (group[1:] == group[:-1]) & (ordered[1:] != ordered[:-1]).any(axis=1)
    mixed = np.unique(group[1:][new])  # groups with a tail unlike the one before
    sizes = np.bincount(group, minlength=n)
    for begin, size in zip(mixed.tolist(), sizes[mixed].tolist()):
        rows = order[begin : begin + size]
        members: dict[bytes, list[int]] = {}
        for row, tail in zip(rows.tolist(), ordered[begin : begin + size]):
            members.setdefault(tail.tobytes(), []).append(row)
        strings = iter(members)
        trie = BlindTrie(next(strings))
        for string in strings:
            trie.insert(string)
        at = begin
        for string, depth in trie.ordered():
            same = members[string]
            order[at : at + len(same)] = same
            if at > begin:
                common[at] = GRAM + depth
            at += len(same)
    return order, common


def owners(strings: bytes, sizes: np.ndarray, before: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For each passage of each entry, in order, the smallest of ``docs`` among all entries that have it.

    An entry has ``sizes`` bytes, of which ``before`` come ahead of its anchor.
    """
    data = np.frombuffer(strings, np.uint8)
    count = sizes - WINDOW + 1
    base = np.cumsum(count) - count
    least = np.repeat(docs, count)
    anchor = np.cumsum(sizes) - sizes + before
    after = sizes - before
    order, common = sorted_suffixes(_windows(data, anchor, after, GRAM), _windows(data, anchor + GRAM, after - GRAM, _TAIL))
    ahead = _windows(data[::-1], len(data) - anchor, before, _BEFORE)
    back, _ = shallow(_characters(ahead))
    back_common = _common(ahead, back)
    together = np.empty(len(order), bool)
    together[order] = (common > 0) | np.r_[common[1:] > 0, False][: len(order)]
    fewest = before - count + 1
    right, left = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    for o in range(_BEFORE + 1):
        rows = np.flatnonzero(together & (fewest <= o) & (o <= before))
        if not len(rows):
            continue
        right[order] = np.cumsum(common < WINDOW - o)
        left[back] = np.cumsum(back_common < o)
        key = right[rows] * (len(order) + 1) + left[rows]
        turn = np.argsort(key)
        key, rows = key[turn], rows[turn]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        smallest = np.minimum.reduceat(docs[rows], first)
        least[base[rows] + before[rows] - o] = np.repeat(smallest, np.diff(np.r_[first, len(rows)]))
    return least


def _keys(table: pa.Table) -> np.ndarray:
    """Document numbers; NULL comes after any."""
    return table.column(0).fill_null(_LAST).to_numpy()


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its integer ``key``, ``n_bytes`` of the text in UTF-8, ``spans`` (the maximal runs of removed
    bytes, from 0, stop exclusive) and ``kept``, the remaining bytes.

    A byte is removed if a string of ``WINDOW`` bytes that covers it also begins in a document with a smaller key. All is
    judged on the given texts. NULL and texts of fewer bytes lose nothing; NULL is empty. Rows with the same key, repeated
    rows among them, are no smaller than each other, so they keep what no smaller key has. NULL keys are larger than any,
    and no smaller than each other. Other columns play no part. A text has to fit into one task, with about ten times its
    size.
    """
    blocks = packed(docs.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("text")), "_key")
    buckets = buckets_for(blocks)

    def hashes(table: pa.Table) -> np.ndarray:
        return Regions(*text_bytes(table)).hash

    notes = with_levels(blocks, hashes, (2, HOT + 1), buckets)

    def chosen(table: pa.Table, note: list[dict] | None) -> tuple[np.ndarray, np.ndarray, Regions]:
        data, begin = text_bytes(table)
        found = Regions(data, begin)
        return data, begin, found.chosen(data, Dealt(found.hash, buckets).levels(note))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, payload, note in zip(batch.column("block").to_pylist(), batch.column("payload"), batch.column("notes")):
                table = opened(payload)
                data, _, found = chosen(table, note.as_py())
                entry, first, bucket, strings = found.united(data, buckets)
                smallest = np.full(len(first), _LAST)
                np.minimum.at(smallest, entry, _keys(table)[found.text])
                before = found.before[first].astype(np.uint8)
                sizes = (found.n[first] + WINDOW - 1).astype(np.uint8)
                edge = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])[: len(bucket)].tolist()
                cut = list(zip(edge, [*edge[1:], len(bucket)]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bucket[edge].astype(np.int32)),
                        pa.array([block] * len(cut), pa.int64()),
                        pa.array([sizes[a:b].tobytes() for a, b in cut], pa.binary()),
                        pa.array([before[a:b].tobytes() for a, b in cut], pa.binary()),
                        pa.array([smallest[a:b].astype("<i8").tobytes() for a, b in cut], pa.binary()),
                        pa.array([pa.compress(b"".join(strings[a:b]), "zstd", asbytes=True) for a, b in cut], pa.binary()),
                    ],
                    ["bucket", "block", "sizes", "before", "docs", "strings"],
                )

    def settle(table: pa.Table) -> pa.Table:
        sizes = [np.frombuffer(part, np.uint8).astype(np.int64) for part in table.column("sizes").to_pylist()]
        before = np.frombuffer(b"".join(table.column("before").to_pylist()), np.uint8).astype(np.int64)
        given = np.frombuffer(b"".join(table.column("docs").to_pylist()), "<i8")
        strings = b"".join(
            pa.decompress(part, int(size.sum()), "zstd", asbytes=True)
            for part, size in zip(table.column("strings").to_pylist(), sizes)
        )
        size = np.concatenate(sizes)
        least = owners(strings, size, before, given)
        # Runs of passages of an entry with the same owner.
        count = size - WINDOW + 1
        first = np.cumsum(count) - count
        new = np.r_[True, least[1:] != least[:-1]]
        new[first] = True
        run = np.flatnonzero(new)
        length = np.diff(np.r_[run, len(least)]).astype(np.uint8)
        owner = least[run].astype("<i8")
        edge = np.searchsorted(run, np.r_[0, np.cumsum([(s - WINDOW + 1).sum() for s in sizes])])
        cut = list(zip(edge[:-1].tolist(), edge[1:].tolist()))
        return pa.table(
            {
                "block": table.column("block"),
                "bucket": table.column("bucket"),
                "owners": pa.array([owner[a:b].tobytes() for a, b in cut], pa.binary()),
                "runs": pa.array([length[a:b].tobytes() for a, b in cut], pa.binary()),
            }
        )

    sent = noted(blocks, notes).mapInArrow(
        send, "bucket int, block long, sizes binary, before binary, docs binary, strings binary"
    )
    settled = sent.groupBy("bucket").applyInArrow(settle, "block long, bucket int, owners binary, runs binary")
    answers = stored(
        settled.groupBy("block").agg(F.collect_list(F.struct("bucket", "owners", "runs")).alias("answers")), "owners"
    )

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload, note, answer in zip(batch.column("payload"), batch.column("notes"), batch.column("answers")):
                table = opened(payload)
                data, begin, found = chosen(table, note.as_py())
                entry, first, _, _ = found.united(data, buckets)
                parts = sorted(answer.as_py() or [], key=lambda part: part["bucket"])
                owner = np.frombuffer(b"".join(part["owners"] for part in parts), "<i8")
                least = np.repeat(owner, np.frombuffer(b"".join(part["runs"] for part in parts), np.uint8))
                yield _removed(table, data, begin, found, entry, first, least)

    return (
        noted(blocks, notes, answers)
        .mapInArrow(cut_out, "key long, n_bytes long, spans array<struct<start: long, stop: long>>, kept binary")
        .withColumnRenamed("key", key)
    )


def _removed(
    table: pa.Table, data: np.ndarray, begin: np.ndarray, found: Regions, entry: np.ndarray, first: np.ndarray, least: np.ndarray
) -> pa.RecordBatch:
    """A block's documents without the passages that have a smaller owner; ``least``: the owners, entry by entry."""
    count = found.n[first]
    base = np.cumsum(count) - count
    keys = _keys(table)
    starts = [np.zeros(0, np.int64)]
    for at in range(0, len(entry), _CHUNK):
        part = slice(at, at + _CHUNK)
        n = found.n[part]
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        lost = least[np.repeat(base[entry[part]], n) + nth] < np.repeat(keys[found.text[part]], n)
        starts.append((np.repeat(found.start[part], n) + nth)[lost])
    # A block has less than 2^31 bytes, as any Arrow value of this kind.
    latest = np.full(len(data) + 1, -WINDOW, np.int32)
    starts = np.concatenate(starts)
    latest[starts] = starts
    np.maximum.accumulate(latest, out=latest)
    gone = np.arange(len(data) + 1, dtype=np.int32) - latest < WINDOW
    gone[-1] = False
    # Spans end with their text.
    opens = gone & ~np.r_[False, gone[:-1]]
    closes = ~gone & np.r_[False, gone[:-1]]
    inner = np.unique(begin)
    both = inner[gone[inner] & np.r_[False, gone[:-1]][inner]]
    opens[both] = True
    start = np.flatnonzero(opens)
    stop = np.sort(np.r_[np.flatnonzero(closes), both])
    edge = np.searchsorted(start, begin)
    of = np.searchsorted(begin, start, "right") - 1
    spans = pa.StructArray.from_arrays([pa.array(start - begin[of]), pa.array(stop - begin[of])], ["start", "stop"])
    stays = ~gone[:-1]
    left = np.r_[0, np.cumsum(stays)][begin]
    kept = pa.Array.from_buffers(
        pa.large_binary(),
        len(begin) - 1,
        [None, pa.py_buffer(left.astype(np.int64).tobytes()), pa.py_buffer(data[stays].tobytes())],
    )
    return pa.RecordBatch.from_arrays(
        [
            table.column(0).combine_chunks(),
            pa.array(np.diff(begin)),
            pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), spans).cast(_SPANS),
            kept.cast(pa.binary()),
        ],
        ["key", "n_bytes", "spans", "kept"],
    )
