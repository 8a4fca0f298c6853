"""Benchmark decontamination over a distributed positional inverted index.

The index holds every word of the training texts, whatever is asked of it later. It is partitioned by document, in
segments: one row has the dictionary of some documents' words and, word by word, the increasing positions in an address
space in which those documents lie one after another, ``GAP`` apart. A frequent word's postings are thus spread over all
segments, a search needs no shuffle, and memory is bounded by a segment (or by the longest document, which has one of
its own).

Benchmark items are asked in blocks of bounded size. A phrase starts from the postings of its rarest word in the corpus;
the lists of its other words, rarest first, are intersected with them at their offsets. Every test is a search in sorted
postings for all candidates of a segment at once.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sedimenta.llm.store import fresh_folder, send_package

#: Words of a segment, after which the next one begins.
SEGMENT_WORDS = 1 << 19
#: Free positions between documents; more than a window and its slop, so that no match leaves its document.
GAP = 64
#: Words of a phrase, how far its words may be from their places in a proximity match, and words of one block of items.
WIDTH = 13
SLOP = 2
BLOCK_WORDS = 1 << 20


def _letters() -> bytes:
    """A-Z lower-cased; ASCII that is neither digit nor letter as a space; bytes of other characters as they are."""
    kept = [chr(c).lower() if chr(c).isalnum() else " " for c in range(128)]
    return "".join(kept).encode() + bytes(range(128, 256))


_TABLE = _letters()


def words_of(text: bytes | None) -> list[bytes]:
    """Runs of digits, letters and characters outside ASCII, A-Z lower-cased; NULL has none."""
    return (text or b"").translate(_TABLE).split()


class _Segment:
    """Documents gathered until they make a row of the index."""

    def __init__(self):
        self.ids: dict[bytes, int] = defaultdict(count().__next__)
        self.keys, self.lengths, self.starts, self.words = [], [], [], []
        self.size, self.end = 0, GAP  # a window around a document's first word may begin before it

    def add(self, key, text: bytes | None) -> None:
        words = words_of(text)
        self.keys.append(key)
        self.lengths.append(len(words))
        self.starts.append(self.end)
        self.words.append(np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words)))
        self.size += len(words)
        self.end += len(words) + GAP

    def row(self) -> dict:
        at = [np.arange(start, start + n) for start, n in zip(self.starts, self.lengths)]
        postings = (np.concatenate(self.words) << 32) | np.concatenate(at)
        postings.sort()
        term, position = postings >> 32, postings & 0xFFFFFFFF
        gaps = np.diff(position, prepend=0)
        first = np.diff(term, prepend=-1) != 0
        gaps[first] = position[first]  # a word's first posting is absolute, the others are distances
        return {
            "keys": self.keys,
            "lengths": self.lengths,
            "starts": self.starts,
            "terms": b" ".join(self.ids),
            "counts": np.bincount(term, minlength=len(self.ids)).astype("<i4").tobytes(),
            "gaps": gaps.astype("<i4").tobytes(),
        }


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored index of all documents: one row per segment. NULL and empty texts are documents without words."""
    send_package(docs.sparkSession)
    types = {
        "keys": f"array<{docs.schema[key].dataType.simpleString()}>",
        "lengths": "array<int>",
        "starts": "array<int>",
        "terms": "binary",
        "counts": "binary",
        "gaps": "binary",
    }

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        segment = _Segment()
        for batch in batches:
            of_key = pa.list_(batch.schema.field(0).type)
            kinds = [of_key, pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.binary()]
            schema = pa.schema(list(zip(types, kinds)))
            for each, value in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                segment.add(each, value.as_py())
                if segment.size >= SEGMENT_WORDS:
                    yield pa.RecordBatch.from_pylist([segment.row()], schema)
                    segment = _Segment()
        if segment.keys:
            yield pa.RecordBatch.from_pylist([segment.row()], schema)

    rows = docs.select(docs[key], docs[text]).mapInArrow(segments, ", ".join(f"{n} {k}" for n, k in types.items()))
    numbered = rows.withColumn("segment", F.monotonically_increasing_id())
    path = fresh_folder(docs.sparkSession, "postings")
    numbered.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(numbered.schema).parquet(path)


class Phrases:
    """The windows of one block of items: ``width`` consecutive words each, or all words of a shorter item."""

    def __init__(self, items: list[tuple[object, bytes | None]], width: int = WIDTH):
        self.vocabulary: dict[bytes, int] = defaultdict(count().__next__)
        self.items, windows = [], []
        for item, text in items:
            ids = [self.vocabulary[word] for word in words_of(text)]
            for at in range(max(len(ids) - width, 0) + 1 if ids else 0):
                windows.append(ids[at : at + width])
                self.items.append(item)
        self.vocabulary = dict(self.vocabulary)
        self.lengths = np.array([len(w) for w in windows], np.int64)
        self.terms = np.array([w + [-1] * (width - len(w)) for w in windows], np.int64).reshape(-1, width)
        self.places = np.zeros_like(self.terms)

    def rarest_first(self, frequency: np.ndarray) -> None:
        """Orders each window's words by their postings in the corpus; ``places`` keeps where they stand."""
        counts = np.where(self.terms < 0, np.iinfo(np.int64).max, frequency[self.terms])
        order = np.argsort(counts, axis=1, kind="stable")
        self.terms, self.places = np.take_along_axis(self.terms, order, 1), order


def _dictionary(terms: bytes, vocabulary: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers in the segment and in the vocabulary of the words that both have."""
    found = [(i, vocabulary[word]) for i, word in enumerate(terms.split()) if word in vocabulary]
    return tuple(np.array(found, np.int64).reshape(-1, 2).T)


def _frequencies(index: DataFrame, vocabulary: dict[bytes, int]) -> np.ndarray:
    """Postings in the corpus of each word of the vocabulary: one row per word and task, summed up."""
    known = index.sparkSession.sparkContext.broadcast(vocabulary)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(known.value), np.int64)
        for batch in batches:
            for terms, counts in zip(*(column.to_pylist() for column in batch.columns)):
                local, term = _dictionary(terms, known.value)
                total[term] += np.frombuffer(counts, "<i4")[local]
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], ["term", "n"])

    sums = index.select("terms", "counts").mapInArrow(counted, "term long, n long").groupBy("term").agg(F.sum("n"))
    frequency = np.zeros(max(len(vocabulary), 1), np.int64)
    for term, n in sums.collect():  # at most the block's vocabulary
        frequency[term] = n
    return frequency


def search(segment: dict, phrases: Phrases, slop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Matches in a segment: window, position of its start, position of its rarest word (which is in the match's document
    although a near match may start before it), and whether each word stands exactly in its place."""
    local, term = _dictionary(segment["terms"], phrases.vocabulary)
    none = np.zeros(0, np.int64)
    if not len(term) or not len(phrases.terms):
        return none, none, none, none.astype(bool)
    counts = np.frombuffer(segment["counts"], "<i4").astype(np.int64)
    begins = np.cumsum(counts) - counts
    gaps = np.frombuffer(segment["gaps"], "<i4")
    by_term = np.argsort(term)
    lists = [np.cumsum(gaps[begins[i] : begins[i] + counts[i]], dtype=np.int64) for i in local[by_term]]
    size = np.zeros(len(phrases.vocabulary) + 1, np.int64)  # the last one stands for no word, at -1
    size[term] = counts[local]
    starts = np.cumsum(size) - size
    positions = np.concatenate(lists)
    span = int(positions.max()) + 2 * GAP
    postings = np.repeat(np.sort(term), size[np.sort(term)]) * span + positions

    whole = np.flatnonzero(np.all((size[phrases.terms] > 0) | (phrases.terms < 0), axis=1))
    rarest = phrases.terms[whole, 0]
    window = np.repeat(whole, size[rarest])
    within = np.arange(len(window)) - np.repeat(np.cumsum(size[rarest]) - size[rarest], size[rarest])
    anchor = positions[np.repeat(starts[rarest], size[rarest]) + within]
    start = anchor - phrases.places[window, 0]
    exact = np.ones(len(window), bool)
    for k in range(1, phrases.terms.shape[1]):
        word = phrases.terms[window, k]
        wanted = word * span + start + phrases.places[window, k]
        at = np.searchsorted(postings, wanted - slop)
        near = (at < len(postings)) & (postings[np.minimum(at, len(postings) - 1)] <= wanted + slop)
        if slop:
            at = np.searchsorted(postings, wanted)
            exact &= (word < 0) | ((at < len(postings)) & (postings[np.minimum(at, len(postings) - 1)] == wanted))
        near |= word < 0
        window, start, anchor, exact = window[near], start[near], anchor[near], exact[near]
    return window, start, anchor, exact


def _united(begin: np.ndarray, end: np.ndarray) -> list[dict]:
    """Spans with those that touch or overlap united."""
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    new = np.r_[True, begin[1:] > end[:-1]]
    last = np.r_[np.flatnonzero(new)[1:] - 1, len(begin) - 1]
    return [{"start": int(b), "stop": int(e)} for b, e in zip(begin[new], end[last])]


def _matches(index: DataFrame, phrases: Phrases, slop: int, item_type: T.DataType) -> DataFrame:
    """Documents with matches: their items, exact and near, and the spans of words in exact ones."""
    asked = index.sparkSession.sparkContext.broadcast(phrases)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = asked.value
        for batch in batches:
            rows = []
            for segment in batch.to_pylist():
                window, start, anchor, exact = search(segment, phrases, slop)
                document = np.searchsorted(np.array(segment["starts"]), anchor, side="right") - 1
                for ordinal in np.unique(document):
                    here = document == ordinal
                    sure = here & exact
                    first = segment["starts"][ordinal]
                    rows.append(
                        {
                            "segment": segment["segment"],
                            "ordinal": int(ordinal),
                            "items": list({phrases.items[w] for w in window[sure]}),
                            "near_items": list({phrases.items[w] for w in window[here]}),
                            "spans": _united(start[sure] - first, start[sure] - first + phrases.lengths[window[sure]])
                            if sure.any()
                            else [],
                        }
                    )
            yield pa.RecordBatch.from_pylist(rows, arrow)

    span = T.StructType([T.StructField(name, T.IntegerType()) for name in ("start", "stop")])
    result = T.StructType(
        [
            T.StructField("segment", T.LongType()),
            T.StructField("ordinal", T.IntegerType()),
            T.StructField("items", T.ArrayType(item_type)),
            T.StructField("near_items", T.ArrayType(item_type)),
            T.StructField("spans", T.ArrayType(span)),
        ]
    )
    arrow = to_arrow_schema(result)
    return index.select("segment", "starts", "terms", "counts", "gaps").mapInArrow(found, result)


def phrase_matches(
    index: DataFrame,
    items: DataFrame,
    item: str = "item_id",
    text: str = "text",
    width: int = WIDTH,
    slop: int = SLOP,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per document with a match: ``segment``, ``ordinal``, ``items``, ``near_items`` and ``spans``.

    ``items`` are those of which a window occurs word by word, ``near_items`` those of which the words of a window stand
    at most ``slop`` from their places around its rarest word; ``spans`` are the words [start, stop) in exact matches.
    Items are asked in as many blocks as their size takes; any number of items and any text is searched in full.
    """
    send_package(index.sparkSession)
    asked = items.select(F.col(item).alias("item"), F.col(text).cast("binary").alias("text"))
    total = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = total // (6 * block_words) + 1
    numbered = asked.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    kind = asked.schema["item"].dataType
    parts = []
    for block in range(blocks):
        rows = numbered.where(F.col("block") == block).select("item", "text").distinct().collect()
        phrases = Phrases([tuple(row) for row in rows], width)
        phrases.rarest_first(_frequencies(index, phrases.vocabulary))
        parts.append(_matches(index, phrases, slop, kind))
    everything = parts[0]
    for part in parts[1:]:
        everything = everything.unionByName(part)
    if blocks == 1:
        return everything
    return everything.groupBy("segment", "ordinal").agg(
        *[F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in ("items", "near_items", "spans")]
    )


def contamination(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", share: int = 20
) -> DataFrame:
    """One row per document: its key, ``n_words``, ``n_hit`` words in exact matches, ``items``, ``near_items`` and
    ``contaminated``: at least one word in ``share`` is hit.

    A NULL or empty text has no words and is clean; repeated rows stay separate; without items all documents are clean;
    other columns of either table play no part.
    """
    index = build_index(docs, key, text)
    lengths = index.select("segment", F.posexplode(F.arrays_zip("keys", "lengths")).alias("ordinal", "document"))
    matched = phrase_matches(index, items, item, text).withColumn(
        "n_hit",
        F.size(
            F.array_distinct(
                F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["stop"] - F.lit(1))))
            )
        ).cast("long"),
    )
    none = F.array().cast(matched.schema["items"].dataType)
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    n_words = F.col("document.lengths").cast("long")
    return lengths.join(matched, ["segment", "ordinal"], "left").select(
        F.col("document.keys").alias(key),
        n_words.alias("n_words"),
        n_hit.alias("n_hit"),
        F.coalesce("items", none).alias("items"),
        F.coalesce("near_items", none).alias("near_items"),
        ((n_hit > 0) & (share * n_hit >= n_words)).alias("contaminated"),
    )
