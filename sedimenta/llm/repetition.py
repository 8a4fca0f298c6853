"""Quality rules on repetition, by suffix arrays over words.

The words of several texts are sorted as one suffix array, in which a word of one text differs from all of another, by
prefix doubling: suffixes that are already alone in their place drop out, so ordinary prose takes a few rounds. The
longest common prefix of neighbours follows from the ranks of the rounds. The deepest interval of common prefixes that
holds a suffix, and so the longest maximal repeat that begins there, is the larger of its two neighbours' values. The
spans of all maximal repeats of a minimum length are united; their share of the words and the longest repeat are limited.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.store import send_package, without

#: Words of a repeat that counts, the share of words that such repeats may cover, and words of the longest one allowed.
LEAST_WORDS = 8
MOST_COVERED = 0.3
LONGEST = 50
#: Base rules: fewest words, and percent of words in repeated windows of three.
FEWEST_WORDS = 50
WINDOW = 3
MOST_REPEATED = 50
SYMBOLS = b"#*$%&|<>"
#: Words sorted at once; a longer text is sorted alone.
BLOCK = 1 << 17
_NO_CHARACTER = bytes([32, *range(9, 14), *range(0x80, 0xC0)])  # white space, and bytes that continue a character

RESULT = (
    "struct<n_words: long, word_chars: long, n_symbols: long, n_dup_lines: long, n_repeat_words: long, "
    "covered_words: long, longest_repeat: long, spans: array<struct<start: int, stop: int>>>"
)
_SPAN = pa.struct([("start", pa.int32()), ("stop", pa.int32())])
_KIND = pa.struct(
    [(name, pa.int64()) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [("covered_words", pa.int64()), ("longest_repeat", pa.int64()), ("spans", pa.list_(_SPAN))]
)


def _ranked(key: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorts by ``key`` in groups of equal ``base``: the order, and in it the rank, which is the place in the suffix
    array of the first one with that key."""
    order = np.argsort(key)
    key, base = key[order], base[order]
    at = np.arange(len(key))
    group = np.maximum.accumulate(np.where(np.r_[True, base[1:] != base[:-1]], at, 0))
    same = np.maximum.accumulate(np.where(np.r_[True, key[1:] != key[:-1]], at, 0))
    return order, base + same - group


def repeats(words: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For each position the length of the longest run of words from there that its text has elsewhere too.

    ``words``: a number for each word, different in different texts; ``end``: for each position the end of its text.
    """
    n = len(words)
    order, rank_of = _ranked(words, np.zeros(n, np.int64))
    rank = np.empty(n, np.int64)
    rank[order] = rank_of
    levels = [(1, rank)]
    active, width = np.arange(n), 1
    while True:
        members = np.bincount(rank[active], minlength=n)
        active = active[members[rank[active]] > 1]
        if not len(active):
            break
        beyond = active + width
        second = np.where(beyond < end[active], rank[np.minimum(beyond, n - 1)] + 1, 0)
        order, rank_of = _ranked(rank[active] * (n + 1) + second, rank[active])
        rank = rank.copy()
        rank[active[order]] = rank_of
        width *= 2
        levels.append((width, rank))
    array = np.empty(n, np.int64)
    array[rank] = np.arange(n)
    left, right = array[:-1], array[1:]
    common = np.zeros(len(left), np.int64)
    pairs = np.arange(len(left))
    pairs = pairs[levels[0][1][left] == levels[0][1][right]]
    for width, rank in reversed(levels):
        a, b = left[pairs] + common[pairs], right[pairs] + common[pairs]
        inside = (a < end[left[pairs]]) & (b < end[right[pairs]])
        same = inside & (rank[np.minimum(a, n - 1)] == rank[np.minimum(b, n - 1)])
        common[pairs[same]] += width
    longest = np.zeros(n, np.int64)
    longest[left] = common
    longest[right] = np.maximum(longest[right], common)
    return longest


def _covered(longest: np.ndarray, least: int, width: np.ndarray) -> np.ndarray:
    """Positions in the ``width`` words from any position whose repeat has at least ``least``."""
    begin = np.flatnonzero(longest >= least)
    steps = np.bincount(begin, minlength=len(longest) + 1)
    np.subtract.at(steps, begin + width[begin], 1)
    return np.cumsum(steps)[:-1] > 0


def _spans(covered: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.r_[False, covered, False]))
    return [{"start": int(a), "stop": int(b)} for a, b in edges.reshape(-1, 2)]


def measured(texts: list[bytes], least: int = LEAST_WORDS) -> list[dict]:
    """Counts and repeats of texts whose words are sorted together."""
    ids: dict[bytes, int] = defaultdict(count().__next__)
    lists, rows = [], []
    for text in texts:
        words = text.split()  # at 09-0D and 20
        lists.append(np.fromiter(map(ids.__getitem__, words), np.int64, len(words)))
        lines = [line for line in text.split(b"\n") if line.strip()]
        rows.append(
            {
                "n_words": len(words),
                "word_chars": len(text.translate(None, _NO_CHARACTER)),
                "n_symbols": len(text) - len(text.translate(None, SYMBOLS)),
                "n_dup_lines": len(lines) - len(set(lines)),
                "n_repeat_words": 0,
                "covered_words": 0,
                "longest_repeat": 0,
                "spans": [],
            }
        )
    sizes = np.array([len(x) for x in lists], np.int64)
    if not sizes.sum():
        return rows
    ends = np.cumsum(sizes)
    text_of = np.repeat(np.arange(len(lists)), sizes)
    longest = repeats(text_of * len(ids) + np.concatenate(lists), np.repeat(ends, sizes))
    windows = _covered(longest, WINDOW, np.full(len(longest), WINDOW))
    covered = _covered(longest, least, longest)
    for row, begin, end in zip(rows, ends - sizes, ends):
        if begin < end:
            row["n_repeat_words"] = int(windows[begin:end].sum())
            row["longest_repeat"] = int(longest[begin:end].max())
            row["covered_words"] = int(covered[begin:end].sum())
            if row["covered_words"]:
                row["spans"] = _spans(covered[begin:end])
    return rows


def measure(docs: DataFrame, text: str = "text", into: str = "repetition", least: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with a struct of counts for each whole text: words, their characters, symbols, lines equal to an earlier
    one, words in repeated windows of three, words covered by repeats of at least ``least`` words, the longest repeat,
    and the covered spans (in words).

    NULL and blank texts have zeros and no spans. All rows and columns stay; a column named like ``into`` is replaced.
    """
    send_package(docs.sparkSession)

    @F.arrow_udf(RESULT)
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows, block, size = [], [], 0
            for value in batch.cast(pa.binary()):
                block.append(value.as_py() or b"")
                size += block[-1].count(b" ") + 1
                if size >= BLOCK:
                    rows += measured(block, least)
                    block, size = [], 0
            yield pa.array(rows + measured(block, least), _KIND)

    return without(docs, into).withColumn(into, counted(docs[text]))


def base_failed(found: Column) -> Column:
    """Too few words, or too many of them in repeated windows."""
    return (found["n_words"] < FEWEST_WORDS) | (100 * found["n_repeat_words"] > MOST_REPEATED * found["n_words"])


def repetitive(found: Column, most_covered: float = MOST_COVERED, longest: int = LONGEST) -> Column:
    """Repeats cover too large a share of the words, or one of them is too long."""
    return (found["covered_words"] > most_covered * found["n_words"]) | (found["longest_repeat"] > longest)
