"""Spelling variants: words that differ by one letter, and the more frequent form that each leads to.

Words whose letters are counted in vectors differ by one inserted, deleted or replaced letter only if the vectors'
squared distance is at most two. Distances of all pairs in a block of words come from one product of the block's count
matrix with itself (its Gram matrix); the few pairs left are verified letter by letter.

A block holds words of two adjacent lengths that share a half: of two words that differ by one letter, the shorter of
them m letters long, either the first m // 2 letters or the last m - m // 2 are the same. A half that very many words
share is divided: its words are dealt into parts, and each pair of parts is a block of its own. What leaves a block is
one row per word with a near one, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.store import send_package, stored

#: Fewest occurrences and letters of a word; a form has so many times the occurrences of its variant.
LEAST = 3
SHORTEST = 5
TIMES = 2
LETTERS = "[A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words with the same half that are compared without dividing them, and words of small blocks compared at once.
MOST = 4096
TILE = 512
_CELLS = 1 << 22
_KINDS = 26 + 64


def vocabulary(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least: int = LEAST,
    shortest: int = SHORTEST,
    thinned: int | None = None,
) -> DataFrame:
    """``word`` and ``n``, its occurrences, of all words with at least ``least`` of them and ``shortest`` letters.

    Words are maximal runs of letters up to U+00FF, A-Z lower-cased. With ``thinned``, a run loses its letter number
    h % length if that number divides h, the CRC-32 of "key:run"; a NULL key is empty there. NULL and empty texts have
    no words, repeated rows count as often as they come.
    """
    run = F.translate("_run", _UPPER, _LOWER)
    found = docs.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_key"),
        F.explode(F.regexp_extract_all(text, F.lit(LETTERS), F.lit(0))).alias("_run"),
    )
    found = found.where(F.length("_run") >= shortest).select("_key", run.alias("word"))
    if thinned:
        found = found.withColumn("_h", F.crc32(F.concat("_key", F.lit(":"), "word").cast("binary")))
        at = F.col("_h") % F.length("word")
        rest = F.concat(
            F.substring(F.col("word"), F.lit(1), at.cast("int")), F.substring(F.col("word"), (at + 2).cast("int"), F.length("word"))
        )
        found = found.withColumn("word", F.when(F.col("_h") % thinned == 0, rest).otherwise(F.col("word")))
    counted = found.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where((F.col("n") >= least) & (F.length("word") >= shortest))


def _in_blocks(words: DataFrame) -> DataFrame:
    """``m``, ``block``, ``second`` (which of a block's two parts), ``tail`` (which half is shared), ``word``, ``n``: each
    word in its blocks."""
    size = F.length("word")
    roles = []
    for m in (size, size - 1):
        half = F.floor(m / 2).cast("int")
        head = F.substring(F.col("word"), F.lit(1), half)
        tail = F.right("word", m - half)
        roles += [F.struct(m.alias("m"), F.lit(t).alias("tail"), part.alias("part")) for t, part in ((False, head), (True, tail))]
    shared = words.select("word", "n", F.explode(F.array(*roles)).alias("_role")).select(
        "word", "n", "_role.m", "_role.tail", F.xxhash64("_role.m", "_role.tail", "_role.part").alias("_half")
    )
    many = stored(shared.groupBy("_half").agg(F.count(F.lit(1)).alias("_words")).where(F.col("_words") > MOST), "halves")
    parts = F.coalesce(F.ceil(F.col("_words") / MOST), F.lit(1)).cast("int")
    divided = shared.join(many, "_half", "left").withColumn("_parts", parts)
    divided = divided.withColumn("_part", F.pmod(F.xxhash64("word"), "_parts").cast("int"))
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("_parts") - 1),
        lambda other: F.struct(F.least("_part", other).alias("a"), F.greatest("_part", other).alias("b")),
    )
    dealt = divided.withColumn("_pair", F.explode(pairs))
    return dealt.select(
        "m",
        F.xxhash64("_half", "_pair.a", "_pair.b").alias("block"),
        (F.col("_pair.a") != F.col("_part")).alias("second"),
        (F.col("_pair.a") != F.col("_pair.b")).alias("across"),
        "tail",
        "word",
        "n",
    )


def _letters(words: list[bytes], size: int) -> np.ndarray:
    """A row of ``size`` letters for each word, zeros after its last."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    rows = np.zeros((len(words), size), np.uint8)
    rows[np.arange(size) < lengths[:, None]] = np.frombuffer(b"".join(words), np.uint8)
    return rows


def _counts(letters: np.ndarray) -> np.ndarray:
    """How often each word has each letter; exact in the products too."""
    row, _ = np.nonzero(letters)
    letter = letters[letters > 0].astype(np.int64)
    letter = np.where(letter < 128, letter - 97, letter - 192 + 26)
    counts = np.bincount(row * _KINDS + letter, minlength=len(letters) * _KINDS).reshape(-1, _KINDS)
    return counts.astype(np.float32 if letters.shape[1] < 1 << 11 else np.float64)


def close_pairs(block: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs within a block whose squared distance is at most two, each once, some rows of the Gram matrix at a time.

    ``block``: a number for each word, ascending.
    """
    square = (counts * counts).sum(axis=1)
    step = max(_CELLS // max(len(counts), 1), 1)
    for at in range(0, len(counts), step):
        end = int(np.searchsorted(block, block[min(at + step, len(counts)) - 1], "right"))
        gram = counts[at : at + step] @ counts[at:end].T
        distance = square[at : at + step, None] + square[at:end] - 2 * gram
        distance[block[at : at + step, None] != block[at:end]] = 3
        i, j = np.nonzero(distance <= 2)
        later = i < j
        yield i[later] + at, j[later] + at


def one_letter_apart(a: np.ndarray, b: np.ndarray, m: int) -> np.ndarray:
    """Whether rows of ``a`` (words of m letters) and ``b`` (words of m or m + 1) differ by exactly one letter."""
    longer = b[:, m] > 0
    same = a[:, :m] == b[:, :m]
    replaced = ~longer & ((~same).sum(axis=1) == 1)
    head = np.where(same.all(axis=1), m, same.argmin(axis=1))
    shifted = (a[:, :m] == b[:, 1 : m + 1]) | (np.arange(m) < head[:, None])
    return replaced | (longer & shifted.all(axis=1))


def near_in_blocks(
    m: int, block: np.ndarray, second: np.ndarray, across: np.ndarray, tail: np.ndarray, words: list[bytes], n: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows with near words, how many in their blocks, and the row of the most frequent one (the smallest of equals)."""
    letters = _letters(words, m + 1)
    long = letters[:, m] > 0
    near = np.zeros(len(words), np.int64)
    order = np.array(sorted(range(len(words)), key=lambda row: (-n[row], words[row])))
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    best = np.full(len(words), len(words))
    for i, j in close_pairs(block, _counts(letters)):
        wanted = ~(long[i] & long[j]) & (~across[i] | (second[i] != second[j]))
        i, j = i[wanted], j[wanted]
        step = max(_CELLS // (m + 1), 1)
        for at in range(0, len(i), step):
            a, b = i[at : at + step], j[at : at + step]
            a, b = np.where(long[a], b, a), np.where(long[a], a, b)
            apart = one_letter_apart(letters[a], letters[b], m)
            # Words that share both halves meet in two blocks and count in the first half's.
            half = m // 2
            apart &= ~tail[a] | (letters[a, :half] != letters[b, :half]).any(axis=1)
            a, b = a[apart], b[apart]
            for x, y in ((a, b), (b, a)):
                near += np.bincount(x, minlength=len(words))
                np.minimum.at(best, x, rank[y])
    rows = np.flatnonzero(near)
    return rows, near[rows], order[best[rows]]


def near_words(words: DataFrame) -> DataFrame:
    """``word``, ``n_near``, and ``near`` with the most frequent near word (``lead``, the smallest of equals) and its
    ``n``; only words that have one. ``words`` are distinct, with ``n``."""
    send_package(words.sparkSession)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole blocks of one length, several small ones at once; the last one of a batch may go on in the next."""
        rest: list[pa.RecordBatch] = []
        for batch in batches:
            rest.append(batch)
            table = pa.Table.from_batches(rest).combine_chunks()
            block = table.column("block").to_numpy()
            edge = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
            if len(edge) > 1:
                yield from tiles(table.slice(0, edge[-1]))
                rest = table.slice(edge[-1]).combine_chunks().to_batches()
        if rest:
            yield from tiles(pa.Table.from_batches(rest).combine_chunks())

    def tiles(table: pa.Table) -> Iterator[pa.RecordBatch]:
        m, block, n = (table.column(name).to_numpy() for name in ("m", "block", "n"))
        second, across, tail = (table.column(name).to_numpy(zero_copy_only=False) for name in ("second", "across", "tail"))
        words = table.column("word")
        edge = np.flatnonzero(np.r_[True, block[1:] != block[:-1], True][: len(block) + 1])
        at = 0
        while at < len(block):
            # Blocks up to a tile's size together, of one length; a larger block alone.
            last = np.searchsorted(edge, at + TILE, "right") - 1
            end = edge[max(last, np.searchsorted(edge, at, "right"))]
            end = min(end, int(np.searchsorted(m, m[at], "right")))
            part = slice(at, end)
            given = [word.encode("latin-1") for word in words.slice(at, end - at).to_pylist()]
            number = np.cumsum(np.r_[0, block[part][1:] != block[part][:-1]])
            rows, near, best = near_in_blocks(int(m[at]), number, second[part], across[part], tail[part], given, n[part])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([given[row].decode("latin-1") for row in rows.tolist()], pa.string()),
                    pa.array(near, pa.int64()),
                    pa.array(n[part][best], pa.int64()),
                    pa.array([given[row].decode("latin-1") for row in best.tolist()], pa.string()),
                ],
                ["word", "n_near", "n", "lead"],
            )
            at = end

    # A block has one length, so blocks of a length follow each other.
    dealt = _in_blocks(words).repartition("block").sortWithinPartitions("m", "block")
    found = dealt.mapInArrow(compared, "word string, n_near long, n long, lead string")
    return found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), "lead")).alias("_near")
    ).select("word", "n_near", F.struct((-F.col("_near.less")).alias("n"), F.col("_near.lead").alias("lead")).alias("near"))


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of ``word`` and ``form``: where the forms of forms end. No word comes back to itself.

    Each round follows twice as many forms as the one before, so that chains of k forms take about log2(k) rounds; since
    occurrences at least double with each form, these are six at most.
    """
    state = stored(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        further = state.select(F.col("word").alias("root"), F.col("root").alias("_further"))
        joined = state.join(further, "root", "left")
        state = stored(joined.select("word", F.coalesce("_further", "root").alias("root"), "_further"), "roots")
        if state.where(F.col("_further").isNotNull()).isEmpty():
            return state.drop("_further")
        state = state.drop("_further")


def spelling_variants(words: DataFrame) -> DataFrame:
    """``words`` (distinct ``word`` of letters up to U+00FF, lower-cased, and ``n``) with ``form``, ``root``, ``n_near``
    and ``form_n``.

    ``form`` is the most frequent word that differs by one letter (of equals the smallest), if it has at least ``TIMES``
    the occurrences; NULL otherwise. ``root`` is where the forms end, the word itself without one. No words give no rows.
    """
    words = stored(words.select("word", "n"), "vocabulary")
    near = stored(near_words(words), "near")
    joined = words.join(near, "word", "left")
    formed = F.col("near.n") >= TIMES * F.col("n")
    found = joined.select(
        "word",
        "n",
        F.when(formed, F.col("near.lead")).alias("form"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, F.col("near.n")).alias("form_n"),
    )
    found = stored(found, "variants")
    ends = roots(found.where(F.col("form").isNotNull()))
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
