"""Collocations: phrases of two to four words that keep together more than their parts do, per language.

Only the longest windows are counted: from each word on, it and the next three, padded where the piece ends. Every
shorter phrase is a prefix of windows, so ROLLUP over the window's columns sums the counts of all orders, and of the
language, at once; nothing is counted order by order.

A window is padded earlier where it holds no frequent phrase: every part of a phrase is at least as frequent as the
phrase, so a window goes on only as long as it and its parts are frequent, and a rare word counts towards the language
only. How often windows of each length occur in the whole corpus is asked beforehand, by short hashes (``blocks``); a
hash that several share can only leave a window longer. What is counted is therefore about as much as there are frequent
phrases, whatever the size of the corpus, and windows are added up per block before they are sent.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sedimenta.llm.blocks import Dealt, buckets_for, noted, opened, packed, with_levels
from sedimenta.llm.store import stored

#: Words of the longest phrase, occurrences of a candidate, percent of a candidate's occurrences within a longer one
#: that drop it, and how many are returned for a language.
ORDER = 4
LEAST = 30
WITHIN = 80
TOP = 2000
UNKNOWN = "und"
SCALE = 2_000_000
#: Bytes of a window's hash beside its bucket. A rare window passes for a frequent one if it shares them with one.
HASH_BYTES = 3
_BREAK = b"."
# Bytes: A-Z to a-z, what ends a piece to a full stop, a tab to a space.
_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else _BREAK[0] if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c for c in range(256)
)
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ values >> np.uint64(32)) * _MIX[0]
    return values ^ values >> np.uint64(29)


class Words:
    """A block's words as numbers, 0 between pieces, with the language of each."""

    def __init__(self, table: pa.Table):
        import xxhash

        numbers: dict[bytes, int] = defaultdict(count().__next__)
        numbers[_BREAK]
        languages: dict[str, int] = defaultdict(count().__next__)
        lists, codes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for language, text in zip(table.column(0).to_pylist(), table.column("text").to_pylist()):
            found = (text or b"").translate(_BYTES).replace(_BREAK, b" . ").split()
            lists.append(np.fromiter(map(numbers.__getitem__, chain(found, (_BREAK,))), np.int64, len(found) + 1))
            codes.append(np.full(len(found) + 1, languages[language]))
        self.word, self.language = np.concatenate(lists), np.concatenate(codes)
        self.words, self.languages = list(numbers), list(languages)
        own = np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, len(self.words))
        of = np.fromiter((xxhash.xxh64_intdigest(name) for name in self.languages), np.uint64, len(self.languages))
        # Where a window of each length begins, and its hash, made of that of the window that is a word shorter.
        self.at, hashes = [np.flatnonzero(self.word)], []
        whole = _mixed(own[self.word] + of[self.language] * _MIX[1])
        hashes.append(whole[self.at[0]])
        for lead in range(1, ORDER):
            at = self.at[-1]
            at = at[self.word[at + lead] != 0]  # the last word is followed by a break
            whole[at] = _mixed(whole[at] * _MIX[2] + own[self.word[at + lead]])
            self.at.append(at)
            hashes.append(whole[at])
        self.hashes = np.concatenate(hashes)

    def windows(self, levels: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """Distinct longest windows: language, the words (0: none) and how often each occurs."""
        first = self.at[0]
        frequent = np.zeros((ORDER, len(self.word) + 1), bool)
        begin = 0
        for known, at in zip(frequent, self.at):
            known[at] = levels[begin : begin + len(at)] > 0
            begin += len(at)
        there = frequent[0][first]
        columns = [np.where(there, self.word[first], 0)]
        for lead in range(1, ORDER):
            # Both parts that are a word shorter are frequent too; the first one is by what came before.
            there = there & frequent[lead][first]
            rest = first[there] + 1
            there[there] = frequent[lead - 1][rest]
            word = np.zeros(len(first), np.int64)
            word[there] = self.word[first[there] + lead]
            columns.append(word)
        language = self.language[first]
        order = np.lexsort([*columns[::-1], language])
        keys = np.stack([language, *columns])[:, order]
        new = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)][: len(order)])
        language, *columns = keys[:, new]
        return language, columns, np.diff(np.r_[new, len(order)])


def longest_windows(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST) -> DataFrame:
    """``lang``, ``w1`` to ``w4`` and ``n``: how often a longest window occurs, NULL where it is padded. Rows of several
    blocks are not yet added up."""
    named = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("_lang"), F.col(text).alias("text"))
    blocks = packed(named, "_lang")
    buckets = buckets_for(blocks)
    notes = with_levels(blocks, lambda table: Words(table).hashes, (least,), buckets, HASH_BYTES)
    names = [f"w{nth}" for nth in range(1, ORDER + 1)]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload, note in zip(batch.column("payload"), batch.column("notes")):
                found = Words(opened(payload))
                language, columns, n = found.windows(Dealt(found.hashes, buckets, HASH_BYTES).levels(note.as_py()))
                words = pa.array([None, *found.words[1:]], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found.languages, pa.string()).take(pa.array(language)),
                        *[words.take(pa.array(column)) for column in columns],
                        pa.array(n, pa.int64()),
                    ],
                    ["lang", *names, "n"],
                )

    schema = ", ".join(["lang string", *[f"{name} string" for name in names], "n long"])
    return noted(blocks, notes).mapInArrow(counted, schema)


def frequencies(windows: DataFrame, least: int = LEAST) -> DataFrame:
    """Stored ``lang``, ``phrase``, ``words`` (how many) and ``f`` of all phrases with at least ``least`` occurrences, and
    as a phrase of no words all words of each language."""
    names = [f"w{nth}" for nth in range(1, ORDER + 1)]
    top = windows.groupBy("lang", *names).agg(F.sum("n").alias("n"))
    summed = top.rollup("lang", *names).agg(F.sum("n").alias("f"), F.grouping_id().alias("_rolled"))
    # The bits of the grouping number that are set are the columns that were rolled up; padding is no phrase.
    whole = [
        (F.col("_rolled") == (1 << ORDER - words) - 1) & (F.col(f"w{words}").isNotNull() if words else F.lit(True))
        for words in range(ORDER + 1)
    ]
    words = F.coalesce(*[F.when(is_whole, F.lit(words)) for words, is_whole in enumerate(whole)])
    found = summed.select("lang", F.concat_ws(" ", *names).alias("phrase"), words.alias("words"), "f")
    return stored(found.where((F.col("words") == 0) | (F.col("words") > 0) & (F.col("f") >= least)), "phrases")


def _exact(name: str) -> Column:
    return F.col(name).cast("decimal(20,0)")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, within: int = WITHIN, top: int = TOP
) -> DataFrame:
    """The ``top`` phrases of each language by score: ``lang``, ``rank``, ``phrase``, its occurrences ``a``, those of the
    two parts of its weakest cut ``l`` and ``r``, all words of the language ``n``, and the ``score``.

    Score: ``SCALE`` times a / (l + r), rounded down, of the cut for which it is lowest, the first one of equals. A
    candidate is dropped if a longer one holds it in at least ``within`` percent of its occurrences. Equal scores go by
    occurrences, then by the phrase's bytes. NULL texts are empty, a NULL language is ``und``; repeated rows count as
    often as they come. No text gives no rows. Other columns play no part.
    """
    phrases = frequencies(longest_windows(docs, text, lang, least), least)
    parts = phrases.where("words > 0").select("lang", "phrase", "f")
    candidates = phrases.where("words > 1").withColumnRenamed("f", "a")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang",
        "phrase",
        "a",
        "k",
        F.expr("substring_index(phrase, ' ', k)").alias("_first"),
        F.expr("substring_index(phrase, ' ', k - words)").alias("_rest"),
    )
    for side, out in (("_first", "l"), ("_rest", "r")):
        found = parts.select("lang", F.col("phrase").alias(side), F.col("f").alias(out))
        cuts = cuts.join(found, ["lang", side])
    cuts = cuts.withColumns({name: _exact(name) for name in ("a", "l", "r")})
    scored = cuts.withColumn("score", F.expr(f"(cast({SCALE} as decimal(7,0)) * a) div (l + r)"))
    weakest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("_cut"))

    words = F.split("phrase", " ")
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("words") - 1),
            lambda size: F.transform(
                F.sequence(F.lit(1), F.col("words") - size + 1), lambda at: F.array_join(F.slice(words, at, size), " ")
            ),
        )
    )
    longer = candidates.where("words > 2").select("lang", F.explode(inner).alias("phrase"), "a")
    most = longer.groupBy("lang", "phrase").agg(F.max("a").alias("_longer"))
    dropped = _exact("_longer") * 100 >= F.col("a") * within
    kept = weakest.join(most, ["lang", "phrase"], "left").where(~F.coalesce(dropped, F.lit(False)))

    order = Window.partitionBy("lang").orderBy(F.desc("_cut.score"), F.desc("a"), F.asc("phrase"))
    best = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    totals = phrases.where("words = 0").select("lang", F.col("f").alias("n"))
    return best.join(totals, "lang").select(
        "lang",
        F.col("rank").cast("long").alias("rank"),
        "phrase",
        *[F.col(column).cast("long").alias(name) for name, column in (("a", "a"), ("l", "_cut.l"), ("r", "_cut.r"))],
        "n",
        F.col("_cut.score").alias("score"),
    )
