"""Quality classifier from weak labels.

Overlapping heuristics vote good, bad or nothing on every text. Expectation-maximisation over the counts of all vote
patterns, which are counted over the whole corpus, estimates how often each heuristic says what about good and bad
texts, and how many texts are good. The posterior of a text's votes is its weak label. Weak labels train a linear scorer
over hashed features (n-grams of characters and of their classes, and the heuristics' measures in steps), which then
scores every whole text: it generalises over texts on which few heuristics vote.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.store import send_package, stored, without

#: Texts, of at most so many characters, that the scorer is trained on.
SAMPLE_ROWS = 4_000
SAMPLE_CHARS = 50_000
BUCKETS = 1 << 17
EPOCHS = 6
ROUNDS = 100
#: What heuristics are taken to vote (-, 0, +) on bad and on good texts before anything is seen, and how much that counts
#: beside the corpus: good texts rarely get a vote against them, and no heuristic sees every flaw.
EXPECTED = ((0.35, 0.25, 0.4), (0.02, 0.18, 0.8))
STRENGTH = 0.1
KEPT_FROM = 0.5
_BLOCK = 1 << 18
_SYMBOLS = b"#*$%&|<>!~^={}@"
_WHITE = bytes([32, *range(9, 14)])
_CONTINUED = bytes(range(0x80, 0xC0))
_UPPER = bytes(range(65, 91))
_LETTERS = bytes([*range(65, 91), *range(97, 123), *range(0xC0, 0x100)])
#: Letters as a or A, digits as 0; white space as one character; other characters as they are.
_CLASSES = bytes(
    32 if c in _WHITE else 48 if 48 <= c <= 57 else 65 if c in _UPPER else 97 if c in _LETTERS or c >= 0x80 else c
    for c in range(256)
)
# Words that are one mark or end in two, among classes of characters.
_LOOSE = re.compile(rb"(?:(?<![^ ])[^Aa0 ]|[^Aa0 ]{2})(?![^ ])")


def measures(text: bytes) -> dict[str, float]:
    """What the heuristics look at, of a whole text."""
    words = text.split()
    lines = [line.strip() for line in text.split(b"\n") if line.strip()]
    n, letters = len(words), len(text) - len(text.translate(None, _LETTERS))
    upper = len(text) - len(text.translate(None, _UPPER))
    return {
        "words": n,
        "word_length": len(text.translate(None, _WHITE + _CONTINUED)) / max(n, 1),
        "symbols": (len(text) - len(text.translate(None, _SYMBOLS))) / max(n, 1),
        "letters": letters / max(len(text.translate(None, _WHITE + _CONTINUED)), 1),
        "upper": upper / max(letters, 1),
        "repeated_lines": 1 - len(set(lines)) / max(len(lines), 1),
        "distinct": len(set(words)) / max(n, 1) ** 0.8,
        "stutter": sum(map(eq, words, words[1:])) / max(n, 1),
        "pairs": len(set(zip(words, words[1:]))) / max(n - 1, 1),
        "top_word": max(Counter(words).values(), default=0) / max(n, 10),
        "loose": len(_LOOSE.findall(text.translate(_CLASSES))) / max(n, 1),
        "ended": sum(line[-1] in b".!?:;\"')" for line in lines) / max(len(lines), 1),
    }


#: Words from which shares of a text can speak against it.
JUDGED_FROM = 16
#: Per heuristic: measure, from and to where it votes good, from and to outside which it votes bad.
HEURISTICS = (
    ("words", 60, 1e9, 20, 1e9),
    ("word_length", 3.0, 9.0, 2.0, 14.0),
    ("symbols", 0.0, 0.03, 0.0, 0.2),
    ("letters", 0.93, 1.0, 0.85, 1.0),
    ("upper", 0.0, 0.15, 0.0, 0.5),
    ("repeated_lines", 0.0, 0.05, 0.0, 0.3),
    ("distinct", 0.8, 1e9, 0.5, 1e9),
    ("stutter", 0.0, 0.02, 0.0, 0.1),
    ("pairs", 0.75, 1.0, 0.5, 1.0),
    ("top_word", 0.0, 0.12, 0.0, 0.3),
    ("loose", 0.0, 0.03, 0.0, 0.15),
    ("ended", 0.7, 1.0, 0.2, 1.0),
)


def votes(found: dict[str, float]) -> str:
    """One of + (good), - (bad) and 0 (nothing) per heuristic."""
    out = []
    for name, good_from, good_to, bad_below, bad_above in HEURISTICS:
        x = found[name]
        bad = (x < bad_below or x > bad_above) and (name == "words" or found["words"] >= JUDGED_FROM)
        out.append("+" if good_from <= x <= good_to else "-" if bad else "0")
    return "".join(out)


@dataclass(frozen=True)
class LabelModel:
    prior: float
    accuracies: np.ndarray  # heuristic, class (bad, good), vote (-, 0, +)

    def posterior(self, pattern: str) -> float:
        """The chance that a text with these votes is good."""
        log = np.log([1 - self.prior, self.prior])
        for table, vote in zip(self.accuracies, pattern):
            log = log + np.log(table[:, "-0+".index(vote)])
        p = np.exp(log - log.max())
        return float(p[1] / p.sum())


def estimate(patterns: dict[str, int], rounds: int = ROUNDS) -> LabelModel:
    """Expectation-maximisation over vote patterns and their counts; begun with texts as bad that two
    heuristics vote against."""
    m = len(HEURISTICS)
    names = sorted(patterns)
    counts = np.array([patterns[name] for name in names], float)
    vote = np.array([["-0+".index(v) for v in name] for name in names], int).reshape(-1, m)
    against = (vote == 0).sum(axis=1)
    good = np.where(against > 1, 0.1, np.where(against == 1, 0.6, 0.95))
    for _ in range(rounds):
        weights = np.stack([(1 - good) * counts, good * counts])
        prior = np.clip((weights[1].sum() + 1) / (counts.sum() + 2), 0.01, 0.99)
        tables = np.empty((m, 2, 3))
        for j in range(m):
            for c in range(2):
                tables[j, c] = np.bincount(vote[:, j], weights[c], minlength=3)
                tables[j, c] += (1 + STRENGTH * weights[c].sum()) * np.array(EXPECTED[c])
        tables /= tables.sum(axis=2, keepdims=True)
        log = np.log([1 - prior, prior]) + np.log(tables)[np.arange(m), :, vote].sum(axis=1)
        good = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -700, 700)))
    return LabelModel(float(prior), tables)


def _grams(text: bytes) -> Iterator[list[np.ndarray]]:
    """Buckets of the n-grams of a text's bytes, and of their classes, block by block."""
    for salt, size, stream in ((1, 4, text), (2, 5, text.translate(_CLASSES))):
        codes = np.frombuffer(stream, np.uint8)
        blocks = []
        for at in range(0, len(codes) - size + 1, _BLOCK):
            part = codes[at : at + _BLOCK + size - 1].astype(np.uint32)
            mixed = np.full(len(part) - size + 1, salt, np.uint32)
            for k in range(size):
                mixed = (mixed ^ part[k : k + len(mixed)]) * np.uint32(16777619)
            blocks.append((mixed ^ (mixed >> np.uint32(13))) & np.uint32(BUCKETS - 1))
        if blocks:
            yield blocks


def _steps(found: dict[str, float]) -> np.ndarray:
    """A bucket for each measure and the step that it is in."""
    steps = [min(int(np.log2(1 + found["words"])), 20)] + [min(int(found[name] * 10), 150) for name, *_ in HEURISTICS[1:]]
    return np.array([(j * 1009 + step * 31 + 7) * 2654435761 % BUCKETS for j, step in enumerate(steps)])


def features(text: bytes, found: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and shares: n-grams share one unit per kind, each stepped measure has one."""
    bucket, share = [], []
    for blocks in _grams(text):
        there, n = np.unique(np.concatenate(blocks), return_counts=True)
        bucket.append(there)
        share.append(n / n.sum())
    steps = _steps(found)
    return np.concatenate([*bucket, steps]), np.concatenate([*share, np.ones(len(steps))])


def train(texts: list[bytes], labels: list[float], seed: int = 3) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic scorer, by stochastic gradient descent on labels between 0 and 1."""
    rng = np.random.default_rng(seed)
    rows = [features(text, measures(text)) for text in texts]
    weights, bias = np.zeros(BUCKETS), 0.0
    mean = np.clip(np.mean(labels) if labels else 0.5, 0.05, 0.95)
    for epoch in range(EPOCHS):
        rate = 0.3 * (1 - epoch / EPOCHS)
        for i in rng.permutation(len(rows)):
            bucket, share = rows[i]
            p = 1 / (1 + np.exp(-np.clip(weights[bucket] @ share + bias, -30, 30)))
            # Rare classes count as much as frequent ones.
            step = rate * (labels[i] - p) * (0.5 / mean if labels[i] >= 0.5 else 0.5 / (1 - mean))
            np.add.at(weights, bucket, step * share)
            bias += 0.1 * step
    return weights, bias


def score(text: bytes, found: dict[str, float], weights: np.ndarray, bias: float) -> float:
    """The scorer's chance that a whole text is good: means of the n-grams' weights, and the measures' weights."""
    z = bias + weights[_steps(found)].sum()
    for blocks in _grams(text):
        z += sum(weights[block].sum() for block in blocks) / sum(map(len, blocks))
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def voted(docs: DataFrame, text: str = "text", into: str = "votes") -> DataFrame:
    """``docs`` with the heuristics' votes on each whole text; NULL counts as empty."""
    send_package(docs.sparkSession)

    @F.arrow_udf("string")
    def vote(texts: pa.Array) -> pa.Array:
        return pa.array([votes(measures(value.as_py() or b"")) for value in texts.cast(pa.binary())], pa.string())

    return without(docs, into).withColumn(into, vote(docs[text]))


def classify(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its key, ``votes``, ``weak_label`` (the posterior), ``quality`` (the scorer's, 0 to 1) and
    ``kept`` (quality of at least ``KEPT_FROM``).

    NULL texts count as empty; repeated rows stay apart; an empty table gives no rows; other columns play no part.
    Vote patterns (3 to the number of heuristics at most) come to the driver with their counts over all documents.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    patterns = stored(voted(rows).select("key", "votes"), "votes")
    counts = {row["votes"]: row["n"] for row in patterns.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()}
    model = estimate(counts)
    weak = {pattern: model.posterior(pattern) for pattern in counts}
    draw = F.pmod(F.xxhash64(F.lit(17), "key", "text"), F.lit(1 << 40))
    share = min(1.0, 0.9 * SAMPLE_ROWS / max(sum(counts.values()), 1))
    drawn = rows.where((F.length("text") <= SAMPLE_CHARS) & (draw < int((1 << 40) * share)))
    sample = sorted((row[0], row[1].encode()) for row in drawn.select(draw, "text").limit(SAMPLE_ROWS).collect())
    texts = [value for _, value in sample]
    fitted = train(texts, [weak.get(votes(measures(value)), 0.5) for value in texts])
    shared = spark.sparkContext.broadcast((weak, *fitted))
    kind = pa.struct([("votes", pa.string()), ("weak_label", pa.float64()), ("quality", pa.float64())])

    @F.arrow_udf("struct<votes: string, weak_label: double, quality: double>")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weak, weights, bias = shared.value
        for batch in batches:
            out = []
            for value in batch.cast(pa.binary()):
                text = value.as_py() or b""
                found = measures(text)
                pattern = votes(found)
                out.append(
                    {"votes": pattern, "weak_label": weak[pattern], "quality": score(text, found, weights, bias)}
                )
            yield pa.array(out, kind)

    done = rows.select(F.col("key").alias(key), scored(rows["text"]).alias("found"))
    return done.select(key, "found.*", (F.col("found.quality") >= KEPT_FROM).alias("kept"))
