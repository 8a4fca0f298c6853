"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text's vector is the mean of the embeddings of its subwords: the character n-grams of its lower-cased words, with
their boundaries, hashed into a fixed number of rows. Embeddings and softmax are trained together by stochastic gradient
descent in numpy. The scores are calibrated (a temperature fitted on texts that were not trained on), and texts whose
calibrated score is under a threshold learned from the same texts are rejected.

Since both layers are linear, a subword's embedding times the softmax matrix is one row of class scores. Prediction adds
up those rows over all subwords of a whole text, so it needs one pass and memory for a block of characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sedimenta.llm.store import send_package, without

UNKNOWN = "und"
#: Most labelled texts per language that the model is fitted on, and the length up to which texts are drawn for it.
SAMPLE_ROWS = 600
SAMPLE_CHARS = 50_000
SIZES = (2, 3, 4)
BUCKETS = 1 << 16
DIMENSIONS = 12
EPOCHS = 4
RATE = 0.5
#: Share of correctly predicted calibration texts that may be rejected, and the score from which none is.
REJECTED_SHARE = 0.001
SURE = 0.4
#: Characters whose subwords are in memory at once.
BLOCK = 1 << 18
_BOUNDARY = 32


def _folding() -> np.ndarray:
    """The lower-case letter of each character, or the boundary where it is no letter."""
    table = np.full(0x110000, _BOUNDARY, np.uint32)
    for code in range(0x110000):
        c = chr(code)
        if c.isalpha():
            table[code] = ord(low) if len(low := c.lower()) == 1 else code
    return table


_table: np.ndarray | None = None


def letters(text: str | None) -> np.ndarray:
    """A text's characters, folded, with a boundary at either end."""
    global _table
    if _table is None:
        _table = _folding()
    codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4")
    return np.concatenate([[_BOUNDARY], _table[codes], [_BOUNDARY]]).astype(np.uint32)


def subwords(folded: np.ndarray) -> Iterator[np.ndarray]:
    """Bucket of each n-gram that begins in a block and lies in one word with its boundaries."""
    for at in range(0, len(folded), BLOCK):
        part = folded[at : at + BLOCK + max(SIZES) - 1]
        edge = part == _BOUNDARY
        for size in SIZES:
            n = min(len(part) - size + 1, BLOCK)
            if n <= 0:
                continue
            mixed = np.full(n, size, np.uint32)
            inside = np.ones(n, bool)
            for k in range(size):
                mixed = (mixed ^ part[k : k + n]) * np.uint32(16777619)
                if 0 < k < size - 1:
                    inside &= ~edge[k : k + n]
            if size == 2:
                inside &= ~(edge[:n] & edge[1 : n + 1])
            yield ((mixed ^ (mixed >> np.uint32(15))) % np.uint32(BUCKETS))[inside]


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    scores: np.ndarray  # a subword's class scores: its embedding times the softmax matrix
    bias: np.ndarray
    temperature: float
    threshold: float

    def logits(self, text: str | None) -> np.ndarray | None:
        """Class scores of a whole text; None without a letter."""
        folded = letters(text)
        if (folded == _BOUNDARY).all():
            return None
        total, n = np.zeros(len(self.languages)), 0
        for bucket in subwords(folded):
            total += self.scores[bucket].sum(axis=0, dtype=np.float64)
            n += len(bucket)
        return total / max(n, 1) + self.bias

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, calibrated score, and whether it is rejected; unknown and rejected without a letter."""
        found = self.logits(text) if self.languages else None
        if found is None:
            return UNKNOWN, 0.0, True
        p = _softmax(found[None] / self.temperature)[0]
        best = int(p.argmax())
        return self.languages[best], float(min(max(p[best], 0.0), 1.0)), bool(p[best] < self.threshold)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and their shares."""
    bucket, n = np.unique(np.concatenate([np.zeros(0, np.uint32), *subwords(letters(text))]), return_counts=True)
    return bucket, n / max(n.sum(), 1)


def train(texts: list[str], labels: list[str], seed: int = 7) -> Model:
    """Fits the two layers on four fifths of the texts, and temperature and threshold on the rest."""
    languages = tuple(sorted(set(labels)))
    if not languages:
        return Model((), np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0, 0.0)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(texts))
    y = np.array([languages.index(label) for label in labels])
    x = [_features(text) for text in texts]
    held = order[: len(order) // 5]
    fit = [i for i in order[len(order) // 5 :] if len(x[i][0])]
    embeddings = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS))
    weights = np.zeros((DIMENSIONS, len(languages)))
    bias = np.zeros(len(languages))
    weight_of = len(labels) / len(languages) / np.maximum(np.bincount(y, minlength=len(languages)), 1)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for i in rng.permutation(fit):
            bucket, share = x[i]
            mean = share @ embeddings[bucket]
            slope = _softmax((mean @ weights + bias)[None])[0]
            slope[y[i]] -= 1
            slope *= rate * min(weight_of[y[i]], 5.0)
            back = weights @ slope
            weights -= np.outer(mean, slope)
            bias -= 0.1 * slope
            # A mean spreads the step thinly over the rows: each gets its share of it, scaled to the rows in use.
            embeddings[bucket] -= np.outer(share * min(len(bucket), 50), back)
    scores = embeddings @ weights
    raw = Model(languages, scores, bias, 1.0, 0.0)
    held = [i for i in held if len(x[i][0])] or fit
    if not held:
        return raw
    z = np.array([x[i][1] @ scores[x[i][0]] + bias for i in held])
    right = y[held]
    # Targets short of 1 by what so many texts can tell, so that faultless predictions don't count as certain.
    doubt = 1 / (len(held) + 2)
    target = np.full(z.shape, doubt / max(len(languages) - 1, 1))
    target[np.arange(len(z)), right] = 1 - doubt
    losses = [(-(target * np.log(_softmax(z / t) + 1e-12)).sum(), t) for t in np.geomspace(0.05, 20, 61)]
    temperature = float(min(losses)[1])
    p = _softmax(z / temperature)
    sure = p.max(axis=1)[p.argmax(axis=1) == right]
    threshold = min(float(np.quantile(sure, REJECTED_SHARE)), SURE) if len(sure) else 0.0
    return Model(languages, scores.astype(np.float32), bias, temperature, threshold)


def fold(key: str) -> Column:
    """One of five parts by the key's digits; part 0 is held out of all training."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", rows: int = SAMPLE_ROWS) -> Model:
    """A model from at most ``rows`` different labelled texts a language, of at most ``SAMPLE_CHARS`` characters, outside
    the held-out part, drawn evenly by a hash of the text.

    The texts are counted over the whole table first (by sketches of fixed size), so that only about as many as are
    wanted are shuffled, and no more reach the driver. Repeated rows and ids have no more weight than one. A NULL key is
    in no part and is not trained on; equal scores of two languages go to the one that sorts first.
    """
    labelled = docs.where(F.col(label).isNotNull() & (F.length(text) <= SAMPLE_CHARS) & (fold(key) != 0)).select(
        F.col(label).alias("label"), F.col(text).alias("text"), F.pmod(F.xxhash64(F.lit(11), F.col(text)), F.lit(1 << 40)).alias("draw")
    )
    sketched = labelled.groupBy("label").agg(F.approx_count_distinct("draw", 0.03))
    wanted = F.lit(False)
    for language, n in sorted(tuple(row) for row in sketched.collect()):  # one row per language
        cut = min(int((1 << 40) * 1.4 * rows / max(n, 1)), 1 << 40)
        wanted |= (F.col("label") == language) & (F.col("draw") < cut)
    order = Window.partitionBy("label").orderBy("draw", "text")
    different = labelled.where(wanted).distinct().withColumn("nth", F.row_number().over(order))
    drawn = sorted((row["label"], row["draw"], row["text"]) for row in different.where(F.col("nth") <= rows).collect())
    return train([value for _, _, value in drawn], [language for language, _, _ in drawn])


def identify(docs: DataFrame, model: Model, text: str = "text", into: str = "language") -> DataFrame:
    """``docs`` with a struct of ``lang``, ``score`` and ``rejected`` for each whole text.

    NULL and texts without a letter are ``und``, score 0, rejected. All rows and columns stay; a column named like
    ``into`` is replaced.
    """
    send_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    @F.arrow_udf("struct<lang: string, score: double, rejected: boolean>")
    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = [shared.value.predict(value.as_py()) for value in batch]
            yield pa.array([dict(zip(("lang", "score", "rejected"), row)) for row in rows], kind)

    return without(docs, into).withColumn(into, predicted(docs[text]))
