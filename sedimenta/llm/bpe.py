"""Byte-level BPE: token ids of whole texts, and the raw bytes of token ids.

The merges are the tiktoken library's, over a local rank file. Its pattern runs on a backtracking engine whose stack
long runs of white space overflow, and its time is best on texts of moderate length; so long texts are cut first, only
where no match of the pattern can cross:

* between a character that is no white space and a space: no alternative of the pattern goes on from one to the other,
  and none looks behind;
* around a run of white space that is too long for the engine: all of it but the last character is one match (all of it
  at the end of a text), which is encoded as a piece of its own.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.store import send_package, without

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Characters after which the next safe boundary is taken, and white space that the pattern's engine is spared.
CHUNK_CHARS = 1 << 17
LONG_SPACE = 1 << 13
# White space as Unicode has it, which the pattern's engine goes by; Python's \s has four characters more.
_SPACE = "\t-\r \x85\xa0  -     　"
_LONG_RUN = re.compile(f"[{_SPACE}]{{{LONG_SPACE},}}")
_BOUNDARY = re.compile(f"(?<=[^{_SPACE}]) ")


def installed_ranks(name: str = RANKS) -> tuple[str, str]:
    """Path of an installed rank file, and the pattern that splits texts for it."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


class Codec:
    """Encoder and decoder over the bytes of a rank file."""

    def __init__(self, rank_lines: bytes, pattern: str):
        import tiktoken

        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, rank_lines.splitlines())}
        self._ranks = ranks
        self._split = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def _whole(self):
        """For a text that is one match; few tasks ever need it."""
        import tiktoken

        return tiktoken.Encoding("piece", pat_str=r"(?s).+", mergeable_ranks=self._ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if len(text) < LONG_SPACE:
            return self._split.encode_ordinary(text)
        ids: list[int] = []
        at = 0
        for run in _LONG_RUN.finditer(text):
            stop = run.end() if run.end() == len(text) else run.end() - 1
            self._encode_chunks(text[at : run.start()], ids)
            ids += self._whole.encode_ordinary(text[run.start() : stop])
            at = stop
        self._encode_chunks(text[at:], ids)
        return ids

    def _encode_chunks(self, text: str, ids: list[int]) -> None:
        at = 0
        while at < len(text):
            cut = _BOUNDARY.search(text, at + CHUNK_CHARS) if len(text) - at > CHUNK_CHARS else None
            stop = cut.start() if cut else len(text)
            ids += self._split.encode_ordinary(text[at:stop])
            at = stop

    def decode(self, ids: list[int]) -> bytes:
        return self._split.decode_bytes(ids)


_NO_IDS = np.zeros(0, np.int32)
_codecs: dict[int, Codec] = {}


def _codec(rank_lines: bytes, pattern: str) -> Codec:
    """One codec per worker and rank file: building it takes longer than a batch."""
    key = hash((rank_lines, pattern))
    if key not in _codecs:
        _codecs[key] = Codec(rank_lines, pattern)
    return _codecs[key]


def _rank_lines(df: DataFrame, path: str):
    """The rank file read on the driver and sent along once: executors need no copy of it (under 1 MB, fixed)."""
    send_package(df.sparkSession)
    with open(path, "rb") as lines:
        return df.sparkSession.sparkContext.broadcast(lines.read())


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    """Arrays as one Arrow column, without a Python object per element."""
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([_NO_IDS, *rows])))


def encode(
    df: DataFrame, text: str = "text", ids: str = "ids", ranks: str | None = None, pattern: str | None = None
) -> DataFrame:
    """``df`` with the token ids of each whole text, special tokens as ordinary text.

    A NULL or empty text has no ids (an empty array). All rows and other columns stay as they are; a column named like
    ``ids`` is replaced. ``ranks`` is a rank file's path on the driver.
    """
    path, default = installed_ranks()
    lines, pattern = _rank_lines(df, ranks or path), pattern or default

    @F.arrow_udf("array<int>")
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(lines.value, pattern)
        for batch in batches:
            yield _lists([np.array(codec.encode(text.as_py() or ""), np.int32) for text in batch])

    return without(df, ids).withColumn(ids, encoded(df[text]))


def decode(
    df: DataFrame, ids: str = "ids", decoded: str = "decoded", ranks: str | None = None, pattern: str | None = None
) -> DataFrame:
    """``df`` with the raw bytes that the token ids stand for; NULL or no ids: no bytes. Bytes need not be UTF-8."""
    path, default = installed_ranks()
    lines, pattern = _rank_lines(df, ranks or path), pattern or default

    @F.arrow_udf("binary")
    def raw(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(lines.value, pattern)
        for batch in batches:
            # One text's ids at a time become Python integers: a whole batch of them takes ten times its bytes.
            lists = [each.values.to_numpy() if each.is_valid else _NO_IDS for each in batch]
            yield pa.array([codec.decode(ids.tolist()) for ids in lists], pa.binary())

    return without(df, decoded).withColumn(decoded, raw(df[ids]))
