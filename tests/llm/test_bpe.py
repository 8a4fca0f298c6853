import base64
import hashlib
import random
import re

import pytest
import tiktoken
from pyspark.sql import functions as F

import edge
from sedimenta.llm import bpe, queries


@pytest.fixture(scope="module")
def plain():
    path, pattern = bpe.installed_ranks()
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture
def codec():
    path, pattern = bpe.installed_ranks()
    with open(path, "rb") as lines:
        return bpe.Codec(lines.read(), pattern)


def test_cuts_do_not_change_ids(plain, codec, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 50)
    monkeypatch.setattr(bpe, "LONG_SPACE", 10)
    monkeypatch.setattr(bpe, "_LONG_RUN", re.compile(f"[{bpe._SPACE}]{{10,}}"))
    draw = random.Random(1)
    parts = ["a", "'s", " ", "  ", "\n", "　", "9", "é", "!", "x" * 30, " " * 12, "\x1c", " \n" * 8, "日本", "\t" * 11]
    for _ in range(1500):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 100)))
        assert codec.encode(text) == plain.encode_ordinary(text)
        assert codec.decode(codec.encode(text)) == text.encode()


def test_very_long_runs(codec):
    text = " " * 2_000_000 + "x" + "b" * 300_000
    assert codec.decode(codec.encode(text)) == text.encode()


def test_special_strings_are_ordinary_text(plain, codec):
    assert codec.encode("<|endoftext|>") == plain.encode_ordinary("<|endoftext|>")


def test_rows_and_round_trip(spark, plain):
    df = edge.clashing(edge.frame(spark), "ids", "decoded")
    out = bpe.decode(bpe.encode(df)).collect()
    assert len(out) == len(edge.rows())
    for row in out:
        assert list(row.ids) == plain.encode_ordinary(row.text or "")
        assert bytes(row.decoded) == (row.text or "").encode()


def test_bytes_that_are_no_text(spark):
    ids = spark.createDataFrame([([128],), ([],), (None,)], "ids array<int>")
    assert [len(row.decoded) for row in bpe.decode(ids).collect()] == [1, 0, 0]


def test_empty_table(spark):
    assert bpe.encode(edge.frame(spark, [])).count() == 0


def test_query(spark, plain, tmp_path):
    out = queries.op10_byte_bpe(spark, edge.folder_of(edge.frame(spark), tmp_path / "in")).collect()
    digest = lambda value: hashlib.sha256(value).hexdigest()
    want = []
    for doc_id, text, *_ in edge.rows():
        ids = plain.encode_ordinary(text or "")
        want.append((doc_id, len(ids), digest(",".join(map(str, ids)).encode()), digest((text or "").encode())))
    assert sorted(map(tuple, out), key=str) == sorted(want, key=str)
