import random
import re

import pytest

import edge
from sedimenta.llm import queries, repetition

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text, least):
    words = WORD.findall(text or "")
    n, longest = len(words), []
    for i in range(n):
        best = 0
        for j in range(n):
            k = 0
            while i != j and i + k < n and j + k < n and words[i + k] == words[j + k]:
                k += 1
            best = max(best, k)
        longest.append(best)
    covered, windows = set(), set()
    for i, length in enumerate(longest):
        covered |= set(range(i, i + length)) if length >= least else set()
        windows |= {i, i + 1, i + 2} if length >= 3 else set()
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return {
        "n_words": n,
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": sum(line in lines[:i] for i, line in enumerate(lines)),
        "n_repeat_words": len(windows),
        "covered_words": len(covered),
        "longest_repeat": max(longest, default=0),
    }


def small_texts():
    draw = random.Random(3)
    words = ["ab", "cd", "é#", "日|", "<x>"]
    make = lambda n: draw.choice([" ", "\n", " \t"]).join(draw.choices(words[: draw.randint(1, 5)], k=n))
    return [None, "", " \n ", "\x0b\x0c", *[make(draw.randint(0, 70)) for _ in range(120)]]


@pytest.mark.parametrize("block", [1, 100, 1 << 17])
def test_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(repetition, "BLOCK", block)
    texts = small_texts()
    df = edge.frame(spark, [(i, text, None, None, None) for i, text in enumerate(texts)])
    for row in repetition.measure(edge.clashing(df, "repetition", "n_words"), least=4).collect():
        found = row.repetition.asDict()
        spans = found.pop("spans")
        assert found == brute(row.text, 4)
        assert sum(span.stop - span.start for span in spans) == found["covered_words"]


def test_long_text_of_one_word():
    found = repetition.measured([b"word " * 200_000])[0]
    assert found["longest_repeat"] == 199_999 and found["n_repeat_words"] == 200_000


def test_query(spark, tmp_path):
    phrase = edge.prose(8, 60)
    data = [row for row in edge.rows() if len(row[1] or "") < 2000]
    data += [(20, phrase + " " + edge.prose(9, 400) + " " + phrase, None, None, None), (21, edge.prose(10, 90), None, None, None)]
    folder = edge.folder_of(edge.frame(spark, data), tmp_path / "in")
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    want = []
    for doc_id, text, *_ in data:
        found = brute(text, repetition.LEAST_WORDS)
        failed = found["n_words"] < 50 or 100 * found["n_repeat_words"] > 50 * found["n_words"]
        bad = found["covered_words"] > 0.3 * found["n_words"] or found["longest_repeat"] > repetition.LONGEST
        want.append((doc_id, *[found[name] for name in base], failed, not failed and not bad))
    out = queries.op3_repetition(spark, folder).select("doc_id", *base, "base_failed", "kept").collect()
    assert sorted(map(tuple, out), key=str) == sorted(want, key=str)
    kept = {row[0]: row[-1] for row in want}
    assert kept[21] and not kept[20]


def test_empty_table(spark):
    assert repetition.measure(edge.frame(spark, [])).count() == 0
