import hashlib
import random
import re
from collections import Counter

import pytest

import edge
from sedimenta.llm import decontamination, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, width=13):
    """Words hit and items found, by sliding every window over the text."""
    own, hit, found = words(text), set(), set()
    for item, item_text in items:
        w = words(item_text)
        n = min(width, len(w))
        for at in range(len(w) - n + 1 if n else 0):
            window = w[at : at + n]
            for i in range(len(own) - n + 1):
                if own[i : i + n] == window:
                    hit |= set(range(i, i + n))
                    found.add(item)
    return len(own), len(hit), found


def cases():
    draw = random.Random(4)
    vocabulary = ["the", "of", "é", "日本", "a1", *(f"w{i}" for i in range(40))]
    make = lambda n: [draw.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(make(draw.randint(1, 40)))) for i in range(12)] + [(90, None), (91, " - "), (3, "the OF")]
    docs = []
    for i in range(60):
        text = make(draw.randint(0, 60))
        for _ in range(draw.randint(0, 2)):
            item = draw.choice(items[:12])[1].split()
            at = draw.randint(0, len(text))
            start = draw.randint(0, len(item) - 1)
            text[at:at] = item[start : start + draw.choice([5, 13, 40])]
        docs.append((i, draw.choice([" ", "-", "\n", "!? "]).join(text).title(), None, None, None))
    return docs + edge.rows() + [(1000 + i, items[i][1], None, None, None) for i in range(3)], items


@pytest.mark.parametrize("block_words, segment", [(1 << 20, 1 << 19), (3, 40)])
def test_against_brute_force(spark, monkeypatch, block_words, segment):
    monkeypatch.setattr(decontamination, "SEGMENT_WORDS", segment)
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", block_words)
    monkeypatch.setattr(decontamination.phrase_matches, "__defaults__", ("item_id", "text", 13, 2, block_words))
    docs, items = cases()
    asked = spark.createDataFrame(items, "item_id long, text string")
    df = edge.clashing(edge.frame(spark, docs), "n_words", "segment", "items")
    out = decontamination.contamination(df, asked).collect()
    want = []
    for doc_id, text, *_ in docs:
        n, hit, found = brute(text, items)
        want.append((doc_id, n, hit, sorted(found), hit > 0 and 20 * hit >= n))
    got = [(r.doc_id, r.n_words, r.n_hit, sorted(r["items"]), r.contaminated) for r in out]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert all(set(r["items"]) <= set(r.near_items) for r in out)


def test_proximity(spark):
    item = [(7, "one two three four")]
    docs = [(1, "one two three four"), (2, "one x two three four"), (3, "one two three x x x four"), (4, "four three two one")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    out = decontamination.contamination(df, spark.createDataFrame(item, "item_id long, text string")).collect()
    assert {r.doc_id: (list(r["items"]), list(r.near_items)) for r in out} == {
        1: ([7], [7]),
        2: ([], [7]),
        3: ([], []),
        4: ([], []),
    }


def near(text, items, frequency, width=13, slop=2):
    """Items with a window whose words stand at most ``slop`` from their places around its rarest word."""
    own, found = words(text), set()
    for item, item_text in items:
        w = words(item_text)
        n = min(width, len(w))
        for at in range(len(w) - n + 1 if n else 0):
            window = w[at : at + n]
            rarest = min(range(n), key=lambda k: (frequency[window[k]], k))
            for i, word in enumerate(own):
                if word == window[rarest] and all(
                    window[k] in own[max(i - rarest + k - slop, 0) : max(i - rarest + k + slop + 1, 0)] for k in range(n)
                ):
                    found.add(item)
    return found


@pytest.mark.parametrize("segment", [1 << 19, 40])
def test_proximity_against_brute_force(spark, monkeypatch, segment):
    """Also at the start of documents and of segments, where a match may begin before its document."""
    monkeypatch.setattr(decontamination, "SEGMENT_WORDS", segment)
    docs, items = cases()
    docs = [(5001, "zz one one", None, None, None), (5002, "two one three four", None, None, None), *docs]
    docs += [(2000 + i, " ".join(words(text)[1:]), None, None, None) for i, text in items]
    items = [*items, (95, "one two three four")]
    frequency = Counter(word for _, text, *_ in docs for word in words(text))
    df = edge.frame(spark, docs).coalesce(1)
    out = decontamination.contamination(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    want = [(doc_id, sorted(near(text, items, frequency))) for doc_id, text, *_ in docs]
    assert sorted(((r.doc_id, sorted(r.near_items)) for r in out), key=str) == sorted(want, key=str)
    assert {r.doc_id: r.near_items for r in out}[5002] == [95]


def test_matches_stay_in_their_document(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, "three four")], "doc_id long, text string").coalesce(1)
    item = spark.createDataFrame([(7, "two three")], "item_id long, text string")
    assert all(not r.near_items for r in decontamination.contamination(docs, item).collect())


def test_empty_tables(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    out = decontamination.contamination(edge.frame(spark), items).collect()
    assert len(out) == len(edge.rows()) and not any(r.contaminated for r in out)
    assert decontamination.contamination(edge.frame(spark, []), items).count() == 0


def test_query(spark, tmp_path):
    docs, items = cases()
    items = items[:12]
    folder = edge.folder_of(
        edge.frame(spark, docs), tmp_path / "in", benchmark=spark.createDataFrame(items, "item_id long, text string")
    )
    want = []
    for doc_id, text, *_ in docs:
        n, hit, found = brute(text, items)
        names = ",".join(sorted(map(str, found)))
        want.append((doc_id, n, hit, len(found), hashlib.sha256(names.encode()).hexdigest(), hit > 0 and 20 * hit >= n))
    out = queries.op5_decontamination(spark, folder).drop("n_near_items").collect()
    assert sorted(map(tuple, out), key=str) == sorted(want, key=str)
