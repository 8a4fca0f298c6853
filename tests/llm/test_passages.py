import random

import edge
import numpy as np
import pytest

from sedimenta.llm import blocks, passages


def brute(rows, window=50):
    """(key, bytes, spans, kept) of each row by looking every window up in a table of all."""
    order = lambda key: float("inf") if key is None else key
    texts = [(row[0], (row[1] or "").encode()) for row in rows]
    least = {}
    for key, text in texts:
        for at in range(len(text) - window + 1):
            part = text[at : at + window]
            least[part] = min(least.get(part, float("inf")), order(key))
    out = []
    for key, text in texts:
        gone = bytearray(len(text))
        for at in range(len(text) - window + 1):
            if least[text[at : at + window]] < order(key):
                gone[at : at + window] = b"\1" * window
        spans, at = [], 0
        while (begin := gone.find(1, at)) >= 0:
            at = gone.find(0, begin)
            at = len(text) if at < 0 else at
            spans.append((begin, at))
        out.append((key, len(text), spans, bytes(c for c, g in zip(text, gone) if not g)))
    return sorted(out, key=repr)


def result(df):
    rows = passages.without_repeats(df).collect()
    return sorted(((r[0], r[1], [tuple(s) for s in r[2]], bytes(r[3])) for r in rows), key=repr)


def corpus(seed=5):
    """Shared passages of many lengths, at both ends and inside, changed copies, a line in most texts."""
    draw = random.Random(seed)
    shared = [edge.prose(800 + i, 40) for i in range(6)]
    line = "this line, of more than fifty bytes in all, stands nearly everywhere; é too"
    rows = []
    for i in range(60):
        parts = [edge.prose(900 + i, draw.randint(0, 30))]
        for _ in range(draw.randint(0, 4)):
            text = draw.choice(shared)
            begin = draw.randint(0, len(text) - 1)
            parts += [text[begin : begin + draw.randint(40, 120)], edge.prose(draw.randint(0, 10**6), draw.randint(0, 6))]
        if i % 3:
            parts.insert(draw.randint(0, len(parts)), line)
        rows.append((i, draw.choice(["", " ", "\n"]).join(parts), "en", "a", 1))
    rows += [(100 + i, rows[7][1], "en", "a", 1) for i in range(5)]
    rows += [(200 + i, rows[9][1][: 30 + i] + "#" + rows[9][1][31 + i :], "en", "a", 1) for i in range(20)]
    rows += [(300, "A" * 300, "", "", 0), (301, "A" * 49, "", "", 0), (302, "A" * 50, "", "", 0), (303, "A" * 51 + "B" * 60, "", "", 0)]
    return rows + [(304, "\0" * 70, "", "", 0), (305, "x" + "\0" * 60, "", "", 0), (306, "\0" * 49 + "y" * 60, "", "", 0)]


@pytest.mark.parametrize("hot", [passages.HOT, 3])
@pytest.mark.parametrize("block", [blocks.BLOCK_BYTES, 2_000])
def test_against_all_windows(spark, monkeypatch, hot, block):
    monkeypatch.setattr(passages, "HOT", hot)
    monkeypatch.setattr(blocks, "BLOCK_BYTES", block)
    monkeypatch.setattr(blocks, "FEWEST_BUCKETS", 5)
    rows = corpus()
    random.Random(1).shuffle(rows)
    expected = brute(rows)
    assert sum(len(r[2]) for r in expected) > 100
    assert result(edge.frame(spark, rows).repartition(4)) == expected


def test_edge_rows(spark):
    rows = edge.rows() + [(3, edge.rows()[0][1], "en", "a", 1), (None, edge.rows()[0][1], "en", "a", 1)]
    df = edge.clashing(edge.frame(spark, rows), "_key", "block", "payload", "key", "kept", "spans", "notes")
    assert result(df) == brute(rows)


def test_empty_table_and_no_texts(spark):
    assert result(edge.frame(spark, [])) == []
    rows = [(1, None, None, None, None), (2, "", None, None, None), (2, "", None, None, None)]
    assert result(edge.frame(spark, rows)) == brute(rows)


def test_hot_passage_in_every_text(spark, monkeypatch):
    """One passage before which and after which all texts differ, and a large group of copies."""
    monkeypatch.setattr(passages, "HOT", 50)
    text = edge.prose(4, 30)
    rows = [(i, f"{i * 7919} {text} {i * 104729}", "en", "a", 1) for i in range(600)]
    rows += [(1000 + i, edge.prose(6, 50), "en", "a", 1) for i in range(500)]
    assert result(edge.frame(spark, rows).repartition(7)) == brute(rows)


def test_blind_trie_orders():
    draw = random.Random(2)
    strings = [bytes(draw.choice(b"ab\0") for _ in range(12)) for _ in range(500)]
    trie = passages.BlindTrie(strings[0])
    for string in strings[1:]:
        trie.insert(string)
    found = list(trie.ordered())
    expected = sorted(set(strings))
    assert [s for s, _ in found] == expected
    for (a, _), (b, common) in zip(found, found[1:]):
        assert a[:common] == b[:common] and a[common] != b[common]


def test_suffix_order():
    draw = np.random.default_rng(3)
    heads = draw.integers(97, 99, (400, passages.GRAM)).astype(np.uint8)
    heads[200:] = heads[:200]
    heads[:, :22] = heads[0, :22]
    tails = draw.integers(97, 99, (400, 26)).astype(np.uint8)
    order, common = passages.sorted_suffixes(heads, tails)
    rows = [bytes(heads[i]) + bytes(tails[i]) for i in order]
    assert rows == sorted(rows)
    for a, b, n in zip(rows, rows[1:], common[1:]):
        same = next((i for i in range(50) if a[i] != b[i]), 50)
        assert n == (same if same >= passages.GRAM else 0)


def test_query_against_all_windows(spark):
    import hashlib

    from compare import DATA
    from sedimenta.llm import queries

    folder = f"{DATA}/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    expected = [
        (key, n, sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest())
        for key, n, spans, kept in brute(docs)
    ]
    assert sorted(map(tuple, queries.op11_suffix_passages(spark, folder).collect())) == sorted(expected)
