import random
import re
from collections import Counter

import edge
import pytest

from compare import DATA, connect, difference
from sedimenta.llm import blocks, collocations, oracle, queries


def brute(rows, least=30, within=80, top=2000):
    """All phrases of every order counted by themselves."""
    f, total = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in range(1, 5):
                for at in range(len(words) - size + 1):
                    f[lang, tuple(words[at : at + size])] += 1
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    inside = Counter()
    for (lang, words), a in candidates.items():
        for size in range(2, len(words)):
            for at in range(len(words) - size + 1):
                key = (lang, words[at : at + size])
                inside[key] = max(inside[key], a)
    scored = {}
    for (lang, words), a in candidates.items():
        if 100 * inside[lang, words] < within * a:
            cuts = [(2000000 * a // (f[lang, words[:k]] + f[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            row = (" ".join(words), a, f[lang, words[:k]], f[lang, words[k:]], total[lang], score)
            scored.setdefault(lang, []).append(row)
    out = []
    for lang, found in scored.items():
        found.sort(key=lambda row: (-row[5], -row[1], row[0].encode()))
        out += [(lang, rank, *row) for rank, row in enumerate(found[:top], 1)]
    return sorted(out)


def result(df, **options):
    return sorted(map(tuple, collocations.collocations(df, **options).collect()))


def corpus():
    draw = random.Random(8)
    words = [f"w{i}" for i in range(12)] + ["É", " ", "\x1c", "日本", "A-B", "Straße"]
    fixed = ["new york city hall", "New York City", "\tex  officio", "a a a a a", "x.y", "ad hoc\x0bad hoc"]
    rows = []
    for i in range(300):
        parts = [draw.choice(fixed if draw.random() < 0.3 else words) for _ in range(draw.randint(0, 60))]
        text = "".join(part + draw.choice([" ", " ", "  ", ", ", ".\n", "\t", "\r"]) for part in parts)
        rows.append((i, text, draw.choice(["en", "en", "de", None, "und", ""]), "s", 1))
    return rows + [rows[3]] * 40 + [(1, None, "xx", None, None), (2, "", None, None, None)]


@pytest.mark.parametrize("block", [blocks.BLOCK_BYTES, 1_000])
@pytest.mark.parametrize("least", [30, 5])
def test_against_all_orders(spark, monkeypatch, block, least):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", block)
    rows = corpus()
    expected = brute(rows, least)
    assert len(expected) > 20 and {row[0] for row in expected} >= {"en", "de", "und", ""}
    assert result(edge.frame(spark, rows).repartition(5), least=least) == expected


def test_top_and_ties(spark):
    rows = [(i, f"t{i % 50} u{i % 50}. v w", "en", "s", 1) for i in range(2_000)]
    found = result(edge.frame(spark, rows), top=20)
    assert found == brute(rows, top=20) and len(found) == 20


def test_edge_rows(spark):
    rows = edge.rows() * 3
    df = edge.clashing(edge.frame(spark, rows), "w1", "n", "_lang", "phrase", "payload", "block", "f")
    assert result(df) == brute(rows)


def test_empty_table(spark):
    assert result(edge.frame(spark, [])) == []
    assert result(edge.frame(spark, [(1, None, None, None, None), (2, "", "en", "a", 0)])) == []


def test_no_candidate_is_lost_to_shared_hashes(spark, monkeypatch):
    """Hashes that collide leave windows longer, and change nothing."""
    monkeypatch.setattr(collocations, "_MIX", (collocations.np.uint64(1 << 62), *collocations._MIX[1:]))
    rows = corpus()[:120]
    assert result(edge.frame(spark, rows)) == brute(rows)


def test_exact_beyond_64_bits(spark):
    """Counts whose product with the scale passes 64 bits."""
    big = 9 * 10**12
    windows = [("en", "a", "b", None, None, big), ("en", "a", "c", None, None, 7), ("en", "b", None, None, None, big + 1)]
    frame = spark.createDataFrame(windows, "lang string, w1 string, w2 string, w3 string, w4 string, n long")
    found = {(r.phrase, r.words): r.f for r in collocations.frequencies(frame).collect()}
    assert found == {("", 0): 2 * big + 8, ("a", 1): big + 7, ("b", 1): big + 1, ("a b", 2): big}
    score = frame.selectExpr(f"(cast(2000000 as decimal(7,0)) * cast({big} as decimal(20,0))) div cast({2 * big + 8} as decimal(21,0)) s")
    assert score.first().s == 2000000 * big // (2 * big + 8)


def test_query_matches_sql(spark):
    folder = f"{DATA}/sf0.01"
    sql = oracle.statements()["op12_collocations"]
    assert difference(queries.op12_collocations(spark, folder), connect(folder), sql) is None
