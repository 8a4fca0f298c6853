import random
import re
import zlib
from collections import Counter

import edge
import pytest

from compare import DATA, connect, difference
from sedimenta.llm import oracle, queries, variants


def counted(rows, thinned=97, least=3, shortest=5):
    found = Counter()
    for key, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % thinned == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {word: n for word, n in found.items() if n >= least and len(word) >= shortest}


def apart(a, b):
    """Whether exactly one code point is inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words):
    near = {word: [other for other in words if apart(word, other)] for word in words}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda other: (-words[other], other), default=None)
        if best is not None and words[best] >= 2 * words[word]:
            form[word] = best
    out = []
    for word, n in words.items():
        root = word
        while root in form:
            root = form[root]
        out.append((word, form.get(word), root, n, len(near[word]), words.get(form.get(word))))
    return sorted(out)


def result(df):
    return sorted(map(tuple, df.collect()))


def edited(word, draw):
    at, letter = draw.randrange(len(word)), draw.choice("abcé×ß")
    return draw.choice([word[:at] + word[at + 1 :], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1 :]])


def family(seed, size):
    draw = random.Random(seed)
    words = {"".join(draw.choice("abcdefé") for _ in range(draw.randint(5, 9))): draw.randint(3, 99) for _ in range(size // 4)}
    while len(words) < size:
        word = edited(draw.choice(list(words)), draw)
        if len(word) >= 5:
            words[word] = draw.choice([3, 3, 4, 6, 8, 16, 50, 100])
    return words


@pytest.mark.parametrize("most, tile", [(variants.MOST, variants.TILE), (7, 5), (60, 16)])
def test_against_all_pairs(spark, monkeypatch, most, tile):
    monkeypatch.setattr(variants, "MOST", most)
    monkeypatch.setattr(variants, "TILE", tile)
    words = family(4, 700)
    expected = brute(words)
    assert sum(row[4] for row in expected) > 1_000 and sum(row[1] is not None and row[1] != row[2] for row in expected) > 20
    frame = spark.createDataFrame(list(words.items()), "word string, n long").repartition(5)
    assert result(variants.spelling_variants(frame)) == expected


def test_one_hot_half(spark, monkeypatch):
    """Thousands of words that begin alike, more than one block takes."""
    monkeypatch.setattr(variants, "MOST", 500)
    draw = random.Random(9)
    words = {"intern" + "".join(draw.choice("abcdef") for _ in range(6)): draw.randint(3, 500) for _ in range(3_000)}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert result(variants.spelling_variants(frame)) == brute(words)


def test_long_words_and_repeated_letters(spark):
    words = {"a" * size: 3 + size % 7 for size in (5, 6, 7, 8, 3_000, 3_001)} | {"a" * 2_000 + "b" + "a" * 999: 50, "aabaa": 9, "abaaa": 4}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert result(variants.spelling_variants(frame)) == brute(words)


def test_vocabulary(spark):
    rows = [(i, "Straße STRASSE Ünder ünder ÄÖÜäöü naïve×x don't abcde1abcdef " + edge.prose(i, 200), "en", "s", 1) for i in range(40)]
    rows += edge.rows() * 3
    df = edge.clashing(edge.frame(spark, rows), "word", "n", "_run", "_key", "_h")
    assert dict(map(tuple, variants.vocabulary(df, thinned=97).collect())) == counted(rows)
    assert dict(map(tuple, variants.vocabulary(df).collect())) == counted(rows, thinned=1 << 40)


def test_empty(spark):
    assert result(variants.spelling_variants(variants.vocabulary(edge.frame(spark, []), thinned=97))) == []
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "one two", "en", "a", 0)]
    assert result(variants.spelling_variants(variants.vocabulary(edge.frame(spark, rows)))) == []


def test_chain_of_forms(spark):
    """Each form leads to the next, over more rounds than one."""
    words = {"z" * 6 + "".join("ab"[i > place] for place in range(20)): 3 << 2 * i for i in range(21)}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    found = result(variants.spelling_variants(frame))
    assert found == brute(words) and len({row[2] for row in found}) == 1


def test_query_matches_sql(spark):
    folder = f"{DATA}/sf0.01"
    sql = oracle.statements()["op13_spelling_variants"]
    assert difference(queries.op13_spelling_variants(spark, folder), connect(folder), sql) is None
