import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import edge
from sedimenta.llm import components, queries, simhash


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    found = [xxhash.xxh64_intdigest(run.encode(), 42) for run in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in found) > len(found))


def grouped(values, linked):
    """The smallest index that links lead to, by comparing all pairs."""
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if linked(values[i], values[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(values))]


def close(a, b):
    return (a ^ b).bit_count() <= 4


def partition(members):
    found = {}
    for member, name in members:
        found.setdefault(name, set()).add(member)
    return sorted(map(sorted, found.values()))


def test_code_covers_and_anchors_are_complete():
    words = np.arange(1 << 23)
    code = words[simhash.Anchors.syndrome(words) == 0]
    assert len(code) == 4096
    drawn = np.random.default_rng(1).integers(0, 1 << 23, 40)
    for slack in (1, 2):
        row, anchor, home = simhash.Anchors(slack).near(drawn)
        for i, word in enumerate(drawn):
            apart = np.bitwise_count((code ^ word).view(np.uint64))
            assert set(anchor[row == i]) == set(code[apart <= 3 + slack])
            assert apart.min() <= 3 and code[apart.argmin()] == anchor[(row == i) & home][0]


@pytest.mark.parametrize("most", [1 << 15, 5])
def test_links_against_all_pairs(spark, monkeypatch, most):
    monkeypatch.setattr(simhash, "MOST", most)
    rng = np.random.default_rng(2)
    values = set()
    for base in rng.integers(0, 2**63, 25):
        for _ in range(25):
            value = int(base)
            for bit in rng.integers(0, 64, rng.integers(0, 9)):
                value ^= 1 << int(bit)
            values.add(value)
    values = sorted(values)
    df = spark.createDataFrame([(int(np.uint64(v).astype(np.int64)),) for v in values], "value long")
    got = {r["value"] % 2**64: r["group"] for r in simhash.groups(df).collect()}
    want = grouped(values, close)
    assert partition((v, got[v]) for v in values) == partition(zip(values, want))


def test_fingerprints_in_pieces(monkeypatch):
    texts = [None, "", " ", "one", "One two THREE", edge.prose(5, 5000), "x " * 3000, *[edge.prose(i, 9) for i in range(300)]]
    whole = [fingerprint(text) for text in texts]
    for size in (1 << 15, 64):
        monkeypatch.setattr(simhash, "_HASHES", size)
        assert simhash.fingerprints([None if t is None else t.encode() for t in texts]).tolist() == whole


def copies():
    out = edge.rows()
    text = edge.prose(9, 400)
    for i in range(30):
        words = text.split()
        words[i * 3] = "changed"
        out.append((100 + i, " ".join(words), "en", "c", 1))
    return out + [(200 + i, text, "en", "c", 1) for i in range(20)]


def test_query_against_all_pairs(spark, tmp_path):
    rows = copies()
    prints = [fingerprint(row[1]) for row in rows]
    group = grouped(prints, close)
    least = {}
    for row, name in zip(rows, group):
        if row[0] is not None:
            least[name] = min(least.get(name, row[0]), row[0])
    want = [(row[0], f"{p:016x}", least.get(name)) for row, p, name in zip(rows, prints, group)]
    folder = edge.folder_of(edge.clashing(edge.frame(spark, rows), "value", "group"), tmp_path / "in")
    assert sorted(map(tuple, queries.op6_simhash(spark, folder).collect()), key=str) == sorted(want, key=str)


def test_one_of_each(spark):
    df = edge.clashing(edge.frame(spark, copies()), "key", "fingerprint", "n")
    out = simhash.one_of_each(df)
    assert out.columns == df.columns
    found = simhash.near_duplicates(df).select("component_id").distinct().collect()
    assert sorted((r.doc_id for r in out.collect()), key=str) == sorted((r.component_id for r in found), key=str)


def test_one_of_each_with_unique_keys(spark):
    df = edge.frame(spark, [(i, *row[1:]) for i, row in enumerate(copies())])
    found = simhash.near_duplicates(df).select("component_id").distinct().collect()
    got = simhash.one_of_each(df)
    assert got.columns == df.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.component_id for r in found)


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 6), (6, 5), (3, 3), (4, None)] + [(i, i + 1) for i in range(100, 140)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components.components(df, "a", "b").collect()}
    want = {1: 1, 2: 1, 3: 1} | {i: 5 for i in range(5, 10)} | {i: 100 for i in range(100, 141)}
    assert got == want


def test_empty_table(spark):
    assert simhash.near_duplicates(edge.frame(spark, [])).count() == 0
    assert simhash.one_of_each(edge.frame(spark, [])).count() == 0


def test_columns_are_kept(spark):
    df = edge.frame(spark).withColumn("fingerprint", F.lit("old"))
    assert dict(simhash.with_fingerprint(df).dtypes)["fingerprint"] == "bigint"
