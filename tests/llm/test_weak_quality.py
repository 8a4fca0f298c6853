import numpy as np

import edge
from compare import DATA
from sedimenta.llm import queries, weak_quality


def test_agrees_with_labels_it_has_not_seen(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/sf0.01/labels.parquet").collect()}
    rows = queries.op8_weak_quality(spark, f"{DATA}/sf0.01").collect()
    judged = [(labels[row.doc_id], row.kept) for row in rows if row.doc_id in labels]
    assert len(rows) == 1000
    assert np.mean([kept for good, kept in judged if good]) > 0.98
    assert np.mean([not kept for good, kept in judged if not good]) > 0.9


def test_accuracies_are_recovered():
    rng = np.random.default_rng(1)
    good = rng.random(20_000) < 0.7
    counts = {}
    for is_good in good:
        wrong = rng.random(len(weak_quality.HEURISTICS)) < 0.15
        pattern = "".join("+" if is_good != w else "-" for w in wrong)
        counts[pattern] = counts.get(pattern, 0) + 1
    model = weak_quality.estimate(counts)
    assert abs(model.prior - 0.7) < 0.05
    assert model.posterior("+" * len(weak_quality.HEURISTICS)) > 0.99
    assert model.posterior("-" * len(weak_quality.HEURISTICS)) < 0.01


def plain_estimate(patterns, rounds):
    """Expectation-maximisation text by text, in plain loops."""
    texts = [name for name, n in patterns.items() for _ in range(n)]
    good = [{0: 0.95, 1: 0.6}.get(name.count("-"), 0.1) for name in texts]
    for _ in range(rounds):
        prior = min(max((sum(good) + 1) / (len(texts) + 2), 0.01), 0.99)
        tables = []
        for j in range(len(weak_quality.HEURISTICS)):
            rows = []
            for c, share in ((0, [1 - g for g in good]), (1, good)):
                seen = {v: sum(w for w, name in zip(share, texts) if name[j] == v) for v in "-0+"}
                added = 1 + weak_quality.STRENGTH * sum(share)
                counts = [seen[v] + added * weak_quality.EXPECTED[c]["-0+".index(v)] for v in "-0+"]
                rows.append([x / sum(counts) for x in counts])
            tables.append(rows)
        good = []
        for name in texts:
            bad_p, good_p = 1 - prior, prior
            for j, v in enumerate(name):
                bad_p, good_p = bad_p * tables[j][0]["-0+".index(v)], good_p * tables[j][1]["-0+".index(v)]
            good.append(good_p / (bad_p + good_p))
    return prior, tables, dict(zip(texts, good))


def test_expectation_maximisation_against_plain_loops():
    rng = np.random.default_rng(5)
    patterns = {}
    for _ in range(120):
        is_good = rng.random() < 0.6
        name = "".join(rng.choice(["-", "0", "+"], p=[0.05, 0.15, 0.8] if is_good else [0.5, 0.2, 0.3]) for _ in weak_quality.HEURISTICS)
        patterns[name] = patterns.get(name, 0) + int(rng.integers(1, 4))
    prior, tables, good = plain_estimate(patterns, 15)
    model = weak_quality.estimate(patterns, 15)
    assert abs(model.prior - prior) < 1e-9 and np.abs(model.accuracies - np.array(tables)).max() < 1e-9
    assert all(abs(model.posterior(name) - p) < 1e-9 for name, p in good.items())


def test_score_against_plain_grams():
    texts = [edge.prose(i, 40).encode() for i in range(20)] + [b"$$ ## x1 x1 x1 " * 9] * 5
    weights, bias = weak_quality.train(texts, [1.0] * 20 + [0.0] * 5)
    for text in [texts[0], texts[-1], b"abc", b"", "é 日本 9".encode()]:
        z = bias
        for salt, size, stream in ((1, 4, text), (2, 5, text.translate(weak_quality._CLASSES))):
            found = []
            for at in range(len(stream) - size + 1):
                mixed = salt
                for byte in stream[at : at + size]:
                    mixed = ((mixed ^ byte) * 16777619) % 2**32
                found.append(weights[(mixed ^ (mixed >> 13)) % weak_quality.BUCKETS])
            z += sum(found) / len(found) if found else 0
        measured = weak_quality.measures(text)
        z += sum(weights[bucket] for bucket in weak_quality._steps(measured))
        assert abs(weak_quality.score(text, measured, weights, bias) - 1 / (1 + np.exp(-z))) < 1e-9


def test_edge_rows(spark):
    df = edge.clashing(edge.frame(spark), "votes", "quality", "kept", "key")
    rows = weak_quality.classify(df).collect()
    assert sorted((row.doc_id for row in rows), key=str) == sorted((row[0] for row in edge.rows()), key=str)
    assert all(0 <= row.quality <= 1 and 0 <= row.weak_label <= 1 for row in rows)
    assert len({row.quality for row in rows if row.doc_id == 2}) == 1


def test_empty_table(spark):
    assert weak_quality.classify(edge.frame(spark, [])).count() == 0
