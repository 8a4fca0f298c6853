import math
import zlib

import pytest

import edge
from compare import DATA
from sedimenta.llm import language, queries


@pytest.fixture(scope="module")
def predicted(spark):
    rows = queries.op2_language_id(spark, f"{DATA}/sf0.01").collect()
    given = {r.doc_id: r for r in spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").collect()}
    return [(row, given[row.doc_id]) for row in rows]


def test_held_out_accuracy(predicted):
    held = [row.lang_pred == doc.lang for row, doc in predicted if row.held_out]
    assert len(held) > 100 and sum(held) / len(held) > 0.98


def test_contract(predicted):
    for row, doc in predicted:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0)
        assert 0 <= row.score <= 1
        assert row.lang_pred in ("de", "en", "es", "fr")
    assert sum(row.rejected for row, _ in predicted) < 0.01 * len(predicted)


def test_held_out_rows_are_not_learned_from(spark):
    data = [(i, "qqq www" if zlib.crc32(str(i).encode()) % 5 == 0 else f"abc def {i}", "zz" if zlib.crc32(str(i).encode()) % 5 == 0 else "aa", None, 0) for i in range(100)]
    assert language.fit(edge.frame(spark, data)).languages == ("aa",)


def test_edge_rows(spark):
    model = language.train([edge.prose(i, 30) for i in range(40)] + ["日本語 中文 漢字 " * 5] * 40, ["en"] * 40 + ["xx"] * 40)
    df = edge.clashing(edge.frame(spark), "language", "score")
    out = language.identify(df, model).collect()
    assert len(out) == len(edge.rows())
    for row in out:
        letters = any(c.isalpha() for c in row.text or "")
        assert (row.language.lang == "und") == (not letters)
        assert letters or (row.language.score == 0 and row.language.rejected)
    assert {row.language.lang for row in out if row.doc_id in (1, 6, 7)} == {"en", "xx"}


def plain_logits(model, text):
    """Mean of the class scores of a text's n-grams, word by word."""
    folded = [low if len(low := c.lower()) == 1 else c for c in text]
    spaced = " " + "".join(c if o.isalpha() else " " for c, o in zip(folded, text)) + " "
    rows = []
    for size in language.SIZES:
        for at in range(len(spaced) - size + 1):
            gram = spaced[at : at + size]
            if " " in gram[1:-1] or gram == "  ":
                continue
            mixed = size
            for c in gram:
                mixed = ((mixed ^ ord(c)) * 16777619) % 2**32
            rows.append(model.scores[(mixed ^ (mixed >> 15)) % language.BUCKETS].astype(float))
    return sum(rows) / len(rows) + model.bias


def test_scores_against_a_loop_over_subwords():
    model = language.train([edge.prose(i, 30) for i in range(20)] + ["uno dos tres ñandú"] * 5, ["en"] * 20 + ["es"] * 5)
    for text in ["One  two", "İstanbul ÉTÉ été-x", "a", "日本語 中文", edge.prose(4, 40) + "\n1 2 3"]:
        assert abs(model.logits(text) - plain_logits(model, text)).max() < 1e-4
        p = math.e ** (plain_logits(model, text) / model.temperature - max(plain_logits(model, text) / model.temperature))
        assert abs(model.predict(text)[1] - max(p) / sum(p)) < 1e-4


def test_one_id_and_hot_rows_keep_all_languages(spark, monkeypatch):
    """One id for all rows, and one text that holds most of a language's rows."""
    rows = [(1, f"hello word {i}", "en", None, 0) for i in range(40)] + [(1, f"hola mundo {i}", "es", None, 0) for i in range(40)]
    rows += [(1, "hello again and again", "en", None, 0)] * 500
    learned = {}
    monkeypatch.setattr(language, "train", lambda texts, labels: learned.update(texts=texts, labels=labels))
    language.fit(edge.frame(spark, rows), rows=20)
    assert learned["labels"] == ["en"] * 20 + ["es"] * 20
    assert len(set(learned["texts"])) == 40


def test_whole_text_in_any_blocks(monkeypatch):
    model = language.train(["one two three"] * 5 + ["uno dos tres"] * 5, ["en"] * 5 + ["es"] * 5)
    text = edge.prose(3, 3000)
    whole = model.logits(text)
    monkeypatch.setattr(language, "BLOCK", 100)
    assert abs(model.logits(text) - whole).max() < 1e-4


def test_nothing_to_learn_from(spark):
    model = language.fit(edge.frame(spark, []))
    assert {row.language.lang for row in language.identify(edge.frame(spark), model).collect()} == {"und"}
    assert language.identify(edge.frame(spark, []), model).count() == 0
