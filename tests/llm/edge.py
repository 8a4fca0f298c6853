"""Rows that every operator has to stand: NULLs, empty and long texts, ties, repeated rows, clashing column names."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(seed: int, words: int) -> str:
    chosen = random.Random(seed)
    return " ".join(chosen.choice(WORDS) + str(chosen.randint(0, 99) if chosen.random() < 0.1 else "") for _ in range(words))


def rows() -> list[tuple]:
    long_text = prose(1, 30_000)
    return [
        (1, prose(2, 80), "en", "a", 1),
        (2, prose(2, 80), "en", "a", 1),
        (2, prose(2, 80), "en", "a", 1),
        (3, None, None, None, None),
        (4, "", "en", "a", 0),
        (5, " \n\t ", "en", "a", 4),
        (None, prose(3, 60), "en", None, 9),
        (None, None, None, None, None),
        (6, long_text, "en", "b", len(long_text)),
        (7, "é 日本語 😀 " * 40, "xx", "b", 3),
        (8, "A" * 5_000, "en", "b", 3),
        (9, "!!! ??? 123", "en", "b", 3),
    ]


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)


def clashing(df, *names):
    """The same rows with further columns of the names that operators give their results."""
    from pyspark.sql import functions as F

    for name in names:
        df = df.withColumn(name, F.lit("taken"))
    return df


def folder_of(df, root, **tables):
    """A folder with ``documents`` and other tables, as queries read them."""
    df.write.parquet(f"{root}/documents.parquet")
    for name, table in tables.items():
        table.write.parquet(f"{root}/{name}.parquet")
    return str(root)
