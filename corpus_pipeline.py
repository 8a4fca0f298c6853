"""Pretraining corpus pipeline over ``documents``: stages of the corpus operators, each stored before the next.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before kept. All but the last return the columns
of ``documents``; extra columns pass through. NULL and empty texts are rejected by the first stage (no letter), so they
reach no other; each stage still takes them, and an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm import bpe, decontamination, language, secret_ledger, simhash
from sedimenta.llm.store import fresh_folder, stored, unused


def in_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of which the language is told with enough certainty; ``lang`` stays as given."""
    told = unused(docs, "_language")
    found = language.identify(docs, language.fit(docs), into=told)
    return found.where(~F.col(f"{told}.rejected")).drop(told)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, the one with the smallest id; fingerprints of at most 4 different bits link."""
    return simhash.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not contaminated, told by the address of their text: ids need not be unique."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    own = unused(docs, "_address")
    addressed = docs.withColumn(own, secret_ledger.address("text"))
    found = decontamination.contamination(addressed, items, key=own).where("contaminated")
    return addressed.join(found.select(own), own, "left_anti").select(*docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked and ``n_chars`` counted anew."""
    ledger = fresh_folder(spark, "pipeline-ledger")
    addresses = stored(docs.select("doc_id", secret_ledger.address("text").alias("blob")), "addresses")
    secret_ledger.update_ledger(docs, addresses, ledger, "doc_id", "text")
    clean = secret_ledger.redact(docs, ledger)
    return clean.select(
        *[F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else c for c in docs.columns]
    )


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids instead of their texts, and how many there are."""
    return bpe.encode(docs).drop("text").withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("language ID", in_known_language),
    ("SimHash near-dedup", without_near_duplicates),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("byte-level BPE", encoded),
]

#: A trained model decides in the first stage, which SQL cannot express: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
