"""The registered queries of the corpus operators; each takes (spark, folder of the parquet files)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm import (
    bpe,
    chat,
    collocations,
    decontamination,
    language,
    passages,
    pii,
    repetition,
    secret_ledger,
    sharding,
    simhash,
    variants,
    weak_quality,
)
from sedimenta.llm.store import fresh_folder

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.withColumn("fingerprint", F.lpad(F.lower(F.hex("fingerprint")), 16, "0"))


def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = secret_ledger.scan(docs, fresh_folder(spark, "secret-ledger"))
    base = F.filter("findings", lambda f: f["kind"].isin(*secret_ledger.BASE))

    def count(kind):
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in secret_ledger.BASE],
        joined_digest(secret_ledger.ordered(base)).alias("base_sha256"),
        F.array_join(secret_ledger.ordered(F.col("findings")), ",").alias("spans"),
    )


def op8_weak_quality(spark: SparkSession, folder: str) -> DataFrame:
    return weak_quality.classify(table(spark, folder, "documents"))


def op9_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.detect(table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in pii.BASE],
        joined_digest(pii.ordered(base)).alias("base_sha256"),
        F.array_join(pii.ordered(F.col("spans")), ",").alias("spans"),
    )


def op10_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    done = bpe.decode(bpe.encode(docs).drop("text"))
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        joined_digest(F.col("ids").cast("array<string>")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def joined_digest(parts):
    return F.sha2(F.array_join(parts, ",").cast("binary"), 256)


def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    found = sharding.placed(table(spark, folder, "documents"))
    return found.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = language.identify(docs.select("doc_id", "text"), language.fit(docs))
    return found.select(
        "doc_id",
        F.coalesce(language.fold("doc_id") == 0, F.lit(False)).alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
        F.col("language.rejected").alias("rejected"),
    )


def op3_repetition(spark: SparkSession, folder: str) -> DataFrame:
    found = repetition.measure(table(spark, folder, "documents").select("doc_id", "text")).drop("text")
    measured = F.col("repetition")
    failed = repetition.base_failed(measured)
    return found.select(
        "doc_id",
        *[measured[n].alias(n) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        failed.alias("base_failed"),
        (~failed & ~repetition.repetitive(measured)).alias("kept"),
        *[measured[n].alias(n) for n in ("covered_words", "longest_repeat")],
    )


def op4_chat_windows(spark: SparkSession, folder: str) -> DataFrame:
    marks = F.lit("</s>[INST] ok [/INST]").alias("text")
    added = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        marks,
    )
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    found = chat.read_back(chat.windows(turns))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    trained = F.array_join("trained", "")
    return found.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length(trained).cast("long").alias("loss_chars"),
        F.sha2(trained.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
        "n_windows",
    )


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    items = F.array_sort(F.col("items").cast("array<string>"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        joined_digest(items).alias("items_sha256"),
        "contaminated",
        F.size("near_items").cast("long").alias("n_near_items"),
    )


def op11_suffix_passages(spark: SparkSession, folder: str) -> DataFrame:
    found = passages.without_repeats(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants.spelling_variants(variants.vocabulary(table(spark, folder, "documents"), thinned=97))


def registered() -> dict[str, Query]:
    found = (
        op1_sharding,
        op2_language_id,
        op3_repetition,
        op4_chat_windows,
        op5_decontamination,
        op6_simhash,
        op7_secrets,
        op8_weak_quality,
        op9_personal_data,
        op10_byte_bpe,
        op11_suffix_passages,
        op12_collocations,
        op13_spelling_variants,
    )
    return {query.__name__: query for query in found}
