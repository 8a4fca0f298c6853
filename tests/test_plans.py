"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from checks.queries import bronze_text, lake_of, registered
from compare import DATA
from sedimenta.operators import joins, quality
from sedimenta.plans import star
from sedimenta.plans.specs import WIDE_SPECS
from sedimenta.sources.retail import RetailSource

FOLDER = f"{DATA}/sf0.001"
QUERIES = registered()
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "MapPartitions", "ExistingRDD")


def plan(df, capsys) -> str:
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


@pytest.mark.parametrize("name", QUERIES)
def test_no_pairwise_joins_and_no_python_rows(spark, capsys, name):
    text = plan(QUERIES[name](spark, FOLDER), capsys)
    assert not [word for word in UNWANTED if word in text]


def test_rules_and_columns_reach_the_scan(spark, capsys, folder):
    RetailSource(spark, FOLDER)("transmissoes").write.parquet(f"{folder}/t")
    stored = spark.read.parquet(f"{folder}/t")
    clean, _ = quality.refine(stored, WIDE_SPECS["transmissoes"])
    text = plan(clean.select("id_transmissao", "data_inicio"), capsys)
    assert "IsNotNull(data_inicio)" in text and "IsNotNull(data_fim)" in text
    # Which copy is kept depends on all columns, so all are read here.
    assert "pico_viewers" in text
    text = plan(quality.clean_rows(stored, WIDE_SPECS["transmissoes"]).select("data_inicio"), capsys)
    assert "pico_viewers" not in text


def test_copies_are_combined_before_the_shuffle(spark, capsys):
    clean, _ = quality.refine(bronze_text(spark, FOLDER, "doacoes"), WIDE_SPECS["doacoes"])
    text = plan(clean, capsys)
    assert "partial_min" in text


def test_small_dimensions_are_broadcast_and_large_ones_shuffled(spark, capsys):
    lake = lake_of(spark, FOLDER)
    inputs = {name: lake[name] for name in star.INPUTS["fato_doacoes"]}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = plan(star.STAR["fato_doacoes"](inputs, lake.rows), capsys)
        large = plan(star.STAR["fato_doacoes"](inputs, {"dim_viewer": 10**9, "dim_streamer": 10**9}), capsys)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in small and "Exchange hashpartitioning" not in small
    assert "SortMergeJoin" in large and "approx_top_k" in large


def test_sides_not_counted_as_small_are_not_broadcast_by_the_size_of_their_files(spark, capsys, folder):
    """Only what hot keys found goes to every task, however small the files of the other side are."""
    spark.range(50_000).select("id", F.col("id").alias("sk")).write.parquet(f"{folder}/right")
    right = spark.read.parquet(f"{folder}/right")
    left = spark.range(1_000).select("id", (F.col("id") * 3).alias("key"))
    found = {
        "one": joins.lookup_join(left, right, "key", "id", right_rows=10**7),
        "any": joins.lookup_by(left, right, {"key": "id"}, right_rows=10**7),
    }
    for df in found.values():
        text = plan(df, capsys)
        assert text.count("SortMergeJoin") >= 2 and len(re.findall(r"\) BroadcastHashJoin", text.split("\n\n")[0])) <= 1
        assert sorted(tuple(r) for r in df.collect()) == [(i, 3 * i, 3 * i) for i in range(1_000)]


def test_top_lists_do_not_sort_everything(spark, capsys):
    assert "TakeOrderedAndProject" in plan(QUERIES["q1_top_streamers_donations"](spark, FOLDER), capsys)


def test_numbering_has_no_window_over_all_rows(spark, capsys):
    """The one single-partition window is over counts of groups of blocks of keys."""
    lake = lake_of(spark, FOLDER)
    text = plan(star.STAR["dim_viewer"]({"viewers": lake["viewers"]}, {}), capsys)
    assert text.count("SinglePartition") <= 1
