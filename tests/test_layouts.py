"""Layouts, sets, keys of any type and runs that are taken up again, on hand-made rows."""

import datetime as dt
import glob
import os
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from checks.queries import bronze_audit, bucketed_join, clustered_views, lake_of, registered
from compare import DATA
from sedimenta.operators import distinct, quality
from sedimenta.operators.dimensional import add_surrogate_key
from sedimenta.operators.joins import lookup_by
from sedimenta.operators.ordering import number_rows
from sedimenta.plans import star
from sedimenta.plans.lake import Lake
from sedimenta.plans.layers import run_layers
from sedimenta.plans.specs import WIDE_SPECS
from sedimenta.sources.bucketed import write_bucketed
from sedimenta.sources.landing import landing_path, write_landing
from sedimenta.sources.months import MONTH, read_months, write_months
from sedimenta.sources.retail import RetailSource
from sedimenta.sources.tables import quarantine_path, read_table, stored_bounds, stored_counts, table_path
from test_plans import plan

FOLDER = f"{DATA}/sf0.001"
DAY = "2024-01-01"


# Sets


@pytest.mark.parametrize("partitions", ["1", "8", "50"])
def test_sets_merge_exactly(spark, monkeypatch, partitions):
    """Sparse and dense containers, on either side of their border, in groups that overlap."""
    monkeypatch.setattr(distinct, "FEW", 100)
    draw = random.Random(3)
    rows = [(draw.randint(1, 4), draw.randint(1, 3), draw.choice([draw.randint(1, 300), draw.randint(30_000, 100_000)])) for _ in range(9_000)]
    rows += [(9, 1, v) for v in (1, 32_768, 32_769, 65_536, 65_537)] * 50 + [(9, 1, None), (9, 2, -1), (9, 2, 0), (8, 1, None)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        sets = distinct.member_sets(spark.createDataFrame(rows, "a int, b int, v long"), "v", "a", "b")
        assert {row.positions is None for row in sets.collect()} == {True, False}
        for by in (("a", "b"), ("a",), ("b",), ()):
            expected = {}
            for a, b, v in rows:
                if v is not None and v > 0:
                    expected.setdefault(tuple({"a": a, "b": b}[c] for c in by), set()).add(v)
            merged = distinct.set_sizes(distinct.merged_sets(sets, *by), "n", *by).collect()
            assert {tuple(row)[:-1]: row.n for row in merged} == {key: len(found) for key, found in expected.items()}
        own = distinct.set_sizes(sets, "n", "a", "b").collect()
        assert {tuple(row) for row in own} == {tuple(row) for row in distinct.set_sizes(distinct.merged_sets(sets, "a", "b"), "n", "a", "b").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_hot_group_moves_as_sets(spark, capsys):
    """A group with most rows leaves each task as its distinct members."""
    rows = spark.range(50_000).select(F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id")).alias("a"), (F.col("id") % 7 + 1).alias("v"))
    sets = distinct.member_sets(rows, "v", "a")
    assert plan(sets, capsys).index("HashAggregate") < plan(sets, capsys).index("Exchange")
    assert distinct.set_sizes(sets, "n", "a").where("a = 1").first().n == 7


def test_sparse_containers_move_no_bitmaps(spark):
    """A merged container stays as positions while they are few; one that meets a bitmap is one bitmap."""
    rows = spark.range(9_000).selectExpr("if(id < 3000, 0, id) a", "if(id < 3000, id, id % 50) + 1 v")
    sets = distinct.member_sets(rows, "v", "a")
    assert sets.where("a > 0 and bitmap is not null").count() == 0 and sets.where("a = 0 and bitmap is not null").count() == 1
    merged = distinct.merged_sets(sets, "a")
    assert merged.where("a > 0 and positions is null").count() == 0
    assert distinct.set_sizes(distinct.merged_sets(sets), "n").first().n == 3000
    assert distinct.merged_sets(sets).where("positions is null").count() == 1


def test_no_members(spark):
    sets = distinct.member_sets(spark.createDataFrame([], "a int, v long"), "v", "a")
    assert distinct.set_sizes(distinct.merged_sets(sets, "a"), "n", "a").count() == 0
    assert distinct.set_sizes(distinct.merged_sets(sets), "n").first().n == 0


# Numbering


def numbered(df, *by, **options):
    return [tuple(row) for row in number_rows(df, "sk", *by, **options).orderBy("sk").collect()]


@pytest.mark.parametrize("most", [1, 4, 1_000_000])
def test_number_by_text_ties_and_integers(spark, most):
    names = [None, "", "a", "a ", "a!", "ab", "aé", "b" * 300, "b" * 300 + "c", "é", "\x00", "a\x00", "日本", "A"]
    ids = [None, -(2**63), -5, -1, 0, 1, 255, 256, 2**63 - 1]
    rows = [(name, i) for name in names for i in ids]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "name string, id long").repartition(5)
    key = lambda row: (row[0] is not None, (row[0] or "").encode(), row[1] is not None, row[1] or 0)
    assert numbered(df, "name", "id", most=most) == [(*row, i) for i, row in enumerate(sorted(rows, key=key), 1)]


def test_number_by_date_and_hot_value(spark):
    days = [dt.date(1969, 12, 30) + dt.timedelta(days=i) for i in range(5)]
    rows = [(days[i % 5] if i % 3 else days[2], i) for i in range(3_000)] + [(None, -1)]
    df = spark.createDataFrame(rows, "day date, id int")
    expected = sorted(rows, key=lambda row: (row[0] is not None, row[0] or days[0], row[1]))
    assert numbered(df, "day", "id", most=50) == [(*row, i) for i, row in enumerate(expected, 1)]


def test_surrogate_key_by_text(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("aa",)], "name string")
    found = add_surrogate_key(df, "sk", "name").orderBy("sk").collect()
    assert [tuple(row) for row in found] == [(None, 1), ("a", 2), ("aa", 3), ("b", 4)]
    assert numbered(spark.createDataFrame([], "name string"), "name") == []
    with pytest.raises(TypeError):
        number_rows(spark.createDataFrame([(1.5,)], "x double"), "sk", "x")


# Lookups


@pytest.mark.parametrize("rows", [None, 3])
def test_lookup_by_pair_with_hot_and_missing_parts(spark, rows):
    left = [(i, "hot" if i % 3 else f"n{i % 50}", 1 if i % 3 else (i % 5 or None)) for i in range(4_000)]
    left += [(5_000 + i, "absent", 9) for i in range(900)] + [(6_000, None, None), (6_001, "hot", None), (6_002, None, 1)]
    right = [("hot", 1, "H"), ("hot", 2, "other"), (None, 1, "never"), ("n3", 3, None)] + [(f"n{i}", i % 5, f"v{i}") for i in range(50) if i != 3]
    known = {(a, b): v for a, b, v in right if a is not None and b is not None}
    l_df = spark.createDataFrame(left, "id int, name string, k int").repartition(4)
    r_df = spark.createDataFrame(right, "rn string, rk int, v string")
    found = lookup_by(l_df, r_df, {"name": "rn", "k": "rk"}, right_rows=rows, spread_by=("id",))
    assert found.columns == ["id", "name", "k", "v"]
    expected = [(*row, known.get((row[1], row[2]))) for row in left]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)


def test_lookup_spreads_hot_text_keys(spark):
    """Rows of a hot key are dealt over all partitions, found or not."""
    left = spark.range(20_000).select("id", F.when(F.col("id") % 4 > 0, F.lit("hot")).otherwise(F.concat(F.lit("n"), "id")).alias("name"))
    right = spark.createDataFrame([("hot", 7)] + [(f"n{i}", i) for i in range(0, 20_000, 4)], "rn string, v int")
    before = {name: spark.conf.get(name) for name in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = lookup_by(left, right, {"name": "rn"}, spread_by=("id",))
        sizes = [row["count"] for row in found.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 20_000 and max(sizes) < 2 * 20_000 / 8
        assert found.where("v IS NULL").count() == 0
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


# Months


def files_of(path):
    found = glob.glob(f"{path}/**/*.parquet", recursive=True)
    return {name: os.stat(name).st_mtime_ns for name in found}


def test_one_month_is_replaced_alone(spark, folder, capsys):
    days = [20240115, 20240131, 20240201, 20240310, -1]
    fact = spark.createDataFrame([(i, days[i % 5]) for i in range(500)], "id int, sk_tempo int").repartition(6)
    path = f"{folder}/fact"
    write_months(fact, path)
    before = files_of(path)
    assert len(before) == 4  # one file a month, though six tasks had rows of each
    more = fact.unionByName(spark.createDataFrame([(900, 20240205)], fact.schema)).where("sk_tempo <> 20240310")
    write_months(more, path, months=[202402, 202403])
    after = files_of(path)
    kept = {name for name in before if "=202402" not in name and "=202403" not in name}
    assert kept and {name: after[name] for name in kept} == {name: before[name] for name in kept}
    assert set(after) & set(before) == kept
    months = {row[0]: row[1] for row in read_months(spark, path).groupBy(MONTH).count().collect()}
    assert months == {202401: 200, 202402: 101, -1: 100}
    one = read_months(spark, path, 202401, 202401)
    assert one.count() == 200
    text = plan(one, capsys)
    assert "PartitionFilters: [isnotnull(mes_ref" in text and "(mes_ref#" in text
    assert {os.path.dirname(f).rsplit("=")[-1] for f in one.inputFiles()} >= {"202401"}


def test_empty_fact_by_month(spark, folder):
    fact = spark.createDataFrame([(1, 20240101)], "id int, sk_tempo int")
    write_months(fact, f"{folder}/fact")
    write_months(fact.where("id > 1"), f"{folder}/fact", months=[202401])
    assert files_of(f"{folder}/fact") == {}


# Buckets, clusters, footers


def test_bucketed_join_has_no_exchange_on_its_key(spark, folder, capsys):
    names = ("layout_left", "layout_right")
    left = spark.range(6_000).select("id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id")).alias("k"))
    right = spark.range(0, 6_000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    expected = sorted(map(tuple, left.join(right, "k", "left").select("id", "k", "v").collect()), key=str)
    write_bucketed(left, names[0], f"{folder}/left", "k", 4)
    write_bucketed(right, names[1], f"{folder}/right", "k", 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = bucketed_join(spark, *names, "k")
        text = plan(joined, capsys)
        assert "SortMergeJoin" in text and "hashpartitioning(k#" not in text
        assert sorted(map(tuple, joined.select("id", "k", "v").collect()), key=str) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in names:
            spark.sql(f"DROP TABLE {name}")
    assert len(glob.glob(f"{folder}/left/*.parquet")) == 4


def test_clusters_skip_row_groups_for_both_keys(spark):
    folder = f"{DATA}/sf0.01"
    views = clustered_views(spark, folder)
    groups = []
    for path in views.inputFiles():
        footer = pq.ParquetFile(path.removeprefix("file://")).metadata
        names = [footer.schema.column(i).name for i in range(footer.num_columns)]
        for i in range(footer.num_row_groups):
            group = footer.row_group(i)
            groups.append({n: (group.column(names.index(n)).statistics.min, group.column(names.index(n)).statistics.max) for n in ("sk_streamer", "sk_tempo")})
    streamer = sum(g["sk_streamer"][0] <= 3 <= g["sk_streamer"][1] for g in groups) / len(groups)
    week = sum(g["sk_tempo"][0] <= 19960317 and g["sk_tempo"][1] >= 19960311 for g in groups) / len(groups)
    print(f"row groups {len(groups)}, read for one streamer {streamer:.2f}, for one week {week:.2f}")
    assert len(groups) >= 8 and streamer <= 0.5 and week <= 0.6


def test_counts_and_bounds_come_from_footers(spark, folder, capsys):
    spark.range(100).select("id", (F.col("id") % 7).cast("int").alias("d")).write.parquet(f"{folder}/t")
    spark.createDataFrame([], "id long, d int").write.parquet(f"{folder}/none")
    paths = {"t": f"{folder}/t", "none": f"{folder}/none"}
    assert "PushedAggregation: [COUNT(*)]" in plan(stored_counts(spark, paths), capsys)
    bounds = stored_bounds(spark, paths, "d")
    assert "MIN(d), MAX(d)" in plan(bounds, capsys)
    assert sorted(map(tuple, bounds.collect())) == [("none", 0, None, None), ("t", 100, 0, 6)]
    assert {tuple(row) for row in stored_counts(spark, paths).collect()} == {("t", 100), ("none", 0), ("TOTAL", 100)}
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


# One parse, deduplication


def test_bronze_is_read_once(spark, folder):
    source, asked = RetailSource(spark, FOLDER), []

    def bronze(name):
        asked.append(name)
        return quality.as_bronze(source(name))

    lake = Lake(spark, folder, bronze, WIDE_SPECS)
    done = lake.write_quarantine("transmissoes", raw="_registro")
    assert asked == ["transmissoes"]
    clean, rejected = quality.refine(bronze("transmissoes"), WIDE_SPECS["transmissoes"])
    silver = read_table(spark, folder, "silver", "transmissoes")
    assert silver.exceptAll(clean).count() == clean.exceptAll(silver).count() == 0
    kept = spark.read.parquet(quarantine_path(folder, "transmissoes"))
    same = kept.select(*rejected.columns)
    assert same.exceptAll(rejected).count() == rejected.exceptAll(same).count() == 0
    assert kept.where(F.get_json_object("_registro", "$.id_transmissao") != F.col("id_transmissao").cast("string")).count() == 0
    assert "_registro" not in silver.columns and done.read == done.rows + done.rejected + done.duplicates
    assert not os.path.exists(f"{folder}/silver/_judged/transmissoes")


def test_tables_without_valid_or_rejected_rows(spark, folder):
    schema = "id_plataforma string, nome string"
    for label, rows in (("none", []), ("bad", [(None, "a"), ("1", None)]), ("good", [("1", "a")])):
        lake = Lake(spark, f"{folder}/{label}", lambda _: spark.createDataFrame(rows, schema), WIDE_SPECS)  # noqa: B023
        done = lake.write_quarantine("plataformas")
        assert (done.read, done.rejected, done.rows) == (len(rows), 2 * (label == "bad"), 1 * (label == "good"))
        assert read_table(spark, f"{folder}/{label}", "silver", "plataformas").count() == done.rows


@pytest.mark.parametrize("partitions", ["1", "8", "40"])
def test_isolated_deduplication_is_the_same(spark, folder, partitions):
    """Clean keys, keys with some copies, a key with a third of all rows."""
    spec = WIDE_SPECS["visualizacoes"]
    rows = spark.range(9_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 5_000).alias("id_visualizacao"),
        (F.col("id") % 11).alias("id_viewer"),
        F.when(F.col("id") % 13 > 0, F.col("id")).alias("id_transmissao"),
        (F.col("id") % 5).cast("int").alias("minutos_assistidos"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("data_hora"),
    )
    rows.write.parquet(f"{folder}/views")
    stored = spark.read.parquet(f"{folder}/views")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        plain, isolated = quality.deduplicate(stored, spec), quality.deduplicate_isolated(stored, spec)
        assert isolated.columns == plain.columns
        assert plain.exceptAll(isolated).count() == isolated.exceptAll(plain).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


# Runs


def test_run_is_taken_up_after_a_failure(spark, folder):
    source = RetailSource(spark, FOLDER)
    names = ["plataformas", "streamers", "jogos", "transmissoes"]
    asked = dict(tables=names, objects=["dim_streamer", "dim_jogo", "fato_transmissoes"], mart_names=["agg_jogo_popularidade"], specs=WIDE_SPECS)
    run_layers(spark, source, folder, DAY, ("landing", "bronze"), record=True, **asked)
    broken = landing_path(f"{folder}/landing", "transmissoes", DAY)
    header = "id_transmissao,id_streamer,id_jogo,data_inicio\n1,1,1,2024-01-01\n"
    for path in glob.glob(f"{broken}/*"):
        os.remove(path)
    with open(f"{broken}/part-0.csv", "w") as out:
        out.write(header)
    with pytest.raises(Exception, match="data_fim"):
        run_layers(spark, source, folder, DAY, ("bronze", "silver", "star"), resume=True, **asked)
    write_landing(source("transmissoes"), f"{folder}/landing", "transmissoes", DAY)
    log = run_layers(spark, source, folder, DAY, ("bronze", "silver", "star"), resume=True, **asked).collect()
    found = {(row.stage, row.table): row.operation for row in log}
    assert found["bronze", "transmissoes"] == found["silver", "transmissoes"] == found["star", "fato_transmissoes"] == "overwrite"
    # What the failed run had finished is not made again.
    assert found["bronze", "jogos"] == found["silver", "jogos"] == "unchanged"
    again = run_layers(spark, source, folder, DAY, ("bronze", "silver", "star"), resume=True, **asked).collect()
    assert {row.operation for row in again} == {"unchanged"}
    assert {(row.stage, row.table): row.rows for row in again} == {(row.stage, row.table): row.rows for row in log}


def test_foreign_files_run_through_the_layers(spark, folder):
    """Plain CSV, one of them a single file, with backslashes, quotes and line breaks; our own files beside them."""
    odd = ["C:\\new\\run", 'say "hi"', "two\nlines", "back\\\\slash", "a,b"]
    path = landing_path(f"{folder}/landing", "plataformas", DAY)
    os.makedirs(os.path.dirname(path))
    with open(f"{path}.csv", "w", newline="") as out:
        out.write("id_plataforma,nome\n")
        for i, text in enumerate(odd, 1):
            out.write('{},"{}"\n'.format(i, text.replace('"', '""')))
    own = spark.createDataFrame([(str(i), text, None, None, None) for i, text in enumerate(odd, 1)], "id_jogo string, nome string, desenvolvedor string, ano_lancamento string, ativo string")
    write_landing(own, f"{folder}/landing", "jogos", DAY)
    run_layers(spark, lambda _: None, folder, DAY, ("bronze", "silver"), ["plataformas", "jogos"], specs=WIDE_SPECS, multi_line=True)
    for table in ("plataformas", "jogos"):
        names = {row.nome for row in read_table(spark, folder, "silver", table).collect()}
        assert names == set(odd)


def test_export_counts_come_with_the_rows(spark, folder):
    """The mart is not counted in a scan of its own."""
    lake = lake_of(spark, FOLDER)
    mart = lake["agg_plataforma_resumo"]
    mart.write.parquet(table_path(folder, "gold", "agg_plataforma_resumo"))
    taken = []
    log = run_layers(spark, lambda _: None, folder, DAY, ("export",), mart_names=["agg_plataforma_resumo"], specs=WIDE_SPECS, export=lambda name, df: taken.append((name, len(df.collect()))))
    assert [(row.table, row.rows) for row in log.collect()] == taken == [("agg_plataforma_resumo", mart.count())]


def test_new_queries_are_registered():
    wanted = "kpi4_true_viewers_by_platform doc_unique_viewers_rollup fato_doacoes_month quarantine_all dedup_isolated sk_by_name lookup_by_name fato_visualizacoes_bucketed clustered_scan rowcount_footer run_resumed landing_foreign layer_types"
    assert set(wanted.split()) <= set(registered())


def test_orders_move_as_narrow_as_they_end_up(spark, folder, capsys):
    """Joined to their items, orders carry the columns asked for, not those that these are made from."""
    orders = [(1, 5, "F", 99.5, "1995-01-02", "5-LOW"), (1, 6, "O", 7.25, "1995-01-03", "2-HIGH"), (None, 7, "F", 1.0, None, None), (4, None, None, None, "1995-01-04", "3-MEDIUM")]
    columns = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, _date string, o_orderpriority string"
    made = spark.createDataFrame(orders, columns).withColumn("o_orderdate", F.col("_date").cast("timestamp")).drop("_date")
    made.write.parquet(f"{folder}/orders.parquet")
    items = [(1, 30, 300, "1995-02-02"), (1, 20, 400, "1995-02-01"), (None, 1, 1, "1995-02-03"), (9, 2, 2, "1995-02-04")]
    items = spark.createDataFrame(items, "l_orderkey long, l_suppkey long, l_partkey long, _date string")
    items.withColumn("l_shipdate", F.col("_date").cast("timestamp")).drop("_date").write.parquet(f"{folder}/lineitem.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    moved = {}
    try:
        for table in ("assinaturas", "transmissoes"):
            out = RetailSource(spark, folder)(table)
            capsys.readouterr()
            out.explain("formatted")
            text = capsys.readouterr().out
            inputs = [line for at, line in zip(text.splitlines(), text.splitlines()[1:]) if ") Exchange" in at and "data_inicio" in line]
            moved[table] = [sorted(c.split("#")[0] for c in line.split(": [", 1)[1].rstrip("]").split(", ")) for line in inputs]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert moved == {
        "assinaturas": [["_id", "data_fim", "data_inicio", "id_viewer", "tipo", "valor_mensal"]],
        "transmissoes": [["_id", "data_inicio", "pico_viewers"]],
    }
    rows = quality.as_bronze(RetailSource(spark, folder)("assinaturas")).collect()
    assert {tuple(row) for row in rows} == {
        ("2", "6", "21", "gratis", "1995-01-02", "1995-02-01", "0.00"),
        ("2", "7", "21", " TIER2 ", "1995-01-03", None, "7.25"),
        (None, "8", None, "none", None, None, "1.00"),
        ("5", None, None, "tier1", "1995-01-04", None, None),
    }
    rows = quality.as_bronze(RetailSource(spark, folder)("transmissoes")).collect()
    assert {tuple(row) for row in rows} == {
        ("2", "21", "301", "1995-01-02 00:00:00", "1995-02-02 00:00:00", "99"),
        ("2", "21", "301", "1995-01-03 00:00:00", "1995-02-02 00:00:00", "7"),
        (None, None, None, None, None, "1"),
        ("5", None, None, "1995-01-04 00:00:00", None, None),
    }


def test_audit_reads_a_table_name_once_a_file(spark, folder):
    """Rows of the landing files are counted by file before the path is taken apart; a table without rows has no line, rows
    that come twice count twice, and so do those without keys."""
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name, rows = os.path.basename(path), spark.read.parquet(path)
        if name == "events.parquet":
            rows = rows.where("event_type != 'click'")
        if name == "part.parquet":
            rows = rows.union(rows).withColumn("p_partkey", F.when(F.col("p_partkey") % 3 > 0, F.col("p_partkey")))
        if name in ("events.parquet", "part.parquet"):
            rows.write.parquet(f"{folder}/{name}")
        else:
            os.symlink(path, f"{folder}/{name}")
    found = bronze_audit(spark, folder)
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract" in text and "regexp_extract" not in text.partition("Union")[2]
    counts = {name: RetailSource(spark, folder)(name).count() for name in WIDE_SPECS}
    assert counts.pop("raids") == 0
    assert {tuple(row) for row in found.collect()} == {(name, DAY, n, n) for name, n in counts.items()}
    assert counts["jogos"] == 2 * spark.read.parquet(f"{FOLDER}/part.parquet").count()


def test_facts_move_days_not_moments(spark, capsys, folder):
    """Lookups that shuffle a fact carry its day key and duration, not the moments that these are read from."""
    moment = "cast({} as timestamp_ntz)".format
    start, end = moment("'2024-01-02 23:59:58'"), moment("'2024-01-03 00:01:28'")
    t = {
        "transmissoes": spark.sql(f"SELECT 1L id_transmissao, 7L id_streamer, 9L id_jogo, {start} data_inicio, {end} data_fim, 5 pico_viewers UNION ALL SELECT 2L, NULL, 8L, {moment('NULL')}, {end}, NULL"),
        "visualizacoes": spark.sql(f"SELECT 1L id_visualizacao, 4L id_viewer, 1L id_transmissao, 3 minutos_assistidos, {end} data_hora UNION ALL SELECT 2L, NULL, 3L, NULL, {moment('NULL')}"),
        "doacoes": spark.sql(f"SELECT 1L id_doacao, 4L id_viewer, 7L id_streamer, 1L id_transmissao, 2.50BD valor, {end} data_hora UNION ALL SELECT 2L, 5L, NULL, NULL, NULL, {moment('NULL')}"),
        **{f"dim_{name}": spark.sql(f"SELECT {key}L id_{name}, {key * 10}L sk_{name}") for name, key in (("streamer", 7), ("jogo", 9), ("viewer", 4))},
    }
    for name, rows in t.items():
        rows.write.parquet(f"{folder}/{name}")
        t[name] = spark.read.parquet(f"{folder}/{name}")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("fato_transmissoes", "fato_visualizacoes", "fato_doacoes"):
            t[name] = star.STAR[name](t, {})
            text = plan(t[name], capsys)
            moved = [line for at, line in zip(text.splitlines(), text.splitlines()[1:]) if ") Exchange" in at]
            assert [line for line in moved if "sk_tempo" in line] and not [line for line in moved if "data_" in line]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {tuple(row) for row in t["fato_transmissoes"].collect()} == {(20240102, 70, 90, 1, 5, 1.5), (-1, -1, -1, 2, None, None)}
    assert {tuple(row) for row in t["fato_visualizacoes"].collect()} == {(20240103, 40, 70, 90, 1, 1, 3), (-1, -1, -1, -1, 2, 3, None)}
    assert {tuple(row)[:5] for row in t["fato_doacoes"].collect()} == {(20240103, 40, 70, 1, 1), (-1, -1, -1, 2, None)}
