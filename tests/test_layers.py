import os

import pytest
from pyspark.sql import functions as F

from sedimenta.plans import marts, sizing, star
from sedimenta.plans.lake import Lake, shared_folder
from sedimenta.plans.layers import export_marts, landed_tables, run_layers
from sedimenta.plans.specs import SPECS
from sedimenta.sources import jdbc, landing, synthetic, tables


def test_csv_quotes_blanks_and_spaces(spark, folder):
    df = spark.createDataFrame(
        [(1, 'a "x" b, c', ""), (2, " com espaco ", None), (3, "barra \\ e , virgula", "fim")], "id int, a string, b string"
    )
    path = landing.write_landing(df, folder, "frases", "2024-01-01")
    rows = {tuple(r) for r in landing.read_landing_csv(spark, path).collect()}
    assert rows == {("1", 'a "x" b, c', None), ("2", " com espaco ", None), ("3", "barra \\ e , virgula", "fim")}


def test_csv_line_breaks(spark, folder):
    df = spark.createDataFrame([(1, "uma\nduas"), (2, "x")], "id int, a string")
    path = landing.write_landing(df, folder, "linhas", "2024-01-01")
    assert {r.a for r in landing.read_landing_csv(spark, path, multi_line=True).collect()} == {"uma\nduas", "x"}


def test_landing_values_are_written_as_text(spark, folder):
    df = spark.sql("SELECT true AS a, DATE'2024-01-05' AS b, TIMESTAMP'2024-01-05 07:08:09' AS c, 1.50BD AS d")
    path = landing.write_landing(df, folder, "tipos", "2024-01-01")
    assert tuple(landing.read_landing_csv(spark, path).first()) == ("True", "2024-01-05", "2024-01-05 07:08:09", "1.50")


def test_discovery(spark, folder):
    df = spark.range(3)
    for table in ("streamers", "jogos"):
        landing.write_landing(df, folder, table, "2024-01-01")
    landing.write_landing(df, folder, "viewers", "2024-01-02")
    found = landing.discover_landing(spark, folder, "2024-01-01")
    assert {r.tabela for r in found.collect()} == {"streamers", "jogos"}
    assert {r.tabela for r in landing.discover_landing(spark, folder, "2024-01-01", ["jogos"]).collect()} == {"jogos"}
    names = spark.createDataFrame([("/x/extraction_date=2024-01-01/public__emotes.csv",), ("s3a://b/public__raids/part-0.csv",)], "p string")
    assert [r[0] for r in names.select(landing.table_name(F.col("p"))).collect()] == ["emotes", "raids"]


def test_nothing_landed_is_an_error(spark, folder):
    landing.write_landing(spark.range(1), f"{folder}/landing", "outra", "2024-01-01")
    with pytest.raises(FileNotFoundError):
        landed_tables(spark, folder, "2024-01-01", ["jogos"])


SIZES = {"streamers": 40, "viewers": 60, "transmissoes": 80}


def source(spark, n=200):
    sizes = {**{t: n for t in SPECS}, "plataformas": 3, "jogos": 7, **SIZES}
    return lambda name: synthetic.synthesize(spark, name, sizes[name], sizes=sizes)


def test_synthetic_rows_do_not_depend_on_partitioning(spark):
    make = source(spark)
    for name in SPECS:
        df = make(name)
        assert df.dtypes == [(c, t.simpleString()) for c, t in SPECS[name].columns.items()]
    before = make("doacoes").collect()
    assert sorted(before) == sorted(make("doacoes").repartition(3).collect())
    assert synthetic.synthesize(spark, "raids").count() == synthetic.SIZES["raids"]
    with pytest.raises((ValueError, KeyError)):
        synthetic.synthesize(spark, "nada")


def test_synthetic_ranges(spark):
    raids = synthetic.synthesize(spark, "raids")
    assert raids.where("id_streamer_origem = id_streamer_destino").count() == 0
    streams = synthetic.synthesize(spark, "transmissoes")
    hours = (F.unix_timestamp("data_fim") - F.unix_timestamp("data_inicio")) / 3600
    low, high = streams.agg(F.min(hours), F.max(hours)).first()
    assert (low, high) == (1, 12)
    first, last = streams.agg(F.min(F.to_date("data_inicio")), F.max(F.to_date("data_inicio"))).first()
    assert str(first) >= synthetic.FIRST_DAY and str(last) <= synthetic.LAST_DAY
    ended = synthetic.synthesize(spark, "assinaturas")
    share = ended.where("data_fim is not null").count() / ended.count()
    assert 0.57 < share < 0.63
    assert ended.where("tipo = 'gratis' and valor_mensal <> 0").count() == 0
    assert ended.where("data_fim < data_inicio").count() == 0


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("run"))
    log = run_layers(spark, source(spark), root, "2024-05-01")
    return root, {(r.stage, r.table): r for r in log.collect()}


def test_all_layers(spark, finished):
    root, log = finished
    for table in SPECS:
        done = log["silver", table]
        assert done.read == log["bronze", table].rows == done.rows + done.rejected + done.duplicates
    facts = {"fato_doacoes": "doacoes", "fato_visualizacoes": "visualizacoes", "fato_assinaturas": "assinaturas", "fato_transmissoes": "transmissoes"}
    for fact, table in facts.items():
        assert log["star", fact].rows == log["silver", table].rows
        assert log["star", fact].unknown_keys == 0
    for name in ("dim_streamer", "dim_viewer", "dim_jogo", "dim_plataforma"):
        stored = tables.read_table(spark, root, "gold", name)
        sk = stored.columns[0]
        keys = sorted(r[0] for r in stored.select(sk).collect())
        assert keys == [-1, *range(1, len(keys))]
    bronze = tables.read_table(spark, root, "bronze", "jogos", drop_audit=False)
    assert all(t == "string" for c, t in bronze.dtypes if c != "_ingestion_timestamp")
    assert bronze.where("_source_file like '%public__jogos%'").count() == bronze.count()
    silver = tables.read_table(spark, root, "silver", "jogos", drop_audit=False)
    assert {"_extraction_date", "_silver_processed_at"} <= set(silver.columns)
    assert spark.read.parquet(tables.quarantine_path(root, "jogos")).count() == 0


def test_stored_tables_have_details(spark, finished):
    root, _ = finished
    detail = tables.table_detail(spark, tables.table_path(root, "gold", "fato_doacoes")).first()
    assert detail.arquivos >= 1 and detail.bytes > 0 and detail.modificado is not None


def test_rerun_gives_the_same_tables(spark, finished):
    root, _ = finished
    before = tables.read_table(spark, root, "gold", "agg_streamer_visao_geral").collect()
    run_layers(spark, source(spark), root, "2024-05-01", stages=("star", "marts"))
    after = tables.read_table(spark, root, "gold", "agg_streamer_visao_geral").collect()
    assert sorted(before) == sorted(after)
    assert spark.read.parquet(f"{root}/_run_log").select("run_at").distinct().count() == 2


def test_lazy_star_equals_the_stored_one(spark, finished):
    root, _ = finished
    silver = {name: tables.read_table(spark, root, "silver", name) for name in SPECS}
    built = star.build_gold(silver, ["fato_visualizacoes", "dim_tempo"])
    assert list(built) == ["dim_tempo", "fato_visualizacoes"]
    counts = tables.stored_counts(spark, {name: tables.table_path(root, "silver", name) for name in SPECS}).collect()
    sized = star.build_gold(silver, ["fato_visualizacoes"], {row.tabela: row.linhas for row in counts})
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (built["fato_visualizacoes"], sized["fato_visualizacoes"])]
    assert "approx_top_k" in plans[0] and "approx_top_k" not in plans[1]
    for name, df in [*built.items(), *sized.items()]:
        stored = tables.read_table(spark, root, "gold", name).select(df.columns)
        assert sorted(df.collect(), key=repr) == sorted(stored.collect(), key=repr)


def test_export_goes_through_each_mart(spark, finished):
    root, _ = finished
    sent = {}
    run_layers(spark, source(spark), root, "2024-05-01", stages=("export",), export=lambda name, df: sent.update({name: df.count()}))
    assert set(sent) == set(marts.MARTS) and sent["agg_streamer_visao_geral"] == SIZES["streamers"]
    with pytest.raises(ValueError):
        run_layers(spark, source(spark), root, "2024-05-01", stages=("export",))
    with pytest.raises(ValueError):
        export_marts(spark, root, "jdbc:x", "s", names=["outro"])


def test_partitioned_write(spark, folder):
    df = spark.range(10).withColumn("p", F.col("id") % 2)
    tables.write_table(df, f"{folder}/t", partition_by=("p",))
    tables.write_table(df, f"{folder}/t", partition_by=("p",))
    assert spark.read.parquet(f"{folder}/t").where("p = 1").count() == 5


def test_quarantine_keeps_rows_and_reasons(spark, folder):
    bad = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "c")], "id_plataforma int, nome string")
    lake = Lake(spark, folder, lambda name: bad)
    done = lake.write_quarantine("plataformas")
    assert (done.read, done.rows, done.rejected, done.duplicates) == (4, 1, 2, 1)
    stored = spark.read.parquet(tables.quarantine_path(folder, "plataformas"))
    assert {r._motivo_rejeicao for r in stored.collect()} == {"nulo_obrigatorio:nome", "pk_nula:id_plataforma"}


def test_shared_folder_is_the_sessions(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


class Recorder:
    """Stands in for a reader or writer: keeps the options, opens no connection."""

    def __init__(self, ends=(1, 1000)):
        self.seen, self.ends = [], ends
        self.set = {}

    def format(self, name):
        self.set = {"format": name}
        return self

    def options(self, **values):
        self.set.update(values)
        return self

    def option(self, name, value):
        other = Recorder(self.ends)
        other.seen, other.set = self.seen, {**self.set, name: value}
        return other

    def mode(self, name):
        self.set["mode"] = name
        return self

    def load(self):
        self.seen.append(dict(self.set))
        return self

    save = load

    def first(self):
        return self.ends


class Session:
    def __init__(self, ends=(1, 1000)):
        self.read = self.write = Recorder(ends)


def test_jdbc_reads_ranges_in_parallel():
    session = Session()
    jdbc.extract_tables(session, "jdbc:postgresql://h/db", {"doacoes": "id_doacao"}, partitions=4, user="u")
    ends, read = session.read.seen
    assert ends["query"] == 'SELECT MIN("id_doacao") AS lo, MAX("id_doacao") AS hi FROM "public"."doacoes"'
    assert (read["dbtable"], read["lowerBound"], read["upperBound"], read["numPartitions"]) == ('"public"."doacoes"', 1, 1001, 4)


def test_jdbc_ranges_follow_the_counted_rows():
    for rows, ranges in ((1_000_000, None), (1_000_001, 2), (250_000_000_000, 250_000)):
        session = Session(ends=(1, 1 << 40, rows))
        jdbc.read_jdbc_table(session, "jdbc:x", "doacoes", "id")
        probe, read = session.read.seen
        assert probe["query"].endswith('COUNT(*) AS n FROM "public"."doacoes"')
        assert read.get("numPartitions") == ranges


def test_jdbc_reads_empty_and_keyless_tables_whole():
    session = Session(ends=(None, None))
    jdbc.read_jdbc_table(session, "jdbc:x", "vendas.doacoes", "id")
    jdbc.read_jdbc_table(session, "jdbc:x", "doacoes")
    assert [r.get("dbtable") for r in session.read.seen] == [None, '"vendas"."doacoes"', '"public"."doacoes"']
    with pytest.raises(ValueError):
        jdbc.qualified('x"; drop')


def test_jdbc_export_keeps_the_table_definition():
    session = Session()
    jdbc.export_jdbc(session, "jdbc:x", "gold_analytics.agg", driver="org.postgresql.Driver")
    (sent,) = session.write.seen
    assert (sent["truncate"], sent["mode"], sent["dbtable"]) == ("true", "overwrite", "gold_analytics.agg")


def test_empty_tables_go_through(spark, folder):
    lake = Lake(spark, folder, lambda name: synthetic.synthesize(spark, name, 0))
    done = lake.write_quarantine("doacoes")
    assert (done.read, done.rows, done.rejected, done.duplicates) == (0, 0, 0, 0)
    assert lake.build("dim_viewer").rows == 1
    assert (lake.build("fato_doacoes").rows, lake.build("fato_doacoes").unknown_keys) == (0, 0)
    with pytest.raises(Exception, match="no valid dates"):
        lake.build("dim_tempo")
    with pytest.raises(KeyError):
        lake["nada"]


def test_shuffles_start_as_wide_as_the_data(spark, folder, monkeypatch):
    for n in (1_000, 100_000):
        spark.range(n).coalesce(1).write.parquet(f"{folder}/{n}")
    small, large = f"{folder}/1000", f"{folder}/100000"
    assert 1_000 < sizing.stored_bytes(spark, small) < sizing.stored_bytes(spark, large)
    assert [sizing.partitions_for(n) for n in (0, 1, 1 << 30, 100 << 40)] == [0, 1, 4, 409_600]
    sizing.size_shuffles(spark, large)
    assert spark.conf.get(sizing.INITIAL, None) is None
    monkeypatch.setattr(sizing, "BYTES_PER_PARTITION", 100)
    try:
        sizing.size_shuffles(spark, small)
        first = int(spark.conf.get(sizing.INITIAL))
        sizing.size_shuffles(spark, large)
        second = int(spark.conf.get(sizing.INITIAL))
        assert 8 < first < second
        sizing.size_shuffles(spark, small)
        assert int(spark.conf.get(sizing.INITIAL)) == second
    finally:
        spark.conf.unset(sizing.INITIAL)


def test_tasks_stay_small_as_the_data_grows(spark, folder):
    """A task's share of a shuffle or scan is bounded; a session's own smaller one is left, and all is put back."""
    spark.range(10).write.parquet(f"{folder}/t")
    advisory, scanned = sizing.TASK_BYTES
    assert [sizing.fine_partitions_for(n) for n in (0, 1, 1 << 30, 6 << 30, 100 << 40)] == [0, 1, 64, 384, 409_600]
    assert [sizing.setting_bytes(text) for text in ("64MB", "8m", "1024", "1g", "134217728b")] == [64 << 20, 8 << 20, 1024, 1 << 30, 128 << 20]
    before = [spark.conf.get(name) for name in (advisory, scanned)]
    with sizing.kept_shuffles(spark):
        spark.conf.set(advisory, "64MB")
        spark.conf.set(scanned, "8m")
        sizing.size_shuffles(spark, folder)
        assert sizing.setting_bytes(spark.conf.get(advisory)) == 16 << 20 and spark.conf.get(scanned) == "8m"
    assert [spark.conf.get(name) for name in (advisory, scanned)] == before


def test_files_are_broadcast_by_their_rows_not_by_their_size(spark, folder, capsys):
    """Files of 10 MB can hold rows that take hundreds in the driver: what is planned by files is small, the rest is
    broadcast once its rows are counted. A session's own settings are kept, and all are put back."""
    names = (sizing.PLANNED_BROADCAST, sizing.COUNTED_BROADCAST, sizing.BROADCAST_WAIT)
    before = [spark.conf.get(name, None) for name in names]
    spark.range(600_000).select("id", (F.col("id") % 7).alias("n")).coalesce(1).write.parquet(f"{folder}/t")
    assert sizing.PLANNED_BROADCAST_BYTES < sizing.stored_bytes(spark, f"{folder}/t") < 10 << 20
    with sizing.kept_shuffles(spark):
        for name in names:
            spark.conf.unset(name)
        sizing.size_shuffles(spark, folder)
        assert sizing.setting_bytes(spark.conf.get(sizing.PLANNED_BROADCAST)) == 256 << 10
        assert sizing.setting_bytes(spark.conf.get(sizing.COUNTED_BROADCAST)) == 10 << 20
        assert spark.conf.get(sizing.BROADCAST_WAIT) == "3600"
        members = spark.read.parquet(f"{folder}/t")
        rows = spark.range(900_000).withColumn("more", F.col("id") + 1)
        for kept, join in ((members, "SortMergeJoin"), (members.where("pmod(id, 1000) = 3"), "BroadcastHashJoin")):
            joined = rows.join(kept, "id")
            joined.explain()
            assert "SortMergeJoin" in capsys.readouterr().out
            joined.collect()
            joined.explain()
            final = capsys.readouterr().out.split("Initial Plan")[0]
            assert join in final
        for name, own in zip(names, ("-1", "1m", "60")):
            spark.conf.set(name, own)
        sizing.size_shuffles(spark, folder)
        assert [spark.conf.get(name) for name in names] == ["-1", "1m", "60"]
    assert [spark.conf.get(name, None) for name in names] == before


@pytest.mark.parametrize("resume", [False, True])
def test_a_run_broadcasts_no_large_files(spark, folder, monkeypatch, resume):
    """While the star is made, also of a run that is taken up again; the session's own threshold is back afterwards."""
    name, seen = "spark.sql.autoBroadcastJoinThreshold", []
    before, build = spark.conf.get(name), star.STAR["dim_jogo"]
    monkeypatch.setitem(star.STAR, "dim_jogo", lambda t, rows: seen.append(spark.conf.get(name)) or build(t, rows))
    asked = dict(tables=["jogos"], objects=["dim_jogo"])
    spark.conf.set(name, "10MB")
    try:
        run_layers(spark, source(spark), folder, "2024-05-01", ("landing", "bronze", "silver"), record=resume, **asked)
        run_layers(spark, source(spark), folder, "2024-05-01", ("bronze", "silver", "star"), resume=resume, **asked)
        assert seen == [str(256 << 10)] and spark.conf.get(name) == "10MB"
    finally:
        spark.conf.set(name, before)


def test_stored_layers_are_written_compressed(spark, folder):
    lake = Lake(spark, folder, source(spark))
    lake.build("dim_plataforma")
    files = [name for _, _, names in os.walk(folder) for name in names if name.startswith("part-")]
    assert len(files) >= 2 and all(name.endswith(".zstd.parquet") for name in files)


def test_work_on_a_folder_is_done_once(spark, folder):
    lake, calls = Lake(spark, folder, None), []
    assert lake.once("a", lambda root: calls.append(root) or root) == f"{folder}/a" == lake.once("a", calls.append)
    assert calls == [f"{folder}/a"]


def test_a_failed_run_leaves_its_log(spark, folder):
    """Empty tables get as far as the calendar."""
    with pytest.raises(Exception, match="no valid dates"):
        run_layers(spark, lambda name: synthetic.synthesize(spark, name, 0), folder, "2024-05-01")
    log = spark.read.parquet(f"{folder}/_run_log")
    assert {r.stage for r in log.collect()} == {"landing", "bronze", "silver"}
