"""What a failed, partial or incomplete run leaves behind, and what must not be lost on the way."""

import glob
import gzip
import os

import pytest
from pyspark.sql import functions as F

from sedimenta.operators import joins, quality
from sedimenta.plans import analytics, lake, sizing
from sedimenta.plans.layers import run_layers
from sedimenta.plans.specs import SPECS
from sedimenta.sources import landing, tables
from test_layers import source

DAY = "2024-05-01"


def files_under(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(root) for f in fs}


def failing(df):
    return df.select("id", F.when(F.col("id") < 0, "x").otherwise(F.raise_error(F.lit("broken"))).alias("text"))


def test_a_failed_write_leaves_the_table(spark, folder):
    path = tables.table_path(folder, "silver", "t")
    tables.write_table(spark.range(5), path)
    with pytest.raises(Exception):
        tables.write_table(failing(spark.range(5)), path)
    assert tables.read_table(spark, folder, "silver", "t").count() == 5
    assert not [name for name in os.listdir(f"{folder}/silver") if name.startswith("_writing")]


def test_readers_see_the_old_table_until_the_switch(spark, folder, monkeypatch):
    path = tables.table_path(folder, "silver", "t")
    tables.write_table(spark.range(5), path)
    seen = []
    switch = tables._take_place

    def watched(*args):
        seen.append(tables.read_table(spark, folder, "silver", "t").count())
        switch(*args)

    monkeypatch.setattr(tables, "_take_place", watched)
    tables.write_table(spark.range(7), path)
    assert seen == [5] and tables.read_table(spark, folder, "silver", "t").count() == 7


def test_a_table_can_be_written_from_itself(spark, folder):
    path = tables.table_path(folder, "silver", "t")
    tables.write_table(spark.range(5), path)
    tables.write_table(tables.read_table(spark, folder, "silver", "t").where("id > 1"), path)
    assert tables.read_table(spark, folder, "silver", "t").count() == 3


def test_a_switch_cut_short_is_read_from_the_table_before(spark, folder):
    path = tables.table_path(folder, "silver", "t")
    tables.write_table(spark.range(5), path)
    os.rename(path, tables._beside(path, "_previous"))
    assert tables.read_table(spark, folder, "silver", "t").count() == 5


@pytest.mark.parametrize("text", ["a\nb", "a\r\nb", "\r", 'q"u,o"te', "\\n", "\\\\s\\", "\\", " a ", "é\n\n日"])
def test_landing_keeps_every_character(spark, folder, text):
    df = spark.createDataFrame([(1, text), (2, "next")], "id long, nome string")
    path = landing.write_landing(df, folder, "t", DAY)
    got = {row.id: row.nome for row in landing.read_landing_csv(spark, path).collect()}
    assert got == {"1": text, "2": "next"}


def test_only_text_is_escaped(spark, folder):
    """Numbers, dates, times and booleans have nothing to escape; nested values may."""
    df = spark.createDataFrame([(1,)], "id long").select(
        "id", F.lit(-1.5).alias("n"), F.lit(True).alias("b"), F.lit("2024-01-02 03:04:05").cast("timestamp_ntz").alias("t"),
        F.lit("2024-01-02").cast("date").alias("d"), F.lit("a\\\n").alias("s"), F.array(F.lit("x\\\ny")).alias("a"),
    )
    path = landing.write_landing(df, folder, "t", DAY)
    row = landing.read_landing_csv(spark, path).first()
    assert row.asDict() == {
        "id": "1", "n": "-1.5", "b": "True", "t": "2024-01-02 03:04:05", "d": "2024-01-02", "s": "a\\\n", "a": "[x\\\ny]"
    }
    touched = [name for name, kind in df.dtypes if "replace" in str(landing.landed_text(df.schema[name]))]
    assert touched == ["s", "a"]


def test_files_of_other_writers_are_read_as_they_are(spark, folder):
    with open(f"{folder}/x.csv", "w") as out:
        out.write("a\n\\n\n")
    assert landing.read_landing_csv(spark, f"{folder}/x.csv", escapes=False).first().a == "\\n"


def test_landing_files_are_compressed_and_divisible(spark, folder, monkeypatch):
    """No file has more rows than a task should, and all of them are found and read like plain ones."""
    monkeypatch.setattr(landing, "FILE_ROWS", 100)
    df = spark.range(0, 1_000, 1, 2).select("id", F.concat(F.lit('say "a,b"\n\\'), "id").alias("nome"))
    paths = {name: landing.write_landing(df, folder, name, DAY, compression=kind) for name, kind in (("p", "none"), ("t", "gzip"))}
    assert landing.write_landing(df, folder, "t", DAY) == paths["t"]
    ends = {"p": ".csv", "t": ".csv.gz"}
    sizes = {}
    for name, path in paths.items():
        parts = glob.glob(f"{path}/part-*")
        assert len(parts) == 10 and all(part.endswith(ends[name]) for part in parts)
        sizes[name] = sum(map(os.path.getsize, parts))
        assert {tuple(row) for row in landing.read_landing_csv(spark, path).collect()} == {
            (str(i), f'say "a,b"\n\\{i}') for i in range(1_000)
        }
    assert 2 * sizes["t"] < sizes["p"]
    found = landing.discover_landing(spark, folder, DAY).groupBy("tabela").count()
    assert {tuple(row) for row in found.collect()} == {("p", 10), ("t", 10)}


def test_a_single_compressed_file_of_another_writer(spark, folder):
    path = landing.landing_path(folder, "t", DAY)
    os.makedirs(os.path.dirname(path))
    with gzip.open(f"{path}.csv.gz", "wt") as out:
        out.write("a\n\\n\n")
    assert [row.tabela for row in landing.discover_landing(spark, folder, DAY).collect()] == ["t"]
    assert landing.landed_path(spark, folder, "t", DAY) == f"{path}.csv.gz"
    assert landing.read_landing_csv(spark, f"{path}.csv.gz").first().a == "\\n"


def test_line_breaks_through_all_layers(spark, folder):
    plain = source(spark)
    odd = lambda name: plain(name).withColumn("nome", F.concat("nome", F.lit('\n"x",\r\ny'))) if name == "jogos" else plain(name)
    log = {(r.stage, r.table): r for r in run_layers(spark, odd, folder, DAY, stages=("landing", "bronze", "silver"), tables=["jogos"]).collect()}
    want = {r.nome for r in odd("jogos").collect()}
    assert {r.nome for r in tables.read_table(spark, folder, "silver", "jogos").collect()} == want
    assert log["landing", "jogos"].rows == log["bronze", "jogos"].rows == log["silver", "jogos"].rows > 0


@pytest.fixture(scope="module")
def lake_root(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("subset"))
    run_layers(spark, source(spark), root, DAY)
    return root


def test_only_what_was_asked_for_is_written(spark, lake_root):
    before = files_under(lake_root)
    log = run_layers(spark, source(spark), lake_root, DAY, stages=("silver", "star"), tables=["plataformas"], objects=["dim_streamer"])
    after = files_under(lake_root)
    changed = {path for path in after if before.get(path) != after[path]} | (set(before) - set(after))
    names = {path[len(lake_root) + 1 :].split("/")[1].split("-")[-1] for path in changed if "_run_log" not in path}
    assert names <= {"plataformas", "_quarentena", "dim_streamer"} and "dim_streamer" in names
    assert sorted((r.stage, r.table) for r in log.collect()) == [("silver", "plataformas"), ("star", "dim_streamer")]


def test_every_log_row_counts(spark, lake_root):
    run_layers(spark, source(spark), lake_root, DAY, stages=("export",), export=lambda name, df: None)
    rows = spark.read.parquet(f"{lake_root}/_run_log").collect()
    assert rows and all(row.rows is not None for row in rows)
    assert {row.stage for row in rows} == {"landing", "bronze", "silver", "star", "marts", "export"}


def test_missing_inputs_are_errors(spark, lake_root):
    run_layers(spark, source(spark), lake_root, "2024-05-02", stages=("landing",), tables=["jogos"])
    with pytest.raises(FileNotFoundError, match="plataformas"):
        run_layers(spark, source(spark), lake_root, "2024-05-02", stages=("bronze",), tables=["jogos", "plataformas"])
    with pytest.raises(ValueError, match=DAY):
        run_layers(spark, source(spark), lake_root, "2024-05-02", stages=("silver",), tables=["plataformas"])


def test_a_run_puts_the_shuffle_width_back(spark, folder):
    before = spark.conf.get(sizing.INITIAL, None)
    with sizing.kept_shuffles(spark):
        spark.conf.set(sizing.INITIAL, "77")
    assert spark.conf.get(sizing.INITIAL, None) == before


def test_no_local_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda name, default=None: None)

    with pytest.raises(RuntimeError, match="checkpoint"):
        lake.shared_folder(Session())
    Session.sparkContext.master = "local[4]"
    assert lake.shared_folder(Session())


def test_width_counts_before_a_side_is_broadcast(spark):
    narrow = spark.range(1)
    wide = narrow.select("id", *[F.lit("x").alias(f"c{i}") for i in range(40)])
    assert joins.fits_everywhere(narrow, joins.BROADCAST_ROWS)
    assert not joins.fits_everywhere(wide, joins.BROADCAST_ROWS) and joins.fits_everywhere(wide, 1000)
    assert not joins.fits_everywhere(narrow, None)


def test_fanout_beyond_64_bits(spark):
    views = spark.range(2_000).selectExpr("1L AS sk_streamer", "CAST(1e15 AS BIGINT) AS minutos_assistidos", "id AS sk_viewer")
    donations = spark.range(20_000).selectExpr("1L AS sk_streamer", "CAST(1 AS DECIMAL(8,2)) AS valor")
    streamers = spark.createDataFrame([(1, "a")], "sk_streamer long, nome_streamer string")
    t = {"fato_visualizacoes": views, "fato_doacoes": donations, "dim_streamer": streamers}
    row = analytics.engagement_fanout(t).first()
    assert int(row.minutos_assistidos) == 2_000 * 10**15 * 20_000 > 2**63
    assert int(row.total_doacoes) == 20_000 * 2_000


def test_unknown_viewer_is_not_counted(spark):
    t = {"fato_visualizacoes": spark.createDataFrame([(-1,), (1,), (1,), (2,)], "sk_viewer long")}
    assert analytics.distinct_viewers(t).first()[0] == 2


def test_unread_values_keep_their_text(spark):
    spec = SPECS["assinaturas"]
    row = ("1", "2", "3", "tier1", "2024-01-01", "2024-13-01", "x9.50")
    df = spark.createDataFrame([row], ", ".join(f"{name} string" for name in spec.columns))
    found = quality.evaluate_strict(df, spec, raw="_original").first()
    assert found[quality.REASON] == "cast_invalido:data_fim; cast_invalido:valor_mensal"
    assert '"valor_mensal":"x9.50"' in found._original and found.valor_mensal is None
