"""One registered query per operator and table; each takes (spark, folder of the source parquet files).

Sources, bronze, rule checks and silver are computed from the files in the query itself. Star, marts
and analytics read stored layers that the session's first such query builds from the same files.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions.calendar import calendar_columns, date_key
from sedimenta.functions.measures import percent_change, ratio
from sedimenta.functions.parsing import parse_as
from sedimenta.operators import quality
from sedimenta.operators.audit import EXTRACTION_DATE, INGESTED_AT, SOURCE_FILE, stamp_bronze, without_audit
from sedimenta.operators.dimensional import map_surrogate, or_unknown, unknown_key_counts
from sedimenta.operators.joins import lookup_by
from sedimenta.operators.ordering import number_rows
from sedimenta.plans import analytics, audience, marts, star
from sedimenta.plans.lake import Lake, session_lake
from sedimenta.plans.layers import load_bronze, run_layers
from sedimenta.plans.sizing import size_shuffles
from sedimenta.plans.specs import WIDE_SPECS
from sedimenta.sources.bucketed import bucketed_join, write_bucketed
from sedimenta.sources.clustered import write_clustered
from sedimenta.sources.landing import landing_path, read_landing_csv, table_name, write_landing
from sedimenta.sources.months import MONTH, read_months, write_months
from sedimenta.sources.retail import RetailSource
from sedimenta.sources.tables import (
    quarantine_path,
    read_table,
    register_star,
    row_counts,
    stored_bounds,
    stored_counts,
    table_path,
)

DAY = "2024-01-01"
# A key of each star and mart table that is summed up to compare them.
OUTPUT_KEYS = {
    "dim_plataforma": "sk_plataforma",
    "dim_streamer": "sk_streamer",
    "dim_viewer": "sk_viewer",
    "dim_jogo": "sk_jogo",
    "dim_tempo": "sk_tempo",
    "fato_transmissoes": "sk_streamer",
    "fato_visualizacoes": "sk_viewer",
    "fato_doacoes": "sk_viewer",
    "fato_assinaturas": "sk_viewer",
    "agg_streamer_visao_geral": "sk_streamer",
    "agg_receita_mensal": "mes",
    "agg_jogo_popularidade": "sk_jogo",
    "agg_plataforma_resumo": "sk_plataforma",
}
Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as DOUBLE and dates as ISO text, which read the same from every client of both engines."""
    shown = {T.DecimalType: "double", T.DateType: "string"}
    return df.select(
        *[
            F.col(f.name).cast(shown[type(f.dataType)]).alias(f.name) if type(f.dataType) in shown else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def lake_of(spark: SparkSession, folder: str) -> Lake:
    """The session's stored layers over ``folder``."""
    return session_lake(spark, folder, RetailSource(spark, folder), WIDE_SPECS)


def bronze_text(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """The source as bronze holds it: text only."""
    return quality.as_bronze(RetailSource(spark, folder)(table))


def typed(spark, folder, table):
    return quality.standardize(bronze_text(spark, folder, table), WIDE_SPECS[table])


def evaluated(spark, folder, table):
    return quality.evaluate_quality(typed(spark, folder, table), WIDE_SPECS[table])


def silver(spark, folder, table):
    clean, _ = quality.refine(bronze_text(spark, folder, table), WIDE_SPECS[table])
    return clean


def reasons(spark, folder, table):
    """Every row's key and the reasons it is rejected for."""
    return evaluated(spark, folder, table).select(WIDE_SPECS[table].key, F.col(quality.REASON).alias("motivo"))


# Landing and bronze


def landed(spark: SparkSession, folder: str, table: str) -> str:
    """One source table's landing files, written once per session to its shared folder."""
    source = RetailSource(spark, folder)
    return lake_of(spark, folder).once(f"landing/{table}", lambda root: write_landing(source(table), root, table, DAY))


def bronze(spark, folder, table):
    loaded = stamp_bronze(read_landing_csv(spark, landed(spark, folder, table)), DAY)
    return without_audit(loaded, "bronze")


def bronze_audit(spark, folder):
    """Rows and distinct extraction dates per source table, as the provenance columns tell them. Rows are counted by file,
    so that a table's name is read from the path once a file, not once a row."""
    parts = []
    for table in WIDE_SPECS:
        loaded = stamp_bronze(read_landing_csv(spark, landed(spark, folder, table)), DAY)
        parts.append(loaded.select(SOURCE_FILE, EXTRACTION_DATE, INGESTED_AT))
    files = reduce(DataFrame.unionByName, parts).groupBy(SOURCE_FILE, EXTRACTION_DATE).agg(
        F.count("*").alias("linhas"), F.count(INGESTED_AT).alias("carimbadas")
    )
    return files.groupBy(table_name(F.col(SOURCE_FILE)).alias("tabela"), EXTRACTION_DATE).agg(
        F.sum("linhas").alias("linhas"), F.sum("carimbadas").alias("carimbadas")
    )


def csv_infer_scan(spark, folder):
    found = read_landing_csv(spark, landed(spark, folder, "jogos"), infer=True)
    return found.select(F.col("id_jogo").cast("bigint").alias("id_jogo"), "nome", "desenvolvedor", "ano_lancamento", "ativo")


def landing_table_name(spark, folder):
    """Rows per table, the table taken from the path of each landing file (less its header line)."""
    paths = [landed(spark, folder, table) for table in WIDE_SPECS]
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"))
    files = lines.groupBy("path").agg(F.count("*").alias("_lines"))
    names = files.groupBy(table_name(F.col("path")).alias("tabela"))
    return names.agg(F.sum(F.col("_lines") - 1).alias("linhas"))


def landing_roundtrip(spark, folder):
    text = read_landing_csv(spark, landed(spark, folder, "transmissoes"))
    return quality.standardize(text, WIDE_SPECS["transmissoes"])


def landing_line_breaks(spark, folder):
    """Line breaks, quotes, commas and backslashes in values, through landing files and back."""
    games = RetailSource(spark, folder)("jogos")
    turn = F.col("id_jogo") % 4
    odd = F.when(turn == 0, "\n").when(turn == 1, "\r\n").when(turn == 2, '","').otherwise("\\n\\")
    named = games.withColumn("nome", F.concat("nome", odd, F.lit("fim")))
    path = lake_of(spark, folder).once("line_breaks", lambda root: write_landing(named, root, "jogos", DAY))
    return read_landing_csv(spark, path).select(F.col("id_jogo").cast("bigint").alias("id_jogo"), "nome")


def rowcount_report(spark, folder):
    source = RetailSource(spark, folder)
    return row_counts({name: source(name) for name in WIDE_SPECS})


def audit_prune(spark, folder):
    """A silver table with its audit columns, read without them."""
    stamped = typed(spark, folder, "streamers").withColumn("_silver_processed_at", F.current_timestamp())
    return without_audit(stamped.withColumn(EXTRACTION_DATE, F.lit(DAY)), "silver")


# Standardising


def std_strings(spark, folder):
    """Padded, upper-cased and blank text in plain and coded columns."""
    source = RetailSource(spark, folder)("emotes")
    blank = F.col("id_emote") % 7 == 0
    dirty = source.select(
        "id_emote",
        F.when(blank, F.lit("   ")).otherwise(F.concat(F.lit("  "), "nome", F.lit(" "))).alias("nome"),
        "id_streamer",
        F.upper("disponivel_para").alias("disponivel_para"),
    )
    return quality.standardize(quality.as_bronze(dirty), WIDE_SPECS["emotes"])


def std_boolean(spark, folder):
    """Every accepted spelling, and one that is not, spread over the games."""
    words = F.array(*[F.lit(w) for w in (" True ", "t", "1", "YES", "y", "False", "f", "0", "No", "n", "talvez", "")])
    word = F.element_at(words, (F.col("id_jogo") % 12 + 1).cast("int"))
    games = RetailSource(spark, folder)("jogos").select("id_jogo", word.alias("_word"))
    return games.select("id_jogo", parse_as(F.col("_word"), T.BooleanType()).alias("ativo"))


def std_numeric_dates(spark, folder):
    """Numbers with decimals, exponents and letters, and dates with and without a valid month."""
    orders = RetailSource(spark, folder).read("orders")
    turn = F.col("o_orderkey") % 4
    price = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    whole = (
        F.when(turn == 0, F.concat(F.lit(" "), price, F.lit(" ")))
        .when(turn == 1, F.concat(price, F.lit("e1")))
        .when(turn == 2, F.concat(F.lit("x"), price))
        .otherwise(price)
    )
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    dated = F.when(turn == 2, F.concat(F.year("o_orderdate").cast("string"), F.lit("-13-01"))).otherwise(day)
    text = orders.select("o_orderkey", whole.alias("_whole"), price.alias("_price"), dated.alias("_day"))
    return text.select(
        "o_orderkey",
        parse_as(F.col("_whole"), T.IntegerType()).alias("inteiro"),
        parse_as(F.col("_price"), T.DecimalType(8, 2)).alias("valor"),
        parse_as(F.col("_price"), T.DecimalType(6, 2)).alias("valor_curto"),
        parse_as(F.col("_day"), T.DateType()).alias("dia"),
    )


# Rules, quarantine, deduplication


def dq_valid(spark, folder):
    return quality.valid_rows(evaluated(spark, folder, "transmissoes"))


def dq_quarantine(spark, folder):
    return quality.quarantined_rows(evaluated(spark, folder, "assinaturas"))


def dq_strict_casts(spark, folder):
    """Reasons where amounts and dates that cannot be read are put in."""
    turn = F.col("id_assinatura").cast("bigint")
    dirty = bronze_text(spark, folder, "assinaturas").withColumns(
        {
            "valor_mensal": F.when(turn % 7 == 0, F.concat(F.lit("x"), "valor_mensal")).otherwise(F.col("valor_mensal")),
            "data_fim": F.when(turn % 11 == 0, F.lit("2024-13-01")).otherwise(F.col("data_fim")),
        }
    )
    found = quality.evaluate_strict(dirty, WIDE_SPECS["assinaturas"])
    return found.groupBy(F.col(quality.REASON).alias("motivo")).agg(F.count("*").alias("linhas"))


def dedup_visualizacoes(spark, folder):
    return silver(spark, folder, "visualizacoes")


def dedup_counts(spark, folder):
    """Rows taken out as copies, per table that has any."""
    report = dq_report(spark, folder)
    return report.where(F.col("duplicados") > 0).select("tabela", "duplicados")


def dq_report(spark, folder):
    return quality.quality_report({name: typed(spark, folder, name) for name in WIDE_SPECS}, WIDE_SPECS)


# Star


def lookup_unmatched(spark, folder):
    """Follows by streamer key: ids without a streamer go to the unknown member."""
    lake = lake_of(spark, folder)
    keyed = map_surrogate(
        lake["follows"],
        lake["dim_streamer"],
        "id_streamer",
        "id_streamer",
        "sk_streamer",
        right_rows=lake.rows["dim_streamer"],
        spread_by=("id_follow",),
    )
    return keyed.groupBy("sk_streamer").agg(F.count("*").alias("linhas"))


def lookup_hot_keys(spark, folder):
    """The same lookup for views by viewer, with the join that keeps hot keys apart."""
    lake = lake_of(spark, folder)
    keyed = map_surrogate(
        lake["visualizacoes"], lake["dim_viewer"], "id_viewer", "id_viewer", "sk_viewer", spread_by=("id_visualizacao",)
    )
    return keyed.groupBy("sk_viewer").agg(F.count("*").alias("linhas"), F.sum("minutos_assistidos").alias("minutos"))


def lookup_hot_streamer(spark, folder):
    """Follows by streamer, a quarter of them of one streamer, with the join that keeps hot keys apart."""
    lake = lake_of(spark, folder)
    keyed = map_surrogate(
        lake["follows"], lake["dim_streamer"], "id_streamer", "id_streamer", "sk_streamer", spread_by=("id_follow",)
    )
    return keyed.groupBy("sk_streamer").agg(F.count("*").alias("linhas"), F.max("id_follow").alias("ultimo"))


def smart_date_key(spark, folder):
    ends = RetailSource(spark, folder)("transmissoes")
    return ends.select("id_transmissao", date_key(F.col("data_fim")).alias("sk_tempo"))


def fact_unknown_fk_counts(spark, folder):
    lake = lake_of(spark, folder)
    return unknown_key_counts({name: lake[name] for name in star.FACTS})


# Functions


def fn_calendar(spark, folder):
    orders = RetailSource(spark, folder).read("orders").select("o_orderkey", F.to_date("o_orderdate").alias("_day"))
    return orders.select("o_orderkey", *calendar_columns(F.col("_day")))


def fn_reason_concat(spark, folder):
    """Several broken rules in one row, in rule order."""
    spec = WIDE_SPECS["assinaturas"]
    turn = F.col("id_assinatura")
    broken = RetailSource(spark, folder)("assinaturas").select(
        F.when(turn % 11 != 0, turn).alias("id_assinatura"),
        "id_viewer",
        "id_streamer",
        "tipo",
        F.when(turn % 5 != 0, F.col("data_inicio")).alias("data_inicio"),
        F.when(turn % 3 == 0, F.date_add("data_inicio", -1)).otherwise(F.col("data_fim")).alias("data_fim"),
        "valor_mensal",
    )
    found = quality.evaluate_quality(quality.standardize(broken, spec), spec)
    return found.groupBy(F.col(quality.REASON).alias("motivo")).agg(F.count("*").alias("linhas"))


def fn_null_guards(spark, folder):
    """Ratios and changes with zero and missing denominators."""
    orders = RetailSource(spark, folder).read("orders")
    part = F.when(F.col("o_orderkey") % 3 != 0, (F.col("o_orderkey") % 2).cast("double"))
    return orders.select(
        "o_orderkey",
        ratio(F.col("o_totalprice"), part).alias("razao"),
        (percent_change(F.col("o_totalprice"), part, 0) / 100).alias("variacao"),
    )


# Marts and SQL


def presented_mart(spark, folder, name):
    return marts.sort_by(lake_of(spark, folder)[name], *marts.ORDER[name])


def star_sql(spark, folder):
    """SQL over the registered star: donations per platform."""
    lake = lake_of(spark, folder)
    register_star(spark, {name: lake[name] for name in ("fato_doacoes", "dim_streamer")}, prefix="star_sql_")
    return spark.sql(
        """
        SELECT s.nome_plataforma, SUM(f.valor) AS total_doacoes, SUM(f.qtd) AS qtd_doacoes
        FROM (SELECT sk_streamer, SUM(valor) AS valor, COUNT(*) AS qtd FROM star_sql_fato_doacoes GROUP BY sk_streamer) f
        JOIN star_sql_dim_streamer s ON s.sk_streamer = f.sk_streamer
        GROUP BY s.nome_plataforma
        """
    )


def layers_end_to_end(spark, folder):
    """All tables through landing files, bronze, silver and star to the marts; gives the monthly one."""
    root = all_layers(spark, folder)
    return marts.sort_by(read_table(spark, root, "gold", "agg_receita_mensal"), "ano", "mes")


def all_layers(spark, folder):
    def run(root):
        run_layers(spark, RetailSource(spark, folder), root, DAY, specs=WIDE_SPECS)
        return root

    return lake_of(spark, folder).once("end_to_end", run)


def layers_all_outputs(spark, folder):
    """Rows and the sum of a key of each of the 26 tables that the same run wrote."""
    root = all_layers(spark, folder)
    keys = {("silver", name): spec.key for name, spec in WIDE_SPECS.items()}
    keys |= {("gold", name): OUTPUT_KEYS[name] for name in (*star.STAR, *marts.MARTS)}
    parts = [
        read_table(spark, root, layer, name).agg(
            F.lit(name).alias("tabela"), F.count("*").alias("linhas"), F.sum(F.col(key).cast("bigint")).alias("chaves")
        )
        for (layer, name), key in keys.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def quarantine_all(spark, folder):
    """Keys and reasons of all rows that the same run put in quarantine."""
    root = all_layers(spark, folder)
    parts = [
        spark.read.parquet(quarantine_path(root, name)).select(
            F.lit(name).alias("tabela"), F.col(spec.key).cast("bigint").alias("chave"), F.col(quality.REASON).alias("motivo")
        )
        for name, spec in WIDE_SPECS.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def landing_foreign(spark, folder):
    """Plain CSV of another writer, with line breaks, quotes, commas and backslashes in values, to bronze."""
    games = RetailSource(spark, folder)("jogos")
    turn = F.col("id_jogo") % 4
    odd = F.when(turn == 0, "\n").when(turn == 1, "C:\\new\\run").when(turn == 2, '","').otherwise("\\n\\")
    named = quality.as_bronze(games.withColumn("nome", F.concat("nome", odd, F.lit("fim"))))

    def load(root):
        named.write.csv(landing_path(f"{root}/landing", "jogos", DAY), header=True, escape='"')
        load_bronze(spark, root, "jogos", DAY, multi_line=True)
        return root

    root = lake_of(spark, folder).once("foreign", load)
    loaded = read_table(spark, root, "bronze", "jogos")
    return loaded.select(F.col("id_jogo").cast("bigint").alias("id_jogo"), "nome")


def run_resumed(spark, folder):
    """The log of a run that is taken up again after one table has landed anew: what depends on it is made again."""

    def run(root):
        source = RetailSource(spark, folder)
        run_layers(spark, source, root, DAY, specs=WIDE_SPECS, record=True)
        write_landing(source("doacoes"), f"{root}/landing", "doacoes", DAY)
        again = run_layers(spark, source, root, DAY, ("bronze", "silver", "star", "marts"), specs=WIDE_SPECS, resume=True)
        again.select("stage", "table", "operation", "rows").write.parquet(f"{root}/_last_log")
        return f"{root}/_last_log"

    return spark.read.parquet(lake_of(spark, folder).once("resumed", run))


def layer_types(spark, folder):
    """Each column of the stored silver and star tables with its type, as written, and how many values it has."""
    root = all_layers(spark, folder)
    parts = []
    for layer, names in (("silver", WIDE_SPECS), ("gold", star.STAR)):
        for name in names:
            df = read_table(spark, root, layer, name)
            kinds = F.create_map(*[F.lit(text) for column in df.dtypes for text in column])
            filled = df.agg(*[F.count(c).alias(c) for c in df.columns]).unpivot([], df.columns, "coluna", "preenchidas")
            parts.append(filled.select(F.lit(name).alias("tabela"), "coluna", kinds[F.col("coluna")].alias("tipo"), "preenchidas"))
    return reduce(DataFrame.unionByName, parts)


# Layouts


def dedup_isolated(spark, folder):
    """Views deduplicated by comparing only those that share a key."""

    def clean(path):
        quality.clean_rows(typed(spark, folder, "visualizacoes"), WIDE_SPECS["visualizacoes"]).write.parquet(path)
        return path

    stored = spark.read.parquet(lake_of(spark, folder).once("clean_views", clean))
    return quality.deduplicate_isolated(stored, WIDE_SPECS["visualizacoes"])


def viewer_sets(spark, folder):
    """The stored sets of viewers per streamer and month."""
    lake = lake_of(spark, folder)

    def store(path):
        audience.viewer_sets(lake).write.parquet(path)
        return path

    return spark.read.parquet(lake.once("viewer_sets", store))


def doc_unique_viewers_rollup(spark, folder):
    return audience.unique_viewers_rollup(viewer_sets(spark, folder))


def kpi4_true_viewers_by_platform(spark, folder):
    return audience.true_viewers_by_platform(viewer_sets(spark, folder), lake_of(spark, folder)["dim_streamer"])


def by_months(spark, folder, fact):
    """A fact's rows kept by month."""
    lake = lake_of(spark, folder)

    def store(path):
        write_months(lake[fact], path)
        return path

    return lake.once(f"months_{fact}", store)


def fato_doacoes_month(spark, folder):
    """The donations of one month, of which alone the files are read."""
    return read_months(spark, by_months(spark, folder, "fato_doacoes"), 199603, 199603).drop(MONTH)


def doc_revenue_quarter(spark, folder):
    """Revenue per streamer and month of one quarter, from that quarter's files."""
    facts = {
        name: read_months(spark, by_months(spark, folder, name), 199601, 199603) for name in ("fato_doacoes", "fato_assinaturas")
    }
    return analytics.revenue_per_streamer({**facts, "dim_streamer": lake_of(spark, folder)["dim_streamer"]})


def fato_visualizacoes_bucketed(spark, folder):
    """The views fact from tables in buckets of the broadcast, which meet without a shuffle."""
    lake = lake_of(spark, folder)

    def tables(path):
        names = {}
        for name in ("visualizacoes", "fato_transmissoes"):
            names[name] = f"sedimenta_{uuid.uuid4().hex}"
            columns = lake[name].columns if name == "visualizacoes" else ["id_transmissao", "sk_streamer", "sk_jogo"]
            write_bucketed(lake[name].select(*columns), names[name], f"{path}/{name}", "id_transmissao", 8)
        return names

    names = lake.once("bucketed", tables)
    joined = bucketed_join(spark, names["visualizacoes"], names["fato_transmissoes"], "id_transmissao")
    views = map_surrogate(
        joined, lake["dim_viewer"], "id_viewer", "id_viewer", "sk_viewer", right_rows=lake.rows["dim_viewer"],
        spread_by=("id_visualizacao",),
    )
    return views.select(
        date_key(F.col("data_hora")).alias("sk_tempo"),
        "sk_viewer",
        *[or_unknown(F.col(name)).alias(name) for name in ("sk_streamer", "sk_jogo")],
        "id_visualizacao",
        "id_transmissao",
        "minutos_assistidos",
    )


def clustered_views(spark, folder):
    """The views fact clustered on streamer and day."""
    lake = lake_of(spark, folder)

    def store(path):
        write_clustered(lake["fato_visualizacoes"], path, "sk_streamer", "sk_tempo", 8, 1 << 16, b_start=19920101)
        return path

    return spark.read.parquet(lake.once("clustered_views", store))


def clustered_scan(spark, folder):
    """Views of one streamer, and of one week, from files clustered on both."""
    views = clustered_views(spark, folder)
    slices = {"streamer": F.col("sk_streamer") == 3, "semana": F.col("sk_tempo").between(19960311, 19960317)}
    parts = [
        views.where(chosen).agg(
            F.lit(name).alias("recorte"),
            F.count("*").alias("linhas"),
            F.coalesce(F.sum("minutos_assistidos"), F.lit(0)).cast("bigint").alias("minutos"),
        )
        for name, chosen in slices.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def rowcount_footer(spark, folder):
    """Rows of all silver tables, from the files' footers."""
    lake = lake_of(spark, folder)
    lake.build_all(list(WIDE_SPECS))
    return stored_counts(spark, {name: table_path(lake.root, "silver", name) for name in WIDE_SPECS})


def fact_date_bounds(spark, folder):
    """Rows, first and last day of each fact, from the files' footers."""
    lake = lake_of(spark, folder)
    lake.build_all(list(star.FACTS))
    paths = {name: table_path(lake.root, "gold", name) for name in star.FACTS}
    return stored_bounds(spark, paths, "sk_tempo").withColumnRenamed("tabela", "fato")


# Keys of any type


def sk_by_name(spark, folder):
    """Games numbered by a name that begins alike for all and is shared by many, then by id."""
    word = F.concat(F.lit("jogo da plataforma: "), F.substring_index("nome", " ", 1))
    named = RetailSource(spark, folder)("jogos").select("id_jogo", word.alias("nome"))
    return number_rows(named, "sk", "nome", "id_jogo", most=64)


def lookup_by_name(spark, folder):
    """Viewers by the key of their country, looked up by its name; a few names have most rows."""
    lake = lake_of(spark, folder)
    names = lake["streamers"].select("pais").where(F.col("pais").isNotNull()).distinct()
    countries = number_rows(names, "sk_pais", "pais")
    found = lookup_by(lake["viewers"], countries, {"pais": "pais"}, spread_by=("id_viewer",))
    return found.groupBy(or_unknown(F.col("sk_pais")).alias("sk_pais")).agg(F.count("*").alias("linhas"))


def lookup_by_pair(spark, folder):
    """Donations by the first subscription of the same viewer to the same streamer: a third of them of one pair, a fifth
    without a streamer."""
    lake = lake_of(spark, folder)
    pairs = lake["assinaturas"].where("id_streamer IS NOT NULL").groupBy("id_viewer", "id_streamer")
    first = pairs.agg(F.min("id_assinatura").alias("primeira"))
    turn = F.col("id_doacao")
    hot = first.agg(F.min(F.struct("id_viewer", "id_streamer"))).first()[0]
    given = lake["doacoes"].select(
        "id_doacao",
        F.when(turn % 3 == 0, F.lit(hot["id_viewer"])).otherwise(F.col("id_viewer")).alias("quem"),
        F.when(turn % 5 != 0, F.when(turn % 3 == 0, F.lit(hot["id_streamer"])).otherwise(F.col("id_streamer"))).alias("canal"),
    )
    found = lookup_by(given, first, {"quem": "id_viewer", "canal": "id_streamer"}, spread_by=("id_doacao",))
    return found.groupBy(F.coalesce("primeira", F.lit(-1)).cast("bigint").alias("primeira")).agg(F.count("*").alias("linhas"))


def _each(names, work, prefix=""):
    return {f"{prefix}{name}": (lambda spark, folder, name=name: work(spark, folder, name)) for name in names}


def registered() -> dict[str, Query]:
    plain = [
        bronze_audit,
        csv_infer_scan,
        landing_table_name,
        landing_roundtrip,
        landing_line_breaks,
        rowcount_report,
        audit_prune,
        std_strings,
        std_boolean,
        std_numeric_dates,
        dq_valid,
        dq_quarantine,
        dq_strict_casts,
        dedup_visualizacoes,
        dedup_counts,
        dq_report,
        lookup_unmatched,
        lookup_hot_keys,
        lookup_hot_streamer,
        smart_date_key,
        fact_unknown_fk_counts,
        fn_calendar,
        fn_reason_concat,
        fn_null_guards,
        star_sql,
        layers_end_to_end,
        layers_all_outputs,
        quarantine_all,
        layer_types,
        landing_foreign,
        run_resumed,
        dedup_isolated,
        doc_unique_viewers_rollup,
        kpi4_true_viewers_by_platform,
        fato_doacoes_month,
        doc_revenue_quarter,
        fato_visualizacoes_bucketed,
        clustered_scan,
        rowcount_footer,
        fact_date_bounds,
        sk_by_name,
        lookup_by_name,
        lookup_by_pair,
    ]
    found: dict[str, Query] = {
        **_each(WIDE_SPECS, bronze, "bronze_"),
        **_each(WIDE_SPECS, typed, "std_"),
        **_each(WIDE_SPECS, reasons, "dq_reasons_"),
        **_each(WIDE_SPECS, silver, "silver_"),
        **{query.__name__: query for query in plain},
        **_each(star.STAR, lambda spark, folder, name: lake_of(spark, folder)[name]),
        **{
            f"mart_{name.removeprefix('agg_')}": (lambda spark, folder, name=name: presented_mart(spark, folder, name))
            for name in marts.MARTS
        },
        **_each(analytics.QUERIES, lambda spark, folder, name: analytics.QUERIES[name](lake_of(spark, folder))),
    }

    def sized(query: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            lake_of(spark, folder).once("shuffle_width", lambda _: size_shuffles(spark, folder))
            return comparable(query(spark, folder))

        return run

    return {name: sized(query) for name, query in found.items()}
