import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sedimenta.functions.measures import exact_sum, hours, minutes_between, percent_change, ratio
from sedimenta.operators import dimensional as dim
from sedimenta.operators import joins
from sedimenta.plans import analytics, marts, star


@pytest.mark.parametrize(
    "keys",
    [
        [3, 1, 2],
        [-5, 0, 1 << 20, (1 << 20) - 1, (1 << 42) + 3, 1 << 62, -(1 << 62)],
        [1 << 41, (1 << 42) - 1, 1 << 42, 1 << 43, 17],
    ],
)
def test_surrogate_keys_equal_a_global_row_number(spark, keys):
    df = spark.createDataFrame([(k, f"n{k}") for k in keys], "id long, nome string")
    got = {r.id: r.sk for r in dim.add_surrogate_key(df, "sk", "id").collect()}
    assert got == {k: i + 1 for i, k in enumerate(sorted(keys))}


def test_surrogate_keys_over_several_blocks(spark):
    df = spark.range(0, 9_000_000, 4_001).select((F.col("id") * 3 - 5_000_000).alias("id"))
    got = dim.add_surrogate_key(df, "sk", "id")
    want = df.withColumn("want", F.row_number().over(Window.orderBy("id")))
    assert got.join(want, "id").where(F.col("sk") == F.col("want")).count() == df.count()


def test_surrogate_key_needs_a_key_in_order(spark):
    """Integers, text and dates are numbered; kinds without an exact order are refused."""
    with pytest.raises(TypeError):
        dim.add_surrogate_key(spark.createDataFrame([(1.5,)], "k double"), "sk", "k")


def test_unknown_member(spark):
    df = spark.createDataFrame([(1, "a", True)], "sk long, nome string, ativo boolean")
    out = dim.with_unknown_member(df, "sk")
    assert out.dtypes == df.dtypes
    assert {tuple(r) for r in out.collect()} == {(-1, "(desconhecido)", None), (1, "a", True)}


@pytest.fixture
def skewed(spark):
    """60,000 facts: a third with key 5, a sixth each without a key and with one key that is not a member."""
    n = F.col("id")
    key = F.when(n % 3 == 0, F.lit(5)).when(n % 6 == 1, F.lit(None)).when(n % 6 == 2, F.lit(77_777)).otherwise(n % 4_000)
    return spark.range(60_000).select(n.alias("id_fato"), key.cast("long").alias("id_cliente"), (n % 11).alias("valor"))


@pytest.fixture
def customers(spark):
    members = spark.range(3_500).select(F.col("id").alias("id_cliente"), F.concat(F.lit("c"), "id").alias("nome"))
    return dim.build_dimension(members, "sk_cliente", "id_cliente", {"id_cliente": "id_cliente", "nome": "nome"})


def expected_lookup(skewed, customers):
    plain = skewed.join(customers.where("sk_cliente <> -1"), "id_cliente", "left")
    return sorted((r.id_fato, -1 if r.sk_cliente is None else r.sk_cliente) for r in plain.collect())


@pytest.mark.parametrize("rows", [None, 3_501])
def test_lookup_gives_every_fact_one_key(spark, skewed, customers, rows):
    out = dim.map_surrogate(
        skewed, customers, "id_cliente", "id_cliente", "sk_cliente", right_rows=rows, spread_by=("id_fato",)
    )
    assert out.columns == [*skewed.columns, "sk_cliente"]
    assert sorted((r.id_fato, r.sk_cliente) for r in out.collect()) == expected_lookup(skewed, customers)


def test_hot_and_missing_keys_are_spread(spark, skewed, customers):
    """Without help one partition would hold a third of the rows and another the rows without a key."""
    before = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = dim.map_surrogate(
            skewed, customers, "id_cliente", "id_cliente", "sk_cliente", spread_by=("id_fato",)
        )
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == 60_000
        assert max(sizes) < 60_000 / 8 * 1.3
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_lookup_moves_no_copy_of_the_key(spark, skewed, customers, capsys):
    """The fact's rows are dealt by an expression, so its shuffle carries its own columns and what hot keys found."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = dim.map_surrogate(skewed, customers, "id_cliente", "id_cliente", "sk_cliente", spread_by=("id_fato",))
        capsys.readouterr()
        out.explain("formatted")
        text = capsys.readouterr().out
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    inputs = [line for at, line in zip(text.splitlines(), text.splitlines()[1:]) if ") Exchange" in at]
    moved = [line.split(": [", 1)[1].rstrip("]").split(", ") for line in inputs if "id_fato" in line]
    assert [sorted(c.split("#")[0] for c in columns) for columns in moved] == [["_h__sk", "_hot", "id_cliente", "id_fato", "valor"]]


def test_lookup_where_the_hash_of_a_settled_row_is_a_key(spark):
    """Rows that are dealt by a hash which is a key of the other side, their own or another's, find what their key has."""
    n = F.col("id")
    left = spark.range(2_000).select(n.alias("n"), F.when(n % 2 == 0, F.lit(5)).when(n % 4 == 1, n).cast("long").alias("k"))
    hashes = left.select(F.xxhash64("n").alias("k"))
    right = left.select("k").where("k is not null").union(hashes).distinct().select("k", F.col("k").cast("string").alias("v"))
    # Rows whose key is the hash that they themselves are dealt by, too.
    both = left.union(left.select("n", F.xxhash64("n")))
    rows = joins.lookup_join(both, right, "k", "k", spread_by=("n",)).collect()
    assert len(rows) == 4_000
    assert all(r.v == (None if r.k is None else str(r.k)) for r in rows)


def test_hot_keys_are_found_and_bounded(skewed):
    found = {r[0] for r in joins.hot_keys(skewed, "id_cliente").collect()}
    assert {5, 77_777} <= found and None not in found
    assert len(found) <= joins.KEY_GROUPS * joins.HOT_PER_GROUP


def test_hot_keys_of_nothing(spark, skewed, customers):
    none = skewed.where("id_cliente is null")
    assert joins.hot_keys(none, "id_cliente").count() == 0
    out = dim.map_surrogate(none, customers, "id_cliente", "id_cliente", "sk_cliente", spread_by=("id_fato",))
    assert {r.sk_cliente for r in out.collect()} == {-1}


def test_calendar(spark):
    a = spark.createDataFrame([(dt.date(2024, 2, 28),), (None,)], "d date")
    b = spark.createDataFrame([(dt.datetime(2024, 3, 2, 23, 59),)], "t timestamp_ntz")
    out = dim.date_dimension([(a, "d"), (b, "t")])
    days = {r.sk_tempo: r for r in out.collect()}
    assert sorted(days) == [-1, 20240228, 20240229, 20240301, 20240302]
    assert days[-1].nome_mes == "(desconhecido)" and days[-1].data is None
    saturday = days[20240302]
    assert (saturday.dia_semana, saturday.nome_dia_semana, saturday.fim_de_semana, saturday.nome_mes) == (
        7,
        "Saturday",
        True,
        "March",
    )


def test_calendar_without_dates_is_an_error(spark):
    empty = spark.createDataFrame([(None,)], "d date")
    with pytest.raises(Exception, match="no valid dates"):
        dim.date_dimension([(empty, "d")]).collect()


def test_measures(spark):
    df = spark.createDataFrame(
        [(Decimal("10.00"), Decimal("4.00")), (Decimal("1.00"), Decimal("0.00")), (Decimal("1.00"), None)],
        "a decimal(10,2), b decimal(10,2)",
    )
    got = df.select(ratio(F.col("a"), F.col("b")), percent_change(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(Decimal("2.5"), Decimal("150.00")), (None, None), (None, None)]
    span = spark.createDataFrame([(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 1, 40))], "a timestamp_ntz, b timestamp_ntz")
    assert span.select(minutes_between(F.col("a"), F.col("b"))).first()[0] == 1.67


@pytest.fixture
def star_tables(spark):
    """A streamer without facts, donations without a date, and unknown keys."""
    ddl = {
        "dim_plataforma": "sk_plataforma long, id_plataforma int, nome_plataforma string",
        "dim_streamer": "sk_streamer long, id_streamer int, nome_streamer string, pais string, id_plataforma int, "
        "nome_plataforma string",
        "dim_jogo": "sk_jogo long, nome_jogo string, desenvolvedor string, ano_lancamento int",
        "dim_tempo": "sk_tempo int, ano int, mes int, nome_mes string",
        "fato_transmissoes": "sk_tempo int, sk_streamer long, sk_jogo long, id_transmissao int, pico_viewers int, "
        "duracao_minutos double",
        "fato_visualizacoes": "sk_tempo int, sk_viewer long, sk_streamer long, sk_jogo long, minutos_assistidos int",
        "fato_doacoes": "sk_tempo int, sk_viewer long, sk_streamer long, valor decimal(8,2)",
        "fato_assinaturas": "sk_tempo int, sk_viewer long, sk_streamer long, tipo string, valor_mensal decimal(8,2), "
        "ativa boolean",
    }
    data = {
        "dim_plataforma": [(-1, None, "(desconhecido)"), (1, 1, "P")],
        "dim_streamer": [(-1, None, "(desconhecido)", "?", None, "?"), (1, 1, "ana", "BR", 1, "P"), (2, 2, "bia", "BR", 9, None)],
        "dim_jogo": [(-1, "(desconhecido)", None, None), (1, "xadrez", "d", 2000)],
        "dim_tempo": [(-1, None, None, "(desconhecido)"), (20240101, 2024, 1, "January"), (20240201, 2024, 2, "February")],
        "fato_transmissoes": [(20240101, 1, 1, 1, 10, 90.0), (20240101, -1, 1, 2, 20, 30.0)],
        "fato_visualizacoes": [(20240101, 1, 1, 1, 5), (20240101, 1, 1, 1, 7), (20240101, 2, 1, -1, 1)],
        "fato_doacoes": [(20240101, 1, 1, Decimal("10.00")), (-1, 1, 1, Decimal("2.50")), (20240101, -1, -1, Decimal("1.00"))],
        "fato_assinaturas": [(20240201, 1, 1, "tier1", Decimal("5.00"), True), (-1, 1, 1, "tier1", None, False)],
    }
    return {name: spark.createDataFrame(data[name], ddl[name]) for name in ddl}


def test_streamer_without_facts_gets_zeros(star_tables):
    got = {r.nome_streamer: r for r in marts.build_marts(star_tables, ["agg_streamer_visao_geral"])["agg_streamer_visao_geral"].collect()}
    assert set(got) == {"ana", "bia"}
    assert tuple(got["bia"])[4:] == (0,) * 9
    ana = got["ana"]
    assert (ana.qtd_transmissoes, ana.horas_transmitidas, ana.viewers_unicos, ana.mrr) == (1, 1.5, 2, Decimal("5.00"))
    assert ana.total_doacoes == Decimal("12.50")


def test_months_without_a_date_stay_apart(star_tables):
    """Rows without a date meet the unknown day; its empty month matches no other in the outer join."""
    got = [tuple(r)[:2] + (r.receita_total,) for r in marts.monthly_revenue(star_tables).collect()]
    assert sorted(got, key=repr) == sorted(
        [
            (2024, 1, Decimal("11.00")),
            (2024, 2, Decimal("5.00")),
            (None, None, Decimal("2.50")),
            (None, None, Decimal("0.00")),
        ],
        key=repr,
    )


def test_platform_ignores_streamers_without_one(star_tables):
    got = marts.platform_summary(star_tables).first()
    assert (got.qtd_streamers, got.total_doacoes, got.minutos_assistidos) == (1, Decimal("12.50"), 13)


def test_fanout_equals_the_row_level_join(spark, star_tables):
    for name in ("dim_streamer", "fato_visualizacoes", "fato_doacoes"):
        star_tables[name].createOrReplaceTempView(name)
    want = spark.sql(
        """SELECT s.nome_streamer, SUM(v.minutos_assistidos) AS m, ROUND(COALESCE(SUM(d.valor), 0), 2) AS t
           FROM dim_streamer s LEFT JOIN fato_visualizacoes v ON v.sk_streamer = s.sk_streamer
           LEFT JOIN fato_doacoes d ON d.sk_streamer = s.sk_streamer
           WHERE s.sk_streamer <> -1 GROUP BY s.nome_streamer"""
    )
    got = analytics.engagement_fanout(star_tables)
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()}


def test_objects_bring_what_they_need():
    assert star.needed(["fato_doacoes"]) == (
        ["doacoes", "plataformas", "streamers", "viewers"],
        ["dim_streamer", "dim_viewer", "fato_doacoes"],
    )
    assert "fato_transmissoes" in star.needed(["fato_visualizacoes"])[1]


def test_inputs_name_every_mart_and_object():
    assert set(star.INPUTS) == set(star.STAR) and set(marts.INPUTS) == set(marts.MARTS) == set(marts.ORDER)


def test_sums_of_minutes_do_not_depend_on_the_order(spark):
    rows = [(float(f"{n}.{n % 100:02}"),) for n in range(0, 3_000_000, 997)]
    up, down = [
        spark.createDataFrame(part, "m double").repartition(n).agg(exact_sum("m").alias("s"), hours(exact_sum("m")).alias("h")).first()
        for part, n in ((rows, 3), (rows[::-1], 17))
    ]
    want = sum(Decimal(f"{n}.{n % 100:02}") for n in range(0, 3_000_000, 997))
    assert up == down and up.s == want
    assert up.h == float((want / 60).quantize(Decimal("0.1"), "ROUND_HALF_UP"))
