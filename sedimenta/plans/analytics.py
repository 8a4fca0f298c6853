"""Analytic queries, KPIs and dashboard metrics over the star and the marts.

``t`` gives a table for a name. Queries that start from a fact reduce it to one row per key before
joining, so their joins never repeat a key. Top lists are sorted with a tie-break.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sedimenta.functions.calendar import months_of_key
from sedimenta.functions.measures import exact_sum, percent_change, ratio
from sedimenta.operators.dimensional import known_members, orphan_counts
from sedimenta.plans.marts import by_month, by_platform, per_streamer, sort_by

Tables = Mapping[str, DataFrame]

# Wide enough for any total, and narrow enough that a quotient keeps a dozen decimal places.
MONEY = "decimal(20,2)"


# Star queries


def top_streamers_by_donations(t: Tables, k: int = 10) -> DataFrame:
    per_key = t["fato_doacoes"].groupBy("sk_streamer").agg(F.sum("valor").alias("_sum"), F.count("*").alias("_rows"))
    named = per_key.join(t["dim_streamer"].select("sk_streamer", "nome_streamer", "nome_plataforma"), "sk_streamer")
    totals = named.groupBy("nome_streamer", "nome_plataforma").agg(
        F.round(F.sum("_sum"), 2).alias("total_doacoes"), F.sum("_rows").alias("qtd_doacoes")
    )
    return sort_by(totals, "total_doacoes desc", "nome_streamer", "nome_plataforma").limit(k)


def donations_by_month(t: Tables) -> DataFrame:
    days = t["fato_doacoes"].groupBy("sk_tempo").agg(F.sum("valor").alias("_sum"))
    months = days.join(t["dim_tempo"].select("sk_tempo", "ano", "mes", "nome_mes"), "sk_tempo")
    totals = months.groupBy("ano", "mes", "nome_mes").agg(F.round(F.sum("_sum"), 2).alias("receita_doacoes"))
    return sort_by(totals, "ano", "mes")


def top_games(t: Tables, k: int = 15) -> DataFrame:
    measures = ("pico_viewers", "duracao_minutos")
    parts = [f(m).alias(f"_{n}_{m}") for m in measures for n, f in (("sum", exact_sum), ("n", F.count))]
    per_key = t["fato_transmissoes"].groupBy("sk_jogo").agg(F.count("*").alias("_rows"), *parts)
    named = per_key.join(t["dim_jogo"].select("sk_jogo", "nome_jogo"), "sk_jogo")

    def mean(measure):
        return F.round(ratio(F.sum(f"_sum_{measure}").cast("double"), F.sum(f"_n_{measure}")), 1)

    games = named.groupBy("nome_jogo").agg(
        F.sum("_rows").alias("qtd_transmissoes"),
        mean("pico_viewers").alias("pico_medio"),
        mean("duracao_minutos").alias("duracao_media_min"),
    )
    return sort_by(games, "qtd_transmissoes desc", "nome_jogo").limit(k)


def watch_time_by_country(t: Tables) -> DataFrame:
    """Viewers are distinct already once the fact has one row per viewer key."""
    per_key = t["fato_visualizacoes"].groupBy("sk_viewer").agg(F.sum("minutos_assistidos").alias("_sum"))
    countries = per_key.join(t["dim_viewer"].select("sk_viewer", "pais"), "sk_viewer").groupBy("pais")
    totals = countries.agg(F.sum("_sum").alias("minutos_totais"), F.count("*").alias("viewers_distintos"))
    return sort_by(totals, "minutos_totais desc", "pais")


def active_subscriptions_by_tier(t: Tables) -> DataFrame:
    tiers = t["fato_assinaturas"].where("ativa").groupBy("tipo").agg(
        F.count("*").alias("assinaturas_ativas"), F.round(F.sum("valor_mensal"), 2).alias("mrr")
    )
    return sort_by(tiers, "mrr desc", "tipo")


def _engagement_parts(t: Tables) -> DataFrame:
    views = t["fato_visualizacoes"].groupBy("sk_streamer").agg(
        F.sum("minutos_assistidos").alias("_minutes"), F.count("*").alias("_views")
    )
    donations = t["fato_doacoes"].groupBy("sk_streamer").agg(
        F.sum("valor").alias("_amount"), F.count("*").alias("_donations")
    )
    streamers = known_members(t["dim_streamer"], "sk_streamer").select("sk_streamer", "nome_streamer")
    return streamers.join(views, "sk_streamer", "left").join(donations, "sk_streamer", "left")


def engagement_fanout(t: Tables, k: int = 20) -> DataFrame:
    """Sums over each streamer's views paired with each of its donations.

    Every view counts once per donation and the other way round (once where the other side is
    empty), so the sums over all pairs are products of per-streamer sums and counts: no pair is made.
    """

    def times(value, rows):
        """A product that does not overflow where its factors do not."""
        each = F.greatest(F.coalesce(F.col(rows), F.lit(0)), F.lit(1)).cast("decimal(18,0)")
        return F.col(value).cast("decimal(19,0)" if value == "_minutes" else "decimal(20,2)") * each

    named = _engagement_parts(t).groupBy("nome_streamer")
    totals = named.agg(
        F.sum(times("_minutes", "_donations")).alias("minutos_assistidos"),
        F.round(F.coalesce(F.sum(times("_amount", "_views")), F.lit(0)), 2).alias("total_doacoes"),
    )
    return sort_by(totals, "total_doacoes desc", "nome_streamer").limit(k)


def engagement(t: Tables, k: int = 20) -> DataFrame:
    """Each view and each donation counted once."""
    totals = _engagement_parts(t).groupBy("nome_streamer").agg(
        F.sum("_minutes").alias("minutos_assistidos"),
        F.round(F.coalesce(F.sum("_amount"), F.lit(0)), 2).alias("total_doacoes"),
    )
    return sort_by(totals, "total_doacoes desc", "nome_streamer").limit(k)


# The keys audited per fact.
AUDITED_KEYS = [
    ("fato_doacoes", "sk_viewer"),
    ("fato_doacoes", "sk_streamer"),
    ("fato_transmissoes", "sk_streamer"),
    ("fato_transmissoes", "sk_jogo"),
    ("fato_visualizacoes", "sk_viewer"),
    ("fato_assinaturas", "sk_streamer"),
]


def referential_audit(t: Tables) -> DataFrame:
    facts = {fact: t[fact] for fact, _ in AUDITED_KEYS}
    return orphan_counts(facts, AUDITED_KEYS)


# KPIs


def total_revenue(t: Tables) -> DataFrame:
    return t["agg_receita_mensal"].agg(F.round(F.sum("receita_total"), 2).alias("receita_total_global"))


def revenue_change(t: Tables) -> DataFrame:
    """Every month with the one before it. The window runs over one row per month."""
    total = F.col("receita_total").cast(MONEY).alias("receita_total")
    months = t["agg_receita_mensal"].select("ano", "mes", total)
    order = Window.orderBy(F.asc_nulls_last("ano"), F.asc_nulls_last("mes"))
    before = F.lag("receita_total").over(order)
    return months.withColumn("receita_mes_anterior", before).withColumn(
        "variacao_pct", percent_change(F.col("receita_total"), F.col("receita_mes_anterior"))
    )


def latest_revenue_change(t: Tables) -> DataFrame:
    return revenue_change(t).orderBy(F.desc_nulls_first("ano"), F.desc_nulls_first("mes")).limit(1)


def average_donation(t: Tables) -> DataFrame:
    months = t["agg_receita_mensal"].where("qtd_doacoes > 0")
    mean = ratio(F.sum("receita_doacoes").cast(MONEY), F.sum("qtd_doacoes"))
    return months.agg(F.round(mean, 2).alias("valor_medio_por_doacao"))


def total_broadcasts(t: Tables) -> DataFrame:
    return t["agg_streamer_visao_geral"].agg(F.sum("qtd_transmissoes").alias("total_transmissoes"))


def top_streamers_by_broadcasts(t: Tables, k: int = 10) -> DataFrame:
    active = t["agg_streamer_visao_geral"].where("qtd_transmissoes > 0")
    top = sort_by(active, "qtd_transmissoes desc", "nome_streamer", "sk_streamer").limit(k)
    return top.select("nome_streamer", "nome_plataforma", "qtd_transmissoes", "horas_transmitidas")


def broadcasts_by_month(t: Tables) -> DataFrame:
    months = by_month(t["fato_transmissoes"], t["dim_tempo"], "pico_viewers")
    return sort_by(months.select("ano", "mes", F.col("_rows").alias("qtd_transmissoes")), "ano", "mes")


def active_viewers(t: Tables) -> DataFrame:
    """Viewers counted once per streamer they watched."""
    watched = t["agg_streamer_visao_geral"].where("viewers_unicos > 0")
    return watched.agg(F.sum("viewers_unicos").alias("viewers_ativos_total"))


def distinct_viewers(t: Tables) -> DataFrame:
    """Viewers counted once; the unknown member is none."""
    return t["fato_visualizacoes"].where("sk_viewer <> -1").agg(F.count_distinct("sk_viewer").alias("viewers_distintos_total"))


def viewers_by_platform(t: Tables) -> DataFrame:
    platforms = t["agg_streamer_visao_geral"].groupBy("nome_plataforma").agg(
        F.sum("viewers_unicos").alias("viewers_ativos"), F.sum("minutos_assistidos").alias("minutos_assistidos_total")
    )
    return sort_by(platforms, "viewers_ativos desc", "nome_plataforma")


def revenue_by_platform(t: Tables) -> DataFrame:
    platforms = t["agg_plataforma_resumo"].groupBy("nome_plataforma").agg(
        F.round(F.sum("total_doacoes"), 2).alias("total_doacoes")
    )
    return sort_by(platforms, "total_doacoes desc", "nome_plataforma")


def top_games_by_broadcasts(t: Tables, k: int = 10) -> DataFrame:
    active = t["agg_jogo_popularidade"].where("qtd_transmissoes > 0")
    return sort_by(active, "qtd_transmissoes desc", "nome_jogo", "sk_jogo").limit(k).select("nome_jogo", "qtd_transmissoes")


# Metrics defined on the facts, by period


def revenue_per_streamer(t: Tables) -> DataFrame:
    """Donations and subscription prices per streamer and month."""
    amounts = t["fato_doacoes"].select("sk_streamer", "sk_tempo", F.col("valor").alias("_amount")).unionByName(
        t["fato_assinaturas"].select("sk_streamer", "sk_tempo", F.col("valor_mensal").alias("_amount"))
    )
    totals = known_members(amounts, "sk_streamer").groupBy("sk_streamer", *months_of_key(F.col("sk_tempo"))).agg(
        F.coalesce(F.sum("_amount"), F.lit(0)).alias("receita_total")
    )
    named = totals.join(t["dim_streamer"].select("sk_streamer", "nome_streamer"), "sk_streamer")
    return named.select("sk_streamer", "nome_streamer", "ano", "mes", "receita_total")


def watch_hours(t: Tables) -> DataFrame:
    """Hours watched per game and month."""
    totals = known_members(t["fato_visualizacoes"], "sk_jogo").groupBy("sk_jogo", *months_of_key(F.col("sk_tempo"))).agg(
        (F.sum("minutos_assistidos") / F.lit(60.0)).alias("horas_assistidas")
    )
    named = totals.join(t["dim_jogo"].select("sk_jogo", "nome_jogo"), "sk_jogo")
    return named.select("sk_jogo", "nome_jogo", "ano", "mes", "horas_assistidas")


def average_peak_per_game(t: Tables) -> DataFrame:
    games = known_members(t["fato_transmissoes"], "sk_jogo").groupBy("sk_jogo").agg(F.avg("pico_viewers").alias("pico_medio"))
    return games.join(t["dim_jogo"].select("sk_jogo", "nome_jogo"), "sk_jogo").select("sk_jogo", "nome_jogo", "pico_medio")


def unique_viewers(t: Tables) -> DataFrame:
    """Distinct viewers per streamer and month."""
    views = known_members(t["fato_visualizacoes"], "sk_streamer")
    totals = views.groupBy("sk_streamer", *months_of_key(F.col("sk_tempo"))).agg(
        F.count_distinct("sk_viewer").alias("viewers_unicos")
    )
    named = totals.join(t["dim_streamer"].select("sk_streamer", "nome_streamer"), "sk_streamer")
    return named.select("sk_streamer", "nome_streamer", "ano", "mes", "viewers_unicos")


def average_ticket(t: Tables) -> DataFrame:
    mean = ratio(F.sum("valor").cast("double"), F.count("valor"))
    return t["fato_doacoes"].agg(mean.alias("ticket_medio"))


def average_duration(t: Tables) -> DataFrame:
    """Mean broadcast length per month."""
    months = t["fato_transmissoes"].groupBy(*months_of_key(F.col("sk_tempo")))
    mean = ratio(exact_sum("duracao_minutos").cast("double"), F.count("duracao_minutos"))
    return months.agg(mean.alias("duracao_media_min"))


def platform_revenue(t: Tables) -> DataFrame:
    """Donations and the monthly price of active subscriptions per platform."""
    active = t["fato_assinaturas"].where("ativa")
    platforms = by_platform(
        t, per_streamer(t["fato_doacoes"], "valor", "_donations"), per_streamer(active, "valor_mensal", "_mrr")
    )
    return platforms.select("nome_plataforma", (F.col("_donations") + F.col("_mrr")).alias("receita_total"))


# Queries by the name they are registered under.
QUERIES = {
    "q1_top_streamers_donations": top_streamers_by_donations,
    "q2_monthly_donations": donations_by_month,
    "q3_top_games": top_games,
    "q4_watch_by_country": watch_time_by_country,
    "q5_active_mrr": active_subscriptions_by_tier,
    "q6_engagement_fanout": engagement_fanout,
    "q6_engagement_drill_across": engagement,
    "q7_referential_audit": referential_audit,
    "kpi1_total_revenue": total_revenue,
    "kpi1_mom_change": latest_revenue_change,
    "kpi1_mom_series": revenue_change,
    "kpi2_avg_donation": average_donation,
    "kpi3_total_broadcasts": total_broadcasts,
    "kpi3_top_streamers": top_streamers_by_broadcasts,
    "kpi3_broadcasts_by_month": broadcasts_by_month,
    "kpi4_active_viewers": active_viewers,
    "kpi4_distinct_viewers": distinct_viewers,
    "kpi4_viewers_by_platform": viewers_by_platform,
    "metric1_revenue_by_platform": revenue_by_platform,
    "metric2_top_games": top_games_by_broadcasts,
    "doc_revenue_per_streamer": revenue_per_streamer,
    "doc_watch_hours": watch_hours,
    "doc_avg_peak_per_game": average_peak_per_game,
    "doc_unique_viewers": unique_viewers,
    "doc_avg_ticket": average_ticket,
    "doc_avg_duration": average_duration,
    "doc_platform_revenue_mrr": platform_revenue,
}
