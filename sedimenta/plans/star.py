"""The gold star: five dimensions and four facts.

Builders take ``t``, anything that gives a table for a name (silver tables, and star objects built
before), and ``rows``, the counted sizes of those that are stored.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.measures import minutes_between
from sedimenta.operators.dimensional import build_dimension, date_dimension, map_date, map_surrogate, or_unknown
from sedimenta.operators.joins import lookup_join
from sedimenta.plans.specs import select_names

Tables = Mapping[str, DataFrame]
Rows = Mapping[str, int]


def dim_plataforma(t: Tables, rows: Rows) -> DataFrame:
    return build_dimension(
        t["plataformas"],
        "sk_plataforma",
        "id_plataforma",
        {"id_plataforma": "id_plataforma", "nome": "nome_plataforma"},
    )


def dim_streamer(t: Tables, rows: Rows) -> DataFrame:
    """Streamers with the name of their platform."""
    platforms = t["plataformas"].select("id_plataforma", F.col("nome").alias("nome_plataforma"))
    streamers = lookup_join(
        t["streamers"],
        platforms,
        "id_plataforma",
        "id_plataforma",
        right_rows=rows.get("plataformas"),
        spread_by=("id_streamer",),
    )
    return build_dimension(
        streamers,
        "sk_streamer",
        "id_streamer",
        {
            "id_streamer": "id_streamer",
            "nome": "nome_streamer",
            "pais": "pais",
            "data_cadastro": "data_cadastro",
            "id_plataforma": "id_plataforma",
            "nome_plataforma": "nome_plataforma",
        },
    )


def dim_viewer(t: Tables, rows: Rows) -> DataFrame:
    return build_dimension(
        t["viewers"],
        "sk_viewer",
        "id_viewer",
        {"id_viewer": "id_viewer", "nome": "nome_viewer", "pais": "pais", "data_cadastro": "data_cadastro"},
    )


def dim_jogo(t: Tables, rows: Rows) -> DataFrame:
    return build_dimension(
        t["jogos"],
        "sk_jogo",
        "id_jogo",
        {
            "id_jogo": "id_jogo",
            "nome": "nome_jogo",
            "desenvolvedor": "desenvolvedor",
            "ano_lancamento": "ano_lancamento",
            "ativo": "ativo",
        },
    )


def dim_tempo(t: Tables, rows: Rows) -> DataFrame:
    return date_dimension(
        [
            (t["transmissoes"], "data_inicio"),
            (t["visualizacoes"], "data_hora"),
            (t["doacoes"], "data_hora"),
            (t["assinaturas"], "data_inicio"),
        ]
    )


def _with_key(fact: DataFrame, source: str, dim: str, t: Tables, rows: Rows, spread_by: str) -> DataFrame:
    """The key of ``dim`` for ``fact``, a widened ``source`` table."""
    entity = dim.removeprefix("dim_")
    return map_surrogate(
        fact,
        t[dim],
        f"id_{entity}",
        f"id_{entity}",
        f"sk_{entity}",
        right_rows=rows.get(dim),
        spread_by=(spread_by,),
        hot_from=t[source],
    )


def fato_transmissoes(t: Tables, rows: Rows) -> DataFrame:
    """One row per broadcast."""
    broadcasts = map_date(t["transmissoes"], "data_inicio")
    fact = broadcasts.select(
        "sk_tempo",
        "id_transmissao",
        "id_streamer",
        "id_jogo",
        "pico_viewers",
        minutes_between(F.col("data_inicio"), F.col("data_fim")).alias("duracao_minutos"),
    )
    for dim in ("dim_streamer", "dim_jogo"):
        fact = _with_key(fact, "transmissoes", dim, t, rows, spread_by="id_transmissao")
    return fact.select("sk_tempo", "sk_streamer", "sk_jogo", "id_transmissao", "pico_viewers", "duracao_minutos")


def fato_visualizacoes(t: Tables, rows: Rows) -> DataFrame:
    """One row per view; streamer and game are those of the broadcast watched.

    Those two keys were looked up once per broadcast already, so views join the broadcast fact
    instead of both dimensions.
    """
    views = t["visualizacoes"]
    fact = map_date(views, "data_hora").drop("data_hora")
    fact = _with_key(fact, "visualizacoes", "dim_viewer", t, rows, spread_by="id_visualizacao")
    fact = lookup_join(
        fact,
        t["fato_transmissoes"].select("id_transmissao", "sk_streamer", "sk_jogo"),
        "id_transmissao",
        "id_transmissao",
        right_rows=rows.get("fato_transmissoes"),
        spread_by=("id_visualizacao",),
        hot_from=views,
    )
    return fact.select(
        "sk_tempo",
        "sk_viewer",
        or_unknown(F.col("sk_streamer")).alias("sk_streamer"),
        or_unknown(F.col("sk_jogo")).alias("sk_jogo"),
        "id_visualizacao",
        "id_transmissao",
        "minutos_assistidos",
    )


def fato_doacoes(t: Tables, rows: Rows) -> DataFrame:
    """One row per donation."""
    fact = map_date(t["doacoes"], "data_hora").drop("data_hora")
    for dim in ("dim_viewer", "dim_streamer"):
        fact = _with_key(fact, "doacoes", dim, t, rows, spread_by="id_doacao")
    return fact.select("sk_tempo", "sk_viewer", "sk_streamer", "id_doacao", "id_transmissao", "valor")


def fato_assinaturas(t: Tables, rows: Rows) -> DataFrame:
    """One row per subscription; it is active while it has no end."""
    fact = t["assinaturas"]
    for dim in ("dim_viewer", "dim_streamer"):
        fact = _with_key(fact, "assinaturas", dim, t, rows, spread_by="id_assinatura")
    return map_date(fact, "data_inicio").select(
        "sk_tempo",
        "sk_viewer",
        "sk_streamer",
        "id_assinatura",
        "tipo",
        "valor_mensal",
        F.datediff("data_fim", "data_inicio").alias("duracao_dias"),
        F.col("data_fim").isNull().alias("ativa"),
    )


Builder = Callable[[Tables, Rows], DataFrame]

DIMENSIONS: dict[str, Builder] = {
    "dim_plataforma": dim_plataforma,
    "dim_streamer": dim_streamer,
    "dim_viewer": dim_viewer,
    "dim_jogo": dim_jogo,
    "dim_tempo": dim_tempo,
}
FACTS: dict[str, Builder] = {
    "fato_transmissoes": fato_transmissoes,
    "fato_visualizacoes": fato_visualizacoes,
    "fato_doacoes": fato_doacoes,
    "fato_assinaturas": fato_assinaturas,
}
STAR: dict[str, Builder] = {**DIMENSIONS, **FACTS}

# What each builder asks ``t`` for.
INPUTS: dict[str, tuple[str, ...]] = {
    "dim_plataforma": ("plataformas",),
    "dim_streamer": ("streamers", "plataformas"),
    "dim_viewer": ("viewers",),
    "dim_jogo": ("jogos",),
    "dim_tempo": ("transmissoes", "visualizacoes", "doacoes", "assinaturas"),
    "fato_transmissoes": ("transmissoes", "dim_streamer", "dim_jogo"),
    "fato_visualizacoes": ("visualizacoes", "dim_viewer", "fato_transmissoes"),
    "fato_doacoes": ("doacoes", "dim_viewer", "dim_streamer"),
    "fato_assinaturas": ("assinaturas", "dim_viewer", "dim_streamer"),
}


def needed(objects: list[str]) -> tuple[list[str], list[str]]:
    """(silver tables, star objects) to build ``objects`` from, star objects in build order."""
    pending, seen = list(objects), set()
    while pending:
        name = pending.pop()
        if name not in seen:
            seen.add(name)
            pending += INPUTS.get(name, ())
    return sorted(seen - set(STAR)), [name for name in STAR if name in seen]


def build_gold(silver: Tables, objects: list[str] | None = None, rows: Rows | None = None) -> dict[str, DataFrame]:
    """Lazy star objects from silver tables: those asked for, built on whatever else they need.

    ``rows`` are counted rows of the silver tables, as ``stored_counts`` gives them; without them every lookup takes the
    way for large tables. An object has at most one row more than the table it is made from, the unknown member.
    """
    wanted = select_names(STAR, objects)
    tables, counted = dict(silver), dict(rows or {})
    for name in needed(wanted)[1]:
        tables[name] = STAR[name](tables, counted)
        if name != "dim_tempo" and INPUTS[name][0] in counted:
            counted[name] = counted[INPUTS[name][0]] + 1
    return {name: tables[name] for name in wanted}
