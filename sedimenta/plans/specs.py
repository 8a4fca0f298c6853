"""What each source table must look like in silver, and which star objects are built from it."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T


INT, LONG, TEXT, FLAG = T.IntegerType(), T.LongType(), T.StringType(), T.BooleanType()
DATE, TIME, ZONELESS, MONEY = T.DateType(), T.TimestampType(), T.TimestampNTZType(), T.DecimalType(8, 2)


@dataclass(frozen=True)
class TableSpec:
    """A source table: its columns in order, its key and the rules its rows have to meet.

    ``ordered`` holds (later, earlier) pairs: where both are set, later >= earlier.
    """

    name: str
    columns: dict[str, T.DataType]
    key: str
    required: tuple[str, ...] = ()
    allowed: dict[str, tuple[str, ...]] = field(default_factory=dict)
    ordered: tuple[tuple[str, str], ...] = ()


# The source tables' columns, types, keys and rules.
PLATFORM_TABLES = (
    TableSpec(
        "plataformas",
        {
            "id_plataforma": INT,
            "nome": TEXT,
        },
        key="id_plataforma",
        required=("nome",),
    ),
    TableSpec(
        "jogos",
        {
            "id_jogo": INT,
            "nome": TEXT,
            "desenvolvedor": TEXT,
            "ano_lancamento": INT,
            "ativo": FLAG,
        },
        key="id_jogo",
        required=("nome",),
    ),
    TableSpec(
        "streamers",
        {
            "id_streamer": INT,
            "nome": TEXT,
            "pais": TEXT,
            "data_cadastro": DATE,
            "id_plataforma": INT,
        },
        key="id_streamer",
        required=("nome", "data_cadastro"),
    ),
    TableSpec(
        "viewers",
        {
            "id_viewer": INT,
            "nome": TEXT,
            "pais": TEXT,
            "data_cadastro": DATE,
        },
        key="id_viewer",
        required=("nome", "data_cadastro"),
    ),
    TableSpec(
        "emotes",
        {
            "id_emote": INT,
            "nome": TEXT,
            "id_streamer": INT,
            "disponivel_para": TEXT,
        },
        key="id_emote",
        required=("nome",),
        allowed={"disponivel_para": ("gratis", "assinante")},
    ),
    TableSpec(
        "transmissoes",
        {
            "id_transmissao": INT,
            "id_streamer": INT,
            "id_jogo": INT,
            "data_inicio": TIME,
            "data_fim": TIME,
            "pico_viewers": INT,
        },
        key="id_transmissao",
        required=("data_inicio", "data_fim"),
        ordered=(("data_fim", "data_inicio"),),
    ),
    TableSpec(
        "visualizacoes",
        {
            "id_visualizacao": INT,
            "id_viewer": INT,
            "id_transmissao": INT,
            "minutos_assistidos": INT,
            "data_hora": TIME,
        },
        key="id_visualizacao",
        required=("data_hora",),
    ),
    TableSpec(
        "follows",
        {
            "id_follow": INT,
            "id_viewer": INT,
            "id_streamer": INT,
            "data_follow": DATE,
            "data_unfollow": DATE,
        },
        key="id_follow",
        required=("data_follow",),
        ordered=(("data_unfollow", "data_follow"),),
    ),
    TableSpec(
        "assinaturas",
        {
            "id_assinatura": INT,
            "id_viewer": INT,
            "id_streamer": INT,
            "tipo": TEXT,
            "data_inicio": DATE,
            "data_fim": DATE,
            "valor_mensal": MONEY,
        },
        key="id_assinatura",
        required=("data_inicio",),
        allowed={"tipo": ("gratis", "tier1", "tier2", "tier3")},
        ordered=(("data_fim", "data_inicio"),),
    ),
    TableSpec(
        "doacoes",
        {
            "id_doacao": INT,
            "id_viewer": INT,
            "id_streamer": INT,
            "id_transmissao": INT,
            "valor": MONEY,
            "data_hora": TIME,
        },
        key="id_doacao",
        required=("valor", "data_hora"),
    ),
    TableSpec(
        "clips",
        {
            "id_clip": INT,
            "id_transmissao": INT,
            "id_viewer": INT,
            "visualizacoes": INT,
            "data_criacao": TIME,
        },
        key="id_clip",
        required=("data_criacao",),
    ),
    TableSpec(
        "raids",
        {
            "id_raid": INT,
            "id_streamer_origem": INT,
            "id_streamer_destino": INT,
            "id_transmissao": INT,
            "viewers_enviados": INT,
            "data_hora": TIME,
        },
        key="id_raid",
        required=("data_hora",),
    ),
    TableSpec(
        "moderadores",
        {
            "id_moderador": INT,
            "id_viewer": INT,
            "id_streamer": INT,
            "data_inicio": DATE,
            "data_fim": DATE,
        },
        key="id_moderador",
        required=("data_inicio",),
        ordered=(("data_fim", "data_inicio"),),
    ),
)

SPECS: dict[str, TableSpec] = {spec.name: spec for spec in PLATFORM_TABLES}


def wide(spec: TableSpec) -> TableSpec:
    """The same spec with BIGINT keys and zoneless timestamps.

    A 32-bit id overflows past two billion rows, and source timestamps carry no zone, so this is
    the form to use for large loads: ids stay whole and no value depends on the session time zone.
    """
    columns = {}
    for name, kind in spec.columns.items():
        if name.startswith("id_") and kind == INT:
            kind = LONG
        columns[name] = ZONELESS if kind == TIME else kind
    return replace(spec, columns=columns)


WIDE_SPECS: dict[str, TableSpec] = {name: wide(spec) for name, spec in SPECS.items()}


def select_names(known, wanted=None) -> list[str]:
    """``wanted`` (all of ``known`` when empty) in the order of ``known``; unknown names are an error."""
    known = list(known)
    if not wanted:
        return known
    unknown = sorted(set(wanted) - set(known))
    if unknown:
        raise ValueError(f"unknown: {', '.join(unknown)}; known: {', '.join(known)}")
    return [name for name in known if name in set(wanted)]
