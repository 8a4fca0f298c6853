"""Generated source tables: every value is a hash of the row number, so any partitioning gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.plans.specs import SPECS

# Rows per table, and the span of dates.
SIZES = {
    "plataformas": 5,
    "jogos": 20,
    "streamers": 10_000,
    "viewers": 16_975,
    "emotes": 1_000,
    "transmissoes": 10_000,
    "visualizacoes": 10_000,
    "follows": 10_000,
    "assinaturas": 10_000,
    "doacoes": 10_000,
    "clips": 10_000,
    "raids": 10_000,
    "moderadores": 2_000,
}
FIRST_DAY, LAST_DAY = "2023-01-01", "2026-06-10"
DAYS = 1_257


class _Draws:
    """Repeatable draws for one row; each ``label`` is an independent stream."""

    def __init__(self, table: str, seed: int, sizes: dict[str, int]):
        self.table, self.seed, self.sizes = table, seed, sizes

    def below(self, label: str, n: int) -> Column:
        return F.pmod(F.xxhash64(F.col("id"), F.lit(f"{self.table}.{label}.{self.seed}")), F.lit(n))

    def between(self, label: str, low: int, high: int) -> Column:
        return self.below(label, high - low + 1) + low

    def parent(self, table: str, label: str | None = None) -> Column:
        return self.between(label or table, 1, self.sizes[table])

    def chance(self, label: str, percent: int) -> Column:
        return self.below(label, 100) < percent

    def cents(self, label: str, low: int, high: int) -> Column:
        return (self.between(label, low, high).cast("decimal(12,0)") / 100).cast("decimal(8,2)")

    def day(self, label: str = "day") -> Column:
        return F.date_add(F.lit(FIRST_DAY).cast("date"), self.below(label, DAYS).cast("int"))

    def moment(self, label: str = "moment") -> Column:
        minute = self.below(f"{label}.minute", 24 * 60)
        return F.timestamp_seconds(F.unix_date(self.day(label)).cast("long") * 86_400 + minute * 60)

    def pick(self, label: str, values: list[str]) -> Column:
        choices = F.array(*[F.lit(v) for v in values])
        return F.element_at(choices, (self.below(label, len(values)) + 1).cast("int"))

    def later(self, day: Column, label: str, low: int, high: int, percent: int) -> Column:
        """A date ``low`` to ``high`` days after ``day`` in ``percent`` of the rows, else NULL."""
        return F.when(self.chance(f"{label}.set", percent), F.date_add(day, self.between(label, low, high).cast("int")))


def synthesize(
    spark: SparkSession, table: str, n: int | None = None, seed: int = 42, sizes: dict[str, int] | None = None
) -> DataFrame:
    """``n`` rows of a source table; ``sizes`` sets how many parents its foreign keys range over."""
    sizes = {**SIZES, **(sizes or {})}
    draw = _Draws(table, seed, sizes)
    columns = _columns(table, draw)
    rows = spark.range(1, (sizes[table] if n is None else n) + 1)
    spec = SPECS[table]
    return rows.select(
        *[columns.get(c, F.col("id")).cast(t).alias(c) for c, t in spec.columns.items()]
    )


def _columns(table: str, draw: _Draws) -> dict[str, Column]:
    """All columns but the key, which is the row number."""
    name = F.concat(F.lit(f"{table[:-1]} "), F.col("id").cast("string"))
    country = draw.pick("pais", ["Argentina", "Brasil", "Chile", "Espanha", "Portugal"])
    if table == "plataformas":
        return {"nome": name}
    if table == "jogos":
        studio = F.concat(F.lit("estudio "), draw.between("studio", 1, 12).cast("string"))
        return {
            "nome": name,
            "desenvolvedor": studio,
            "ano_lancamento": draw.between("year", 2015, 2024),
            "ativo": draw.chance("active", 90),
        }
    if table == "streamers":
        return {"nome": name, "pais": country, "data_cadastro": draw.day(), "id_plataforma": draw.parent("plataformas")}
    if table == "viewers":
        return {"nome": name, "pais": country, "data_cadastro": draw.day()}
    if table == "emotes":
        audience = draw.pick("audience", ["gratis", "assinante"])
        return {"nome": name, "id_streamer": draw.parent("streamers"), "disponivel_para": audience}
    if table == "transmissoes":
        start = draw.moment()
        length = F.make_dt_interval(hours=draw.between("hours", 1, 12).cast("int"))
        return {
            "id_streamer": draw.parent("streamers"),
            "id_jogo": draw.parent("jogos"),
            "data_inicio": start,
            "data_fim": start + length,
            "pico_viewers": draw.between("peak", 10, 100_000),
        }
    if table == "visualizacoes":
        return {
            "id_viewer": draw.parent("viewers"),
            "id_transmissao": draw.parent("transmissoes"),
            "minutos_assistidos": draw.between("minutes", 1, 720),
            "data_hora": draw.moment(),
        }
    if table == "follows":
        return {
            "id_viewer": draw.parent("viewers"),
            "id_streamer": draw.parent("streamers"),
            "data_follow": draw.day(),
            "data_unfollow": draw.later(draw.day(), "end", 1, 365, percent=40),
        }
    if table == "assinaturas":
        tier = draw.pick("tier", ["gratis", "tier1", "tier2", "tier3"])
        return {
            "id_viewer": draw.parent("viewers"),
            "id_streamer": draw.parent("streamers"),
            "tipo": tier,
            "data_inicio": draw.day(),
            "data_fim": draw.later(draw.day(), "end", 30, 730, percent=60),
            "valor_mensal": F.when(tier == "gratis", F.lit(0).cast("decimal(8,2)")).otherwise(draw.cents("price", 499, 2499)),
        }
    if table == "doacoes":
        return {
            "id_viewer": draw.parent("viewers"),
            "id_streamer": draw.parent("streamers"),
            "id_transmissao": draw.parent("transmissoes"),
            "valor": draw.cents("amount", 100, 50_000),
            "data_hora": draw.moment(),
        }
    if table == "clips":
        return {
            "id_transmissao": draw.parent("transmissoes"),
            "id_viewer": draw.parent("viewers"),
            "visualizacoes": draw.between("views", 0, 500_000),
            "data_criacao": draw.moment(),
        }
    if table == "raids":
        total = draw.sizes["streamers"]
        origin = draw.parent("streamers", "origin")
        step = draw.between("step", 1, max(total - 1, 1))
        return {
            "id_streamer_origem": origin,
            "id_streamer_destino": (origin - 1 + step) % total + 1,
            "id_transmissao": draw.parent("transmissoes"),
            "viewers_enviados": draw.between("sent", 10, 50_000),
            "data_hora": draw.moment(),
        }
    if table == "moderadores":
        return {
            "id_viewer": draw.parent("viewers"),
            "id_streamer": draw.parent("streamers"),
            "data_inicio": draw.day(),
            "data_fim": draw.later(draw.day(), "end", 30, 500, percent=50),
        }
    raise ValueError(f"unknown source table: {table}")
