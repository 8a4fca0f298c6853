"""Who watched: viewers counted once at every grain, from one stored table of sets."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.calendar import months_of_key
from sedimenta.operators.dimensional import known_members
from sedimenta.operators.distinct import member_sets, merged_sets, set_sizes

Tables = Mapping[str, DataFrame]

# Grains of the roll-up: their name and the columns they keep.
GRAINS = {"streamer_mes": ("sk_streamer", "ano", "mes"), "streamer": ("sk_streamer",), "mes": ("ano", "mes"), "total": ()}


def viewer_sets(t: Tables) -> DataFrame:
    """The viewers of each streamer and month. Views without a known streamer stay, under -1."""
    views = t["fato_visualizacoes"].select("sk_streamer", *months_of_key(F.col("sk_tempo")), "sk_viewer")
    return member_sets(views, "sk_viewer", "sk_streamer", "ano", "mes")


def unique_viewers_rollup(sets: DataFrame) -> DataFrame:
    """Distinct viewers per streamer and month, per streamer, per month and in all (``nivel`` tells which); columns that a
    grain does not keep are NULL. Grains of streamers leave out the unknown one."""
    kinds = dict(sets.dtypes)

    def grain(label: str, by: tuple[str, ...]) -> DataFrame:
        own = known_members(sets, "sk_streamer") if "sk_streamer" in by else sets
        counted = set_sizes(own if len(by) == 3 else merged_sets(own, *by), "viewers_unicos", *by)
        shown = [F.col(c) if c in by else F.lit(None).cast(kinds[c]).alias(c) for c in GRAINS["streamer_mes"]]
        return counted.select(F.lit(label).alias("nivel"), *shown, "viewers_unicos")

    return reduce(DataFrame.unionByName, [grain(label, by) for label, by in GRAINS.items()])


def true_viewers_by_platform(sets: DataFrame, streamers: DataFrame) -> DataFrame:
    """Distinct viewers per platform: who watched several of its streamers counts once."""
    platforms = known_members(streamers, "sk_streamer").select("sk_streamer", "nome_plataforma")
    return set_sizes(merged_sets(sets.join(platforms, "sk_streamer"), "nome_plataforma"), "viewers_unicos", "nome_plataforma")
