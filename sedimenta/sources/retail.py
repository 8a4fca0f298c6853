"""The platform's 13 source tables derived from a retail data set (region, supplier, orders, ...).

It maps one public star-shaped data set onto another so that every rule and join has rows to work
on: duplicated keys, missing and reversed dates, values outside their lists, keys without a parent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.plans.specs import WIDE_SPECS

DAY_ZERO = "1995-01-01"


class RetailSource:
    """Lazy source tables over ``<folder>/<table>.parquet``; ids are BIGINT, as in the files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __call__(self, name: str) -> DataFrame:
        if name not in WIDE_SPECS:
            raise ValueError(f"unknown source table: {name}")
        return getattr(self, f"_{name}")()

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _events(self, kind: str) -> DataFrame:
        return self.read("events").where(F.col("event_type") == kind)

    def _plataformas(self) -> DataFrame:
        return self.read("region").select(_next_id("r_regionkey", "id_plataforma"), F.col("r_name").alias("nome"))

    def _jogos(self) -> DataFrame:
        return self.read("part").select(
            _next_id("p_partkey", "id_jogo"),
            F.col("p_name").alias("nome"),
            F.col("p_brand").alias("desenvolvedor"),
            (F.lit(2000) + F.col("p_size") % 25).cast("int").alias("ano_lancamento"),
            (F.col("p_partkey") % 10 != 0).alias("ativo"),
        )

    def _streamers(self) -> DataFrame:
        supplier = self.read("supplier").join(self.read("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        return supplier.select(
            _next_id("s_suppkey", "id_streamer"),
            F.col("s_name").alias("nome"),
            F.col("n_name").alias("pais"),
            _joined_on("s_suppkey"),
            _next_id("n_regionkey", "id_plataforma"),
        )

    def _parent(self, table: str, key, out: str):
        """Ids of a table's rows, counted in the plan: each fourth child has the first one, the others are spread over
        all of them, and about one in 17 lies beyond the last."""
        rows = self.read(table).agg((F.count("*") + F.floor(F.count("*") / 16) + 1).alias("n")).scalar()
        return F.when(key % 4 == 0, F.lit(1).cast("long")).otherwise((key % rows + 1).cast("long")).alias(out)

    def _viewers(self) -> DataFrame:
        customer = self.read("customer").join(self.read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        return customer.select(
            _next_id("c_custkey", "id_viewer"),
            F.col("c_name").alias("nome"),
            F.col("n_name").alias("pais"),
            _joined_on("c_custkey"),
        )

    def _emotes(self) -> DataFrame:
        turn = F.col("event_id") % 3
        return self._events("error").select(
            _next_id("event_id", "id_emote"),
            F.col("event_type").alias("nome"),
            self._parent("supplier", F.col("event_id"), "id_streamer"),
            F.when(turn == 0, " Gratis ").when(turn == 1, "assinante").otherwise("vip").alias("disponivel_para"),
        )

    def _orders_with_items(self, *columns) -> DataFrame:
        """``columns`` of the orders, made before the join, so that it moves them as narrow as they end up."""
        # The items' aggregate is keyed by the shifted id, not by l_orderkey itself: both join inputs
        # are then plain shuffles, which adaptive execution can split if one order id is hot.
        items = (
            self.read("lineitem")
            .groupBy("l_orderkey")
            .agg(F.min("l_suppkey").alias("_sk"), F.min("l_partkey").alias("_pk"), F.max("l_shipdate").alias("_fim"))
            .select(_next_id("l_orderkey", "_id"), "_sk", "_pk", "_fim")
        )
        orders = self.read("orders").select((F.col("o_orderkey") + 1).alias("_id"), *columns)
        return orders.join(items, "_id", "left")

    def _transmissoes(self) -> DataFrame:
        orders = self._orders_with_items(
            F.col("o_orderdate").alias("data_inicio"), F.floor("o_totalprice").cast("int").alias("pico_viewers")
        )
        return orders.select(
            F.col("_id").alias("id_transmissao"),
            _next_id("_sk", "id_streamer"),
            _next_id("_pk", "id_jogo"),
            "data_inicio",
            F.col("_fim").alias("data_fim"),
            "pico_viewers",
        )

    def _items_with_orders(self) -> DataFrame:
        orders = self.read("orders").select("o_orderkey", "o_custkey")
        return self.read("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))

    def _visualizacoes(self) -> DataFrame:
        return self._items_with_orders().select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id_visualizacao"),
            _next_id("o_custkey", "id_viewer"),
            _next_id("l_orderkey", "id_transmissao"),
            F.floor("l_quantity").cast("int").alias("minutos_assistidos"),
            F.col("l_shipdate").alias("data_hora"),
        )

    def _follows(self) -> DataFrame:
        day = F.col("ts").cast("date")
        shift = (F.col("event_id") % 9 - 2).cast("int")
        return self._events("signup").select(
            _next_id("event_id", "id_follow"),
            _next_id("user_id", "id_viewer"),
            self._parent("supplier", F.col("event_id"), "id_streamer"),
            day.alias("data_follow"),
            F.when(F.col("event_id") % 5 == 0, F.date_add(day, shift)).alias("data_unfollow"),
        )

    def _assinaturas(self) -> DataFrame:
        day = F.col("o_orderdate").cast("date")
        priority = F.col("o_orderpriority")
        tier = (
            F.when(priority == "1-URGENT", "tier3")
            .when(priority == "2-HIGH", " TIER2 ")
            .when(priority == "3-MEDIUM", "tier1")
            .when(priority == "5-LOW", "gratis")
            .otherwise("none")
        )
        price = F.when(priority == "5-LOW", F.lit(0.0)).otherwise(F.col("o_totalprice"))
        orders = self._orders_with_items(
            _next_id("o_custkey", "id_viewer"),
            tier.alias("tipo"),
            day.alias("data_inicio"),
            F.when(F.col("o_orderstatus") == "F", F.date_add(day, 30)).alias("data_fim"),
            price.cast("decimal(8,2)").alias("valor_mensal"),
        )
        return orders.select(
            F.col("_id").alias("id_assinatura"),
            "id_viewer",
            _next_id("_sk", "id_streamer"),
            "tipo",
            "data_inicio",
            "data_fim",
            "valor_mensal",
        )

    def _doacoes(self) -> DataFrame:
        returned = self._items_with_orders().where(F.col("l_returnflag") == "R")
        return returned.select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id_doacao"),
            _next_id("o_custkey", "id_viewer"),
            _next_id("l_suppkey", "id_streamer"),
            _next_id("l_orderkey", "id_transmissao"),
            F.col("l_extendedprice").cast("decimal(8,2)").alias("valor"),
            F.col("l_shipdate").alias("data_hora"),
        )

    def _clips(self) -> DataFrame:
        return self._events("view").select(
            _next_id("event_id", "id_clip"),
            self._parent("orders", F.col("event_id"), "id_transmissao"),
            _next_id("user_id", "id_viewer"),
            F.floor("value").cast("int").alias("visualizacoes"),
            F.col("ts").alias("data_criacao"),
        )

    def _raids(self) -> DataFrame:
        return self._events("click").select(
            _next_id("event_id", "id_raid"),
            self._parent("supplier", F.col("event_id"), "id_streamer_origem"),
            self._parent("supplier", F.col("event_id") + 5, "id_streamer_destino"),
            self._parent("orders", F.col("event_id"), "id_transmissao"),
            F.floor("value").cast("int").alias("viewers_enviados"),
            F.col("ts").alias("data_hora"),
        )

    def _moderadores(self) -> DataFrame:
        day = F.col("ts").cast("date")
        shift = (F.col("event_id") % 7 - 1).cast("int")
        return self._events("purchase").select(
            _next_id("event_id", "id_moderador"),
            _next_id("user_id", "id_viewer"),
            self._parent("supplier", F.col("event_id"), "id_streamer"),
            day.alias("data_inicio"),
            F.when(F.col("event_id") % 4 == 0, F.date_add(day, shift)).alias("data_fim"),
        )


def _next_id(name: str, out: str):
    """Retail keys start at 0, platform ids at 1."""
    return (F.col(name).cast("long") + 1).alias(out)


def _joined_on(key: str):
    return F.date_add(F.lit(DAY_ZERO).cast("date"), (F.col(key) % 365).cast("int")).alias("data_cadastro")
