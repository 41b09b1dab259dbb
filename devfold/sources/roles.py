"""Gives generic order and event tables the roles of device-profile inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Roles:
    """Device-profile inputs derived from the tables in ``folder``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def devices(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.table("customer").select(
            key.alias("device_id"),
            F.when(key % 2 == 0, "F").otherwise("M").alias("gender"),
            (key % 50 + 18).cast("int").alias("age"),
            F.col("c_mktsegment").alias("grp"),
        )

    def train(self) -> DataFrame:
        return self.devices().where(F.col("device_id") % 10 < 8)

    def test(self) -> DataFrame:
        return self.devices().where(F.col("device_id") % 10 >= 8).select("device_id")

    def phones(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        return (
            self.table("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("c_custkey").alias("device_id"),
                F.col("r_name").alias("phone_brand"),
                F.col("n_name").alias("device_model"),
            )
        )

    def app_events(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("event_id"), F.col("l_partkey").alias("app_id")
        )

    def app_owners(self) -> DataFrame:
        """Events as the app side sees them: which device each one came from."""
        return self.table("orders").select(
            F.col("o_orderkey").alias("event_id"), F.col("o_custkey").alias("device_id")
        )

    def app_labels(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("app_id"), F.col("p_size").alias("label_id")
        )

    def label_categories(self) -> DataFrame:
        return (
            self.table("part")
            .groupBy(F.col("p_size").alias("label_id"))
            .agg(F.min("p_type").alias("category"))
        )

    def events(self) -> DataFrame:
        """Located events; ``k`` is its own step, so the JSON text is read once per row."""
        k = F.get_json_object("props", "$.k").try_cast("int")
        parsed = self.table("events").select(
            "event_id", F.col("user_id").alias("device_id"), "ts", "value", k.alias("k")
        )
        nowhere = F.col("k") % 5 == 0
        zero = F.lit(0.0)
        return parsed.select(
            "event_id",
            "device_id",
            "ts",
            F.when(nowhere, zero).otherwise((F.col("k") - 50).cast("double")).alias("longitude"),
            F.when(nowhere, zero).otherwise(F.col("value")).alias("latitude"),
        )
