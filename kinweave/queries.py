"""The catalogue of the engine's queries over a folder of Parquet tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.operators import shred, units
from kinweave.plans import domain, relational, roster

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return units.found(table(spark, d, "player_bio"), table(spark, d, "profile_players_staging"), table(spark, d, "currency_rates"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return shred.found(table(spark, d, "player_career"), table(spark, d, "player_tournament"))


def p5_seasons(spark: SparkSession, d: str) -> DataFrame:
    """The seasons of every career as a flat table tied to the club they belong to."""
    objects = shred.entities(shred.adjacency(table(spark, d, "player_career"), table(spark, d, "player_tournament")), "player_id")
    return shred.entity(objects, "player_id", "career_trajectory", "seasons", ["season"])


def p5_objects(spark: SparkSession, d: str) -> DataFrame:
    """Every object of the three JSON columns with its scalars as JSON text, tied to its parent: the entity tables in one."""
    objects = shred.entities(shred.adjacency(table(spark, d, "player_career"), table(spark, d, "player_tournament")), "player_id")
    return objects.withColumn("scalars", F.to_json("scalars"))


DATA_QUERIES: dict[str, Query] = {"p3_found": p3_found, "p5_found": p5_found, "p5_seasons": p5_seasons, "p5_objects": p5_objects}


def queries() -> dict[str, Query]:
    return DATA_QUERIES | relational.QUERIES | domain.QUERIES | roster.QUERIES


def oracle_sql() -> dict[str, str]:
    return relational.SQL | domain.SQL | roster.SQL
