"""Readers with explicit schemas; an absent source is an empty one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns of the raw player, club, transfer and valuation files.
PLAYERS_CSV = "player_id int, first_name string, last_name string, name string, date_of_birth string, country_of_citizenship string, country_of_birth string, city_of_birth string, position string, sub_position string, foot string, height_in_cm double, current_club_id double, current_club_name string, current_club_domestic_competition_id string, market_value_in_eur double, highest_market_value_in_eur double, image_url string, url string, agent_name string, contract_expiration_date string"
CLUBS_CSV = "club_id int, name string, domestic_competition_id string, squad_size double, average_age double, total_market_value double"
TRANSFERS_CSV = "player_id int, transfer_date string, transfer_season string, from_club_id double, to_club_id double, from_club_name string, to_club_name string, transfer_fee double, transfer_type string"
VALUATIONS_CSV = "player_id int, date string, market_value_in_eur double, current_club_id double"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def optional(spark: SparkSession, path: str, schema: str | T.StructType, kind: str = "parquet", **options) -> DataFrame:
    """The table at path, or an empty one of its schema."""
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    return spark.read.schema(schema).options(**options).format(kind).load(path) if exists(spark, path) else spark.createDataFrame([], schema)


def csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header and a declared schema. Columns are matched by place, unreadable numbers are null."""
    return spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True).option("enforceSchema", False).csv(path)


def active_players(spark: SparkSession, path: str) -> DataFrame:
    """Players with a club, renamed and cast; whole numbers are truncated."""
    whole = lambda c, t: F.col(c).cast("double").try_cast(t)
    return csv(spark, path, PLAYERS_CSV).where("current_club_id is not null").select(
        F.lit("base").alias("source"), F.col("player_id").cast("string").alias("source_id"), "name", F.substring("date_of_birth", 1, 10).alias("date_of_birth"),
        F.col("country_of_citizenship").alias("nationality"), "position", "sub_position", "foot", whole("height_in_cm", "int").alias("height_cm"), whole("current_club_id", "int").alias("current_club_id"),
        F.col("current_club_name").alias("current_club"), F.col("current_club_domestic_competition_id").alias("competition_id"), whole("market_value_in_eur", "bigint").alias("market_value_eur"),
        F.col("image_url").alias("photo_url"), "url", "agent_name", F.substring("contract_expiration_date", 1, 10).alias("contract_expires"),
    )


def clubs(spark: SparkSession, path: str) -> DataFrame:
    return csv(spark, path, CLUBS_CSV).select("club_id", "name", "domestic_competition_id", F.col("squad_size").cast("int").alias("squad_size"), F.bround("average_age", 1).alias("average_age"), "total_market_value")


def json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON documents (one list or object a file) with a declared schema."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def recorded(responses: DataFrame, key: str, body: str, schema: str) -> DataFrame:
    """Recorded answers of an outside service, parsed with a schema: what a live call would give, without one."""
    return responses.select(key, F.from_json(body, schema).alias("_b")).select(key, "_b.*")
