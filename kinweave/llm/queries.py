"""Queries of the training-data operators; SQL for those that SQL can express is in sql.py."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kinweave.llm import canonical, components, leakage, linkage, lookalike, mixing, names, survivorship
from kinweave.llm.sql import ORACLES

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return survivorship.found(table(spark, d, "profile_players_staging"))


def p1_records(spark: SparkSession, d: str) -> DataFrame:
    """The surviving record of each group: every field from its own best row."""
    fields = ["display_name", "birth_city", "nationality", "height_cm", "position", "current_club", "market_value_eur"]
    best = survivorship.profile_survivors(table(spark, d, "profile_players_staging"), fields)
    return best.select("group_id", *[best[f]["value"].alias(f) for f in fields])


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return names.found(table(spark, d, "pipeline_players"), table(spark, d, "players"))


def p2_links(spark: SparkSession, d: str) -> DataFrame:
    """The links with the level of their evidence and the similarity of the names."""
    return names.link(table(spark, d, "pipeline_players"), table(spark, d, "players"))


def p2_unlinked(spark: SparkSession, d: str) -> DataFrame:
    """The named records that are linked to nobody, and why."""
    return names.unlinked(table(spark, d, "pipeline_players"), table(spark, d, "players"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return components.found(table(spark, d, "dedup_pairs_ambiguous"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return canonical.found(table(spark, d, "dedup_pairs"), table(spark, d, "clubs"), table(spark, d, "wc_2026_team_map"))


def p6_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """The typed values that belong to no entry, with how many rows hold each, and whether several entries were equally near."""
    rows = canonical.mapped(table(spark, d, "dedup_pairs"), table(spark, d, "clubs"), table(spark, d, "wc_2026_team_map"))
    return rows.where("ref_key = 'NONE'").groupBy("field", "value", "tied").count().withColumnRenamed("count", "n")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return linkage.found(table(spark, d, "pipeline_players"))


def p7_confidence(spark: SparkSession, d: str) -> DataFrame:
    return linkage.with_confidence(table(spark, d, "pipeline_players"), table(spark, d, "dedup_pairs"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.found(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p8_alignments(spark: SparkSession, d: str) -> DataFrame:
    """Every leak, verbatim or edited, with the alignment's score and the share of the item it keeps."""
    return leakage.leaked(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p9_selection(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "source_targets"))[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "source_targets"))[1]


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.pairs(table(spark, d, "documents"))


def p10_classes(spark: SparkSession, d: str) -> DataFrame:
    """Every document that looks like another, with its class: the pairs' short form, exact copies too."""
    return lookalike.classes(table(spark, d, "documents"))


def p10_texts(spark: SparkSession, d: str) -> DataFrame:
    """Every document's text in one consistent form."""
    return lookalike.canonical(table(spark, d, "documents"))


def queries() -> dict[str, Query]:
    own = (p1_found, p1_records, p2_found, p2_links, p2_unlinked, p4_found, p6_found, p6_unmatched, p7_found, p7_confidence, p8_found, p8_alignments, p9_selection, p9_shares, p10_found, p10_classes, p10_texts)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
