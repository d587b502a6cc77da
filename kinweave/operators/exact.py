"""Exact linkage of two sources by several keys, quarantine of ambiguous pairs, staging and kill switches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def equi_pairs(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Inner equi-join on keys both sides have; rows with a null key match nothing."""
    return a.join(b, keys, "inner")


def multiple(pairs: DataFrame, key: str) -> DataFrame:
    """The keys that occur in more than one pair."""
    return pairs.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1").select(key)


def quarantined(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """Every pair that touches an id which occurs in several pairs. Two existence joins; neither side is collected."""
    a, b = multiple(pairs, left).withColumn("_l", F.lit(True)), multiple(pairs, right).withColumn("_r", F.lit(True))
    flagged = pairs.join(a, left, "left").join(b, right, "left")
    return flagged.where("_l or _r").select(*pairs.columns)


def clean(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """The pairs left after the quarantine: ids of both sides occur once."""
    return pairs.join(multiple(pairs, left), left, "left_anti").join(multiple(pairs, right), right, "left_anti").select(*pairs.columns)


def survive(preferred: Column, other: Column) -> Column:
    return F.coalesce(preferred, other)


def or_join(rows: DataFrame, aliases: DataFrame, options: list[tuple[str, str]], target: str) -> DataFrame:
    """rows joined to aliases(kind, value, target) where any of the (column, kind) options agrees: a union of equi-joins and
    distinct, instead of a nested loop over an OR."""
    parts = [rows.join(aliases.where(F.col("kind") == kind).select(F.col("value").alias(column), target), column).select(*rows.columns, target) for column, kind in options]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def duplicates(df: DataFrame, key: str, label: str) -> DataFrame:
    """(check, key, n): the keys of df that occur more than once: a kill switch expects none."""
    return df.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("string").alias("key")).agg(F.count("*").alias("n")).where("n > 1").select(F.lit(label).alias("check"), "key", "n")
