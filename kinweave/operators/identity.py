"""Identity of a person across rows: keys with a fallback, stable ids, other names and ids by kind, identity by several routes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.functions.text import canonical_name, last_token
from kinweave.operators.reconcile import first_of, stable_id


def surname(c: Column) -> Column:
    """The last word of the canonical name."""
    return last_token(canonical_name(c))


def identity_key(full: Column, name: Column, born: Column, team: Column, club: Column) -> Column:
    """struct(key, kind): "surname|born|TEAM" where all three are known (primary), else "full name|TEAM|club" with unknown for
    a missing club (fallback)."""
    given = lambda c: F.nullif(c, F.lit(""))
    whole, day, code = F.coalesce(given(full), name, F.lit("")), given(F.substring(born.cast("string"), 1, 10)), F.upper(F.coalesce(team, F.lit("")))
    primary = F.when((whole != "") & day.isNotNull() & (code != ""), F.concat_ws("|", surname(whole), day, code))
    fallback = F.concat_ws("|", canonical_name(whole), code, canonical_name(F.coalesce(given(club), F.lit("unknown"))))
    return F.struct(F.coalesce(primary, fallback).alias("key"), F.when(primary.isNotNull(), "primary").otherwise("fallback").alias("kind"))


def identified(rows: DataFrame, key: Column, order: list[Column]) -> DataFrame:
    """rows with (dedup_key, kind, canonical_id, duplicate): the first row of a key keeps it, later ones are duplicates of it."""
    keyed = rows.withColumn("_k", key).select(*rows.columns, F.col("_k.key").alias("dedup_key"), F.col("_k.kind").alias("kind"))
    ranked = first_of(keyed, ["dedup_key"], order)
    return ranked.select(*rows.columns, "dedup_key", "kind", stable_id(F.col("dedup_key")).alias("canonical_id"), (F.col("_rank") > 1).alias("duplicate"))


def aliases(rows: DataFrame, owner: str, kinds: dict[str, Column], lists: dict[str, Column]) -> DataFrame:
    """(owner, alias_type, alias_value): other names and ids of each owner, one column a kind, or an array whose items are each
    one; missing and blank ones give no row, a value of a kind counts once, for its least owner."""
    pair = lambda kind: lambda v: F.struct(F.lit(kind).alias("alias_type"), v.cast("string").alias("alias_value"))
    one = [F.array(pair(k)(c)) for k, c in kinds.items()]
    many = [F.coalesce(F.transform(c, pair(k)), F.array().cast("array<struct<alias_type:string,alias_value:string>>")) for k, c in lists.items()]
    every = rows.select(owner, F.explode(F.concat(*one, *many)).alias("a")).select(owner, "a.*").where(r"alias_value rlike '\\S'")
    return every.groupBy("alias_type", "alias_value").agg(F.min(owner).alias(owner)).select(owner, "alias_type", "alias_value")


def routed(rows: DataFrame, key: str, routes: list[tuple[str, DataFrame]], failed: Column | None = None) -> DataFrame:
    """(key, target, route) for each row: the target of the first route(key, target) that has one, the least where it has several;
    route is null where none has, or api_error where `failed` holds for the row."""
    tagged = reduce(DataFrame.unionByName, [t.select(key, F.struct(F.lit(n).alias("n"), "target", F.lit(name).alias("route")).alias("r")) for n, (name, t) in enumerate(routes)])
    best = tagged.where("r.target is not null").groupBy(key).agg(F.min("r").alias("r"))
    bad = F.coalesce(failed, F.lit(False)) if failed is not None else F.lit(False)
    out = rows.join(best, key, "left")
    return out.select(key, F.when(~bad, F.col("r.target")).alias("target"), F.when(bad, "api_error").otherwise(F.coalesce("r.route", F.lit("no_match"))).alias("route"))
