"""State changes as new versions of a table: inserts, upserts, updates from a join, deletes, flags, snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.functions.text import append_reason, remove_reason


def one_each(df: DataFrame, key: list[str], order: list[Column] | None = None) -> DataFrame:
    """One row for each key: the last by `order`, else the greatest by all columns, so that the choice is stable."""
    rest = [c for c in df.columns if c not in key]
    if order:
        w = Window.partitionBy(*key).orderBy(*order)
        return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
    return df.groupBy(*key).agg(F.max(F.struct(*rest)).alias("_r")).select(*key, *[F.col("_r")[c].alias(c) for c in rest])


def insert_missing(target: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """ON CONFLICT DO NOTHING: rows of new whose key the target lacks are added, each key once."""
    return target.unionByName(one_each(new.select(*target.columns), key).join(target, key, "left_anti"))


def upsert(target: DataFrame, new: DataFrame, key: list[str], keep_old_if_null: bool = True) -> DataFrame:
    """ON CONFLICT DO UPDATE: new values replace old ones; with keep_old_if_null a null keeps the old."""
    n = one_each(new.select(*target.columns), key)
    rest = [c for c in target.columns if c not in key]
    joined = target.alias("t").join(n.select(*key, *[F.col(c).alias(f"_new_{c}") for c in rest], F.lit(True).alias("_hit")), key, "full_outer")
    value = (lambda c: F.coalesce(F.col(f"_new_{c}"), F.col(c))) if keep_old_if_null else (lambda c: F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)))
    return joined.select(*key, *[value(c).alias(c) for c in rest]).select(*target.columns)


def add_counts(target: DataFrame, new: DataFrame, key: list[str], count: str) -> DataFrame:
    """ON CONFLICT DO UPDATE SET n = n + EXCLUDED.n: counters of equal keys are added up, others kept or added."""
    return target.select(*key, count).unionAll(new.select(*key, count)).groupBy(*key).agg(F.sum(count).alias(count))


def update_from(target: DataFrame, source: DataFrame, key: list[str], sets: dict[str, Column], order: list[Column] | None = None) -> DataFrame:
    """UPDATE ... FROM: sets may name source columns as s_<name>; the source is reduced to one row a key before the join."""
    s = one_each(source, key, order)
    s = s.select(*key, *[F.col(c).alias(f"s_{c}") for c in s.columns if c not in key], F.lit(True).alias("_hit"))
    joined = target.join(s, key, "left")
    return joined.select(*[F.when(F.col("_hit"), sets[c]).otherwise(F.col(c)).alias(c) if c in sets else F.col(c) for c in target.columns])


def delete_in(target: DataFrame, doomed: DataFrame, key: list[str]) -> DataFrame:
    """DELETE ... WHERE IN: null keys are never in the list."""
    return target.join(doomed.select(*key).distinct(), key, "left_anti")


def flag_in(target: DataFrame, listed: DataFrame, key: list[str], reason: str, column: str = "curation_reason", again: bool = False) -> DataFrame:
    """Appends a reason to the rows whose key is listed; a row that has it already is left alone unless `again`."""
    hit = target.join(listed.select(*key).distinct().withColumn("_hit", F.lit(True)), key, "left")
    has = F.coalesce(F.array_contains(F.split(F.col(column), "; "), reason), F.lit(False))
    due = F.col("_hit").isNotNull() if again else F.col("_hit").isNotNull() & ~has
    return hit.withColumn(column, F.when(due, append_reason(F.col(column), F.lit(reason))).otherwise(F.col(column))).select(*target.columns)


def unflag(target: DataFrame, reason: str, column: str = "curation_reason") -> DataFrame:
    return target.withColumn(column, remove_reason(F.col(column), reason))


def snapshot_diff(before: DataFrame, after: DataFrame, key: list[str]) -> DataFrame:
    """(key, change): added, removed, changed or unchanged between two versions, by a hash of the other columns."""
    rest = sorted(c for c in before.columns if c not in key)
    h = lambda df, n: df.select(*key, F.xxhash64(*rest).alias(n), F.lit(True).alias(f"_{n}"))
    j = h(before, "a").join(h(after, "b"), key, "full_outer")
    change = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(F.col("a") != F.col("b"), "changed").otherwise("unchanged")
    return j.select(*key, change.alias("change"))
