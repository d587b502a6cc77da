"""The best value of each field within each group of duplicate rows.

Rows that name a common source id, directly or through further rows, form a group (components.py). A single aggregation
then takes, for every field at once, the best composite (filled, priority, time, id) of the group, so each field survives
from its own best row and no group is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.llm.components import components

# Words that stand for no value.
EMPTY = ("", "-", "--", "---", "–", "—", "?", ".", "none", "null", "nil", "nan", "na", "n/a", "n.a.", "unknown", "undisclosed", "not known", "tbc", "tbd", "ninguno", "desconocido", "keine", "unbekannt", "nenhum", "desconhecido")
# Trust in a row, best first.
CONFIDENCE = ("VERIFIED", "PROJECTED", "PARTIAL", "ORPHAN")


def filled(c: Column, dtype: str) -> Column:
    """Whether a value says something: text that is no placeholder, a number above 0."""
    if dtype == "string":
        return F.coalesce(~F.lower(F.trim(c)).isin(*EMPTY), F.lit(False))
    return F.coalesce(c > 0, F.lit(False))


def source_ids(tm: str, apif: str, records: str) -> Column:
    """The ids a row names, T or A before the digits, in its two id columns and in free text like "TM:1 + APIF:apif_2"."""
    number = lambda c, mark: F.when(F.regexp_extract(c, r"(\d+)", 1) != "", F.concat(F.lit(mark), F.regexp_extract(c, r"(\d+)", 1)))
    named = F.regexp_extract_all(F.lower(F.col(records)), F.lit(r"(?:tm|apif)[\s:#_=]*(?:apif[\s_]*)?\d+"), F.lit(0))
    parsed = F.transform(named, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.regexp_extract(x, r"(\d+)$", 1)))
    listed = F.concat(F.array(number(F.col(tm), "T"), number(F.col(apif), "A")), F.coalesce(parsed, F.array().cast("array<string>")))
    return F.array_distinct(F.filter(listed, lambda x: x.isNotNull()))


def survivors(rows: DataFrame, group: str, key: str, fields: list[str], priority: Column, at: str) -> DataFrame:
    """(group_id, _last, <field>: struct(key, value)): for each group and field the key and value of the row that fills the
    field with the smallest priority, then the latest `at` (null: oldest), then the smallest key; null where no row fills it.

    group_id is the smallest key of the group. A composite maximum taken as the minimum of its reverse, so that the key
    breaks ties upwards; every field in one aggregation with partial results before the shuffle. Null keys are no rows.
    """
    types = dict(rows.dtypes)
    age = F.coalesce(-F.unix_micros(F.col(at)), F.lit(2**63 - 1))
    best = [
        F.min(F.when(filled(F.col(f), types[f]), F.struct(priority.alias("p"), age.alias("t"), F.col(key).alias("k"), F.col(f).alias("v")))).alias(f)
        for f in fields
    ]
    out = rows.where(F.col(key).isNotNull()).groupBy(group).agg(F.min(key).alias("group_id"), F.max(key).alias("_last"), *best)
    return out.select("group_id", "_last", *[F.struct(F.col(f)["k"].alias("key"), F.col(f)["v"].alias("value")).alias(f) for f in fields])


def profile_survivors(staging: DataFrame, fields: list[str]) -> DataFrame:
    """survivors() over profile_players_staging, for groups of two or more profile_ids."""
    ids = staging.select("profile_id", source_ids("tm_id", "apif_id", "source_records").alias("ids")).where("profile_id is not null")
    edges = ids.select(F.col("profile_id").alias("a"), F.explode("ids").alias("s"))
    groups = components(edges.select(F.concat(F.lit("p"), "a").alias("a"), F.col("s").alias("b"))).where("id like 'p%'")
    groups = groups.select(F.expr("substring(id, 2)").alias("profile_id"), F.col("group_id").alias("_group"))
    word = F.upper(F.trim("data_confidence"))
    priority = F.lit(len(CONFIDENCE))
    for i, c in reversed(list(enumerate(CONFIDENCE))):
        priority = F.when(word == c, i).otherwise(priority)
    rows = staging.select("profile_id", "data_confidence", "updated_at", *fields).join(groups, "profile_id")
    return survivors(rows, "_group", "profile_id", fields, priority, "updated_at").where("group_id <> _last").drop("_last")


def found(staging: DataFrame) -> DataFrame:
    """(group_id, field, profile_id): which row's current_club and market_value_eur survive in each group."""
    fields = ["current_club", "market_value_eur"]
    best = profile_survivors(staging, fields)
    long = best.select("group_id", F.explode(F.create_map(*[x for f in fields for x in (F.lit(f), F.col(f)["key"])])).alias("field", "profile_id"))
    return long.where("profile_id is not null")
