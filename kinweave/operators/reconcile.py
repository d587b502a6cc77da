"""Values of several sources in long form (entity, field, source, value, priority): merge, vote, conflicts, resolution, diff.

Every step is one or two aggregations by (entity, field), so an entity's fields never meet in one row before publishing and
hot entities are combined on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.functions.nulls import SENTINELS
from kinweave.functions.text import comparable

# Nominal severity of a conflict by field.
SEVERITY = {
    "CRITICAL": ("current_club", "current_league", "date_of_birth", "nationality"),
    "IMPORTANT": ("position", "market_value_eur", "contract_expires", "international_caps", "international_goals", "jersey_number", "captain"),
    "INFORMATIONAL": ("career_trajectory", "major_trophies", "height_cm", "photo_url", "agent"),
}


def long_form(df: DataFrame, entity: str, source: Column, priority: Column, fields: list[str]) -> DataFrame:
    """(entity, field, source, value, prio) of a wide table; null values give no row."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])).alias("_p")
    return df.select(F.col(entity).cast("string").alias("entity"), source.alias("source"), priority.alias("prio"), pairs).select("entity", "_p.field", "source", "_p.value", "prio").where("value is not null and entity is not null")


def merge(values: DataFrame) -> DataFrame:
    """(entity, field, value, source, n_sources): the value of the best source (least prio; then the least value)."""
    best = F.min(F.struct("prio", "value", "source")).alias("m")
    return values.groupBy("entity", "field").agg(best, F.count_distinct("source").alias("n_sources")).select("entity", "field", "m.value", "m.source", "n_sources")


# Which fields each source may supply, best source first.
PERMITTED = {
    "transfermarkt": ("date_of_birth", "nationality", "position", "height_cm", "current_club", "current_league", "market_value_eur", "contract_expires", "photo_url", "agent", "career_trajectory"),
    "static_bios": ("date_of_birth", "height_cm", "market_value_eur", "international_caps", "international_goals", "major_trophies"),
    "static_squads": ("position", "jersey_number", "captain", "current_club"),
    "gpt_enrichment": ("date_of_birth", "nationality", "position", "height_cm", "current_club", "current_league", "market_value_eur", "contract_expires", "agent", "career_trajectory", "international_caps", "international_goals", "jersey_number", "major_trophies"),
}


def permitted(values: DataFrame, allowed: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """The values whose source may supply their field; a source that isn't listed supplies nothing."""
    pairs = [F.struct(F.lit(s).alias("source"), F.lit(f).alias("field")) for s, fields in (PERMITTED if allowed is None else allowed).items() for f in fields]
    return values.where(F.array_contains(F.array(*pairs), F.struct(F.col("source").alias("source"), F.col("field").alias("field"))))


def missing_fields(values: DataFrame, critical: list[str]) -> DataFrame:
    """(entity, missing, coverage): entities that lack one of the critical fields, which ones in the given order, and the share
    they have, to two places. Every entity counts that has a row, if only with nulls."""
    has = [F.max(((F.col("field") == f) & F.col("value").isNotNull()).cast("int")).alias(f) for f in critical]
    flags = values.groupBy("entity").agg(*has)
    lacking = F.array_compact(F.array(*[F.when(F.col(f) == 0, F.lit(f)) for f in critical]))
    return flags.select("entity", lacking.alias("missing")).where(F.size("missing") > 0).withColumn("coverage", F.round((len(critical) - F.size("missing")) / F.lit(float(len(critical))), 2))


def attributed(values: DataFrame) -> DataFrame:
    """merge() with all sources' values as a map: for the edge of the system, where it's wanted whole."""
    best = F.min(F.struct("prio", "value", "source")).alias("m")
    every = F.map_from_entries(F.array_sort(F.collect_set(F.struct("source", "value")))).alias("all_sources")
    once = values.groupBy("entity", "field", "source").agg(F.min(F.struct("prio", "value")).alias("v")).select("entity", "field", "source", "v.*")
    return once.groupBy("entity", "field").agg(best, every).select("entity", "field", "m.value", "m.source", "all_sources")


def severity(field: Column) -> Column:
    out = F.lit("INFORMATIONAL")
    for name, fields in SEVERITY.items():
        out = F.when(field.isin(*fields), name).otherwise(out)
    return out


def vote(values: DataFrame, severities: Column | None = None, compare: bool = True) -> DataFrame:
    """(entity, field, n_sources, n_values, majority_value, majority, top_value, outcome, severity, status) for fields that two or
    more sources fill.

    The majority is the most common value, ties going to the better source; the outcome is agreed, dismissed (one outlier
    and the best source with the majority) or conflict. A critical conflict is informational where the best source is with a
    majority of two or more that more than one source stands against. Values are compared in their fields' comparable form
    (text.comparable; nothing left of a value is no vote), or as given; majority_value is in that form, top_value as stated.
    A source that states a field twice counts with its least value.
    """
    form = comparable(F.col("field"), F.col("value")) if compare else F.col("value")
    once = values.groupBy("entity", "field", "source").agg(F.min(F.struct("prio", "value")).alias("v")).select("entity", "field", "v.prio", "v.value").withColumn("form", form).where("form is not null")
    by_value = once.groupBy("entity", "field", "form").agg(F.count("*").alias("n"), F.min(F.struct("prio", "value")).alias("s"))
    both = by_value.groupBy("entity", "field").agg(
        F.sum("n").alias("n_sources"), F.count("*").alias("n_values"),
        F.max(F.struct("n", (-F.col("s.prio")).alias("p"), "form")).alias("m"), F.min(F.struct("s", "form")).alias("t"),
    ).where("n_sources >= 2")
    n, major, agrees = F.col("n_sources"), F.col("m.n"), F.col("m.form") == F.col("t.form")
    outlier = (major >= 2) & (n - major <= 1)
    outcome = F.when(F.col("n_values") == 1, "agreed").when(outlier & agrees, "dismissed").otherwise("conflict")
    level = severity(F.col("field")) if severities is None else severities
    lowered = F.when(~outlier & (major >= 2) & agrees & (level == "CRITICAL"), "INFORMATIONAL").otherwise(level)
    status = F.when(outcome != "conflict", "none").when(lowered == "INFORMATIONAL", "auto_resolved").otherwise("needs_review")
    return both.select("entity", "field", "n_sources", "n_values", F.col("m.form").alias("majority_value"), major.alias("majority"), F.col("t.s.value").alias("top_value"), outcome.alias("outcome"), lowered.alias("severity"), status.alias("status"))


def blocked(votes: DataFrame) -> DataFrame:
    """(entity, n_conflicts, blocked): whether an open critical conflict holds the entity back."""
    return votes.groupBy("entity").agg(F.count_if(F.col("outcome") == "conflict").alias("n_conflicts"), F.max((F.col("severity") == "CRITICAL") & (F.col("status") == "needs_review")).alias("blocked"))


def report(votes: DataFrame) -> DataFrame:
    """(severity, field, n): conflicts by severity and field."""
    return votes.where("outcome = 'conflict'").groupBy("severity", "field").agg(F.count("*").alias("n"))


def resolve_by_priority(votes: DataFrame) -> DataFrame:
    """The open conflicts that aren't critical, resolved to the best source's value."""
    take = (F.col("status") == "needs_review") & (F.col("severity") != "CRITICAL")
    return votes.withColumn("resolved_value", F.when(take, F.col("top_value"))).withColumn("status", F.when(take, "resolved").otherwise(F.col("status")))


def agreement(values: DataFrame, base: str, second: str, third: str) -> DataFrame:
    """(entity, field, resolved_value): where second and third contain one another (case ignored), differ from base, and base
    isn't part of second, their value replaces base's."""
    wide = values.where(F.col("source").isin(base, second, third)).groupBy("entity", "field").agg(*[F.min(F.when(F.col("source") == s, F.col("value"))).alias(n) for s, n in ((base, "b"), (second, "s"), (third, "t"))])
    low = lambda c: F.lower(F.trim(c))
    together = F.contains(low("s"), low("t")) | F.contains(low("t"), low("s"))
    return wide.where(together & (low("s") != low("b")) & ~F.contains(low("s"), low("b"))).select("entity", "field", F.col("s").alias("resolved_value"))


def tolerant_conflict(field: Column, a: Column, b: Column) -> Column:
    """Numeric values of a field conflict only beyond its tolerance: money by a factor of 3, counts by 10, heights by 3."""
    x, y = a.cast("double"), b.cast("double")
    return F.when(field == "market_value_eur", F.greatest(x, y) >= 3 * F.least(x, y)).when(field.isin("international_caps", "international_goals"), F.abs(x - y) > 10).when(field == "height_cm", F.abs(x - y) > 3).otherwise(a != b)


# Fields that are verified, by tier, in the order of a report.
TIERS = {
    1: ("current_club", "current_league", "nationality_for_wc", "position_primary", "in_wc_2026_squad"),
    2: ("date_of_birth", "estimated_value_eur"),
    3: ("current_jersey_number", "international_caps", "international_goals", "injury_fitness_status", "contract_expires"),
}


def tier_of(field: Column) -> Column:
    """A field's tier; 3 for a field that is in none."""
    return F.when(field.isin(*TIERS[1]), 1).when(field.isin(*TIERS[2]), 2).otherwise(3)


def diff(current: DataFrame, verified: DataFrame, tier: int | None = None, fields: list[str] | None = None) -> DataFrame:
    """(entity, field, tier, old, new, was_missing): verified(entity, field, value) that differ from current as trimmed text in
    lower case, of one tier or some fields if given.

    "" and "null" are nothing on either side, of a verified value also the words none, n/a and unknown; a verified nothing
    overwrites a known value, nothing against nothing is no change. A field that current has no row for is missing there;
    entities that current doesn't have at all give no change (not_found()).
    """
    c = current.select("entity", "field", F.col("value").alias("old"))
    v = verified.select("entity", "field", F.col("value").alias("new"), tier_of(F.col("field")).alias("tier")).join(current.select("entity").distinct(), "entity", "left_semi")
    v = v if tier is None else v.where(F.col("tier") == tier)
    v = v if fields is None else v.where(F.col("field").isin(*fields))
    said = lambda x: F.when(~x.isin("", "null"), F.lower(F.trim(x)))
    old, new = said(F.col("old")), said(F.col("new"))
    new = F.when(~new.isin(*SENTINELS["verified_new"]), new)
    changed = v.join(c, ["entity", "field"], "left").where(~old.eqNullSafe(new))
    return changed.select("entity", "field", "tier", "old", F.when(new.isNotNull(), F.col("new")).alias("new"), F.coalesce(F.col("old").isin("", "null"), F.lit(True)).alias("was_missing"))


def not_found(current: DataFrame, verified: DataFrame) -> DataFrame:
    """(entity): verified entities that current doesn't have."""
    return verified.select("entity").distinct().join(current.select("entity").distinct(), "entity", "left_anti")


def change_counts(changes: DataFrame) -> DataFrame:
    """(kind, n): filled fields, and changed ones by tier."""
    kind = F.when(F.col("was_missing"), "filled").otherwise(F.concat(F.lit("tier"), F.col("tier").cast("string")))
    return changes.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


def curation_flags(changes: DataFrame) -> DataFrame:
    """(entity, curation_reason): "recency_check: T1:field:old->new; ..." for each entity with changes, by tier, then in the
    fields' order. An entity has at most as many changes as there are fields."""
    listed = [f for t in sorted(TIERS) for f in TIERS[t]]
    at = F.array_position(F.array(*[F.lit(f) for f in listed]), F.col("field"))
    at = F.when(at == 0, len(listed) + 1).otherwise(at)
    shown = lambda c: F.coalesce(F.col(c), F.lit("NULL"))
    line = F.concat(F.lit("T"), F.col("tier").cast("string"), F.lit(":"), "field", F.lit(":"), shown("old"), F.lit("->"), shown("new"))
    ordered = F.array_sort(F.collect_list(F.struct("tier", at.alias("at"), "field", line.alias("line"))))
    return changes.groupBy("entity").agg(F.concat(F.lit("recency_check: "), F.array_join(F.transform(ordered, lambda x: x["line"]), "; ")).alias("curation_reason"))


def apply_changes(current: DataFrame, changes: DataFrame) -> DataFrame:
    """current with the changes' new values, null ones too."""
    c = changes.select("entity", "field", F.col("new").alias("_new"), F.lit(True).alias("_hit"))
    return current.join(c, ["entity", "field"], "left").withColumn("value", F.when(F.col("_hit"), F.col("_new")).otherwise(F.col("value"))).drop("_new", "_hit")


def first_of(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """Each key's first row with _rank 1, later ones with 2 and on (collisions)."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))


def stable_id(key: Column) -> Column:
    """A UUID-shaped id derived from the key: the same key always gets the same id."""
    h = F.sha2(key, 256)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12))
