"""Whole records: lookups by several keys, name search, plausibility, nested values, golden records, comparison with live data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.functions.text import combined_name, last_token


def latest(table: DataFrame, key: str, fields: list[str], at: str) -> DataFrame:
    """(key, fields...): of each key the row with the latest `at` (null: oldest); of equally late ones the greatest values."""
    rows = table.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(F.col(at).alias("_at"), *fields)).alias("_f"))
    return rows.select(key, *[F.col("_f")[f].alias(f) for f in fields])


def lookup(rows: DataFrame, table: DataFrame, key: str, by: list[str], fields: list[str], at: str) -> DataFrame:
    """rows with the fields of table(key, fields...) found by the first of rows' columns `by` that has a hit. The table's keys
    are made unique first (latest row), so no row multiplies."""
    once = latest(table, key, fields, at).select(key, F.struct(*fields).alias("_f"))
    out = rows
    for n, c in enumerate(by):
        out = out.join(once.select(F.col(key).alias(c), F.col("_f").alias(f"_f{n}")), c, "left")
    found = reduce(F.coalesce, [F.col(f"_f{n}") for n in range(len(by))]) if len(by) > 1 else F.col("_f0")
    return out.select(*rows.columns, *[found[f].alias(f) for f in fields])


def names_match(a: Column, b: Column) -> Column:
    """Equal, or the same last word of more than two letters, or one within the other; both without accents, in lower case."""
    x, y = combined_name(a), combined_name(b)
    last = (last_token(x) == last_token(y)) & (F.length(last_token(x)) > 2)
    return (x == y) | last | ((x != "") & (y != "") & (F.contains(x, y) | F.contains(y, x)))


def first_match(rows: DataFrame, listed: DataFrame, group: str, name: str, other: str, order: Column) -> DataFrame:
    """rows with the first entry of listed in the same group whose name matches; null where none does. The group bounds what
    is compared, so it should be a natural one (a team)."""
    pairs = rows.join(listed, group).where(names_match(F.col(name), F.col(other)))
    keys = [c for c in rows.columns]
    best = pairs.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(order))).where("_n = 1").select(*keys, *[c for c in listed.columns if c != group])
    return rows.join(best, keys, "left")


def plausible(value: Column, accepted: Column) -> Column:
    """Whether any accepted text contains the value or is part of it, case ignored; a missing side is plausible."""
    v = F.lower(F.trim(value))
    return F.coalesce(F.exists(accepted, lambda a: F.contains(F.lower(a), v) | F.contains(v, F.lower(a))), F.lit(True))


def search(df: DataFrame, wanted: str, columns: list[str], order: list[Column], limit: int = 5) -> DataFrame:
    """The first rows one of whose names is the wanted text or contains it, exact hits first, accents and case ignored. The
    limit is the feature."""
    w = combined_name(F.lit(wanted))
    names = [combined_name(F.coalesce(F.col(c), F.lit(""))) for c in columns]
    exact = reduce(lambda x, y: x | y, [n == w for n in names])
    part = reduce(lambda x, y: x | y, [F.contains(n, w) for n in names])
    return df.where(part).orderBy(F.when(exact, 0).otherwise(1), *order).limit(limit)


def set_path(df: DataFrame, path: str, value: Column) -> DataFrame:
    """df with a nested field set: "career.club" replaces that field of the struct column career."""
    head, _, rest = path.partition(".")
    return df.withColumn(head, F.col(head).withField(rest, value) if rest else value)


def apply_paths(df: DataFrame, resolved: DataFrame, key: str, paths: dict[str, str]) -> DataFrame:
    """df with resolved(key, field, value) written to the paths of the fields; a field resolved to null becomes null, others stay."""
    wide = resolved.where(F.col("field").isin(*paths)).groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("_r"))
    out = df.join(wide, key, "left")
    for field, path in paths.items():
        hit = F.coalesce(F.map_contains_key("_r", F.lit(field)), F.lit(False))
        out = set_path(out, path, F.when(hit, F.element_at("_r", F.lit(field))).otherwise(F.col(path)))
    return out.drop("_r")


def as_list(text: Column, key: str) -> Column:
    """Texts of a JSON list whose items are texts or objects with the key; of a single text or object too. Unreadable JSON is null."""
    v = F.try_parse_json(text)
    one = lambda x: F.coalesce(F.try_variant_get(x, f"$.{key}", "string"), F.when(F.schema_of_variant(x) == "STRING", F.try_variant_get(x, "$", "string")))
    items = F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.when(v.isNotNull(), F.array(v)))
    return F.filter(F.transform(items, one), lambda x: x.isNotNull())


def review_lines(values: DataFrame) -> DataFrame:
    """(entity, field, sources): what each source says, as "a=1 | b=2" in alphabetical order, for a reviewer."""
    pairs = F.array_sort(F.collect_set(F.concat_ws("=", "source", F.coalesce("value", F.lit("")))))
    return values.groupBy("entity", "field").agg(F.array_join(pairs, " | ").alias("sources"))


def golden(identity: DataFrame, sections: dict[str, tuple[DataFrame, list[str], str]], key: str) -> DataFrame:
    """One nested record for each identity: a struct column for each section (table, fields, time), its fields from the section's
    latest row, null fields where there is none."""
    out = identity
    for name, (table, fields, at) in sections.items():
        once = latest(table, key, fields, at).select(key, F.struct(*fields).alias(name))
        out = out.join(once, key, "left").withColumn(name, F.struct(*[F.col(name)[f].alias(f) for f in fields]))
    return out


def live_changes(known: DataFrame, live: DataFrame, key: str, if_changed: list[str], always: list[str], height: str | None = None) -> DataFrame:
    """known with live values: some fields only where they differ, others always (a missing live value never), a height only
    from 100 to 230; status says updated, no_changes or not_found."""
    l = live.select(key, *[F.col(c).alias(f"_{c}") for c in [*if_changed, *always, *([height] if height else [])]], F.lit(True).alias("_hit"))
    out = known.join(l, key, "left")
    new = {c: F.when(F.col(f"_{c}").isNotNull() & ~F.col(c).eqNullSafe(F.col(f"_{c}")), F.col(f"_{c}")).otherwise(F.col(c)) for c in if_changed} | {c: F.coalesce(F.col(f"_{c}"), F.col(c)) for c in always}
    if height:
        new[height] = F.when((F.col(f"_{height}") > 100) & (F.col(f"_{height}") < 230), F.col(f"_{height}")).otherwise(F.col(height))
    changed = reduce(lambda x, y: x | y, [~v.eqNullSafe(F.col(c)) for c, v in new.items()])
    status = F.when(F.col("_hit").isNull(), "not_found").when(changed, "updated").otherwise("no_changes")
    return out.select(*[new.get(c, F.col(c)).alias(c) for c in known.columns], status.alias("status"))


def catalogue(df: DataFrame) -> DataFrame:
    """(ord, column, type): a table's columns as rows."""
    return df.sparkSession.createDataFrame([(i, c, t) for i, (c, t) in enumerate(df.dtypes)], "ord int, column string, type string")
