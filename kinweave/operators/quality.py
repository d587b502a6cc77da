"""Quality gates: contracts over a table in one aggregation, row and group checks as issue rows, runners that stop a run."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.functions.nulls import present
from kinweave.functions.parse import age_at


@dataclass(frozen=True)
class Gate:
    """A named aggregate that must lie within bounds."""

    name: str
    value: Column
    low: float | None = None
    high: float | None = None


class GateError(RuntimeError):
    """Names every gate that failed."""


def evaluate(df: DataFrame, gates: list[Gate]) -> DataFrame:
    """(gate, value, passed): all gates in one pass over df; a gate without a value (empty input) fails."""
    one = df.agg(*[g.value.cast("double").alias(g.name) for g in gates])
    rows = F.array(*[F.struct(F.lit(g.name).alias("gate"), F.col(g.name).alias("value"), F.lit(g.low).cast("double").alias("low"), F.lit(g.high).cast("double").alias("high")) for g in gates])
    long = one.select(F.explode(rows).alias("g")).select("g.*")
    ok = F.col("value").isNotNull() & (F.col("low").isNull() | (F.col("value") >= F.col("low"))) & (F.col("high").isNull() | (F.col("value") <= F.col("high")))
    return long.select("gate", "value", ok.alias("passed"))


def require(df: DataFrame, gates: list[Gate], strict: bool = True) -> list[str]:
    """The failed gates; raises with all of them unless lenient. No gates, no look at df."""
    if not gates:
        return []
    failed = [f"{r['gate']}={r['value']}" for r in evaluate(df, gates).where("not passed").collect()]  # one row a gate
    if failed and strict:
        raise GateError("; ".join(sorted(failed)))
    return failed


def coverage(name: str, c: Column, least: float) -> Gate:
    return Gate(name, F.round(100 * F.avg(F.when(present(c), 1.0).otherwise(0.0)), 1), least)


def unique(name: str, c: Column) -> Gate:
    """No repeated and no missing key."""
    return Gate(name, F.count("*") - F.count_distinct(c), 0, 0)


def at_least(name: str, n: int) -> Gate:
    return Gate(name, F.count("*"), n)


def group_sizes(df: DataFrame, group: str, low: int, high: int) -> DataFrame:
    """(group, n): groups whose size is out of bounds."""
    return df.groupBy(group).agg(F.count("*").alias("n")).where(~F.col("n").between(low, high))


def switched(df: DataFrame, key: str, value: str, order: list[Column]) -> DataFrame:
    """Rows whose value differs from that of the key's previous row."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("previous", F.lag(value).over(w)).where(F.col("previous") != F.col(value))


def row_issues(df: DataFrame, key: str, checks: dict[str, tuple[str, Column]]) -> DataFrame:
    """(key, check, severity): one row for each check that a row fails; a null result is no failure."""
    found = F.array(*[F.when(c, F.struct(F.lit(n).alias("check"), F.lit(s).alias("severity"))) for n, (s, c) in checks.items()])
    return df.select(F.col(key), F.explode(F.filter(found, lambda x: x.isNotNull())).alias("i")).select(key, "i.check", "i.severity")


def repeated(df: DataFrame, key: str, group: list[Column], order: list[Column], label: str, severity: str) -> DataFrame:
    """(key, check, severity) for the second and later rows of a group."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n > 1").select(key, F.lit(label).alias("check"), F.lit(severity).alias("severity"))


# Bounds of a player's age and of a squad.
YOUNGEST, OLDEST, SQUAD = 15, 45, (23, 26)


def player_issues(players: DataFrame, squads: DataFrame) -> DataFrame:
    """(player_name, source_id, check, severity, detail) of players(id, name, position, nationality, date_of_birth) and of
    squads(the same, team_code): missing texts, ages out of bounds; squads of a wrong size, without a goalkeeper, with a name
    that occurs again (lower case, trimmed; the least id is the first). Blank texts are missing; an unknown birth date gives
    no age."""
    age = age_at(F.col("date_of_birth"))
    aged = F.concat(F.lit("Age "), age.cast("string"), F.lit(" (DOB: "), F.date_format("date_of_birth", "yyyy-MM-dd"), F.lit(")"))
    blank = lambda c: F.coalesce(F.trim(c) == "", F.lit(True))
    issue = lambda name, level, detail: F.struct(F.lit(name).alias("check"), F.lit(level).alias("severity"), detail.alias("detail"))
    found = F.array(
        F.when(blank("name"), issue("missing_name", "critical", F.lit("Player has no name"))), F.when(blank("position"), issue("missing_position", "warning", F.lit("No position assigned"))),
        F.when(blank("nationality"), issue("missing_nationality", "warning", F.lit("No nationality"))),
        F.when(age < YOUNGEST, issue("age_too_young", "error", aged)).when(age > OLDEST, issue("age_too_old", "warning", aged)),
    )
    own = players.select(F.col("name").alias("player_name"), F.col("id").alias("source_id"), F.explode(F.array_compact(found)).alias("i")).select("player_name", "source_id", "i.*")
    teams = squads.groupBy("team_code").agg(F.count("*").alias("n"), F.count_if(F.upper("position").isin("GK", "GOALKEEPER")).alias("keepers"))
    low, high = SQUAD
    size = lambda middle, end: F.concat("team_code", F.lit(middle), F.col("n").cast("string"), F.lit(end))
    of_team = F.array(
        F.when(F.col("n") < low, issue("squad_incomplete", "warning", size(" has only ", f" players (expected {low}-{high})"))).when(F.col("n") > high, issue("squad_too_large", "warning", size(" has ", f" players (max {high})"))),
        F.when(F.col("keepers") == 0, issue("no_goalkeeper", "error", F.concat("team_code", F.lit(" has no goalkeeper in squad")))),
    )
    team = teams.select(F.concat(F.lit("TEAM:"), "team_code").alias("player_name"), F.lit("").alias("source_id"), F.explode(F.array_compact(of_team)).alias("i")).select("player_name", "source_id", "i.*")
    again = F.row_number().over(Window.partitionBy("team_code", F.trim(F.translate(F.lower("name"), "\u0307", ""))).orderBy("id"))
    twice = squads.where("name is not null").withColumn("_n", again).where("_n > 1")
    shown = F.concat(F.lit("'"), "name", F.lit("' appears multiple times in "), "team_code")
    names = twice.select(F.col("name").alias("player_name"), F.lit("").alias("source_id"), F.lit("duplicate_in_team").alias("check"), F.lit("error").alias("severity"), shown.alias("detail"))
    return own.unionByName(team).unionByName(names)


def completeness(df: DataFrame, fields: list[str]) -> DataFrame:
    """(field, filled, total) in one pass."""
    one = df.agg(F.count("*").alias("_total"), *[F.count_if(present(F.col(f))).alias(f) for f in fields])
    return one.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("filled"), F.col("_total").alias("total")) for f in fields])).alias("r")).select("r.*")


def stage(name: str, run: Callable[[], DataFrame], gates: list[Gate], strict: bool = True) -> tuple[str, DataFrame, list[str]]:
    df = run()
    return name, df, require(df, gates, strict)
