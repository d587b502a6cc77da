"""Data written as object literals in source code: squads by team, biographies by slug."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A quoted text with escapes.
_TEXT = r'"((?:[^"\\]|\\.)*)"'


def texts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, text): whole files; a source file is small, so it's one row."""
    return spark.read.text(paths, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def squads(files: DataFrame) -> DataFrame:
    """(team, pos, name, number, position, club, age, captain) of `TEAM: [{...}, ...]` blocks; line comments are dropped.
    Players' objects hold no brackets of their own. Built-in functions only."""
    text = F.regexp_replace("text", r"//[^\n]*", "")
    teams = files.select(F.explode(F.regexp_extract_all(text, F.lit(r"[A-Z]{3}\s*:\s*\[[^\]]*\]"), F.lit(0))).alias("block"))
    rows = teams.select(F.substring("block", 1, 3).alias("team"), F.posexplode(F.regexp_extract_all("block", F.lit(r"\{([^}]*)\}"), F.lit(1))).alias("pos", "o"))

    def text_of(key: str) -> Column:
        v = F.regexp_extract("o", rf"(?:^|[,\s]){key}\s*:\s*{_TEXT}", 1)
        return F.nullif(F.replace(v, F.lit('\\"'), F.lit('"')), F.lit(""))

    def number_of(key: str) -> Column:
        return F.expr(rf"try_cast(nullif(regexp_extract(o, '(?:^|[,\\s]){key}\\s*:\\s*(\\d+)', 1), '') as int)")

    return rows.select("team", "pos", text_of("name").alias("name"), number_of("number").alias("number"), text_of("position").alias("position"), text_of("club").alias("club"), number_of("age").alias("age"), F.col("o").rlike(r"captain\s*:\s*true").alias("captain"))


def objects(text: str) -> Iterator[tuple[str, str]]:
    """(key, body) of the `"key": {...}` entries at the outermost level, braces balanced, quotes respected."""
    text = re.sub(r"//[^\n]*", "", text)
    for m in re.finditer(r'["\']?([\w-]+)["\']?\s*:\s*\{', text):
        depth, i, quote = 1, m.end(), None
        while i < len(text) and depth:
            c = text[i]
            if quote:
                if c == "\\":
                    i += 1
                elif c == quote:
                    quote = None
            elif c in "\"'`":
                quote = c
            else:
                depth += (c == "{") - (c == "}")
            i += 1
        if not depth:
            yield m.group(1), text[m.end() : i - 1]


def _list(body: str, key: str) -> list[str] | None:
    m = re.search(rf"(?:^|[,\s]){key}\s*:\s*\[(.*?)\]", body, re.S)
    return re.findall(_TEXT, m.group(1)) if m else None


def _value(body: str, key: str) -> str | None:
    m = re.search(rf"(?:^|[,\s]){key}\s*:\s*(?:{_TEXT}|(-?\d+))", body)
    return (m.group(1) if m.group(1) is not None else m.group(2)) if m else None


def bios(files: DataFrame, rank: Column) -> DataFrame:
    """(slug, height, foot, caps, goals, value, born, clubs, honours): one row a slug, files of a higher rank overriding others."""

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for r, text in zip(frame["r"], frame["text"], strict=True):
                for n, (slug, body) in enumerate(objects(text)):
                    if "{" in body:
                        continue  # a list of objects, not one of them
                    whole = lambda k: int(v) if (v := _value(body, k)) and v.lstrip("-").isdigit() else None  # noqa: B023, E731
                    rows.append((r, n, slug, _value(body, "height"), _value(body, "foot"), whole("intlCaps"), whole("intlGoals"), _value(body, "marketValue"), _value(body, "birthDate"), _list(body, "previousClubs"), _list(body, "achievements")))
            yield pd.DataFrame(rows, columns=["r", "n", "slug", "height", "foot", "caps", "goals", "value", "born", "clubs", "honours"]).astype({"caps": "Int32", "goals": "Int32"})

    schema = "r int, n int, slug string, height string, foot string, caps int, goals int, value string, born string, clubs array<string>, honours array<string>"
    found = files.select(rank.cast("int").alias("r"), "text").mapInPandas(scan, schema)
    last = F.row_number().over(Window.partitionBy("slug").orderBy(F.desc("r"), F.desc("n")))
    return found.withColumn("_k", last).where("_k = 1").drop("_k", "r", "n")
