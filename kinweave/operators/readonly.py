"""A guard for questions in SQL from outside: one SELECT over listed tables, no writes, a bounded result."""

from __future__ import annotations

import re
import threading
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

#: Rows an answer may have, seconds it may take.
MOST, SECONDS = 50, 5.0
_FORBIDDEN = re.compile(r"\b(insert|update|delete|merge|drop|create|alter|truncate|grant|revoke|call|set|reset|use|cache|uncache|refresh|load|add|copy|into|transform|reflect|java_method|input_file_name)\b", re.I)


class Rejected(ValueError):
    """Says why a statement isn't run."""


def check(sql: str) -> str:
    """The statement without comments, if it's a single SELECT. What it reads is seen from its plan (read())."""
    text = re.sub(r"/\*.*?\*/|--[^\n]*", " ", sql, flags=re.S).strip().rstrip(";").strip()
    bare = re.sub(r"'(?:[^']|'')*'", "''", text)
    if not re.match(r"(select|with)\b", bare, re.I):
        raise Rejected("not a SELECT")
    if ";" in bare:
        raise Rejected("more than one statement")
    if m := _FORBIDDEN.search(bare):
        raise Rejected(f"uses {m.group(1).lower()}")
    return text


def _walk(plan):
    """A plan's nodes, those of its subqueries too; a view's own plan isn't looked into."""
    yield plan
    if plan.nodeName() == "View":
        return
    for group in (plan.children(), plan.subqueries()):
        for n in range(group.size()):
            yield from _walk(group.apply(n))


def read(spark: SparkSession, df: DataFrame) -> set[str]:
    """What an analyzed statement reads: names of temporary views in lower case; anything else by its kind of plan node. Names
    that stand for common table expressions are resolved by then, so a name can't pretend to be one."""
    out = set()
    for node in _walk(df._jdf.queryExecution().analyzed()):
        kind = node.nodeName()
        if kind == "View":
            d = node.desc().identifier()
            out.add(d.table().lower() if not d.database().isDefined() else f"{d.database().get()}.{d.table()}")
        elif node.children().isEmpty() and kind not in ("OneRowRelation", "LocalRelation", "CTERelationRef", "Range"):
            out.add(f"{kind} outside the listed tables")
    return out


def answer(spark: SparkSession, sql: str, tables: dict[str, DataFrame], most: int = MOST) -> DataFrame:
    """The checked statement's rows, at most `most` of them. The tables are views only while the statement is analyzed; a view
    of the session that has the name of one of them makes the call fail rather than be replaced."""
    text = check(sql)
    if taken := [t for t in tables if spark.catalog.tableExists(t)]:
        raise Rejected(f"the session has tables named {', '.join(sorted(taken))}")
    try:
        for name, df in tables.items():
            df.createTempView(name)
        try:
            got = spark.sql(text)
        except AnalysisException as e:
            raise Rejected(str(e).splitlines()[0]) from e
        if other := read(spark, got) - {t.lower() for t in tables}:
            raise Rejected(f"reads {', '.join(sorted(other))}")
        return got.limit(most)
    finally:
        for name in tables:
            spark.catalog.dropTempView(name)


def rows(spark: SparkSession, sql: str, tables: dict[str, DataFrame], most: int = MOST, seconds: float = SECONDS) -> list:
    """answer() collected, stopped after some seconds."""
    tag = f"readonly-{uuid.uuid4().hex}"
    timer = threading.Timer(seconds, lambda: spark.sparkContext.cancelJobsWithTag(tag))
    spark.sparkContext.addJobTag(tag)
    timer.start()
    try:
        return answer(spark, sql, tables, most).collect()
    finally:
        timer.cancel()
        spark.sparkContext.removeJobTag(tag)
