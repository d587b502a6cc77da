"""Publishing: versioned folders with a pointer, seed files in SQL, generated source text."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.functions.text import script_escape, sql_array, sql_literal
from kinweave.sources.files import exists


class Versions:
    """Versions of a table in folders v=<n>; a small pointer file names the current one, so readers never see half a write
    and a rollback only moves the pointer."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def list(self) -> list[int]:
        """Versions that are written whole."""
        return [n for n in self._numbers() if exists(self.spark, f"{self.root}/v={n}/_SUCCESS")]

    def _numbers(self) -> list[int]:
        if not exists(self.spark, self.root):
            return []
        fs, p = self._fs(self.root)
        return sorted(int(s.getPath().getName()[2:]) for s in fs.listStatus(p) if s.getPath().getName().startswith("v="))

    def current(self) -> int | None:
        if not exists(self.spark, f"{self.root}/current"):
            return None
        return json.loads(self.spark.read.text(f"{self.root}/current").first()[0])["version"]

    def _reserve(self) -> int:
        """A number of one's own: its marker is created only if nobody else has."""
        version = max(self._numbers(), default=0) + 1
        while True:
            fs, p = self._fs(f"{self.root}/_taken/{version}")
            try:
                fs.create(p, False).close()
                return version
            except Py4JJavaError:
                if not fs.exists(p):
                    raise
                version += 1

    def publish(self, df: DataFrame) -> int:
        version = self._reserve()
        df.write.parquet(f"{self.root}/v={version}")
        self.point(version)
        return version

    def point(self, version: int) -> None:
        """Makes a version the current one. The new pointer is renamed over the old one in a single step, so that readers always
        find one."""
        if version not in self.list():
            raise ValueError(f"no version {version}")
        fs, new = self._fs(f"{self.root}/_current-{uuid.uuid4().hex}")
        out = fs.create(new, True)
        out.write(bytearray(json.dumps({"version": version}).encode()))
        out.close()
        jvm = self.spark.sparkContext._jvm
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        over = self.spark.sparkContext._gateway.new_array(rename, 1)
        over[0] = rename.OVERWRITE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri() if new.toUri().getScheme() else fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        context.rename(fs.makeQualified(new), fs.makeQualified(self._fs(f"{self.root}/current")[1]), over)

    def read(self, version: int | None = None) -> DataFrame:
        version = self.current() if version is None else version
        return self.spark.read.parquet(f"{self.root}/v={version}")


def insert_lines(df: DataFrame, table: str, order: list[Column]) -> DataFrame:
    """(n, line): INSERT statements that skip existing rows, one for each row of df."""
    literal = lambda c, t: sql_array(F.col(c)) if t.startswith("array") else F.coalesce(F.col(c).cast("string"), F.lit("NULL")) if t in ("int", "bigint", "boolean", "double") else sql_literal(F.col(c))
    values = F.concat_ws(", ", *[literal(c, t) for c, t in df.dtypes])
    line = F.concat(F.lit(f"INSERT INTO {table} ({', '.join(df.columns)}) VALUES ("), values, F.lit(") ON CONFLICT DO NOTHING;"))
    return df.sort(*order).select(line.alias("line"))


def write_seed(df: DataFrame, table: str, order: list[Column], path: str) -> None:
    """Statements in order as text; a range-partitioned sort, no single task."""
    insert_lines(df, table, order).write.mode("overwrite").text(path)


def squad_source(df: DataFrame) -> DataFrame:
    """(team, text): an object literal for each team's players, captain first, then by number. df(team, name, number, position, captain).
    A squad is small by nature, so its ordered list is one row."""
    player = F.concat(F.lit('    { name: "'), script_escape(F.col("name")), F.lit('", number: '), F.coalesce(F.col("number").cast("string"), F.lit("null")), F.lit(', position: "'), F.coalesce("position", F.lit("")), F.lit('"'), F.when(F.col("captain"), ", captain: true").otherwise(""), F.lit(" },"))
    ordered = F.array_sort(F.collect_list(F.struct((~F.coalesce("captain", F.lit(False))).alias("c"), F.coalesce("number", F.lit(999)).alias("n"), "name", player.alias("line"))))
    lines = F.array_join(F.transform(ordered, lambda x: x["line"]), "\n")
    return df.groupBy("team").agg(F.concat(F.lit("  "), F.col("team"), F.lit(": [\n"), lines, F.lit("\n  ],")).alias("text"))


def summary(df: DataFrame, label: str, groups: dict[str, Column]) -> DataFrame:
    """(section, key, n): the number of rows under the label, and the counts by each group's values; one pass for every group."""
    every = F.array(F.struct(F.lit("rows").alias("section"), F.lit(label).alias("key")), *[F.struct(F.lit(g).alias("section"), c.cast("string").alias("key")) for g, c in groups.items()])
    return df.select(F.explode(every).alias("s")).groupBy("s.section", "s.key").agg(F.count("*").alias("n"))


def speaks_of(text: Column, words: tuple[str, ...]) -> Column:
    """Whether a text contains one of the words, case ignored; a missing text doesn't."""
    low = F.lower(text)
    return F.coalesce(F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(low, w)), F.lit(False))


def write_if_any(df: DataFrame, path: str, kind: str = "csv") -> bool:
    """Writes unless df is empty."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").option("header", True).format(kind).save(path)
    return True


def remaining(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What an interrupted run still has to do."""
    return todo.join(done.select(key).distinct(), key, "left_anti")
