"""Rankings with unique tie-breaks: top n of groups, keep ranks, counters, first and last rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, group: list[str], order: list[Column], n: int, name: str = "rank") -> DataFrame:
    """The first n rows of each group. Spark limits each partition's groups before the shuffle."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col(name) <= n)


def split_ranks(df: DataFrame, first: int, second: int, name: str = "rank") -> DataFrame:
    """Marks the first ranks as squad and the next as reserve."""
    return df.where(F.col(name) <= second).withColumn("part", F.when(F.col(name) <= first, "squad").otherwise("reserve"))


def later_rows(df: DataFrame, group: list[Column], order: list[Column]) -> DataFrame:
    """All but the row to keep of each group."""
    return df.withColumn("keep_rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where("keep_rank > 1")


def counted_ids(df: DataFrame, base: str, order: list[Column], name: str = "uid") -> DataFrame:
    """base, base_2, base_3, ... in order of appearance."""
    n = F.row_number().over(Window.partitionBy(base).orderBy(*order))
    return df.withColumn("_n", n).withColumn(name, F.when(F.col("_n") > 1, F.concat_ws("_", F.col(base), F.col("_n").cast("string"))).otherwise(F.col(base))).drop("_n")


def last_of(df: DataFrame, key: list[str], at: list[str], keep: list[str]) -> DataFrame:
    """The last state of each key in one aggregation with partial results."""
    best = F.max(F.struct(*at, *keep)).alias("_m")
    return df.groupBy(*key).agg(best).select(*key, *[F.col("_m")[c].alias(c) for c in [*at, *keep]])


def sample(df: DataFrame, key: str, n: int, seed: str = "42") -> DataFrame:
    """The same n rows whatever the partitioning: the first by a hash of key and seed. The limit is the feature."""
    return df.withColumn("_h", F.md5(F.concat(F.col(key).cast("string"), F.lit(seed)))).orderBy("_h", key).limit(n).drop("_h")
