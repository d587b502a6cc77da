"""Live snapshots: the latest state of each key from a stream of files, replaced batch by batch, resumable."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.operators.ranking import last_of
from kinweave.sources.files import exists
from kinweave.storage import remove


def latest(df: DataFrame, key: str, at: list[str], keep: list[str]) -> DataFrame:
    return last_of(df, [key], at, keep)


def freshness(df: DataFrame, kind: str, at: str, now: str, ok_hours: int, stale_hours: int) -> DataFrame:
    """(kind, last_at, n, status): OK, STALE or FAILING by the age of a kind's last row at a given time."""
    hours = (F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp("last_at")) / 3600
    out = df.groupBy(kind).agg(F.max(at).alias("last_at"), F.count("*").alias("n"))
    return out.withColumn("status", F.when(hours <= ok_hours, "OK").when(hours <= stale_hours, "STALE").otherwise("FAILING"))


def replace_each_batch(spark: SparkSession, source: str, schema: str, key: str, at: list[str], keep: list[str], target: str, checkpoint: str, files_per_batch: int = 1) -> DataFrame:
    """Reads Parquet files as a stream until none is left and folds each batch into the state at target: the latest row of
    each key. A batch writes state n from state n - 1 by its id, so one that is run again after a failure gives the same."""

    def fold(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        rows = batch.select(key, *at, *keep)
        if number:
            rows = rows.unionByName(session.read.parquet(f"{target}/state={number - 1}").select(key, *at, *keep))
        latest(rows, key, at, keep).write.mode("overwrite").parquet(f"{target}/state={number}")
        if number > 1:  # the batch before may be run again, those before it never
            remove(session, f"{target}/state={number - 2}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    query = stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if not exists(spark, target):  # a stream without files
        return spark.createDataFrame([], schema).select(key, *at, *keep)
    last = spark.read.parquet(target).agg(F.max("state")).first()[0]
    return spark.read.parquet(f"{target}/state={last}")
