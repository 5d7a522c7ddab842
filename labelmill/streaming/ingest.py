"""Streaming ingestion: label files and event logs as they arrive."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelmill.operators.upsert import upsert
from labelmill.session import materialize, shared_dir


def upsert_stream(stream: DataFrame, target: str, keys: list[str], order: str, checkpoint: str | None = None) -> None:
    """Takes what has arrived, upserts it by key into the Parquet table ``target`` and stops.

    Every batch writes the table into a new version folder and then logs it, so readers see the
    old or the new table, and a batch that is repeated after a failure gives the same result. One
    stream at a time may write a target.
    """
    spark = stream.sparkSession
    checkpoint = checkpoint or f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"

    def merge(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        now = current_table(session, target)
        version = f"{target}/v{time.time_ns():020d}-{batch_id}"
        upsert(batch.limit(0) if now is None else now, batch, keys, order).write.parquet(version)
        session.createDataFrame([(version,)], "version string").coalesce(1).write.mode("append").json(f"{target}/_versions_log")

    query = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def current_table(spark: SparkSession, target: str) -> DataFrame | None:
    """The newest version of a table written by :func:`upsert_stream`, or None."""
    jvm = spark.sparkContext._jvm
    log = jvm.org.apache.hadoop.fs.Path(f"{target}/_versions_log")
    if not log.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(log):
        return None
    last = spark.read.schema("version string").json(f"{target}/_versions_log").agg(F.max("version").alias("v")).first()["v"]
    return None if last is None else spark.read.parquet(last)


def event_windows(events: DataFrame, late: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """Events per window and type; on a stream rows later than ``late`` are left out of closed windows."""
    w = F.window("ts", window)
    return (
        events.withWatermark("ts", late)
        .groupBy(w, "event_type")
        .agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
        .select(F.col("window.start").alias("window_start"), "event_type", "n", "total")
    )


def _as_stream(rows: DataFrame) -> DataFrame:
    """A table written and read again file by file as a stream."""
    rows = materialize(rows)
    folder = rows.inputFiles()[0].rsplit("/", 1)[0]
    return rows.sparkSession.readStream.schema(rows.schema).option("maxFilesPerTrigger", 4).parquet(folder)


def window_table(stream: DataFrame, target: str, late: str = "10 minutes", window: str = "1 hour", checkpoint: str | None = None) -> DataFrame:
    """:func:`event_windows` of what has arrived, open windows included; every batch writes the whole result to a folder of its own.

    The state is one row per window and type. A batch that is repeated after a failure overwrites its own folder.
    """
    spark = stream.sparkSession
    checkpoint = checkpoint or f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/b{batch_id:09d}")

    windows = event_windows(stream, late, window)
    query = windows.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    written = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{target}/b*")
    found = written.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(written)
    last = max((f.getPath().toString() for f in found), default=None)
    return spark.createDataFrame([], windows.schema) if last is None else spark.read.schema(windows.schema).parquet(last)


def streamed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per hour and type, from the events as a stream."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))  # what a watermark takes
    out = window_table(_as_stream(events), f"{shared_dir(spark)}/windows-{uuid.uuid4().hex}")
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def streamed_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The medications table as a stream, upserted by label version."""
    target = f"{shared_dir(spark)}/labels-{uuid.uuid4().hex}"
    rows = spark.read.parquet(f"{sf_dir}/medications.parquet").where("set_id is not null and version_number is not null")
    upsert_stream(_as_stream(rows), target, ["set_id", "version_number"], "updated_at")
    return current_table(spark, target)
