"""Incremental ingest: file streams into aggregate states, each file once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fragmill.operators import warehouse
from fragmill.session import work_folder


def drained(stream: DataFrame, folder: str, write, mode: str = "append") -> None:
    """Runs a stream over what is there now; write(batch, number) is called once for each batch, again after a failure."""
    query = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()


def appended_states(stream: DataFrame, folder: str) -> DataFrame:
    """States of all that a stream of fragments has brought: each batch's own, written under its number, merged when read.

    A batch that is run again overwrites its own folder, so each row counts once.
    """

    def write(batch: DataFrame, number: int) -> None:
        warehouse.states(batch).write.mode("overwrite").parquet(f"{folder}/states/batch={number}")

    drained(stream, folder, write)
    return warehouse.merged(stream.sparkSession.read.parquet(f"{folder}/states"))


def compacted(spark: SparkSession, folder: str) -> str:
    """Merges all states into a new folder, whose path it returns; old ones stay for those who read them."""
    target = f"{folder}/compacted-{uuid.uuid4().hex}"
    warehouse.merged(spark.read.parquet(f"{folder}/states")).write.parquet(target)
    return target


def streamed_states(tables) -> DataFrame:
    """The big build's states, by a stream over files of its rows."""
    folder = work_folder(tables.spark)
    tables.big().write.parquet(f"{folder}/landing")
    landing = tables.spark.read.parquet(f"{folder}/landing")
    stream = tables.spark.readStream.schema(landing.schema).option("maxFilesPerTrigger", 64).parquet(f"{folder}/landing")
    return appended_states(stream, folder)


def counted_by_day(stream: DataFrame, folder: str, late: str) -> DataFrame:
    """(start, event_type, n) of a stream of (event_id, ts, event_type): events by day and kind.

    An event that comes twice within the bound on lateness counts once; days older
    than the bound are closed, so their state goes and what comes later is left out.
    Each batch writes the days that it changes, and the last batch's count is valid.
    """
    once = stream.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])
    counts = once.groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n"))

    def write(batch: DataFrame, number: int) -> None:
        batch.select(F.col("w.start").alias("start"), "event_type", "n").write.mode("overwrite").parquet(f"{folder}/days/batch={number}")

    drained(counts, folder, write, "update")
    days = stream.sparkSession.read.parquet(f"{folder}/days")
    return days.groupBy("start", "event_type").agg(F.max_by("n", "batch").alias("n"))


def streamed_requests(tables) -> DataFrame:
    """Requests by day and kind, by a stream over files of the events."""
    folder = work_folder(tables.spark)
    events = tables.raw("events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    events.write.parquet(f"{folder}/landing")
    stream = tables.spark.readStream.schema(events.schema).parquet(f"{folder}/landing")
    days = counted_by_day(stream, folder, "1 day")
    return days.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n")
