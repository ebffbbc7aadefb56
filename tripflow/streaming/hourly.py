"""Live hourly counts over an event feed (extension)."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.functions.wallclock import from_wall_seconds, wall_seconds
from tripflow.session import child_folders, remove_folder


def read_feed(
    spark: SparkSession, path: str, schema: T.StructType | str, files_per_batch: int | None = None
) -> DataFrame:
    """A Parquet table as a stream, whether it is one file or a folder of files.

    The path is written as a glob that matches only itself, because the file
    source accepts a plain path only for a folder. Without a limit on files
    per batch all present files form one micro-batch, so the watermark cannot
    overtake rows that are merely listed late. With ``files_per_batch`` files are
    taken oldest first, state that the watermark has passed is dropped between the
    batches, and a backlog of any size is worked off in bounded pieces.
    """
    path = path.rstrip("/")
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def hourly_counts(
    events: DataFrame, time: str, keys: Sequence[str], lateness: str = "1 hour"
) -> DataFrame:
    """Events per wall-clock hour and key; state older than ``lateness`` is dropped.

    Watermarks need an instant, so the wall clock is read as seconds since the
    epoch and turned back after the window, whatever the session time zone.
    Works on streams and, for comparison, on batch frames.
    """
    instant = F.expr(f"timestamp_seconds({wall_seconds(time)})")
    timed = events.withColumn("_instant", instant).withWatermark("_instant", lateness)
    counted = timed.groupBy(F.window("_instant", "1 hour"), *keys).agg(
        F.count(F.lit(1)).alias("n_events")
    )
    start = from_wall_seconds("unix_seconds(window.start)")
    return counted.selectExpr(f"{start} AS hour_start", *keys, "n_events")


def run_hourly_counts(
    events: DataFrame,
    time: str,
    keys: Sequence[str],
    folder: str,
    lateness: str = "1 hour",
) -> DataFrame:
    """Drain what the stream has now and return the counts so far.

    Update mode: each micro-batch writes the counts it changed to its own
    ``epoch=N`` directory, replacing it if the batch is retried, and a reader
    takes the newest epoch of each hour and key. Calling it again with the
    same folder continues from the checkpoint. Rows later than the watermark
    are dropped and counted, see ``late_rows``: each batch notes the progress of
    the one before, as a query keeps its last hundred only.
    """
    spark = events.sparkSession
    counted = hourly_counts(events, time, keys, lateness)
    # A feed without any event yet still has a (empty) result to read.
    nothing = spark.createDataFrame([], counted.schema)
    nothing.write.mode("ignore").parquet(f"{folder}/counts/epoch=-1")

    late: dict[int, int] = {}  # by batch

    def note(progress) -> None:
        if progress is not None:
            late[progress["batchId"]] = sum(
                state["numRowsDroppedByWatermark"] for state in progress["stateOperators"]
            )

    def write_epoch(changed: DataFrame, epoch: int) -> None:
        for running in spark.streams.active:
            if running.name == name:
                note(running.lastProgress)
        changed.write.mode("overwrite").parquet(f"{folder}/counts/epoch={epoch}")

    name = f"hourly-{uuid.uuid4().hex}"
    query = (
        counted.writeStream.outputMode("update")
        .queryName(name)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .foreachBatch(write_epoch)
        .start()
    )
    query.awaitTermination()
    for progress in query.recentProgress:
        note(progress)
    spark.createDataFrame([(sum(late.values()),)], "rows long").write.mode("append").parquet(f"{folder}/late")
    return compacted(spark, folder, keys)


def late_rows(spark: SparkSession, folder: str) -> int:
    """Rows that all runs on this folder dropped as later than the watermark."""
    return spark.read.parquet(f"{folder}/late").agg(F.sum("rows")).first()[0]


def latest_counts(written: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of every hour and key the count of its newest epoch."""
    return written.groupBy("hour_start", *keys).agg(
        F.max_by("n_events", "epoch").alias("n_events")
    )


def compacted(spark: SparkSession, folder: str, keys: Sequence[str]) -> DataFrame:
    """The counts so far, kept with the last epoch; earlier epochs are removed.

    A folder so holds about one row per hour and key, however long the stream
    has run. A run that is cut short between adding and removing leaves both,
    which read the same.
    """
    root = f"{folder}/counts"
    written = spark.read.parquet(root)
    last = written.agg(F.max("epoch")).first()[0]
    if last is None:  # no event yet
        return latest_counts(written, keys)
    earlier = [name for name in child_folders(spark, root) if name != f"epoch={last}"]
    if earlier:
        # Added to the last epoch, where a count that is there already is equal.
        latest_counts(written, keys).write.mode("append").parquet(f"{root}/epoch={last}")
        for name in earlier:
            remove_folder(spark, f"{root}/{name}")
    return latest_counts(spark.read.schema(written.schema).parquet(root), keys)
