"""Structured Streaming forms of the pipeline: file streams, dedupe across polls, stages that can be paused."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeline.functions import text
from lakeline.operators import control


def file_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int = 1000, glob: str | None = None) -> DataFrame:
    """New Parquet files of a landing folder; ``max_files`` bounds a micro-batch."""
    r = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    return (r.option("pathGlobFilter", glob) if glob else r).parquet(path)


def flagged(docs: DataFrame, body: str = "text") -> DataFrame:
    """Type, pest and enforcement flags of each document; the same expressions as in batch."""
    c = F.col(body)
    return docs.withColumns({"doc_type": text.doc_type(c), "has_pest": text.pest(c), **text.enforcement_flags(c)})


def first_seen(entries: DataFrame, key: str = "id", at: str | None = None, within: str | None = None) -> DataFrame:
    """One row a key over all polls. Without ``within`` the state keeps every key for good; with it, keys seen within that time."""
    if within:
        return entries.withWatermark(at, within).dropDuplicatesWithinWatermark([key])
    return entries.dropDuplicates([key])


def drain(df: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """Process what there is and stop; exactly once by the checkpoint and the file sink's log."""
    df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start().awaitTermination()


def watch(df: DataFrame, out: str, checkpoint: str, every: str = "15 seconds") -> StreamingQuery:
    """The same, again and again, until the query is stopped."""
    return df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()


def stage(df: DataFrame, work: Callable[[DataFrame, int, float], None], checkpoint: str, knob: str, control_path: str, once: bool = True, wait: bool = False, poll: float = 3.0) -> StreamingQuery:
    """A stage whose parallelism is read from the control document at each micro-batch.

    While the knob is 0 or everything is paused, a stage that may ``wait`` holds its batch and looks again every ``poll``
    seconds; another one fails over to the next start: nothing is marked as done, so the batch comes again with the same
    id. A torn document leaves the last good values in force.
    """
    reader = control.Reader(df.sparkSession, control_path)

    def batch(rows: DataFrame, number: int) -> None:
        limit = reader.wait(knob, poll) if wait else reader().effective(knob)
        if limit <= 0:
            raise PausedError(f"{knob} is paused")
        work(gated(rows, limit), number, limit)

    w = df.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime="15 seconds")).start()


def gated(rows: DataFrame, limit: float) -> DataFrame:
    """The rows in at most ``limit`` partitions, so that no more of them are worked on at once."""
    return rows.coalesce(max(1, int(limit)))


class PausedError(RuntimeError):
    """A stage did not take its batch because it is paused."""


def windowed_counts(events: DataFrame, at: str, size: str, late: str, *by: str) -> DataFrame:
    """Counts by window and key with rows up to ``late`` late; an addition of this engine."""
    return events.withWatermark(at, late).groupBy(F.window(at, size).alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *by, "n")


def running(spark: SparkSession, name: str) -> bool:
    """Whether a stream of that name is active in this session."""
    return any(q.name == name and q.isActive for q in spark.streams.active)


def stream_to_table(stream: DataFrame, name: str, shared: str, mode: str = "append") -> DataFrame:
    """Drain a stream into a folder below ``shared`` and read the result."""
    out = f"{shared}/{name}"
    drain(stream, f"{out}/rows", f"{out}/checkpoint", mode)
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{out}/rows")
