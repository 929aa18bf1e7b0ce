"""The log of delivered files: change flags and latest versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_change(log: DataFrame) -> DataFrame:
    """Deliveries, each once, with ``is_changed``: the content differs from the delivery before; the first always does."""
    w = Window.partitionBy("source", "kind").orderBy("fetched_at", "snap_id")
    return log.dropDuplicates(["snap_id"]).withColumn("is_changed", ~F.col("sha256").eqNullSafe(F.lag("sha256").over(w)) | (F.row_number().over(w) == 1))


def latest_version(log: DataFrame) -> DataFrame:
    """The newest content of each (source, kind)."""
    return log.groupBy("source", "kind").agg(F.max(F.struct("fetched_at", "snap_id", "sha256", "path")).alias("w")).select("source", "kind", "w.*")


def short_hash(c):
    return F.left(c, F.lit(12))


def snapshot_row(files: DataFrame, log: DataFrame, now: float, source: str, kind: str) -> DataFrame:
    """Log rows for newly fetched files (path, content, url) of one source: hash, size and change flag against the log."""
    last = latest_version(log).where((F.col("source") == source) & (F.col("kind") == kind)).agg(F.max("sha256").alias("last"))
    new = files.select(F.lit(source).alias("source"), F.lit(kind).alias("kind"), F.lit(now).alias("fetched_at"), "url", "path", F.sha2("content", 256).alias("sha256"), F.length("content").cast("long").alias("bytes"))
    return new.join(F.broadcast(last)).withColumn("changed", ~F.col("sha256").eqNullSafe(F.col("last"))).drop("last")
