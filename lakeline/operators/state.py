"""Keyed state as folds over an append-only event log.

An event is (seq, pipeline, key, kind, status, sha256, path, error, meta, bump, updated_at); kind
'upsert' carries all columns, kind 'touch' sets status and time alone. The current state is one
aggregation by key: combined before the shuffle, so a hot key is no hot task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ("pipeline", "key")


def _latest(value: str, order: Column, when: Column) -> Column:
    """Value at the greatest order among rows where ``when`` holds; null values count."""
    return F.max(F.when(when, F.struct(order.alias("o"), F.col(value).alias("v"))))["v"]


def fold_items(events: DataFrame) -> DataFrame:
    """Current state of each key: status, time and error as last given, sha256, path and meta as last known, attempts as the sum of bumps.

    A touch leaves the error as it is. Order is (updated_at, seq).
    """
    order, upsert = F.struct("updated_at", "seq"), F.col("kind") == "upsert"
    known = {c: _latest(c, order, upsert & F.col(c).isNotNull()) for c in ("sha256", "path", "meta")}
    return events.groupBy(*KEY).agg(
        _latest("status", order, F.lit(True)).alias("status"), *[v.alias(c) for c, v in known.items()],
        _latest("error", order, upsert).alias("error"), F.sum(F.coalesce(F.col("bump").cast("long"), F.lit(0))).alias("attempts"), F.max("updated_at").alias("updated_at"),
    )


def merge_items(current: DataFrame, batch: DataFrame) -> DataFrame:
    """State after one more batch of events: a full join of the state with the folded batch."""
    new = fold_items(batch)
    touched_only = batch.groupBy(*KEY).agg(F.max((F.col("kind") == "upsert").cast("int")).alias("ups"))
    new = new.join(touched_only, list(KEY))
    c, n = current.alias("c"), new.alias("n")
    j = c.join(n, [F.col(f"c.{k}") == F.col(f"n.{k}") for k in KEY], "full")
    pick = lambda x: F.coalesce(F.col(f"n.{x}"), F.col(f"c.{x}"))
    return j.select(
        *[pick(k).alias(k) for k in KEY], pick("status").alias("status"), *[pick(x).alias(x) for x in ("sha256", "path", "meta")],
        F.when(F.col("n.ups") == 1, F.col("n.error")).otherwise(F.col("c.error")).alias("error"),
        (F.coalesce("c.attempts", F.lit(0)) + F.coalesce("n.attempts", F.lit(0))).alias("attempts"), F.greatest("c.updated_at", "n.updated_at").alias("updated_at"),
    )


def latest_items(log: DataFrame, *keys: str) -> DataFrame:
    """The newest row of each key by (updated_at, seq); of equal rows one."""
    keys = keys or KEY
    rest = [c for c in log.columns if c not in (*keys, "updated_at", "seq")]
    return log.groupBy(*keys).agg(F.max(F.struct("updated_at", "seq", *rest)).alias("w")).select(*keys, "w.*")


def progress(items: DataFrame) -> DataFrame:
    return items.groupBy("pipeline", "status").agg(F.count("*").alias("n"))


def progress_wide(items: DataFrame, statuses: tuple[str, ...] = ("done", "pending", "failed", "skipped")) -> DataFrame:
    """One row a pipeline, one column a status; the statuses are given, so nothing is scanned for them."""
    return items.groupBy("pipeline").agg(*[F.count_if(F.col("status") == s).alias(s) for s in statuses])


def pending(items: DataFrame, pipeline: str, limit: int | None = None) -> DataFrame:
    """Keys still to be worked on, in order of key; a limit of 0 or None is none."""
    todo = items.where((F.col("pipeline") == pipeline) & F.col("status").isin("pending", "failed"))
    return todo.orderBy("key").limit(limit) if limit else todo


def done_keys(items: DataFrame, pipeline: str) -> DataFrame:
    return items.where((F.col("pipeline") == pipeline) & (F.col("status") == "done")).select("key")


def todo(source: DataFrame, done: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """Rows of ``source`` whose key isn't done. Rows without key stay."""
    rest = source.join(done.select(F.col(done.columns[0]).alias(key)), key, "left_anti")
    return rest.orderBy(key).limit(limit) if limit else rest


def with_file(items: DataFrame) -> DataFrame:
    """Finished rows that have a stored file."""
    return items.where("path is not null and status = 'done'")


def parent_key(meta: Column, field: str = "navnelbnr") -> Column:
    """A field of a JSON text; null if the text is broken or lacks it."""
    return F.get_json_object(F.when(F.try_parse_json(meta).isNotNull(), meta), f"$.{field}")


def retry_status(attempts: Column, most: int = 3) -> Column:
    """Status after one more failure, ``attempts`` being those before it."""
    return F.when(attempts + 1 >= most, "skipped").otherwise("failed")


def outcome_status(code: Column, pdf: Column, network_error: Column) -> Column:
    """Network errors, 429 and 5xx may be tried again; other 4xx and what is no PDF may not."""
    return (
        F.when(network_error | code.isNull() | (code == 429) | code.between(500, 599), "failed")
        .when(code.between(400, 499) | ~F.coalesce(pdf, F.lit(False)), "skipped").otherwise("done")
    )


def page_outcome_status(code: Column) -> Column:
    """Of pages that list reports every error may be tried again."""
    return F.when(code.between(200, 399), "done").otherwise("failed")


def discovery_events(ids: DataFrame, known: DataFrame, pipeline: str, now: Column) -> DataFrame:
    """'pending' upserts for keys never seen; keys already known are left as they are."""
    new = ids.select("key", "meta").dropDuplicates(["key"]).join(known.where(F.col("pipeline") == pipeline).select("key"), "key", "left_anti")
    return new.select(F.lit(pipeline).alias("pipeline"), "key", F.lit("upsert").alias("kind"), F.lit("pending").alias("status"), "meta", F.lit(False).alias("bump"), now.cast("double").alias("updated_at"))
