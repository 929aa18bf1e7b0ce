"""Feed entries: identity, insertion of what is new, validators, and the state of the archive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeline.functions.text import first_given


def entry_key(entry_id: Column, link: Column, title: Column) -> Column:
    return first_given(entry_id, link, title)


def article_id(source: Column, key: Column) -> Column:
    return F.sha2(F.concat(source, F.lit("|"), key), 256)


def insert_new(archive: DataFrame, entries: DataFrame) -> DataFrame:
    """Rows to append: entries whose id the archive lacks, the first of each id (by seq). Their number is the count of new ones."""
    key = entry_key(F.col("entry_id"), F.col("link"), F.col("title"))
    rows = entries.withColumn("entry_id", key).withColumn("id", article_id(F.col("source"), key)).withColumn("published", F.coalesce("published", "updated"))
    cols = ["source", "entry_id", "title", "summary", "link", "published", "fetched_at"]
    first = rows.groupBy("id").agg(F.min(F.struct("seq", *cols)).alias("w")).select("id", "w.*").drop("seq")
    return first.join(archive.select("id"), "id", "left_anti").select("id", *cols)


def poll_log(entries: DataFrame, new: DataFrame, errors: DataFrame, ran_at: float) -> DataFrame:
    """(ran_at, source, entries, new, error), a row for each source polled: how many entries it gave, how many the archive lacked, or its error.

    entries and new: (source, ...); errors: (source, error) of polls that failed. Sources whose poll gave nothing must be in ``errors``, with null.
    """
    n = entries.groupBy("source").agg(F.count("*").alias("entries")).join(new.groupBy("source").agg(F.count("*").alias("new")), "source", "full")
    j = n.join(errors.groupBy("source").agg(F.max("error").alias("error")), "source", "full")
    return j.select(F.lit(float(ran_at)).alias("ran_at"), "source", F.coalesce("entries", F.lit(0)).alias("entries"), F.coalesce("new", F.lit(0)).alias("new"), "error")


def feed_state(events: DataFrame) -> DataFrame:
    """Last validators of each feed, of polls that gave at least one."""
    return events.where("etag is not null or modified is not null").groupBy("source").agg(F.max(F.struct("seq", "etag", "modified")).alias("w")).select("source", "w.etag", "w.modified")


def archive_stats(articles: DataFrame, polls: DataFrame | None, now: float) -> DataFrame:
    """One row: size, rows of the last day, sources, age of the oldest row and of the last poll in whole seconds."""
    a = articles.agg(
        F.count("*").alias("articles"), F.count_if(F.col("fetched_at") > F.lit(now) - 86400).alias("new_24h"),
        F.count_distinct("source").alias("sources"), (F.lit(now) - F.min("fetched_at")).cast("long").alias("archive_age_s"),
    )
    if polls is None:
        return a.withColumn("last_poll_ago_s", F.lit(None).cast("long"))
    return a.join(polls.agg((F.lit(now) - F.max("ran_at")).cast("long").alias("last_poll_ago_s")))


def topics_by_outlets(mentions: DataFrame, topic: str = "topic", source: str = "source") -> DataFrame:
    """Topics by the number of different outlets that carry them."""
    return mentions.groupBy(topic).agg(F.count_distinct(source).alias("outlets"), F.count("*").alias("n"))


def half_year_slices(df: DataFrame, month: Column) -> DataFrame:
    """Each row once for each of the six month slices (a slice is named by its last month) it falls into."""
    first = F.trunc(month, "month")
    return df.withColumn("slice_end", F.explode(F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: F.add_months(first, i))))
