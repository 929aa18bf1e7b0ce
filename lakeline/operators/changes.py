"""Processing only new or changed records, run by run (problem 3).

State is a table of (stream, key) -> greatest order seen and content hash, kept in numbered
versions below one folder. ``advance`` hashes the rows that arrived since, joins them with the
state, yields what is new or changed at each successful run, writes the next version beside the
old one and only then commits it: one atomic rename puts ``commits/<n>.json`` in place, if no one else
did. A failure before that leaves the old version in force, so a repeated call neither skips nor repeats
a record; of two callers that began at the same version one commits and the other gets ``Conflict``.
``vacuum`` removes old versions and what failed calls left.

Only rows that arrived after the oldest outstanding run before them and up to the last one due are read on: both bounds
are literals that reach the scan.

Several outstanding runs are settled by one call: rows are first reduced to one winner per key and
run, so that a hot key carries at most as many rows as there are runs into the join.

Edge cases: rows without arrival time, stream or key are never taken; a null order value sorts
below all others; null content equals null; equal (order) values are settled by the greater
content hash; repeated rows change nothing; empty tables give no rows.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeline.sources import fs


def content_hash(columns: list[str]) -> Column:
    """128-bit hash of columns as text; null differs from every text, and pieces can't run together."""
    pieces = []
    for c in columns:
        text = F.col(f"`{c}`").cast("string")
        pieces += [F.when(text.isNull(), "-").otherwise(F.concat(F.length(text).cast("string"), F.lit(":"), text))]
    return F.unhex(F.md5(F.concat_ws("|", *pieces)))


class Conflict(RuntimeError):
    """Another caller committed the version this one wanted to."""


@dataclass
class ChangeFeed:
    """Versioned key and content-hash state of one table, below ``root`` on shared storage."""

    spark: SparkSession
    root: str
    stream: str = "pipeline"
    key: str = "key"
    content: list[str] = field(default_factory=lambda: ["status", "sha256", "attempts"])
    order: list[str] = field(default_factory=lambda: ["updated_at", "seq"])
    arrival: str = "loaded_at"

    def _pointer(self) -> dict | None:
        names = fs.listing(self.spark, f"{self.root}/commits", ".json")
        return json.loads(fs.read_text(self.spark, f"{self.root}/commits/{names[-1]}")) if names else None

    def _commit(self, version: int, path: str) -> None:
        try:
            fs.write_text(self.spark, f"{self.root}/commits/{version:09d}.json", json.dumps({"version": version, "path": path}), False)
        except FileExistsError:
            fs.remove(self.spark, path)
            raise Conflict(f"version {version} of {self.root} was committed by another caller") from None

    def vacuum(self, keep: int = 1) -> int:
        """Remove all but the last ``keep`` committed versions, and data without a commit; returns how many. Not beside a running ``advance``."""
        commits = fs.listing(self.spark, f"{self.root}/commits", ".json")
        last = commits[max(0, len(commits) - max(1, keep)) :]
        held = {json.loads(fs.read_text(self.spark, f"{self.root}/commits/{n}"))["path"].rpartition("/")[2] for n in last}
        gone = [n for n in fs.listing(self.spark, self.root) if n != "commits" and n not in held]
        for n in gone:
            fs.remove(self.spark, f"{self.root}/{n}")
        for n in commits[: len(commits) - len(last)]:
            fs.remove(self.spark, f"{self.root}/commits/{n}")
        return len(gone)

    def state(self) -> DataFrame | None:
        """(stream, key, w) of the version in force; w = (order..., hash) of the key's winner."""
        at = self._pointer()
        return self.spark.read.parquet(f"{at['path']}/state").select("s", "k", "w") if at else None

    def settled(self) -> DataFrame | None:
        """(stream, upto): start of the last successful run that the state covers."""
        at = self._pointer()
        return self.spark.read.parquet(f"{at['path']}/settled") if at else None

    def changes(self, path: str) -> DataFrame:
        """What a version found new or changed; it stands beside the state it led to, in one table written once."""
        return self.spark.read.parquet(f"{path}/state").select(F.explode("hits").alias("run_id"), F.col("k").alias("item_key"), F.col("s").alias(self.stream))

    def advance(self, rows: DataFrame, runs: DataFrame) -> DataFrame:
        """Settle successful ``runs`` (stream, run_id, started_at); returns (run_id, key) new or changed.

        Runs the state already covers are ignored, so a call may be repeated. Commits before it returns.
        """
        s, k = self.stream, self.key
        at = self._pointer()
        runs = runs.select(F.col(s).alias("s"), "run_id", F.col("started_at").cast("double").alias("started_at")).where("s is not null and started_at is not null").distinct()
        if at:
            runs = runs.join(self.settled(), "s", "left").where("upto is null or started_at > upto").withColumn("upto", F.coalesce("upto", F.lit(float("-inf"))))
        else:
            runs = runs.withColumn("upto", F.lit(float("-inf")))
        span = runs.agg(F.min("upto").alias("low"), F.max("started_at").alias("high")).first()
        if span.high is None:  # nothing is due
            kinds = dict(runs.dtypes)["run_id"], dict(rows.dtypes)[k], dict(rows.dtypes)[s]
            return self.spark.createDataFrame([], f"run_id {kinds[0]}, item_key {kinds[1]}, `{s}` {kinds[2]}")
        since = F.col(f"`{self.arrival}`") <= span.high
        if span.low > float("-inf"):
            since &= F.col(f"`{self.arrival}`") > span.low
        plan = runs.groupBy("s").agg(F.array_sort(F.collect_list(F.struct("started_at", "run_id"))).alias("due"), F.max("upto").alias("upto"))

        arrived = rows.where(since).select(
            F.col(f"`{s}`").alias("s"), F.col(f"`{k}`").alias("k"), F.col(f"`{self.arrival}`").cast("double").alias("a"),
            F.struct(*[F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(self.order)], content_hash(self.content).alias("h")).alias("w"),
        ).where("s is not null and k is not null and a is not null")
        # The run log is small next to the items; Spark broadcasts it while it is below the size limit of the session, and else splits hot streams.
        due = arrived.join(plan, "s").where(F.col("a") > F.col("upto"))
        # First run that starts at or after the arrival, by binary search; rows after the last run wait for the next call.
        steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size("due") + 1)).cast("int") + 1)
        found = F.aggregate(
            steps, F.struct(F.lit(0).alias("lo"), F.size("due").alias("hi")),
            lambda x, _: F.when(x["lo"] >= x["hi"], x).otherwise(
                F.when(F.get("due", F.floor((x["lo"] + x["hi"]) / 2).cast("int"))["started_at"] < F.col("a"), F.struct((F.floor((x["lo"] + x["hi"]) / 2).cast("int") + 1).alias("lo"), x["hi"].alias("hi")))
                .otherwise(F.struct(x["lo"].alias("lo"), F.floor((x["lo"] + x["hi"]) / 2).cast("int").alias("hi")))
            ),
            lambda x: x["lo"],
        )
        per_run = (
            due.withColumn("n", found).where(F.col("n") < F.size("due"))
            .groupBy("s", "k", "n", F.get("due", F.col("n"))["run_id"].alias("run_id")).agg(F.max("w").alias("w"))
        )
        per_key = per_run.groupBy("s", "k").agg(F.array_sort(F.collect_list(F.struct("n", "run_id", "w"))).alias("steps"))
        run_type = dict(per_run.dtypes)["run_id"]
        if at:
            joined = per_key.join(self.state().withColumnRenamed("w", "old"), ["s", "k"], "full")
        else:
            joined = per_key.withColumn("old", F.expr(f"cast(null as {dict(per_run.dtypes)['w']})"))
        start = F.struct(F.col("old").alias("w"), F.expr(f"cast(array() as array<{run_type}>)").alias("hits"))

        def step(acc: Column, x: Column) -> Column:
            wins = acc["w"].isNull() | (x["w"] > acc["w"])
            differs = acc["w"].isNull() | (wins & (x["w"]["h"] != acc["w"]["h"]))
            return F.struct(
                F.when(wins, x["w"]).otherwise(acc["w"]).alias("w"),
                F.when(differs, F.concat(acc["hits"], F.array(x["run_id"]))).otherwise(acc["hits"]).alias("hits"),
            )

        folded = joined.withColumn("f", F.when(F.col("steps").isNull(), start).otherwise(F.aggregate("steps", start, step)))

        version = (at["version"] if at else 0) + 1
        path = f"{self.root}/v{version:06d}-{uuid.uuid4().hex[:8]}"
        folded.select("s", "k", F.col("f.w").alias("w"), F.col("f.hits").alias("hits")).write.parquet(f"{path}/state")
        upto = plan.select("s", F.element_at("due", -1)["started_at"].alias("upto"))
        if at:
            upto = upto.unionByName(self.settled()).groupBy("s").agg(F.max("upto").alias("upto"))
        upto.coalesce(1).write.parquet(f"{path}/settled")
        self._commit(version, path)
        return self.changes(path)


def successful(runs: DataFrame) -> DataFrame:
    """Runs that ended well."""
    return runs.where("ok and finished_at is not null").select("pipeline", "run_id", "started_at").distinct()
