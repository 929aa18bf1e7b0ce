"""Far too many small files: size-tiered incremental compaction with a journal (problem 6).

Level by level, files of similar size (a tier spans one factor of ``fan_in``) are merged, about
``fan_in`` at a time, until they reach the target size; copies of a key that meet in a merge are
reduced to the newest. The last, major merge distributes rows by key into files of the target size,
which makes every key stand exactly once. Groups follow from each file's name alone, so no list
of files is sorted, windowed or collected in one place.

Each merge is one transaction: its id follows from its inputs; inputs and outputs are recorded
beside its data as tables (there may be millions of names), and its journal entry is put in place by
one atomic rename after the data is complete. A call leaves out every file that an entry names as an
input, in favour of the outputs that no later entry took; data without an entry is written anew.
Nothing is merged twice, lost or doubled.

So a later call merges only the parts that came since, level by level. Its major merge rewrites, of
the files by key, those that share a hash bucket of keys with the new rows; the others stand. Only
when the total outgrows twice the number of buckets are all rewritten. Parts are taken to be
immutable: if one that was merged has other bytes, time or rows now, all is compacted anew. A part
that is gone since it was merged stays in the result.

Files of unfinished writes (``.tmp``) are never read. The newest copy of a key is the one with the
greatest (written_at, part_file, row_no); keys are compared trimmed; a null key is a key of its own;
a part that is missing from the list of parts counts as the oldest. Empty tables give empty outputs.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeline.session import materialise
from lakeline.sources import fs

_OWN = ("_k", "_at", "_file", "_row", "_unit", "_bytes", "_group")
_UNIT = "_unit string, _bytes long, _at double, _rows long"


@dataclass
class SizeTieredCompactor:
    """Compacts one set of part files into ``root`` on shared storage."""

    spark: SparkSession
    root: str
    fan_in: int = 64
    target_bytes: int = 128 << 20
    least_bytes: int = 1024

    def journal(self) -> list[dict]:
        """Committed transactions, oldest first."""
        found = [json.loads(fs.read_text(self.spark, f"{self.root}/journal/{n}")) for n in fs.listing(self.spark, f"{self.root}/journal", ".json")]
        return sorted(found, key=lambda x: x["level"])

    def _txn(self, gen: int, level: int, kind: str, rows: DataFrame, units: DataFrame, parts: int, by: list[str]) -> dict:
        """Merge ``units`` (files _unit, _bytes) of ``rows`` into ``parts`` files grouped by ``by``; once."""
        sign = units.agg(F.count("*").alias("n"), F.coalesce(F.sum("_bytes"), F.lit(0)).alias("b"), F.bit_xor(F.xxhash64("_unit", "_bytes")).alias("x")).first()
        txn = f"{level:03d}-{hashlib.sha256(repr((level, kind, parts, sign.n, sign.b, sign.x)).encode()).hexdigest()[:24]}"
        entry = f"{self.root}/journal/{txn}.json"
        if done := fs.read_text(self.spark, entry):
            return json.loads(done)
        at = f"{self.root}/data/{txn}"
        units.select("_unit", "_bytes", "_at", "_rows", _group(parts).alias("_group")).write.mode("overwrite").parquet(f"{at}/inputs")
        placed = rows.repartition(parts, *by)
        # Rows of one key within one group are in one partition already: this aggregation needs no further exchange.
        payload = [c for c in rows.columns if c not in _OWN and c not in by]
        newest = placed.groupBy(*dict.fromkeys([*by, "_k"])).agg(F.max_by(F.struct("_at", "_file", "_row", *payload), F.struct("_at", "_file", "_row")).alias("_w"))
        newest.select("_k", "_w.*").write.mode("overwrite").parquet(f"{at}/rows")
        out = self.spark.read.parquet(f"{at}/rows")
        buckets = F.collect_set(_bucket(parts)) if kind == "major" else F.lit(None).cast("array<int>")
        out.groupBy(F.col("_metadata.file_path").alias("_unit")).agg(F.max("_metadata.file_size").alias("_bytes"), F.count("*").alias("_rows"), buckets.alias("_buckets")).withColumn("txn", F.lit(txn)).write.mode("overwrite").parquet(f"{at}/outputs")
        done = {"txn": txn, "gen": gen, "level": level, "kind": kind, "parts": parts, "inputs": f"{at}/inputs", "outputs": f"{at}/outputs", "rows": f"{at}/rows", "files": sign.n}
        fs.write_text(self.spark, entry, json.dumps(done))
        return done

    def run(self, rows: DataFrame, parts: DataFrame, key: str) -> DataFrame:
        """Compacted rows: the columns of ``rows`` (part_file, row_no and the rest), one row a key.

        rows: part_file, row_no, ``key`` and any others; parts: part_file, written_at, n_bytes.
        """
        other = [c for c in rows.columns if c not in ("part_file", "row_no")]
        meta = parts.groupBy("part_file").agg(F.max("written_at").alias("_at"), F.max("n_bytes").alias("_bytes"))
        live = (
            rows.where(~F.coalesce(F.col("part_file").endswith(".tmp"), F.lit(False)))
            .select(F.trim(F.col(f"`{key}`")).alias("_k"), F.col("part_file").alias("_file"), F.col("row_no").alias("_row"), F.coalesce("part_file", F.lit("")).alias("_unit"), *[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(other)])
        )
        stored = rows.groupBy(F.coalesce("part_file", F.lit("")).alias("_unit")).agg(F.count("*").alias("_rows"))  # parts with rows that the list may lack
        listed = meta.where("part_file is not null").select(F.col("part_file").alias("_unit"), "_bytes", "_at")
        units = listed.join(stored, "_unit", "full").where(~F.col("_unit").endswith(".tmp")).select("_unit", F.coalesce("_bytes", F.lit(self.least_bytes)).cast("long").alias("_bytes"), F.col("_at").cast("double").alias("_at"), F.coalesce("_rows", F.lit(0)).alias("_rows"))
        units = materialise(units, "parts")  # a row a part; read by every step below
        log = self.journal()
        level, gen = max((x["level"] for x in log), default=0), max((x.get("gen", 0) for x in log), default=0) or 1
        log = [x for x in log if x.get("gen") == gen]
        if log and self._changed(units, self._used(log)):
            gen, log = gen + 1, []
        pending, base, majors = [(live, units)], None, [x for x in log if x["kind"] == "major"]
        if log:
            used = self._used(log)
            fresh = units.join(used, "_unit", "left_anti")
            pending = [(live, fresh)] if fresh.limit(1).count() else []
            tiers = self._standing([x for x in log if x["kind"] == "tier"], used)
            pending += [(tiers[0], _units(tiers[1]))] if tiers else []
            base = self._standing(majors, used)
            if majors and not pending:
                return self._result(base[0] if base else self._open(majors[-1])[0], other)
        while True:
            level += 1
            tier = F.greatest(F.lit(0), F.floor(F.log(F.greatest(F.lit(1.0), F.col("_bytes") / self.least_bytes)) / F.log(F.lit(float(self.fan_in))))).cast("int")
            sizes = [(r, u, u.withColumn("_tier", tier).where(F.col("_bytes") < self.target_bytes).groupBy("_tier").agg(F.count("*").alias("n"), F.sum("_bytes").alias("b")).orderBy("_tier").collect()) for r, u in pending]
            # The lowest tier of which there are more than fan_in files is merged next; what is left goes to the major merge.
            todo = next(((i, t["_tier"], t["n"]) for i, (_, _, s) in enumerate(sizes) for t in s if t["n"] > self.fan_in), None)
            if todo is None:
                break
            i, at, n = todo
            r, u = pending.pop(i)
            mine = (tier == at) & (F.col("_bytes") < self.target_bytes)
            inside, outside = u.where(mine), u.where(~mine)
            groups = -(-n // self.fan_in)
            chosen = _picked(r, inside).withColumn("_group", _group(groups))
            done = self._txn(gen, level, "tier", chosen, inside, groups, ["_group"])
            merged = self._open(done)
            if outside.limit(1).count():
                pending.append((r if "_at" not in r.columns else _picked(r, outside), outside))
            pending.append(merged)
        rows_, units_ = _picked(*pending[0]), pending[0][1]
        for r, u in pending[1:]:
            rows_, units_ = rows_.unionByName(_picked(r, u)), _units(units_).unionByName(_units(u))
        total = units_.agg(F.coalesce(F.sum("_bytes"), F.lit(0)).alias("b")).first().b
        if base:
            total += base[1].agg(F.coalesce(F.sum("_bytes"), F.lit(0)).alias("b")).first().b
        count = max(1, -(-int(total) // self.target_bytes))
        if base:
            old, files = base
            if count <= 2 * majors[-1]["parts"]:
                count = majors[-1]["parts"]
                hit = rows_.select(_bucket(count).alias("_b")).distinct()
                files = files.join(files.select("_unit", F.explode("_buckets").alias("_b")).join(hit, "_b", "left_semi"), "_unit", "left_semi")
                old = old.join(files.select("_unit"), "_unit", "left_semi")
            rows_, units_ = rows_.unionByName(old), _units(units_).unionByName(_units(files))
        final = self._txn(gen, level, "major", rows_, units_, count, ["_k"])
        out, _ = self._open(final)
        rest = self._standing(majors, self._used([*log, final])) if base else None
        return self._result(out.unionByName(rest[0]) if rest else out, other)

    def levels(self) -> DataFrame:
        """(level, kind, files_in, bytes_in, files_out, bytes_out) of each committed merge."""
        one = "level int, kind string, files_in long, bytes_in long, files_out long, bytes_out long"
        out = self.spark.createDataFrame([], one)
        for x in self.journal():  # a few merges a call
            total = lambda path, name: self.spark.read.parquet(path).agg(F.count("*").alias(f"files_{name}"), F.coalesce(F.sum("_bytes"), F.lit(0)).alias(f"bytes_{name}"))
            row = total(x["inputs"], "in").join(total(x["outputs"], "out")).select(F.lit(x["level"]).alias("level"), F.lit(x["kind"]).alias("kind"), "files_in", "bytes_in", "files_out", "bytes_out")
            out = out.unionByName(row)
        return out

    def vacuum(self) -> int:
        """Remove outputs that a later merge took, data of earlier generations and data without an entry; returns how many files or folders.

        Not beside a running call, nor before results that read those outputs have been written. The lists of inputs and outputs stay.
        """
        log = self.journal()
        gen = max((x.get("gen", 0) for x in log), default=0)
        now = [x for x in log if x.get("gen", 0) == gen]
        known, gone = {x["txn"] for x in log}, 0
        for n in fs.listing(self.spark, f"{self.root}/data"):
            if n not in known:
                fs.remove(self.spark, f"{self.root}/data/{n}")
                gone += 1
        for x in (x for x in log if x.get("gen", 0) != gen):
            gone += fs.remove(self.spark, x["rows"])
        if not now:
            return gone
        files = self.spark.read.parquet(*[x["outputs"] for x in now]).select("_unit", "txn")
        taken = files.join(self._used(now).select("_unit"), "_unit", "left_semi")
        left = {r.txn for r in files.join(taken.select("_unit"), "_unit", "left_anti").select("txn").distinct().collect()}  # at most one row a merge
        for x in now:
            if x["txn"] not in left:
                gone += fs.remove(self.spark, x["rows"])
        for r in taken.where(F.col("txn").isin(sorted(left))).select("_unit").toLocalIterator():  # files by key that a later major merge rewrote
            gone += fs.remove(self.spark, r["_unit"])
        return gone

    def _result(self, out: DataFrame, other: list[str]) -> DataFrame:
        return out.select(F.col("_file").alias("part_file"), F.col("_row").alias("row_no"), *[F.col(f"v{i}").alias(c) for i, c in enumerate(other)])

    def _used(self, log: list[dict]) -> DataFrame:
        """Files that transactions took as inputs."""
        return self.spark.read.schema(_UNIT).parquet(*[x["inputs"] for x in log])

    def _changed(self, units: DataFrame, used: DataFrame) -> bool:
        """Whether a part that was merged is another one now."""
        u, w = units.alias("u"), used.alias("w")
        same = [F.col(f"u.{c}").eqNullSafe(F.col(f"w.{c}")) for c in ("_bytes", "_at", "_rows")]
        return u.join(w, F.col("u._unit") == F.col("w._unit")).where(~(same[0] & same[1] & same[2])).limit(1).count() > 0

    def _standing(self, log: list[dict], used: DataFrame) -> tuple[DataFrame, DataFrame] | None:
        """Rows and files of those outputs that no transaction took; None where there are none."""
        if not log:
            return None
        schema = f"{_UNIT}, _buckets array<int>, txn string"
        files = self.spark.read.schema(schema).parquet(*[x["outputs"] for x in log]).join(used.select("_unit"), "_unit", "left_anti")
        held = {x.txn for x in files.select("txn").distinct().collect()}  # at most one row a transaction
        if not held:
            return None
        rows = self.spark.read.parquet(*[x["rows"] for x in log if x["txn"] in held]).withColumn("_unit", F.col("_metadata.file_path"))
        return rows.join(files.select("_unit"), "_unit", "left_semi"), files

    def _open(self, done: dict) -> tuple[DataFrame, DataFrame]:
        rows = self.spark.read.parquet(done["rows"])
        return rows.withColumn("_unit", F.col("_metadata.file_path")), _units(self.spark.read.parquet(done["outputs"]))


def _picked(rows: DataFrame, units: DataFrame) -> DataFrame:
    """The rows of some files. Rows of parts get the time of their part by the same join; those of outputs have it."""
    if "_at" in rows.columns:
        return rows.join(units.select("_unit"), "_unit", "left_semi")
    return rows.join(units.select("_unit", "_at"), "_unit")


def _units(files: DataFrame) -> DataFrame:
    """Files as units of a merge; outputs have no time of their own."""
    at = F.col("_at") if "_at" in files.columns else F.lit(None).cast("double")
    return files.select("_unit", "_bytes", at.alias("_at"), "_rows")


def _group(n: int):
    """Group of a file among ``n``: outputs of a merge in turn by their number, so that groups are even and the same in every run; parts by a hash of their name."""
    number = F.nullif(F.regexp_extract("_unit", r"/rows/part-(\d+)-", 1), F.lit("")).cast("long")
    return F.pmod(F.coalesce(number, F.xxhash64("_unit")), F.lit(n))


def _bucket(n: int):
    """Bucket of a row's key among ``n``; the same in every call."""
    return F.pmod(F.hash("_k"), F.lit(n))


def directory_parts(spark: SparkSession, path: str, schema) -> tuple[DataFrame, DataFrame]:
    """(rows, parts) of a folder of Parquet files, for ``SizeTieredCompactor.run``; file and row number come from the files themselves."""
    read = spark.read.schema(schema).parquet(path)
    rows = read.select("*", F.col("_metadata.file_path").alias("part_file"), F.col("_metadata.row_index").alias("row_no"))
    parts = read.select(F.col("_metadata.file_path").alias("part_file"), F.col("_metadata.file_modification_time").cast("double").alias("written_at"), F.col("_metadata.file_size").alias("n_bytes")).distinct()
    return rows, parts
