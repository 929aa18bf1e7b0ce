"""Parquet tables, part folders, dated snapshots, landing folders and folder sizes."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeline.functions import text as tx
from lakeline.session import materialise
from lakeline.sources import fs


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A file, folder or glob under a declared schema."""
    return spark.read.schema(schema).parquet(path)


def read_legacy_parts(spark: SparkSession, path: str, schema: T.StructType, key: str | None = None) -> DataFrame:
    """Parts whose columns were typed by chance (all null: int), which the vectorised reader refuses; one row a key if given.

    They are converted once, into a table of the declared schema in the shared folder, so that the
    reader's setting matters for nothing but this copy.
    """
    was = spark.conf.get("spark.sql.parquet.enableVectorizedReader")
    spark.conf.set("spark.sql.parquet.enableVectorizedReader", "false")
    try:
        df = spark.read.schema(schema).parquet(path)
        return materialise(df.dropDuplicates([key]) if key else df, "legacy")
    finally:
        spark.conf.set("spark.sql.parquet.enableVectorizedReader", was)


def append_part(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Add rows to a folder of parts; readers see all of them or none."""
    df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]).write.mode("append").parquet(path)


def write_snapshot(df: DataFrame, root: str, source: str, day: str) -> None:
    """One delivery below source=.../day=...; a repeated call replaces it."""
    df.write.mode("overwrite").parquet(f"{root}/source={source}/day={day}")


def read_snapshots(spark: SparkSession, root: str) -> DataFrame:
    """All deliveries; filters on source and day prune folders."""
    return spark.read.option("basePath", root).parquet(f"{root}/source=*/day=*")


def folder_size(spark: SparkSession, glob: str) -> DataFrame:
    """(files, bytes) by listing alone: contents are not read."""
    return spark.read.format("binaryFile").load(glob).agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def stored_ids(spark: SparkSession, glob: str) -> DataFrame:
    """(report_id, path) of stored files, by their names."""
    files = spark.read.format("binaryFile").load(glob).select("path")
    return files.select(F.regexp_extract("path", r"([^/]+?)(\.[^./]*)?$", 1).alias("report_id"), "path")


#: content -> (pages of text) of one document.
Parser = Callable[[bytes], list[str]]


def parse_documents(files: DataFrame, parser: Parser) -> DataFrame:
    """(report_id, text, n_pages, error) of binary files; a document that can't be parsed gives its error, not a failed job."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            out = []
            for path, content in zip(p["path"], p["content"]):
                name = path.rsplit("/", 1)[-1].rsplit(".", 1)[0]
                try:
                    pages = parser(bytes(content))
                    out.append((name, "\n".join(pages), len(pages), None))
                except Exception as e:  # noqa: BLE001 - one bad file must not end the job
                    out.append((name, None, None, f"{type(e).__name__}: {e}"[:200]))
            yield pd.DataFrame(out, columns=["report_id", "text", "n_pages", "error"]).astype({"n_pages": "Int64"})

    return files.select("path", "content").mapInPandas(run, "report_id string, text string, n_pages long, error string")


def extract(parsed: DataFrame, parents: DataFrame) -> DataFrame:
    """Reports as stored: type, sections of what is no placard, flags and counts of parsed documents (report_id, text, n_pages, error).

    parents: (report_id, navnelbnr). A document that could not be parsed has its error and nothing else.
    """
    c = F.col("text")
    kind = tx.doc_type(c)
    parts = F.when(kind == "report", tx.sections(c)).otherwise(F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))
    rows = parsed.join(parents.select("report_id", "navnelbnr").dropDuplicates(["report_id"]), "report_id", "left").withColumn("sections", F.when(c.isNotNull(), parts))
    good = lambda x: F.when(c.isNotNull(), x)
    return rows.select(
        "report_id", good(F.col("navnelbnr")).alias("navnelbnr"), good(kind).alias("doc_type"), good(F.col("n_pages")).alias("n_pages"), F.length(c).cast("long").alias("n_chars"),
        F.array_sort(F.map_keys("sections")).alias("control_points"), "sections", tx.pest(c).alias("has_pest"), *[v.alias(k) for k, v in tx.enforcement_flags(c).items()], "text", "error",
    )


def write_document(df: DataFrame, path: str) -> None:
    """The one row of ``df`` as a JSON document, replaced atomically."""
    row = df.select(F.to_json(F.struct("*")).alias("j")).first()
    fs.write_text(df.sparkSession, path, row.j if row else "{}")


def read_document(spark: SparkSession, path: str, last_good: dict | None = None) -> dict:
    """The document, or the last good one if it is missing, broken or no object."""
    try:
        got = json.loads(fs.read_text(spark, path) or "")
        return got if isinstance(got, dict) else (last_good or {})
    except ValueError:
        return last_good or {}


def register(spark: SparkSession, root: str, names: list[str]) -> None:
    """Tables of a folder as views, for spark.sql."""
    for n in names:
        spark.read.parquet(f"{root}/{n}.parquet").createOrReplaceTempView(n)
