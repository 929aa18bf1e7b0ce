"""Landing folders: feeds, and the CSV, JSON and XML deliveries of registries; schemas are always given."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeline import schemas


def read_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """CSV with a header; rows that don't fit the schema keep what does and their text in ``_bad``."""
    wide = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    return spark.read.schema(wide).csv(path, header=True, sep=sep, mode="PERMISSIVE", columnNameOfCorruptRecord="_bad", enforceSchema=True)


def read_json(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    wide = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    return spark.read.schema(wide).json(path, mode="PERMISSIVE", columnNameOfCorruptRecord="_bad", multiLine=multi_line)


def read_xml(spark: SparkSession, path: str, row: str, schema: T.StructType) -> DataFrame:
    """One row an element ``row``; attributes are fields whose name begins with _."""
    return spark.read.format("xml").option("rowTag", row).schema(schema).load(path)


def read_feed(spark: SparkSession, path: str, fetched_at: float) -> DataFrame:
    """Entries (FEED_ENTRIES) of RSS files named <source>.<batch>.xml; ``seq`` follows file and place."""
    item = T.StructType.fromDDL("guid string, title string, description string, link string, pubDate string, updated string")
    df = spark.read.format("xml").option("rowTag", "item").schema(item).load(path)
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    out = df.select(
        F.regexp_extract(name, r"^([^.]+)", 1).alias("source"), F.col("guid").alias("entry_id"), "title", F.col("description").alias("summary"), "link", F.col("pubDate").alias("published"), "updated",
        F.lit(fetched_at).alias("fetched_at"), F.monotonically_increasing_id().alias("seq"),
    )
    return out.select(*schemas.FEED_ENTRIES.fieldNames())


#: content -> rows (page, idx, page_width, page_height, text, x0, y0, x1, y1, size, color, bold, baseline).
LineParser = Callable[[bytes], list[tuple]]


def page_lines(files: DataFrame, parser: LineParser) -> DataFrame:
    """PAGE_LINES of binary documents; documents that can't be parsed give no lines."""
    names = schemas.PAGE_LINES.fieldNames()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            out = []
            for path, content in zip(p["path"], p["content"]):
                try:
                    out += [(path.rsplit("/", 1)[-1].rsplit(".", 1)[0], *x) for x in parser(bytes(content))]
                except Exception:  # noqa: BLE001, S112 - one bad file must not end the job
                    continue
            yield pd.DataFrame(out, columns=names)

    return files.select("path", "content").mapInPandas(run, schemas.PAGE_LINES)


def variants(images: DataFrame, decode: Callable[[bytes], object], key: Callable[[object], str]) -> DataFrame:
    """(report_id, page, variant) of page backgrounds (report_id, page, width, content); only wide ones are decoded."""
    from lakeline.operators.template import backgrounds

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            yield pd.DataFrame({"report_id": p["report_id"], "page": p["page"], "variant": [key(decode(bytes(c))) for c in p["content"]]})

    return backgrounds(images).select("report_id", "page", "content").mapInPandas(run, "report_id string, page int, variant string")
