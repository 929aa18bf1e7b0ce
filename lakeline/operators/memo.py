"""Memo table of an expensive function of text: look up, call for distinct misses only, keep what came back."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeline.functions.text import memo_key

#: (texts) -> texts or None for what could not be done.
Provider = Callable[[list[str]], list[str | None]]


def merge(memo: DataFrame, pairs: DataFrame) -> DataFrame:
    """Put (k, da, en, seq) into memo: the first value of a key stays, each further one counts as a hit."""
    old = memo.select("k", "da", "en", F.col("hits"), F.lit(-1).cast("long").alias("seq"), F.lit(1).alias("have"))
    new = pairs.select("k", "da", "en", F.lit(0).cast("long").alias("hits"), F.col("seq").cast("long"), F.lit(0).alias("have"))
    g = old.unionByName(new).groupBy("k").agg(F.min(F.struct("seq", "da", "en")).alias("w"), (F.sum("hits") + F.count("*") - 1).alias("hits"))
    return g.select("k", "w.da", "w.en", "hits")


def lookup(keys: DataFrame, memo: DataFrame) -> DataFrame:
    """Distinct keys that the memo knows, with their value. Spark broadcasts the smaller side only below its limit."""
    return keys.select("k").distinct().join(memo.select("k", "en"), "k")


def stats(memo: DataFrame) -> DataFrame:
    return memo.agg(F.count("*").alias("lines"), F.coalesce(F.sum("hits"), F.lit(0)).alias("reuses"))


def call(df: DataFrame, provider: Provider, text: str, out: str, batch: int = 40) -> DataFrame:
    """Call the provider by batches; a batch that fails is halved and tried again, a single text that fails gives null."""
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in df.schema)}, `{out}` string"

    def attempt(texts: list[str]) -> list[str | None]:
        try:
            got = provider(texts)
            if len(got) == len(texts):
                return list(got)
        except Exception:  # noqa: BLE001 - whatever the provider raises, smaller batches may pass
            pass
        if len(texts) == 1:
            return [None]
        half = len(texts) // 2
        return attempt(texts[:half]) + attempt(texts[half:])

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            texts = p[text].tolist()
            got: list[str | None] = []
            for i in range(0, len(texts), batch):
                got += attempt(texts[i : i + batch])
            yield p.assign(**{out: pd.Series(got, index=p.index, dtype=object)})

    return df.mapInPandas(run, schema)


def call_again(df: DataFrame, provider: Provider, text: str, out: str, batch: int = 40) -> DataFrame:
    """``call``, and once more for the texts alone that came back without a value; what fails twice stays null."""

    def twice(texts: list[str]) -> list[str | None]:
        got = list(provider(texts))
        if len(got) != len(texts):
            raise ValueError("not as many answers as texts")
        left = [i for i, x in enumerate(got) if x is None]
        if left:
            try:
                again = list(provider([texts[i] for i in left]))
            except Exception:  # noqa: BLE001 - the first answers stand
                again = []
            for i, x in zip(left, again if len(again) == len(left) else []):
                got[i] = x
        return got

    return call(df, twice, text, out, batch)


def translate(lines: DataFrame, memo: DataFrame, provider: Provider, text: str = "text", batch: int = 40) -> tuple[DataFrame, DataFrame]:
    """(lines with ``en``, new pairs): from the memo, else fresh, else the text itself. The provider sees each missing key once, and once more if it gave none."""
    keyed = lines.withColumn("k", memo_key(F.col(text)))
    missing = keyed.where("k <> ''").groupBy("k").agg(F.min(text).alias("da")).join(memo.select("k"), "k", "left_anti")
    fresh = call_again(missing, provider, "da", "en", batch)
    pairs = fresh.where("en is not null")
    known = memo.select("k", F.col("en").alias("en1")).unionByName(pairs.select("k", F.col("en").alias("en1")))
    return keyed.join(known, "k", "left").withColumn("en", F.coalesce("en1", F.col(text))).drop("en1", "k"), pairs


def reply_by_id(requests: DataFrame, replies: DataFrame) -> DataFrame:
    """(id, text, en): answers by the id they echo; of several the last, foreign ids dropped, gaps keep the text."""
    last = replies.groupBy("id").agg(F.max_by("en", "pos").alias("en"))
    return requests.join(last, "id", "left").select("id", "text", F.coalesce("en", "text").alias("en"))


def page_counters(lines: DataFrame, memo: DataFrame, page: tuple[str, ...] = ("report_id", "page"), text: str = "text") -> DataFrame:
    """Per page: lines, distinct keys the memo lacks, and lines served without a call."""
    keyed = lines.withColumn("k", memo_key(F.col(text)))
    known = keyed.join(memo.select("k", F.lit(True).alias("hit")), "k", "left")
    g = known.groupBy(*page).agg(F.count("*").alias("n"), F.count_distinct(F.when(F.col("hit").isNull(), F.col("k"))).alias("misses"))
    return g.withColumn("hits", F.col("n") - F.col("misses"))


def report_texts(blocks: DataFrame) -> DataFrame:
    """(report_id, text_en): blocks in order, lines within a page and pages within a report joined by line ends."""
    pages = blocks.groupBy("report_id", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "en"))), lambda x: x["en"]), "\n").alias("t"))
    return pages.groupBy("report_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "t"))), lambda x: x["t"]), "\n\n").alias("text_en"))
