"""Lines repeated across one site's documents (problem 2).

Lines are normalised and hashed to 64 bits. Documents are counted per (source, hash): each row first
reduces its own lines to distinct hashes, rows of one document are merged (hashes alone travel, never
text), and counts are combined before the shuffle, so a hot line costs one row a task. Lines in at least
``share`` of a source's documents are kept; there can be at most (mean lines a document) / share of
them in a source, whatever its size. They come back as one array a source, joined to the documents,
which are flagged or rebuilt in one pass without exploding them.

Edge cases: rows without source or text count nowhere and lose no line, but of rows whose source is
known the parts are cleaned even if the text is null; a line that is empty after normalisation never
counts; null parts stay null, empty ones empty; a document stored twice counts once; empty tables give
no rows; a document id of null counts as one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeline.session import materialise

SHARE = 0.1
_MARKS = " .,:;!?-–|*"
#: White space but the blank and the line end.
_OTHER = "\t\u000b\f\r\u001c\u001d\u001e\u001f\u0085\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def line_key(line: Column) -> Column:
    """Lower case, digit runs as one digit, white space runs as one blank, edges without blanks and marks."""
    return F.btrim(_folded(line), F.lit(_MARKS))


def _folded(text: Column) -> Column:
    s = F.regexp_replace(F.lower(text), r"\p{Nd}+", "0")
    return F.regexp_replace(F.translate(s, _OTHER, " " * len(_OTHER)), " {2,}", " ")


def line_hashes(text: Column) -> Column:
    """One hash a line of ``text``, null for lines that are empty after normalisation. Linear in the length of the text."""
    keys = F.transform(F.split(_folded(text), "\n", -1), lambda x: F.btrim(x, F.lit(_MARKS)))
    return F.transform(keys, lambda x: F.when(x != "", F.xxhash64(x)))


def frequent_lines(docs: DataFrame, *, doc: str, source: str, text: str, share: float = SHARE) -> DataFrame:
    """(source, hot): sorted hashes of the lines that stand in at least ``share`` of the source's documents."""
    per_row = docs.where(F.col(source).isNotNull() & F.col(text).isNotNull()).select(
        F.col(source).alias("s"), F.col(doc).alias("d"), F.array_distinct(F.filter(line_hashes(F.col(text)), lambda x: x.isNotNull())).alias("h")
    )
    per_doc = per_row.groupBy("s", "d").agg(F.array_distinct(F.flatten(F.collect_list("h"))).alias("h"))
    # A null hash stands for the document itself: the size of a source comes from the same aggregation.
    counts = per_doc.select("s", F.explode(F.concat(F.array(F.lit(None).cast("long")), "h")).alias("h")).groupBy("s", "h").agg(F.count("*").alias("n"))
    total = counts.where("h is null").select("s", F.col("n").alias("of"))
    hot = counts.where("h is not null").join(total, "s").where(F.col("n") >= F.col("of") * F.lit(share) - 1e-9)
    # Written first, so that its size is known when it is joined: broadcast below the session's limit, else a join that splits hot sources.
    return materialise(hot.groupBy("s").agg(F.array_sort(F.collect_list("h")).alias("hot")).withColumnRenamed("s", source), "lines")


def flag_lines(docs: DataFrame, *, doc: str, source: str, text: str, parts: str | None = None, share: float = SHARE) -> DataFrame:
    """(doc, place, line_no): every frequent line of ``text`` and of the values of the map ``parts``."""
    hot = frequent_lines(docs, doc=doc, source=source, text=text, share=share)
    own = F.array(F.struct(F.lit("text").alias("place"), F.col(text).alias("v")))
    if parts:
        own = F.concat(own, F.coalesce(F.transform(F.map_entries(parts), lambda e: F.struct(e["key"].alias("place"), e["value"].alias("v"))), F.array().cast("array<struct<place:string,v:string>>")))
    places = docs.select(F.col(source), F.col(doc), F.explode(own).alias("p")).join(hot, source)
    at = F.transform(line_hashes(F.col("p.v")), lambda x, i: F.when(F.array_contains("hot", x), i.cast("long")))
    # Outer, then filtered: of a plain explode the optimizer would infer a filter on its size, and hash every line twice.
    return places.select(F.col(doc), F.col("p.place").alias("place"), F.explode_outer(F.filter(at, lambda i: i.isNotNull())).alias("line_no")).where("line_no is not null")


def remove_lines(docs: DataFrame, *, doc: str, source: str, text: str, parts: str | None = None, share: float = SHARE) -> DataFrame:
    """``docs`` with the frequent lines gone from ``text`` and ``parts``; all rows and columns stay."""
    name = "_hot"
    while name in docs.columns:
        name = "_" + name
    hot = frequent_lines(docs, doc=doc, source=source, text=text, share=share).withColumnRenamed("hot", name)

    def rebuilt(v: Column) -> Column:
        keep = F.filter(F.arrays_zip(F.split(v, "\n", -1).alias("line"), line_hashes(v).alias("h")), lambda z: ~F.coalesce(F.array_contains(name, z["h"]), F.lit(False)))
        return F.when(F.col(name).isNull(), v).otherwise(F.array_join(F.transform(keep, lambda z: z["line"]), "\n"))

    out = docs.join(hot, source, "left").withColumn(text, rebuilt(F.col(text)))
    if parts:
        out = out.withColumn(parts, F.transform_values(parts, lambda _, v: rebuilt(v)))
    return out.select(*docs.columns)
