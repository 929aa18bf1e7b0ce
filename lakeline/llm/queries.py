"""Queries of the problems on text (2, 4, 7, 8, 9) over their whole tables, and SQL to hold them against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeline.llm import langid, lines, mix, neardup, tokens
from lakeline.session import materialise, table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "smiley_extract").select("report_id", "site", "text", "sections")
    return lines.flag_lines(docs, doc="report_id", source="site", text="text", parts="sections").select("report_id", "place", "line_no").distinct()


def p2_cleaned(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "smiley_extract").select("report_id", "site", "text", "sections")
    return lines.remove_lines(docs, doc="report_id", source="site", text="text", parts="sections")


_P2_KEY = r"""trim(regexp_replace(regexp_replace(lower({x}), '\p{{Nd}}+', '0', 'g'), '[\s\p{{Z}}\x{{85}}]+', ' ', 'g'), ' .,:;!?-–|*')"""
P2_SQL = f"""
with d as (select distinct report_id, site, text, sections from smiley_extract where site is not null),
t as (select distinct report_id, site, {_P2_KEY.format(x='l')} k from (select report_id, site, unnest(string_split(text, chr(10))) l from d where text is not null)),
h as (select site, k from t where k <> '' group by 1, 2
      having count(*) * 10 >= (select count(distinct report_id) from d where d.site = t.site and text is not null)),
p as (select report_id, site, 'text' place, text v from d where text is not null
      union all select report_id, site, e.key, e.value from (select report_id, site, unnest(map_entries(sections)) e from d)),
l as (select report_id, site, place, generate_subscripts(a, 1) - 1 line_no, unnest(a) l from (select *, string_split(v, chr(10)) a from p))
select distinct report_id, place, line_no from l join h on h.site = l.site and h.k = {_P2_KEY.format(x='l.l')}
"""


def p2_texts(spark: SparkSession, d: str) -> DataFrame:
    """``p2_cleaned`` with the sections as text."""
    pairs = F.transform(F.map_entries("sections"), lambda e: F.concat(e["key"], F.lit("\u0001"), F.coalesce(e["value"], F.lit("\u0003"))))
    return p2_cleaned(spark, d).select("report_id", "site", "text", F.array_join(pairs, "\u0002").alias("sections"))




def _p2_kept(v: str) -> str:
    return f"array_to_string(list_filter(string_split({v}, chr(10)), lambda l: not list_contains(ks, {_P2_KEY.format(x='l')})), chr(10))"


P2_TEXTS_SQL = f"""
with d as (select distinct report_id, site, text from smiley_extract where site is not null and text is not null),
t as (select distinct report_id, site, {_P2_KEY.format(x='l')} k from (select report_id, site, unnest(string_split(text, chr(10))) l from d)),
h as (select site, list(k) ks from (select site, k from t where k <> '' group by 1, 2 having count(*) * 10 >= (select count(distinct report_id) from d where d.site = t.site)) group by 1),
x as (select e.report_id, e.site, e.text, e.sections, coalesce(ks, []) ks from smiley_extract e left join h on h.site = e.site)
select report_id, site, case when text is not null then {_p2_kept('text')} end "text",
case when sections is not null then array_to_string(list_transform(map_entries(sections), lambda e: e.key || chr(1) || coalesce({_p2_kept('e.value')}, chr(3))), chr(2)) end sections from x
"""


def _articles(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "articles").select("id", "title", "summary")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return neardup.near_duplicates(_articles(spark, d))


def p4_groups(spark: SparkSession, d: str) -> DataFrame:
    return neardup.duplicate_groups(_articles(spark, d))


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_column(table(spark, d, "documents").select("doc_id", "text"), "text")


def p7_counts(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return tokens.count_tokens(docs, "text")


def _mixed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return table(spark, d, "documents").select("doc_id", "source", "text"), table(spark, d, "source_weights")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return mix.report(*_mixed(spark, d)).where("short").select("source")


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return mix.report(*_mixed(spark, d))


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    return mix.mix(*_mixed(spark, d))


def _identified(spark: SparkSession, d: str) -> DataFrame:
    return langid.identify(table(spark, d, "documents").select("doc_id", "text", "lang"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    found = langid.paragraph_languages(_identified(spark, d))
    named = langid.named_language(F.col("lang"))
    return found.where(named.isNull() | (named != F.col("para_lang"))).select("doc_id", "para_no", "para_lang")


def p9_segments(spark: SparkSession, d: str) -> DataFrame:
    return _identified(spark, d).select("doc_id", F.inline("segments"))


def p9_documents(spark: SparkSession, d: str) -> DataFrame:
    return langid.document_languages(_identified(spark, d))


QUERIES = {
    "p2_found": p2_found, "p2_cleaned": p2_cleaned, "p2_texts": p2_texts, "p4_found": p4_found, "p4_groups": p4_groups, "p7_ids": p7_ids, "p7_counts": p7_counts,
    "p8_found": p8_found, "p8_shares": p8_shares, "p8_mix": p8_mix, "p9_found": p9_found, "p9_segments": p9_segments, "p9_documents": p9_documents,
}
SQL = {"p2_found": P2_SQL, "p2_texts": P2_TEXTS_SQL}
