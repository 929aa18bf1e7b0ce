"""Queries of the engine's own operators over the whole tables, and the SQL they are held against.

Expressions that differ between dialects are kept to forms both understand; SQL follows the meaning,
not the plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeline.functions import text as tx
from lakeline.functions import urls
from lakeline.operators import control, findings, layout, memo, metrics, news, registry, snapshots, state, template
from lakeline.session import scratch, table
from lakeline.streaming import stream

NOW = 1_785_000_000.0  # "now" is a parameter of every query that needs it

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# --- reports: flags, sections, selection -----------------------------------------------------------

_PEST_SQL = r"""regexp_matches(' ' || lower(text) || ' ', '[^\p{L}\p{N}_](rotte[\p{L}\p{N}_]*|mus|mose[\p{L}\p{N}_]*|skadedyr[\p{L}\p{N}_]*|kakerlak[\p{L}\p{N}_]*|insekt[\p{L}\p{N}_]*|fluer|gnaver[\p{L}\p{N}_]*)[^\p{L}\p{N}_]')"""
_FLAGS_SQL = r"""
lower(text) like '%indskærp%' has_indskaerpelse, lower(text) like '%påbud%' has_paabud, lower(text) like '%forbud%' has_forbud,
regexp_matches(' ' || lower(text) || ' ', '[^\p{L}\p{N}_]bøde[^\p{L}\p{N}_]') has_boede, lower(text) like '%gebyr%' has_gebyr, lower(text) like '%politianmeld%' has_politianmeldelse,
regexp_matches(lower(text), '(autorisation|registrering)[\s\p{Z}]+[\p{L}\p{N}_]*[\s\p{Z}]*(frataget|inddrag)') has_autorisation_frataget"""


@query(f"select report_id, case when text like '%Scan: gå til%' or text like '%gå til https://findsmiley%' then 'placard' else 'report' end doc_type, {_PEST_SQL} has_pest, {_FLAGS_SQL} from smiley_extract where text is not null")
def report_flags(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "smiley_extract").select("report_id", "text").where("text is not null")
    return t.select("report_id", tx.doc_type(F.col("text")).alias("doc_type"), tx.pest(F.col("text")).alias("has_pest"), *[v.alias(k) for k, v in tx.enforcement_flags(F.col("text")).items()])


_HEADS = "|".join(h.replace(".", "[.]") for h in tx.CONTROL_POINTS)
_BLANK = r"[\s\p{Z}\x{85}\x{1c}-\x{1f}]+"


@query(f"""with t as (select row_number() over () n, report_id, doc_type, text from smiley_extract where text is not null),
p as (select n, generate_subscripts(a, 1) i, unnest(a) x from (select n, string_split(regexp_replace(text, '(({_HEADS})[\\s\\p{{Z}}]*:)', chr(1) || '\\1', 'g'), chr(1)) a from t where doc_type = 'report')),
o as (select n, i, s, list_filter([{", ".join(f"'{h}'" for h in tx.CONTROL_POINTS)}], lambda h: starts_with(s, h))[1] h from (select n, i, regexp_replace(regexp_replace(x, '^{_BLANK}', ''), '{_BLANK}$', '') s from p)),
m as (select n, h, min(i) i, string_agg(s, ' ' order by i) v from o where h is not null group by 1, 2),
s as (select n, list_sort(list(h)) control_points, '{{' || string_agg(to_json(h)::varchar || ':' || to_json(v)::varchar, ',' order by i) || '}}' sections from m group by 1)
select report_id, case when doc_type = 'report' then coalesce(control_points, []) end control_points, case when doc_type = 'report' then coalesce(sections, '{{}}') end sections from t left join s using (n)""".replace("\\\\", "\\"))
def report_sections(spark: SparkSession, d: str) -> DataFrame:
    """Sections of reports built from the text."""
    t = table(spark, d, "smiley_extract").where("text is not null").select("report_id", "text", F.when(F.col("doc_type") == "report", tx.sections(F.col("text"))).alias("sections"))
    return t.select("report_id", F.array_sort(F.map_keys("sections")).alias("control_points"), F.to_json("sections").alias("sections"))


_REMARKS = "doc_type = 'report' and (has_pest or has_indskaerpelse or has_paabud or has_forbud or has_gebyr or has_politianmeldelse or has_boede or text ilike '%konstateret%')"


@query(f"select report_id, navnelbnr from smiley_extract where {_REMARKS} and report_id not in (select trim(report_id) from smiley_analyze where report_id is not null and part_file not like '%.tmp')")
def remarks_todo(spark: SparkSession, d: str) -> DataFrame:
    done = table(spark, d, "smiley_analyze").where("report_id is not null and part_file not like '%.tmp'").select(F.trim("report_id").alias("report_id")).distinct()
    return state.todo(table(spark, d, "smiley_extract").where(findings.has_remarks()).select("report_id", "navnelbnr"), done, "report_id")


@query("select report_id, doc_type, length(text) n_chars, left(text, 6000) prompt from smiley_extract where doc_type = 'report' and navnelbnr is not null")
def report_prompts(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "smiley_extract").where("doc_type = 'report' and navnelbnr is not null")
    return t.select("report_id", "doc_type", F.length("text").cast("long").alias("n_chars"), findings.prompt_text(F.col("text")).alias("prompt"))


@query("select report_id, doc_type, length(text) n_chars, left(text, 6000) prompt from smiley_extract where doc_type = 'report'")
def report_prompts_all(spark: SparkSession, d: str) -> DataFrame:
    """Prompts of every report, as in the reference's analyze step; ``report_prompts`` has only those with a navnelbnr."""
    t = table(spark, d, "smiley_extract").where("doc_type = 'report'")
    return t.select("report_id", "doc_type", F.length("text").cast("long").alias("n_chars"), findings.prompt_text(F.col("text")).alias("prompt"))


@query("select report_id, control_points, list_sort(map_keys(sections)) section_keys, len(map_keys(sections)) n_sections from smiley_extract where sections is not null")
def section_keys(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "smiley_extract").where("sections is not null")
    return t.select("report_id", "control_points", F.array_sort(F.map_keys("sections")).alias("section_keys"), F.size("sections").cast("long").alias("n_sections"))


_RANK = "list_position(['none','guidance','injunction','order','ban','fine','police'], x.enforcement)"
_ACTUAL = "list_filter(coalesce(findings, []), lambda x: coalesce(x.is_actual_finding, false) and not coalesce(x.resolved, false))"


@query(f"""
select report_id, part_file, row_no, n n_findings_now, m n_actual_now, pest pest_now, ['none','guidance','injunction','order','ban','fine','police'][greatest(1, coalesce(r, 1))] enforcement_now,
       case when m = 0 then 'no_remarks' when r >= 5 then 'serious' when r in (3, 4) then 'remarks' else 'minor' end severity_now
from (select report_id, part_file, row_no, len(coalesce(findings, [])) n, len(a) m, len(list_filter(a, lambda x: x.category = 'pest')) > 0 pest,
             list_max(list_transform(a, lambda x: coalesce({_RANK}, 0))) r
      from (select *, {_ACTUAL} a from smiley_analyze))""")  # fmt: skip
def findings_severity(spark: SparkSession, d: str) -> DataFrame:
    t = findings.derive(table(spark, d, "smiley_analyze").select("report_id", "part_file", "row_no", "findings"))
    return t.select("report_id", "part_file", "row_no", F.col("n_findings").alias("n_findings_now"), F.col("n_actual_findings").alias("n_actual_now"), F.col("actual_pest").alias("pest_now"), F.col("max_enforcement").alias("enforcement_now"), F.col("severity").alias("severity_now"))


@query("select count(*) filter (doc_type = 'report') reports, count(*) filter (doc_type = 'placard') placards, coalesce(sum(has_pest::int), 0)::bigint pest, coalesce(sum(has_indskaerpelse::int), 0)::bigint injunctions, coalesce(sum(has_gebyr::int), 0)::bigint fees from smiley_extract")
def extract_stats(spark: SparkSession, d: str) -> DataFrame:
    return metrics.extract_stats(table(spark, d, "smiley_extract"))


@query("select coalesce(sum(actual_pest::int), 0)::bigint actual_pest, count(*) filter (severity = 'serious') serious, count(*) filter (severity = 'remarks') remarks, count(*) filter (max_enforcement in ('fine','police','ban')) enforced from smiley_analyze")
def analyze_stats(spark: SparkSession, d: str) -> DataFrame:
    return metrics.analyze_stats(table(spark, d, "smiley_analyze"))


@query(f"select count(*) to_analyze from smiley_extract where {_REMARKS}")
def to_analyze(spark: SparkSession, d: str) -> DataFrame:
    return metrics.to_analyze(table(spark, d, "smiley_extract"))


# --- items: state, queue, errors -------------------------------------------------------------------

_LATEST = "(select * exclude n from (select *, row_number() over (partition by pipeline, key order by updated_at desc, seq desc) n from (select distinct pipeline, key, updated_at, seq, status, sha256, path, attempts, error, meta from items)) where n = 1)"
# Rows of one seq may differ in loaded_at alone; the fold takes them as one.


def _items(spark: SparkSession, d: str) -> DataFrame:
    return state.latest_items(table(spark, d, "items").drop("loaded_at"))


@query(f"select pipeline, key, status, sha256, path, attempts, error, updated_at from {_LATEST}")
def latest_items(spark: SparkSession, d: str) -> DataFrame:
    return _items(spark, d).select("pipeline", "key", "status", "sha256", "path", "attempts", "error", "updated_at")


def _events(spark: SparkSession, d: str) -> DataFrame:
    """The log as events: pending rows bump nothing, finished ones of the report pipeline are touches."""
    t = table(spark, d, "items").drop("loaded_at").dropDuplicates(["seq"])
    kind = F.when((F.col("status") == "done") & (F.col("pipeline") != "smiley_report"), "touch").otherwise("upsert")
    return t.withColumn("kind", kind).withColumn("bump", F.col("status") == "failed")


_FOLD_SQL = """
with e as (select *, case when status = 'done' and pipeline <> 'smiley_report' then 'touch' else 'upsert' end kind from (select seq, any_value(pipeline) pipeline, any_value(key) "key", any_value(status) status,
           any_value(sha256) sha256, any_value(path) path, any_value(error) error, any_value(updated_at) updated_at from items group by seq))
select pipeline, "key", arg_max(status, row(updated_at, seq)) status, arg_max(sha256, row(updated_at, seq)) filter (kind = 'upsert') sha256, arg_max(path, row(updated_at, seq)) filter (kind = 'upsert') path,
       arg_max_null(error, row(updated_at, seq)) filter (kind = 'upsert') error, (count(*) filter (status = 'failed'))::bigint attempts, max(updated_at) updated_at
from e group by pipeline, "key"
"""


@query(_FOLD_SQL)
def item_fold(spark: SparkSession, d: str) -> DataFrame:
    return state.fold_items(_events(spark, d)).drop("meta")


@query(_FOLD_SQL)
def item_merge(spark: SparkSession, d: str) -> DataFrame:
    """The same state, by merging a second batch of events into that of a first."""
    e = _events(spark, d)
    cut = e.agg(F.percentile_approx("updated_at", 0.5).alias("m")).first().m
    return state.merge_items(state.fold_items(e.where(F.col("updated_at") < cut)), e.where(F.col("updated_at") >= cut)).drop("meta")


@query(f"select pipeline, status, count(*) n from {_LATEST} group by 1, 2")
def status_progress(spark: SparkSession, d: str) -> DataFrame:
    return state.progress(_items(spark, d))


@query(f"select pipeline, count(*) filter (status = 'done') done, count(*) filter (status = 'pending') pending, count(*) filter (status = 'failed') failed, count(*) filter (status = 'skipped') skipped from {_LATEST} group by 1")
def status_wide(spark: SparkSession, d: str) -> DataFrame:
    return state.progress_wide(_items(spark, d))


@query(f"select key, status, attempts from {_LATEST} where pipeline = 'smiley_report' and status in ('pending', 'failed')")
def pending_reports(spark: SparkSession, d: str) -> DataFrame:
    return state.pending(_items(spark, d), "smiley_report").select("key", "status", "attempts")


@query(f"""select key, case when json_valid(meta) then json_extract_string(meta, '$.navnelbnr') end navnelbnr, path from {_LATEST} r where pipeline = 'smiley_report' and status = 'done' and path is not null
and key not in (select key from {_LATEST} where pipeline = 'smiley_extract' and status = 'done')""")
def extract_todo(spark: SparkSession, d: str) -> DataFrame:
    i = _items(spark, d)
    rows = state.with_file(i.where("pipeline = 'smiley_report'")).select("key", state.parent_key(F.col("meta")).alias("navnelbnr"), "path")
    return state.todo(rows, state.done_keys(i, "smiley_extract"), "key")


@query(f"select pipeline, key, attempts, case when attempts + 1 >= 3 then 'skipped' else 'failed' end next_status from {_LATEST} where status = 'failed'")
def retry_budget(spark: SparkSession, d: str) -> DataFrame:
    return _items(spark, d).where("status = 'failed'").select("pipeline", "key", "attempts", state.retry_status(F.col("attempts")).alias("next_status"))


@query("""select case when regexp_matches(error, 'HTTP\\s*\\d{3}') then 'HTTP ' || regexp_extract(error, 'HTTP\\s*(\\d{3})', 1) when contains(error, 'not a PDF') then 'invalid id (HTML ''Fejl'' page)'
when contains(lower(error), 'timeout') or contains(error, 'timed out') then 'timeout' when contains(error, 'onnection') then 'connection error' when error = '' then 'unknown' else left(error, 40) end "key", count(*) "count"
from items where status in ('failed', 'skipped') and error is not null group by 1 order by 2 desc, 1 limit 10""")
def error_topk(spark: SparkSession, d: str) -> DataFrame:
    return metrics.top_errors(table(spark, d, "items"))


@query("""with h as (select *, avg((status in ('failed', 'skipped'))::int) over w r, count(*) over w n from (select seq, any_value(pipeline) pipeline, any_value(status) status from items group by seq)
window w as (partition by pipeline order by seq rows between 39 preceding and current row))
select seq, pipeline, r ratio, max((n >= 20 and r >= 0.5)::int) over (partition by pipeline order by seq rows unbounded preceding) = 1 is_open from h""")
def breaker_window(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "items").groupBy("seq").agg(F.min("pipeline").alias("pipeline"), F.min("status").alias("status"))
    return metrics.breaker(t, ["pipeline"], ["seq"], F.col("status").isin("failed", "skipped")).select("seq", "pipeline", "ratio", "is_open")


@query("select seq, count(distinct (pipeline, key, status)) n from items group by 1 having count(*) > 1")
def repeated_seq(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "items").groupBy("seq").agg(F.count_distinct("pipeline", "key", "status").alias("n"), F.count("*").alias("m")).where("m > 1").drop("m")


# --- snapshots -------------------------------------------------------------------------------------


@query("""select snap_id, source, kind, fetched_at, left(sha256, 12) sha12, sha256 is distinct from lag(sha256) over w or row_number() over w = 1 is_changed from (select distinct on (snap_id) * from snapshots)
window w as (partition by source, kind order by fetched_at, snap_id)""")
def snapshot_changes(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.with_change(table(spark, d, "snapshots")).select("snap_id", "source", "kind", "fetched_at", snapshots.short_hash(F.col("sha256")).alias("sha12"), "is_changed")


@query("select source, kind, max(fetched_at) fetched_at, arg_max(sha256, row(fetched_at, snap_id)) sha256 from snapshots group by 1, 2")
def latest_per_source(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.latest_version(table(spark, d, "snapshots")).select("source", "kind", "fetched_at", "sha256")


@query("select snap_id, regexp_extract(url, '([^/]+)$', 1) name, regexp_extract(url, '^https?://([^/]+)', 1) host from (select distinct snap_id, url from snapshots)")
def url_parts(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "snapshots").select("snap_id", "url").distinct()
    return t.select("snap_id", urls.basename(F.col("url")).alias("name"), F.try_parse_url("url", F.lit("HOST")).alias("host"))


@query("select source, kind, count(*) deliveries, count(*) filter (path is not null) stored from (select distinct snap_id, source, kind, path from snapshots) group by 1, 2")
def deliveries(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "snapshots").select("snap_id", "source", "kind", "path").distinct()
    return t.groupBy("source", "kind").agg(F.count("*").alias("deliveries"), F.count("path").alias("stored"))


# --- links, ids, paths -----------------------------------------------------------------------------


@query("select report_id, lpad(right(report_id, 3), 3, '0') shard, 'pdf/' || lpad(right(report_id, 3), 3, '0') || '/' || report_id || '.pdf' path from (select distinct report_id from smiley_extract)")
def report_paths(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "smiley_extract").select("report_id").distinct()
    return t.select("report_id", urls.shard(F.col("report_id")).alias("shard"), urls.sharded_path("pdf", F.col("report_id")).alias("path"))


@query("select distinct path, regexp_extract(path, '([^/]+)\\.[^./]*$', 1) stem from items where path is not null")
def path_stems(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "items").where("path is not null").select("path").distinct().select("path", urls.stem(F.col("path")).alias("stem"))


@query("""with p as (select source, '<a href="KontrolRapport.aspx?Virk' || (length(link) * 7919 % 100000) || '">x</a> <A HREF=''/files/' || source || '.XLSX''>y</A> <a class="z" href="https://x.example/a/smiley.xml?v=' || source || '">z</a>' html, link url from (select distinct source, link from articles where link is not null))
select url, html, list_sort(list_distinct(regexp_extract_all(html, '(?i)KontrolRapport\\.aspx\\?Virk(\\d+)', 1))) ids from p""")
def page_links(spark: SparkSession, d: str) -> DataFrame:
    return _pages(spark, d).select("url", "html", urls.report_ids(F.col("html")).alias("ids"))


def _pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages with links, one for each distinct article link."""
    t = table(spark, d, "articles").where("link is not null").select("source", "link").distinct()
    n = (F.length("link") * 7919 % 100000).cast("string")
    html = F.concat(F.lit('<a href="KontrolRapport.aspx?Virk'), n, F.lit("\">x</a> <A HREF='/files/"), "source", F.lit(".XLSX'>y</A> <a class=\"z\" href=\"https://x.example/a/smiley.xml?v="), "source", F.lit('">z</a>'))
    return t.select(F.col("link").alias("url"), html.alias("html"))


@query("""with p as (select distinct source, link from articles where link is not null)
select link url, 'xlsx' kind, min(regexp_extract(link, '^(https?://[^/?#]*)', 1) || '/files/' || source || '.XLSX') href from p group by 1 union all
select link, 'xml', min('https://x.example/a/smiley.xml?v=' || source) from p group by 1""")
def page_link_kinds(spark: SparkSession, d: str) -> DataFrame:
    return urls.download_links(_pages(spark, d)).groupBy("url", "kind").agg(F.min("href").alias("href"))


# --- memo ------------------------------------------------------------------------------------------

_KEY_SQL = r"trim(regexp_replace({x}, '[\s\p{{Z}}\x{{85}}\x{{1c}}-\x{{1f}}]+', ' ', 'g'))"


def _doc_lines(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "smiley_translate").select("report_id", "part_file", "row_no", "text_en")
    return t.select(F.concat_ws("/", "part_file", F.col("row_no").cast("string")).alias("doc"), F.posexplode(F.split("text_en", "\n", -1)).alias("line_no", "text"))


@query(f"""select k, count(*) n, count(*) - 1 reused from (select {_KEY_SQL.format(x='l')} k from (select unnest(string_split(text_en, chr(10))) l from smiley_translate where text_en is not null)) where k <> '' group by 1""")
def memo_keys(spark: SparkSession, d: str) -> DataFrame:
    return _doc_lines(spark, d).select(tx.memo_key(F.col("text")).alias("k")).where("k <> ''").groupBy("k").agg(F.count("*").alias("n"), (F.count("*") - 1).alias("reused"))


@query(f"""with l as (select part_file || '/' || row_no::varchar doc, generate_subscripts(a, 1) - 1 line_no, unnest(a) t from (select part_file, row_no, string_split(text_en, chr(10)) a from smiley_translate where text_en is not null)),
s as (select doc, line_no, {_KEY_SQL.format(x='t')} k, t from l)
select k, arg_min(t, row(doc, line_no)) da, upper(arg_min(t, row(doc, line_no))) en, count(*) - 1 hits from s where k <> '' group by 1""")
def memo_merge(spark: SparkSession, d: str) -> DataFrame:
    """Two batches of pairs merged one after the other: the first value of a key stays."""
    w = _doc_lines(spark, d).withColumn("k", tx.memo_key(F.col("text"))).where("k <> ''")
    seq = w.groupBy("k").agg(F.min(F.struct("doc", "line_no", "text")).alias("f"), F.count("*").alias("n"))
    pairs = seq.select("k", F.col("f.text").alias("da"), F.upper("f.text").alias("en"), F.lit(0).cast("long").alias("seq"))
    again = seq.where("n > 1").select("k", F.col("f.text").alias("da"), F.lit("later").alias("en"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("n") - 1)).alias("seq"))
    empty = spark.createDataFrame([], "k string, da string, en string, hits long")
    return memo.merge(memo.merge(empty, pairs), again)


@query(f"""with l as (select part_file, unnest(string_split(text_en, chr(10))) t from smiley_translate where text_en is not null), m as (select distinct {_KEY_SQL.format(x='summary_en')} k from smiley_analyze where summary_en is not null)
select part_file, count(*) n, count(distinct case when m.k is null then {_KEY_SQL.format(x='t')} end) misses, count(*) - count(distinct case when m.k is null then {_KEY_SQL.format(x='t')} end) hits from l left join m on m.k = {_KEY_SQL.format(x='l.t')} group by 1""")
def memo_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Lines of translated reports against summaries as the memo: what a part would ask for, and what it would not."""
    known = table(spark, d, "smiley_analyze").where("summary_en is not null").select(tx.memo_key(F.col("summary_en")).alias("k")).distinct()
    lines = table(spark, d, "smiley_translate").where("text_en is not null").select("part_file", F.explode(F.split("text_en", "\n", -1)).alias("text"))
    return memo.page_counters(lines, known, page=("part_file",))


def shout(texts: list[str]) -> list[str | None]:
    """A stand-in provider: upper case; texts of one word fail."""
    return [t.upper() if " " in t else None for t in texts]


@query(r"""select report_id, part_file, row_no, case when contains(trim(regexp_replace(summary_en, '[\s\p{Z}]+', ' ', 'g')), ' ') then upper(f) else summary_en end en from (select report_id, part_file, row_no, summary_en, min(summary_en) over (partition by trim(regexp_replace(summary_en, '[\s\p{Z}]+', ' ', 'g'))) f from smiley_analyze where summary_en is not null)""")
def memo_translate(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "smiley_analyze").where("summary_en is not null").select("report_id", "part_file", "row_no", "summary_en")
    empty = spark.createDataFrame([], "k string, da string, en string, hits long")
    return memo.translate(lines, empty, shout, text="summary_en")[0].select("report_id", "part_file", "row_no", "en")


# --- news ------------------------------------------------------------------------------------------


@query("select sha256(source || '|' || coalesce(nullif(entry_id, ''), nullif(link, ''), nullif(title, ''), '')) id, min(fetched_at) first_at, count(*) n from articles group by 1")
def article_ids(spark: SparkSession, d: str) -> DataFrame:
    k = news.entry_key(F.col("entry_id"), F.col("link"), F.col("title"))
    return table(spark, d, "articles").select(news.article_id(F.col("source"), k).alias("id"), "fetched_at").groupBy("id").agg(F.min("fetched_at").alias("first_at"), F.count("*").alias("n"))


@query("""with e as (select *, coalesce(nullif(entry_id, ''), nullif(link, ''), nullif(title, ''), '') k from articles where fetched_at >= 1770000000), x as (select sha256(source || '|' || k) id, source, k entry_id from e)
select distinct id, source, entry_id from x where id not in (select id from articles where fetched_at < 1770000000)""")
def feed_insert_new(spark: SparkSession, d: str) -> DataFrame:
    """Entries fetched from a given time on that the archive before it lacks."""
    a = table(spark, d, "articles")
    late = a.where("fetched_at >= 1770000000").withColumns({"updated": F.lit(None).cast("string"), "seq": F.xxhash64("id", "fetched_at", "title")})
    return news.insert_new(a.where("fetched_at < 1770000000"), late.drop("id")).select("id", "source", "entry_id")


@query(f"select count(*) articles, count(*) filter (fetched_at > {NOW} - 86400) new_24h, count(distinct source) sources, trunc({NOW} - min(fetched_at))::bigint archive_age_s, null::bigint last_poll_ago_s from articles")
def archive_stats(spark: SparkSession, d: str) -> DataFrame:
    return news.archive_stats(table(spark, d, "articles"), None, NOW)


@query("select w topic, count(distinct source) outlets, count(*) n from (select source, unnest(list_distinct(string_split(lower(title), ' '))) w from articles where title is not null and source is not null) where w <> '' group by 1")
def topics(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "articles").where("title is not null and source is not null").select("source", F.explode(F.array_distinct(F.split(F.lower("title"), " "))).alias("topic")).where("topic <> ''")
    return news.topics_by_outlets(a)


@query("select (date_trunc('month', o_orderdate) + to_months(i::int))::date slice_end, count(*) n from orders, range(0, 6) r(i) group by 1")
def half_year_slices(spark: SparkSession, d: str) -> DataFrame:
    return news.half_year_slices(table(spark, d, "orders"), F.to_date("o_orderdate")).groupBy("slice_end").agg(F.count("*").alias("n"))


@query("select source, kind, arg_max_null(url, row(fetched_at, snap_id)) etag from snapshots where url is not null group by 1, 2")
def validators(spark: SparkSession, d: str) -> DataFrame:
    """The last validator by feed (here: the address of each source and kind)."""
    t = table(spark, d, "snapshots").select(F.concat_ws("|", "source", "kind").alias("source"), F.struct("fetched_at", "snap_id").alias("seq"), F.col("url").alias("etag"), F.lit(None).cast("string").alias("modified"))
    f = news.feed_state(t)
    return f.select(F.split("source", r"\|")[0].alias("source"), F.split("source", r"\|")[1].alias("kind"), "etag")


# --- status over time ------------------------------------------------------------------------------


def _history(spark: SparkSession, d: str) -> DataFrame:
    """One sample a day and user from the event stream: cumulated counts."""
    e = table(spark, d, "events").groupBy("user_id", F.unix_date(F.to_date("ts")).alias("day")).agg(
        F.count("*").alias("n"), F.sum("value").alias("v"), *[F.count_if(F.col("event_type") == x).alias(x) for x in ("view", "click", "purchase")])
    w = Window.partitionBy("user_id").orderBy("day")
    c = lambda x: F.sum(x).over(w)
    return e.select("user_id", (F.col("day") * 86400.0).alias("t"), c("n").alias("reports_done"), c("n").alias("pdf_bytes"), c("view").alias("extracted"), c("click").alias("analyzed"), c("purchase").alias("overlay_done"))


@query("""with e as (select user_id, (epoch(date_trunc('day', ts)))::double t, count(*) n, count(*) filter (event_type = 'view') v from events group by 1, 2),
h as (select user_id, t, sum(n) over w r, sum(v) over w x from e window w as (partition by user_id order by t)),
g as (select *, first(t) over f t0, first(r) over f r0, first(x) over f x0 from h window f as (partition by user_id order by t rows between 9 preceding and current row))
select user_id, t, case when t > t0 then (r - r0)::double / (t - t0) * 1e6 else 0.0 end report_rate, case when t > t0 then (x - x0)::double / (t - t0) * 1e6 else 0.0 end extract_rate from g""")
def rate_window(spark: SparkSession, d: str) -> DataFrame:
    """Rates over the last 10 samples of each user, per million seconds and not rounded."""
    h = _history(spark, d)
    w = Window.partitionBy("user_id").orderBy("t").rowsBetween(-9, 0)
    dt = F.col("t") - F.first("t").over(w)
    rate = lambda c: F.when(dt > 0, (F.col(c) - F.first(c).over(w)) / dt * 1e6).otherwise(0.0)
    return h.select("user_id", "t", rate("reports_done").alias("report_rate"), rate("extracted").alias("extract_rate"))


@query("""with e as (select user_id, (epoch(date_trunc('day', ts)))::double t, count(*) n from events group by 1, 2), h as (select user_id, t, sum(n) over (partition by user_id order by t) r from e),
g as (select *, first(t) over f t0, first(r) over f r0 from h window f as (partition by user_id order by t rows between 89 preceding and current row))
select user_id, t, r::bigint reports_done, case when t > t0 then round_even((r - r0)::double / (t - t0), 2) else 0.0 end report_rate_per_s from g""")
def rates(spark: SparkSession, d: str) -> DataFrame:
    return metrics.rates(_history(spark, d), ["user_id"]).select("user_id", "t", "reports_done", "report_rate_per_s")


@query(f"""with q as (select pipeline, count(*) filter (status = 'done') done, count(*) filter (status = 'pending') pending, count(*) filter (status = 'failed') failed, count(*) filter (status = 'skipped') skipped from {_LATEST} group by 1),
p as (select *, (done + pending + failed + skipped)::double / nullif(done, 0) per from q)
select pipeline, (pending + failed + greatest(0, 1000000 - done) * (1 + coalesce(per, 0)))::double requests, (done + pending + failed + round_even(coalesce(per, 0) * greatest(0, 1000000 - done), 0))::bigint final_reports from p""")
def projection(spark: SparkSession, d: str) -> DataFrame:
    s = state.progress_wide(_items(spark, d))
    c = F.col
    left, final = metrics.remaining_work(c("done"), c("pending"), c("failed"), c("skipped"), c("done"), F.lit(0), F.lit(1_000_000))
    return s.select("pipeline", left.alias("requests"), final.alias("final_reports"))


@query(f"""with q as (select pipeline, count(*) filter (status = 'done') done, count(*) filter (status = 'pending') pending, count(*) filter (status = 'failed') failed, count(*) filter (status = 'skipped') skipped from {_LATEST} group by 1),
p as (select *, coalesce((done + pending + failed + skipped)::double / nullif(done, 0), 0.0) per, 2 * done + failed unseen from q),
r as (select *, (done + pending + failed + round_even(per * unseen, 0))::bigint est, pending + failed + unseen * (1 + per) left_ from p),
e as (select *, case when left_ > 0 then greatest(trunc(left_ / 2.6::double)::bigint, 0) end eta, case when est > done then greatest(trunc((est - done) / 40.0::double)::bigint, 0) end x,
      round_even(coalesce((done // 2)::double / nullif(done, 0), 0.0) * est, 0)::bigint - done // 4 a from r)
select pipeline, est est_total_reports, eta eta_seconds, case when x is not null then greatest(x, coalesce(eta, 0)) end extract_eta_seconds,
case when a > 0 then greatest(trunc(a / 4.0::double)::bigint, coalesce(eta, 0)) end analyze_eta_seconds, null::bigint overlay_eta_seconds from e""")
def stage_etas(spark: SparkSession, d: str) -> DataFrame:
    s = state.progress_wide(_items(spark, d)).withColumns({
        "b_done": F.col("done"), "b_failed": F.col("failed"), "b_total": F.col("done") * 3, "extracted": F.col("done"), "to_analyze": F.floor(F.col("done") / 2), "analyzed": F.floor(F.col("done") / 4),
        "to_overlay": F.floor(F.col("done") / 3), "o_done": F.floor(F.col("done") / 6), "o_skipped": F.lit(1), "report_rate_per_s": F.lit(2.6), "extract_rate_per_s": F.lit(40.0), "analyze_rate_per_s": F.lit(4.0), "overlay_rate_per_s": F.lit(0.0),
    })
    return metrics.projections(s).select("pipeline", "est_total_reports", "eta_seconds", "extract_eta_seconds", "analyze_eta_seconds", "overlay_eta_seconds")


@query()
def status_document(spark: SparkSession, d: str) -> DataFrame:
    m = spark.createDataFrame([], "k string, da string, en string, hits long")
    return metrics.status_document(_items(spark, d), table(spark, d, "smiley_extract"), table(spark, d, "smiley_analyze"), m, 58616, 0, NOW).select(F.to_json(F.struct("*")).alias("status"))


@query("select run_id, pipeline, coalesce(ok and finished_at is not null, false) up, coalesce(finished_at - started_at, 0.0) took from (select distinct run_id, pipeline, started_at, finished_at, ok from runs)")
def run_log(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "runs").select("run_id", "pipeline", "started_at", "finished_at", "ok").distinct()
    return r.select("run_id", "pipeline", F.coalesce(F.col("ok") & F.col("finished_at").isNotNull(), F.lit(False)).alias("up"), F.coalesce(F.col("finished_at") - F.col("started_at"), F.lit(0.0)).alias("took"))


@query("""select part_file, dataset, n_bytes, case when n_bytes = 0 then '0 B' when n_bytes < 1024 then printf('%.1f B', n_bytes::double) when n_bytes < 1048576 then printf('%.1f KB', n_bytes / 1024.0) else printf('%.1f MB', n_bytes / 1048576.0) end size from part_files""")
def part_sizes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part_files").select("part_file", "dataset", "n_bytes", tx.bytes_text(F.col("n_bytes")).alias("size"))


# --- layout and pixels over stand-in tables --------------------------------------------------------


@query("""with s as (select *, case when event_type is not distinct from lag(event_type) over w then 0 else 1 end b from events window w as (partition by user_id order by ts, event_id)),
g as (select *, sum(b) over (partition by user_id order by ts, event_id) - 1 run from s)
select user_id, run::bigint run, min(event_type) event_type, count(*) n, string_agg(event_id::varchar, ' ' order by ts, event_id) ids from g group by 1, 2""")
def islands(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    runs = layout.islands(e, ["user_id"], ["ts", "event_id"], F.col("event_type") == F.lag("event_type").over(w), "run")
    ids = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ts", "event_id"))), lambda x: x["event_id"].cast("string")), " ")
    return runs.groupBy("user_id", "run").agg(F.min("event_type").alias("event_type"), F.count("*").alias("n"), ids.alias("ids"))


@query("""with g as (select *, epoch(ts - lag(ts) over (partition by user_id order by ts, event_id)) s from events)
select user_id, coalesce(list_sort(list(s) filter (s is not null))[(count(s) // 2 + 1)::int], 0.0) pitch, count(*) n_lines from g group by 1""")
def upper_median_step(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", F.struct("ts", "event_id").alias("idx"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("baseline"))
    return layout.pitch_table(e, ["user_id"]).select("user_id", F.round("pitch", 6).alias("pitch"), "n_lines")


@query("""with l as (select distinct l_orderkey o, l_linenumber n, l_quantity x0, l_quantity + 10 x1, l_extendedprice / 100 y0, l_extendedprice / 100 + 5 y1 from lineitem),
b as (select o, n, min(x0) x0, max(x1) x1, min(y0) y0, max(y1) y1 from l group by 1, 2)
select b.o report_id, b.n block, least(1000.0, min(l.y0 - 2)) bottom from b left join l on l.o = b.o and l.n <> b.n and l.y0 >= b.y1 - 1 and least(b.x1, l.x1) - greatest(b.x0, l.x0) > 1 group by 1, 2""")
def room_limit(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("report_id"), F.lit(0).alias("page"), F.col("l_linenumber").alias("block"), F.col("l_quantity").alias("x0"), (F.col("l_quantity") + 10).alias("x1"), (F.col("l_extendedprice") / 100).alias("y0"), (F.col("l_extendedprice") / 100 + 5).alias("y1")).distinct()
    blocks = li.groupBy("report_id", "page", "block").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.min("y0").alias("y0"), F.max("y1").alias("y1")).withColumn("page_height", F.lit(1020.0))
    return layout.room_limit(blocks, li).select("report_id", "block", "bottom")


def _pixels(spark: SparkSession, d: str) -> DataFrame:
    """Each vector as a row of pixels: three neighbouring components are a colour."""
    e = table(spark, d, "embeddings").select("vec_id", F.expr("transform(embedding, x -> cast(least(255, greatest(0, floor((x + 1) * 128))) as int))").alias("v"))
    px = F.transform(F.sequence(F.lit(0), F.floor(F.size("v") / 3).cast("int") - 1), lambda i: F.struct(i.alias("x"), F.get("v", i * 3).alias("r"), F.get("v", i * 3 + 1).alias("g"), F.get("v", i * 3 + 2).alias("b")))
    return e.select(F.col("vec_id").alias("box"), F.inline(px)).withColumn("y", F.lit(0))


_PIXELS_SQL = """px as (select vec_id box, i x, least(255, greatest(0, floor((embedding[i * 3 + 1]::double + 1) * 128)))::int r, least(255, greatest(0, floor((embedding[i * 3 + 2]::double + 1) * 128)))::int g, least(255, greatest(0, floor((embedding[i * 3 + 3]::double + 1) * 128)))::int b
from (select vec_id, embedding, unnest(range(0, len(embedding) // 3)) i from embeddings))"""


@query(f"""with {_PIXELS_SQL}, q as (select box, r // 8 * 8 fr, g // 8 * 8 fg, b // 8 * 8 fb, count(*) n from px group by all) select box, fr::int fr, fg::int fg, fb::int fb from (select *, row_number() over (partition by box order by n desc, fr, fg, fb) k from q) where k = 1""")
def colour_mode(spark: SparkSession, d: str) -> DataFrame:
    return template.fills(_pixels(spark, d))


@query(f"""with {_PIXELS_SQL}, q as (select box, r // 8 * 8 fr, g // 8 * 8 fg, b // 8 * 8 fb, count(*) n from px group by all), f as (select * from (select *, row_number() over (partition by box order by n desc, fr, fg, fb) k from q) where k = 1),
e as (select px.*, abs(r - fr) + abs(g - fg) + abs(b - fb) d from px join f using (box)) select box, r tr, g tg, b tb from (select *, row_number() over (partition by box order by d desc, x) k from e) where k = 1""")
def colour_ink(spark: SparkSession, d: str) -> DataFrame:
    p = _pixels(spark, d)
    return template.inks(p, template.fills(p))


@query(f"""with {_PIXELS_SQL}, fl as (select box, fr, fg, fb from (select *, row_number() over (partition by box order by n desc, fr, fg, fb) k from (select box, r // 8 * 8 fr, g // 8 * 8 fg, b // 8 * 8 fb, count(*) n from px group by all)) where k = 1),
ds as (select px.*, abs(r - fr) + abs(g - fg) + abs(b - fb) d from px join fl using (box)), nk as (select box, r tr, g tg, b tb from (select *, row_number() over (partition by box order by d desc, x) k from ds) where k = 1),
c as (select box, avg((d > 90)::int) cov from ds group by 1), w as (select box, min(x) x0, max(x) x1, min(x) filter (d > 90) lo, max(x) filter (d > 90) hi from ds group by 1),
j as (select *, lo is not null and cov > 0.02 and cov < 0.65 ok from w join c using (box))
select box, case when ok then greatest(x0, lo - 1) else x0 end::int x0, 0::int y0, case when ok then least(x1, hi + 1) + 1 else x1 + 1 end::int x1, 1::int y1, bold from j join
(select ds.box, avg((abs(r - tr) + abs(g - tg) + abs(b - tb) < d)::int) > 0.295 bold from ds join nk using (box) group by 1) using (box)""")
def pixel_boxes(spark: SparkSession, d: str) -> DataFrame:
    p = _pixels(spark, d)
    f = template.fills(p)
    return template.tight_boxes(p, f).join(template.is_bold(p, f, template.inks(p, f)), "box")


# --- registry, places ------------------------------------------------------------------------------


@query("""select o_orderkey, c_name, n_name, r_name from orders left join customer on c_custkey = o_custkey left join nation on n_nationkey = c_nationkey left join region on r_regionkey = n_regionkey""")
def star_join(spark: SparkSession, d: str) -> DataFrame:
    t = lambda n: table(spark, d, n)
    dims = [(t("customer").select("c_custkey", "c_name", "c_nationkey"), "o_custkey", "c_custkey"), (t("nation").select("n_nationkey", "n_name", "n_regionkey"), "c_nationkey", "n_nationkey"), (t("region").select("r_regionkey", "r_name"), "n_regionkey", "r_regionkey")]
    return registry.star(t("orders").select("o_orderkey", "o_custkey"), dims).select("o_orderkey", "c_name", "n_name", "r_name")


@query(r"""with b as (select distinct nullif(trim(regexp_replace(navnelbnr, '[\s\p{Z}]+', ' ', 'g')), '') navnelbnr, nullif(trim(regexp_replace(branche, '[\s\p{Z}]+', ' ', 'g')), '') branche from business_index),
s as (select distinct navnelbnr from smiley_extract where navnelbnr is not null)
select navnelbnr, branche from b where branche in (select branche from b where navnelbnr in (select * from s)) and navnelbnr not in (select * from s)""")
def no_report_yet(spark: SparkSession, d: str) -> DataFrame:
    from lakeline.operators.diff import clean_text

    b = table(spark, d, "business_index").select(clean_text(F.col("navnelbnr")).alias("navnelbnr"), clean_text(F.col("branche")).alias("branche")).where("navnelbnr is not null").distinct()
    return registry.without_report(b, table(spark, d, "smiley_extract"), "navnelbnr", "branche").select("navnelbnr", "branche")


@query(r"""with a as (select lower(trim(regexp_replace(adresse1, '[\s\p{Z}]+', ' ', 'g'))) s, trim(postnr) p, geo_lat, geo_lng from business_index),
k as (select regexp_replace(s, ',.*$', '') || '|' || p k, avg(geo_lat) x from a where geo_lat is not null and geo_lng is not null group by 1), c as (select p, avg(geo_lat) x from a where geo_lat is not null and geo_lng is not null group by 1)
select snap_id, row_no, case when k.x is not null then 'address' when c.x is not null then 'postcode' end located_by, round(coalesce(k.x, c.x), 4) lat
from (select snap_id, row_no, regexp_replace(lower(trim(regexp_replace(adresse1, '[\s\p{Z}]+', ' ', 'g'))), ',.*$', '') || '|' || trim(postnr) kk, trim(postnr) pp from business_index) b left join k on k.k = b.kk left join c on c.p = b.pp""")
def geo_fallback(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "business_index")
    known = b.select(F.col("adresse1").alias("street"), F.col("postnr").alias("postcode"), F.col("geo_lat").alias("lat"), F.col("geo_lng").alias("lng"))
    out = registry.locate(b.select("snap_id", "row_no", "adresse1", "postnr"), known, street="adresse1", postcode="postnr")
    return out.select("snap_id", "row_no", "located_by", F.round("lat", 4).alias("lat"))


@query("select key, case when try_cast(attempts as double) is null then 3 else least(3, greatest(1, attempts)) end::double clamped from items")
def clamped(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "items").select("key", control.clamp(F.col("attempts").cast("string"), 1.0, 3.0, 3.0).alias("clamped"))


@query("""with e as (select user_id, event_id, epoch(ts) a, row_number() over (partition by user_id order by ts, event_id) i from events)
select user_id, event_id, round(i / 0.001 + max(a - i / 0.001) over (partition by user_id order by a, event_id rows unbounded preceding), 3) start_at from e""")
def paced(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", "event_id", F.struct((F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("a"), "event_id").alias("o"))
    w = Window.partitionBy("user_id").orderBy("o")
    return e.withColumn("i", F.row_number().over(w) / F.lit(0.001)).select("user_id", "event_id", F.round(F.col("i") + F.max(F.col("o.a") - F.col("i")).over(w.rowsBetween(Window.unboundedPreceding, 0)), 3).alias("start_at"))


@query("select event_id, event_type, json_extract_string(props, '$.page') page from events where json_valid(props)")
def json_props(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").where(F.try_parse_json("props").isNotNull()).select("event_id", "event_type", F.get_json_object("props", "$.page").alias("page"))


# --- streams ---------------------------------------------------------------------------------------


@query("select distinct id from articles")
def stream_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """Articles as a stream of files, each id once."""
    a = table(spark, d, "articles")
    s = stream.file_stream(spark, f"{d}/articles.parquet" if _is_folder(d, "articles") else d, a.schema, glob=None if _is_folder(d, "articles") else "articles.parquet")
    return stream.stream_to_table(stream.first_seen(s.select("id")), "rows", scratch(spark, "stream"))


def _is_folder(d: str, name: str) -> bool:
    import os

    return os.path.isdir(f"{d}/{name}.parquet")


@query(f"select report_id, {_PEST_SQL} has_pest from smiley_extract where text is not null")
def stream_flags(spark: SparkSession, d: str) -> DataFrame:
    """Flags of reports as they arrive as files; the rows of the batch form."""
    t = table(spark, d, "smiley_extract")
    s = stream.file_stream(spark, f"{d}/smiley_extract.parquet" if _is_folder(d, "smiley_extract") else d, t.schema, glob=None if _is_folder(d, "smiley_extract") else "smiley_extract.parquet")
    return stream.stream_to_table(stream.flagged(s.where("text is not null")).select("report_id", "has_pest"), "rows", scratch(spark, "stream"))
