"""Queries of operators on layout, labels, memo, status and queues over whole stand-in tables, and the SQL they are held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeline.functions import text as tx
from lakeline.operators import control, layout, memo, metrics, news, state, template
from lakeline.session import table

NOW = 1_785_000_000.0

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


# --- scalars ---------------------------------------------------------------------------------------


@query(r"""select part_file, row_no, regexp_replace(replace(replace(replace(lower(summary_en), 'æ', 'ae'), 'ø', 'o'), 'å', 'a'), '[^\p{L}\p{N}]', '', 'g') k,
regexp_matches(summary_en, '[A-Za-zÆØÅæøå]') letters, regexp_matches(summary_en, '[gjpqy]') descender from smiley_analyze where summary_en is not null""")
def label_keys(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("summary_en")
    return table(spark, d, "smiley_analyze").where(c.isNotNull()).select("part_file", "row_no", tx.label_key(c).alias("k"), tx.has_letters(c).alias("letters"), tx.has_descender(c).alias("descender"))


@query("""with r as (select distinct run_id, pipeline, started_at, finished_at from runs), s as (select *, finished_at - started_at x, greatest(0, round(finished_at - started_at))::bigint n from r)
select run_id, pipeline, started_at, case when x is null then '–' when n >= 86400 then (n // 86400) || 'd ' || (n % 86400 // 3600) || 'h' when n >= 3600 then (n // 3600) || 'h ' || (n % 3600 // 60) || 'm'
when n >= 60 then (n // 60) || 'm ' || (n % 60) || 's' else n || 's' end took,
case when x is null then 'never' when trunc(x) < 60 then trunc(x)::bigint || 's ago' when trunc(x) < 3600 then (trunc(x)::bigint // 60) || 'm ago' else (trunc(x)::bigint // 3600) || 'h ago' end ago from s""")
def durations(spark: SparkSession, d: str) -> DataFrame:
    x = F.col("finished_at") - F.col("started_at")
    r = table(spark, d, "runs").select("run_id", "pipeline", "started_at", "finished_at").distinct()
    return r.select("run_id", "pipeline", "started_at", tx.duration_text(x).alias("took"), tx.ago_text(x).alias("ago"))


@query("""with i as (select distinct seq, key, try_cast(regexp_extract(error, 'HTTP\\s*(\\d{3})', 1) as int) code, coalesce(path, '') like '%.pdf' pdf, coalesce(contains(lower(error), 'timeout'), false) net from items)
select seq, key, case when net or code is null or code = 429 or code between 500 and 599 then 'failed' when code between 400 and 499 or not pdf then 'skipped' else 'done' end status,
case when code between 200 and 399 then 'done' else 'failed' end page_status from i""")
def outcomes(spark: SparkSession, d: str) -> DataFrame:
    code = F.nullif(F.regexp_extract("error", r"HTTP\s*(\d{3})", 1), F.lit("")).try_cast("int")
    i = table(spark, d, "items").select("seq", "key", code.alias("code"), F.coalesce("path", F.lit("")).endswith(".pdf").alias("pdf"), F.coalesce(F.lower("error").contains("timeout"), F.lit(False)).alias("net")).distinct()
    return i.select("seq", "key", state.outcome_status(F.col("code"), F.col("pdf"), F.col("net")).alias("status"), state.page_outcome_status(F.col("code")).alias("page_status"))


@query("""select part_file, row_no, coalesce(contains(lower(report_id), '7'), false) or left(text_en, 4) = 'Deer' pdf from smiley_translate where text_en is not null""")
def pdf_marks(spark: SparkSession, d: str) -> DataFrame:
    """The test for PDF over stand-in contents: a type by the id, and content that begins with the mark where the text begins with one word."""
    t = table(spark, d, "smiley_translate").where("text_en is not null")
    kind = F.when(F.lower("report_id").contains("7"), "application/pdf; x").otherwise("text/html")
    content = F.to_binary(F.when(F.left("text_en", F.lit(4)) == "Deer", "%PDF-1.7").otherwise("<html>"), F.lit("utf-8"))
    return t.select("part_file", "row_no", tx.is_pdf(kind, content).alias("pdf"))


@query("select o_orderkey, (o_custkey // 65536 % 256) / 255.0 r, (o_custkey // 256 % 256) / 255.0 g, (o_custkey % 256) / 255.0 b from orders")
def rgb_shares(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", template.rgb(F.col("o_custkey")).alias("c")).select("o_orderkey", "c.*")


@query("select p_partkey, p_retailprice - case when regexp_matches(p_name, '[gjpqy]') then p_size * 0.21 else 0.0 end baseline from part")
def label_baselines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", template.baseline(F.col("p_name"), F.col("p_retailprice"), F.col("p_size").cast("double")).alias("baseline"))


@query("""select p_partkey, case when length(p_name) * 0.5 * s > 40.0 then greatest(3.2, 40.0 / (length(p_name) * 0.5)) else s end size from (select *, least(p_size * 0.8, 11.0) s from part)""")
def label_sizes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", layout.label_size(F.length("p_name") * 0.5, F.lit(40.0), F.col("p_size").cast("double")).alias("size"))


@query("select seq, key, least(9, greatest(0, trunc(try_cast(v as double))))::bigint n from (select distinct seq, key, case when seq % 5 = 0 then attempts || '.9' else attempts::varchar end v from items) where v is not null")
def clamped_whole(spark: SparkSession, d: str) -> DataFrame:
    v = F.when(F.col("seq") % 5 == 0, F.concat(F.col("attempts").cast("string"), F.lit(".9"))).otherwise(F.col("attempts").cast("string"))
    i = table(spark, d, "items").select("seq", "key", v.alias("v")).distinct().where("v is not null")
    return i.select("seq", "key", control.clamp(F.col("v"), 0, 9, 1, whole=True).cast("long").alias("n"))


# --- memo and replies ------------------------------------------------------------------------------

_KEY = r"trim(regexp_replace({x}, '[\s\p{{Z}}\x{{85}}\x{{1c}}-\x{{1f}}]+', ' ', 'g'))"


def _memo(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "smiley_analyze").where("summary_en is not null").select(tx.memo_key(F.col("summary_en")).alias("k"), "summary_en")
    return t.groupBy("k").agg(F.min("summary_en").alias("da"), F.upper(F.min("summary_en")).alias("en"), (F.count("*") - 1).alias("hits"))


@query(f"""with m as (select {_KEY.format(x='summary_en')} k, upper(min(summary_en)) en from smiley_analyze where summary_en is not null group by 1)
select k, en from m where k in (select {_KEY.format(x='l')} from (select unnest(string_split(text_en, chr(10))) l from smiley_translate union all select summary_en from smiley_analyze where severity = 'minor'))""")
def memo_found(spark: SparkSession, d: str) -> DataFrame:
    """Keys of report lines and of some summaries that the memo knows."""
    lines = table(spark, d, "smiley_translate").select(F.explode(F.split("text_en", "\n", -1)).alias("l")).unionByName(table(spark, d, "smiley_analyze").where("severity = 'minor'").select(F.col("summary_en").alias("l")))
    return memo.lookup(lines.select(tx.memo_key(F.col("l")).alias("k")), _memo(spark, d))


@query(f"select count(distinct {_KEY.format(x='summary_en')}) lines, count(summary_en) - count(distinct {_KEY.format(x='summary_en')}) reuses from smiley_analyze")
def memo_totals(spark: SparkSession, d: str) -> DataFrame:
    return memo.stats(_memo(spark, d))


@query("""select part_file || '/' || row_no id, text_en "text", case when row_no % 3 = 0 then text_en when row_no % 3 = 1 then upper(text_en) else lower(text_en) end en from smiley_translate where text_en is not null""")
def replies_by_id(spark: SparkSession, d: str) -> DataFrame:
    """Answers that echo ids: some missing, some given twice (the last counts), some of ids no one asked for."""
    t = table(spark, d, "smiley_translate").where("text_en is not null")
    asked = t.select(F.concat_ws("/", "part_file", F.col("row_no").cast("string")).alias("id"), F.col("text_en").alias("text"), "row_no")
    first = asked.where("row_no % 3 > 0").select("id", F.upper("text").alias("en"), F.lit(1).alias("pos"))
    again = asked.where("row_no % 3 = 2").select("id", F.lower("text").alias("en"), F.lit(2).alias("pos"))
    foreign = asked.select(F.concat("id", F.lit("?")).alias("id"), F.lit("x").alias("en"), F.lit(3).alias("pos"))
    return memo.reply_by_id(asked.select("id", "text"), first.unionByName(again).unionByName(foreign))


_LINES = "l as (select report_id, generate_subscripts(a, 1) - 1 idx, unnest(a) t from (select report_id, string_split(min(text), chr(10)) a from smiley_extract where text is not null group by 1))"


def _report_lines(spark: SparkSession, d: str) -> DataFrame:
    """(report_id, idx, text): the lines of each report once."""
    t = table(spark, d, "smiley_extract").where("text is not null").groupBy("report_id").agg(F.min("text").alias("text"))
    return t.select("report_id", F.posexplode(F.split("text", "\n", -1)).alias("idx", "text"))


@query(f"""with {_LINES}, p as (select report_id, idx // 5 page, string_agg(t, chr(10) order by idx) t from l group by 1, 2) select report_id, string_agg(t, chr(10) || chr(10) order by page) text_en from p group by 1""")
def report_bodies(spark: SparkSession, d: str) -> DataFrame:
    """Report texts put together again from lines, five a page."""
    return memo.report_texts(_report_lines(spark, d).select("report_id", F.floor(F.col("idx") / 5).alias("page"), "idx", F.col("text").alias("en")))


# --- layout ----------------------------------------------------------------------------------------

_PAGE = f"""{_LINES}, g as (select report_id, 0 page, idx, 600.0 page_width, 800.0 page_height, t "text", (50.0 + length(t) % 2 * 30)::double x0, (50.0 + length(t) % 2 * 30 + length(t) * 6.0)::double x1, (idx * 14.0)::double y0, (idx * 14.0 + 10)::double y1,
(10.0 + length(t) % 3 * 0.5)::double size, 0 color, length(t) % 7 = 0 bold from l),
h as (select *, case when abs(x0 - lag(x0) over w) < 2.0 and abs(size - lag(size) over w) < 0.6 and bold = lag(bold) over w and y0 - lag(y0) over w > 0 and y0 - lag(y0) over w < 3.0 * greatest(size, 1.0)
      and lag(x1) over w - lag(x0) over w > 0.3 * page_width then 0 else 1 end b from g window w as (partition by report_id order by idx)),
r as (select *, sum(b) over (partition by report_id order by idx) - 1 para from h),
q as (select report_id, para::bigint para, min(idx) idx, min(x0) x0, max(x1) x1, min(y0) y0, max(y1) y1, count(*) n_lines, arg_min(size, idx) size, arg_min(bold, idx) bold, string_agg("text", ' ' order by idx) "text" from r group by 1, 2)"""


def _page_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of reports with made-up geometry: edge, size and weight follow from the length."""
    n = F.length("text")
    x0 = F.lit(50.0) + n % 2 * 30
    return _report_lines(spark, d).select(
        "report_id", F.lit(0).alias("page"), "idx", F.lit(600.0).alias("page_width"), F.lit(800.0).alias("page_height"), "text", x0.alias("x0"), (x0 + n * 6.0).alias("x1"), (F.col("idx") * 14.0).alias("y0"), (F.col("idx") * 14.0 + 10).alias("y1"),
        (F.lit(10.0) + n % 3 * 0.5).alias("size"), F.lit(0).alias("color"), (n % 7 == 0).alias("bold"), (F.col("idx") * 14.0 + 8).alias("baseline"),
    )


@query(f'with {_PAGE} select report_id, para, idx::int idx, x0, x1, y0, y1, n_lines, size, bold, "text" from q')
def paragraph_runs(spark: SparkSession, d: str) -> DataFrame:
    return layout.paragraph_table(layout.paragraphs(_page_lines(spark, d))).select("report_id", "para", "idx", "x0", "x1", "y0", "y1", "n_lines", "size", "bold", "text")


@query(f"""with {_PAGE}, c as (select *, case when x1 - x0 > 180.0 and lag(x1) over w - lag(x0) over w > 180.0 and abs(x0 - lag(x0) over w) < 2.0 and abs(size - lag(size) over w) < 0.6 and bold = lag(bold) over w
and y0 - lag(y1) over w >= 0 and y0 - lag(y1) over w < 2.5 * greatest(size, 1.0) then 0 else 1 end b from q window w as (partition by report_id order by para))
select report_id, para, (sum(b) over (partition by report_id order by para) - 1)::bigint block from c""")
def text_columns(spark: SparkSession, d: str) -> DataFrame:
    return layout.columns(layout.paragraph_table(layout.paragraphs(_page_lines(spark, d)))).select("report_id", "para", "block")


@query("""with b as (select distinct l_orderkey, l_linenumber, l_quantity x0, l_quantity * 3 x1, l_linenumber % 4 n_lines, l_quantity * 10 bottom, l_linenumber * 10.0 baseline0, l_linenumber * 10.0 + 30 last_baseline, l_linenumber % 3 * 4.0 pitch from lineitem)
select l_orderkey, l_linenumber, x0, least(x1 + case when n_lines = 1 then 55.0 else 8.0 end, 100.0 - 6) - x0 width,
greatest(n_lines, coalesce(case when pitch > 0 then trunc((case when bottom <> 0 then bottom else last_baseline end - baseline0) / pitch)::bigint + 1 end, 0))::bigint slots from b""")
def block_boxes(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("l_linenumber")
    b = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("x0"), (F.col("l_quantity") * 3).alias("x1"), (c % 4).cast("long").alias("n_lines"), (F.col("l_quantity") * 10).alias("bottom"), (c * 10.0).alias("baseline0"), (c * 10.0 + 30).alias("last_baseline"), (c % 3 * 4.0).alias("pitch"), F.lit(100.0).alias("page_width"),
    ).distinct()
    return layout.box(b).select("l_orderkey", "l_linenumber", "x0", "width", F.col("slots").cast("long").alias("slots"))


# --- template labels -------------------------------------------------------------------------------


def _grid(spark: SparkSession, d: str) -> DataFrame:
    """Each vector as a crop of four pixels a row."""
    v = table(spark, d, "embeddings").select("vec_id", F.expr("transform(embedding, x -> cast(least(255, greatest(0, floor((x + 1) * 128))) as int))").alias("v"))
    px = F.transform(F.sequence(F.lit(0), F.floor(F.size("v") / 3).cast("int") - 1), lambda i: F.struct((i % 4).alias("x"), F.floor(i / 4).cast("int").alias("y"), F.get("v", i * 3).alias("r"), F.get("v", i * 3 + 1).alias("g"), F.get("v", i * 3 + 2).alias("b")))
    return v.select(F.col("vec_id").alias("box"), F.inline(px))


_GRID = """px as (select vec_id box, i % 4 x, i // 4 y, least(255, greatest(0, floor((embedding[i * 3 + 1]::double + 1) * 128)))::int r, least(255, greatest(0, floor((embedding[i * 3 + 2]::double + 1) * 128)))::int g, least(255, greatest(0, floor((embedding[i * 3 + 3]::double + 1) * 128)))::int b
from (select vec_id, embedding, unnest(range(0, len(embedding) // 3)) i from embeddings)),
fl as (select box, fr, fg, fb from (select *, row_number() over (partition by box order by n desc, fr, fg, fb) k from (select box, r // 8 * 8 fr, g // 8 * 8 fg, b // 8 * 8 fb, count(*) n from px group by all)) where k = 1),
ds as (select px.*, fl.* exclude (box), abs(r - fr) + abs(g - fg) + abs(b - fb) d from px join fl using (box)),
nk as (select box, r tr, g tg, b tb from (select *, row_number() over (partition by box order by d desc, y, x) k from ds) where k = 1)"""


@query(f"with {_GRID} select box, y::int y, avg((d > 90)::int) cov from ds group by 1, 2")
def ink_coverage(spark: SparkSession, d: str) -> DataFrame:
    p = _grid(spark, d)
    return template.coverage(p, template.fills(p), "y")


@query(f"""with {_GRID}, cy as (select box, y, avg((d > 90)::int) cov from ds group by 1, 2), cx as (select box, x, avg((d > 90)::int) cov from ds group by 1, 2),
by_ as (select box, min(y) lo, max(y) hi from cy where cov > 0.02 and cov < 0.65 group by 1), bx as (select box, min(x) lo, max(x) hi from cx where cov > 0.02 group by 1),
wy as (select by_.*, coalesce((select max(1) from cy where cy.box = by_.box and cov < 0.65 and y = lo - 1), 0) a, coalesce((select max(1) from cy where cy.box = by_.box and cov < 0.65 and y = hi + 1), 0) z from by_),
wx as (select bx.*, coalesce((select max(1) from cx where cx.box = bx.box and x = lo - 1), 0) a, coalesce((select max(1) from cx where cx.box = bx.box and x = hi + 1), 0) z from bx),
w as (select box, min(x) x0, min(y) y0, max(x) x1, max(y) y1 from px group by 1)
select w.box, case when wy.box is null or wx.box is null then w.x0 else wx.lo - wx.a end::bigint x0, case when wy.box is null or wx.box is null then w.y0 else wy.lo - wy.a end::bigint y0,
case when wy.box is null or wx.box is null then w.x1 else wx.hi + wx.z end::bigint + 1 x1, case when wy.box is null or wx.box is null then w.y1 else wy.hi + wy.z end::bigint + 1 y1 from w left join wy using (box) left join wx using (box)""")
def tight_boxes(spark: SparkSession, d: str) -> DataFrame:
    p = _grid(spark, d)
    t = template.tight_boxes(p, template.fills(p))
    return t.select("box", *[F.col(c).cast("long").alias(c) for c in ("x0", "y0", "x1", "y1")])


@query(f"with {_GRID} select ds.box, avg((abs(r - tr) + abs(g - tg) + abs(b - tb) < d)::int) > 0.295 bold from ds join nk using (box) group by 1")
def bold_labels(spark: SparkSession, d: str) -> DataFrame:
    p = _grid(spark, d)
    f = template.fills(p)
    return template.is_bold(p, f, template.inks(p, f))


@query(f"with {_GRID} select box, coalesce(min(x) filter (d > 90 and x >= 1 and x < 3), 3)::bigint avail_x1 from ds group by 1")
def room_right(spark: SparkSession, d: str) -> DataFrame:
    p = _grid(spark, d)
    edges = p.select("box").distinct().select("box", F.lit(1).alias("x1"), F.lit(3).alias("lim"))
    return template.room_right(p, template.fills(p), edges).select("box", F.col("avail_x1").cast("long").alias("avail_x1"))


@query("""with b as (select p_partkey box, p_type da, case when p_size % 3 = 0 then null when p_size % 3 = 1 then lower(p_type) else p_brand end en from part),
o as (select distinct p_type t from part where p_size > 45), k as (select *, regexp_replace(lower(da), '[^\\p{L}\\p{N}]', '', 'g') k from b)
select box, da, e en from (select *, case when k in ('promobrushed', 'economybrass') then da when da in (select t from o) then 'fixed ' || da else coalesce(en, da) end e from k) where regexp_replace(lower(e), '[^\\p{L}\\p{N}]', '', 'g') <> k""")
def label_texts(spark: SparkSession, d: str) -> DataFrame:
    """Labels with fixed wordings for some kinds, kept ones, and gaps that keep the text."""
    p = table(spark, d, "part")
    boxes = p.select(F.col("p_partkey").alias("box"), F.col("p_type").alias("da"), F.when(F.col("p_size") % 3 == 1, F.lower("p_type")).when(F.col("p_size") % 3 == 2, F.col("p_brand")).alias("en"))
    fixed = p.where("p_size > 45").select("p_type").distinct().select(tx.label_key(F.col("p_type")).alias("k"), F.concat(F.lit("fixed "), "p_type").alias("fixed"))
    return template.labels(boxes, fixed, ["promobrushed", "economybrass"]).select("box", "da", "en")


@query("select (o_custkey % 7)::varchar variant, count(*) n, min(o_orderkey) example from orders where o_custkey % 7 >= 5 group by 1")
def unknown_variants(spark: SparkSession, d: str) -> DataFrame:
    seen = table(spark, d, "orders").select((F.col("o_custkey") % 7).cast("string").alias("variant"), F.col("o_orderkey").alias("report_id"))
    return template.unknown_variants(seen, table(spark, d, "region").select(F.col("r_regionkey").cast("string").alias("variant")))


@query("""with s as (select r_regionkey variant, i box, 10 * i + r_regionkey bx0, 20 * i by0, 10 * i + r_regionkey + 30 bx1, 20 * i + 12 by1, 80 + i avail from region, range(0, 3) t(i)),
p as (select o_orderkey report_id, o_custkey % 7 variant, o_orderkey % 5 * 1.0 rx0, 7.0 ry0, 400.0 rwidth, 300.0 rheight from orders),
j as (select report_id, box::int box, rx0 + bx0 * rwidth / 200 x0, ry0 + by0 * rheight / 100 y0, rx0 + bx1 * rwidth / 200 x1, ry0 + by1 * rheight / 100 y1, rx0 + avail * rwidth / 200 avail, 12.0 * rheight / 100 font_pt, ry0 + by1 * rheight / 100 baseline from p join s using (variant)),
o as (select distinct l_orderkey, l_quantity * 8 ox0, l_linenumber * 15.0 oy0, l_linenumber * 15.0 + 12 oy1 from lineitem)
select report_id, box, x0, y0, x1, y1, greatest(x1, least(avail, (select min(ox0 - 2) from o where l_orderkey = report_id and ox0 >= x1 - 1 and oy1 > y0 + 1 and oy0 < y1 - 1))) limit_x1, font_pt, baseline from j""")
def patch_boxes(spark: SparkSession, d: str) -> DataFrame:
    """Labels of each order's variant on its page, with the order's lines in their way."""
    i = lambda n: F.lit(n).cast("int")
    spec = lambda n: F.struct(
        F.array((F.lit(10 * n) + F.col("r_regionkey")).cast("int"), i(20 * n), (F.lit(10 * n + 30) + F.col("r_regionkey")).cast("int"), i(20 * n + 12)).alias("bbox"), F.lit("en").alias("en"), F.lit(False).alias("bold"), F.array(i(0)).alias("fill"), F.array(i(0)).alias("color"),
        i(80 + n).alias("avail_x1"), F.lit(None).cast("double").alias("font_px"), F.lit(None).cast("double").alias("baseline_px"))
    specs = table(spark, d, "region").select(F.col("r_regionkey").cast("long").alias("variant"), F.lit(200).alias("width"), F.lit(100).alias("height"), F.array(*[spec(n) for n in range(3)]).alias("boxes"))
    pages = table(spark, d, "orders").select(F.col("o_orderkey").alias("report_id"), F.lit(0).alias("page"), (F.col("o_custkey") % 7).alias("variant"), (F.col("o_orderkey") % 5 * 1.0).alias("rx0"), F.lit(7.0).alias("ry0"), F.lit(400.0).alias("rwidth"), F.lit(300.0).alias("rheight"))
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("report_id"), F.lit(0).alias("page"), (F.col("l_quantity") * 8).alias("x0"), (F.col("l_linenumber") * 15.0).alias("y0"), (F.col("l_linenumber") * 15.0 + 12).alias("y1")).distinct()
    return template.patch_plan(pages, specs, lines).select("report_id", "box", "x0", "y0", "x1", "y1", "limit_x1", "font_pt", "baseline")


# --- queues, status, time --------------------------------------------------------------------------

_LATEST = "(select * exclude n from (select *, row_number() over (partition by pipeline, key order by updated_at desc, seq desc) n from (select distinct pipeline, key, updated_at, seq, status, attempts, error from items)) where n = 1)"


def _items(spark: SparkSession, d: str) -> DataFrame:
    return state.latest_items(table(spark, d, "items").select("pipeline", "key", "updated_at", "seq", "status", "attempts", "error").distinct())


@query(f"select key, status from {_LATEST} where pipeline = 'smiley_report' and status in ('pending', 'failed') order by key limit 25")
def pending_first(spark: SparkSession, d: str) -> DataFrame:
    """The first keys of the queue: a limit is the feature here."""
    return state.pending(_items(spark, d), "smiley_report", 25).select("key", "status")


@query("select report_id from (select distinct report_id from smiley_extract where doc_type = 'report') where report_id not in (select trim(report_id) from smiley_analyze where report_id is not null) order by 1 limit 40")
def todo_first(spark: SparkSession, d: str) -> DataFrame:
    """The first reports not analysed yet: a limit is the feature here."""
    done = table(spark, d, "smiley_analyze").where("report_id is not null").select(F.trim("report_id").alias("report_id"))
    return state.todo(table(spark, d, "smiley_extract").where("doc_type = 'report'").select("report_id").distinct(), done, "report_id", 40)


@query("select distinct 'smiley_overlay' pipeline, report_id key, 'pending' status from smiley_extract where report_id not in (select key from items where pipeline = 'smiley_overlay' and key is not null)")
def discovered(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "smiley_extract").select(F.col("report_id").alias("key"), F.lit(None).cast("string").alias("meta"))
    return state.discovery_events(ids, table(spark, d, "items"), "smiley_overlay", F.lit(NOW)).select("pipeline", "key", "status")


@query("""select count(*) filter (error is null) ok, count(*) filter (error is not null and attempts + 1 < 3) err, count(*) filter (error is not null) skip, coalesce(sum(seq % 7), 0)::bigint cache_hits, coalesce(sum(seq % 3), 0)::bigint calls,
100.0 * coalesce(sum(seq % 7), 0) / greatest(1, coalesce(sum(seq % 7), 0) + coalesce(sum(seq % 3), 0)) hit_pct from items""")
def run_counts(spark: SparkSession, d: str) -> DataFrame:
    i = table(spark, d, "items").select(F.col("error").alias("problem"), "attempts", (F.col("seq") % 7).alias("cache_hits"), (F.col("seq") % 3).alias("calls"))
    return metrics.run_counters(i)


@query(f"""with q as (select pipeline, count(*) filter (status = 'done') done, count(*) filter (status = 'skipped') skipped, count(*) total, max(updated_at) updated_at from {_LATEST} group by 1)
select pipeline, {NOW} - updated_at > 15.0 stale, greatest(0, total - done - skipped) remaining, least(100.0, greatest(0.0, 100.0 * done / total)) bar from q""")
def shown_progress(spark: SparkSession, d: str) -> DataFrame:
    s = _items(spark, d).groupBy("pipeline").agg(F.count_if(F.col("status") == "done").alias("done"), F.count_if(F.col("status") == "skipped").alias("skipped"), F.count("*").alias("total"), F.max("updated_at").alias("updated_at"))
    return metrics.display(s, NOW).select("pipeline", "stale", "remaining", "bar")


@query("select run_id, pipeline, started_at, coalesce(ok and finished_at <> 0 and 1777000000.0 - finished_at < 3000000.0, false) up from (select distinct run_id, pipeline, started_at, finished_at, ok from runs)")
def services_up(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "runs").select("run_id", "pipeline", "started_at", "finished_at", "ok").distinct()
    return r.select("run_id", "pipeline", "started_at", metrics.service_up(F.col("ok"), F.col("finished_at"), 1777000000.0, 3_000_000.0).alias("up"))


@query("""with h as (select user_id, event_id, case when event_id % 11 = 0 then 0.0 else floor(epoch(ts) / 86400) * 86400.0 end t from events)
select user_id, t from (select distinct user_id, t from h where t <> 0)""")
def clean_samples(spark: SparkSession, d: str) -> DataFrame:
    """Samples by user and day: those without a time and repeats are dropped."""
    t = F.when(F.col("event_id") % 11 == 0, 0.0).otherwise(F.unix_date(F.to_date("ts")) * 86400.0)
    return metrics.clean_history(table(spark, d, "events").select("user_id", t.alias("t")), ["user_id"])


@query(f"""with q as (select pipeline, count(*) filter (status = 'pending') pending, count(*) filter (status = 'failed') failed from {_LATEST} group by 1)
select pipeline, (pending + failed + 1000 * 4)::double requests, (pending + failed + 3000)::bigint final_reports from q""")
def default_yield(spark: SparkSession, d: str) -> DataFrame:
    """No business seen yet: each of 1,000 is taken to yield three reports."""
    z = F.lit(0)
    s = _items(spark, d).groupBy("pipeline").agg(F.count_if(F.col("status") == "pending").alias("pending"), F.count_if(F.col("status") == "failed").alias("failed"))
    left, final = metrics.remaining_work(z, F.col("pending"), F.col("failed"), z, z, z, F.lit(1000), default_yield=3.0)
    return s.select("pipeline", left.cast("double").alias("requests"), final.alias("final_reports"))


@query(f"""with i as (select * from {_LATEST}), e as (select count(*) filter (doc_type = 'report') reports, count(*) filter (doc_type = 'placard') placards from smiley_extract), a as (select count(*) filter (severity = 'serious') serious from smiley_analyze)
select count(*) filter (pipeline = 'smiley_business' and status = 'done') b_done, count(*) filter (pipeline = 'smiley_report' and status = 'done') r_done, count(*) filter (pipeline = 'smiley_report' and status = 'pending') r_pending, count(*) filter (pipeline = 'smiley_extract' and status = 'done') extracted,
count(*) filter (pipeline = 'smiley_analyze' and status = 'done') analyzed, any_value(e.reports) reports, any_value(e.placards) placards, any_value(a.serious) serious from i, e, a""")
def status_fields(spark: SparkSession, d: str) -> DataFrame:
    """Parts of the status document, as columns."""
    m = spark.createDataFrame([], "k string, da string, en string, hits long")
    s = metrics.status_document(_items(spark, d), table(spark, d, "smiley_extract"), table(spark, d, "smiley_analyze"), m, 58616, 0, NOW)
    c = F.col
    return s.select(c("businesses.done").alias("b_done"), c("reports.done").alias("r_done"), c("reports.pending").alias("r_pending"), c("extract.extracted").alias("extracted"), c("analyze.analyzed").alias("analyzed"), c("extract.reports").alias("reports"), c("extract.placards").alias("placards"), c("analyze.serious").alias("serious"))


@query("""with w as (select user_id, event_id, epoch(ts) a, row_number() over (partition by user_id order by ts, event_id) i from events)
select user_id, event_id, round(i / 0.001 + max(a - i / 0.001) over (partition by user_id order by a, event_id rows unbounded preceding), 3) start_at from w""")
def paced_requests(spark: SparkSession, d: str) -> DataFrame:
    """When each request may start at one in 1,000 s, by the operator."""
    at = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    return control.paced(table(spark, d, "events").select("user_id", "event_id", at.alias("at")), ["user_id"], ["at", "event_id"], 0.001).select("user_id", "event_id", F.round("start_at", 3).alias("start_at"))


@query("""with n as (select source, count(*) entries, count(*) filter (fetched_at >= 1770000000) new from articles where source is not null group by 1)
select 1785000000.0::double ran_at, coalesce(n.source, e.source) source, coalesce(entries, 0) entries, coalesce(new, 0) new, error from n full join (select 'no-feed' source, 'timeout' error) e using (source)""")
def poll_rows(spark: SparkSession, d: str) -> DataFrame:
    """The poll log of all articles as one poll, and of a feed that failed."""
    a = table(spark, d, "articles").where("source is not null")
    failed = spark.createDataFrame([("no-feed", "timeout")], "source string, error string")
    return news.poll_log(a, a.where("fetched_at >= 1770000000"), failed, NOW)
