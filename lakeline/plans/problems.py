"""Queries of the general problems (1, 3, 5, 6) over their whole tables, and SQL to hold them against."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeline.operators.changes import ChangeFeed, successful
from lakeline.operators.compact import SizeTieredCompactor
from lakeline.operators.diff import diff_snapshots
from lakeline.operators.instants import MONTHS, ZONES, number_ms, with_instant
from lakeline.session import scratch, table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "articles").select("id", "published", "fetched_at")
    a = with_instant(a, "published", "published_ms").withColumn("fetched_ms", number_ms(F.col("fetched_at")))
    return a.select("id", "published_ms", "fetched_ms").where("published_ms is not null and fetched_ms is not null").distinct()


def p1_unreadable(spark: SparkSession, d: str) -> DataFrame:
    """Texts that state no existing date and time, with how often."""
    a = with_instant(table(spark, d, "articles").select("published"), "published", "ms")
    return a.where("ms is null").groupBy("published").agg(F.count("*").alias("n"))


_WD = r"(?:\pL{2,9}(?:\.?, ?|\.? )(?:den |d\. ?)?)?"
_REST = r"(\D.*)?$"
_TZ = r"(?: ?(?:(?:gmt|utc|ut)?([+-])(\d{1,2})(?::?(\d{2}))?|([a-z_]{2,20}(?:/[a-z0-9_+-]{2,30}){1,2})|([a-z]{1,5})))?(?: ?\[([a-z0-9_/+-]{2,60})\])?(?: ?\([^()]{1,40}\))?$"
_CLOCK = r"(\d{1,2})[:.](\d{2})(?:[:.](\d{2})(?:[.,](\d{1,9}))?)?(?: ?([ap])\.? ?m\b\.?)?"
_ZN = "['h', 'i', 's', 'f', 'p', 'sg', 'oh', 'om', 'zr', 'za', 'zb']"


def _sql_map(values: dict[str, int]) -> str:
    return f"map {{{', '.join(f"'{k}': {v}" for k, v in values.items())}}}"


#: Each written form is taken apart by a pattern of its own, the rest of the text then as a time and a zone.
_P1_SQL = f"""
with a as (select distinct published, translate(lower(trim(regexp_replace(published, '[\\s\\p{{Z}}\\x{{85}}\\x{{1c}}-\\x{{1f}}]+', ' ', 'g'))), '−‐‑', '---') c from articles),
m as (select *, regexp_extract(c, '^(\\d{{4}})([-/.])(\\d{{1,2}})([-/.])(\\d{{1,2}}){_REST}', ['y', 'q', 'm', 'q2', 'd', 'r']) f1,
 regexp_extract(c, '^{_WD}(\\d{{1,2}})([-/.])(\\d{{1,2}})([-/.])(\\d{{4}}|\\d{{2}}){_REST}', ['d', 'q', 'm', 'q2', 'y', 'r']) f2,
 regexp_extract(c, '^{_WD}(\\d{{1,2}})(?:\\.|st|nd|rd|th)?[ -]?(?:of )?(\\pL{{3,9}})\\.?,?[ -]?(\\d{{4}}|\\d{{2}}){_REST}', ['d', 'm', 'y', 'r']) f3,
 regexp_extract(c, '^{_WD}(\\pL{{3,9}})\\.? (\\d{{1,2}})(?:st|nd|rd|th)?,? (\\d{{4}}){_REST}', ['m', 'd', 'y', 'r']) f4,
 regexp_extract(c, '^(\\d{{4}})(\\d{{2}})(\\d{{2}})(?:[t ](\\d.*))?$', ['y', 'm', 'd', 'r']) f5,
 regexp_extract(c, '^\\pL{{2,9}}\\.?,? (\\pL{{3,9}})\\.? (\\d{{1,2}}) (\\d{{1,2}}[:.].*?)(?: ([a-z]{{1,5}}))? (\\d{{4}})$', ['m', 'd', 'r', 'z', 'y']) f6 from a),
n as (select *, case when f1.y <> '' and f1.q = f1.q2 then 1 when f2.y <> '' and f2.q = f2.q2 then 2 when f3.y <> '' then 3 when f4.y <> '' then 4 when f5.y <> '' then 5 when f6.y <> '' then 6 end k from m),
o as (select published, c, k, case k when 1 then f1.y when 2 then f2.y when 3 then f3.y when 4 then f4.y when 5 then f5.y when 6 then f6.y end y, case k when 1 then f1.m when 2 then f2.m when 3 then f3.m when 4 then f4.m when 5 then f5.m when 6 then f6.m end mm,
 case k when 1 then f1.d when 2 then f2.d when 3 then f3.d when 4 then f4.d when 5 then f5.d when 6 then f6.d end::int d,
 case k when 1 then f1.r when 2 then f2.r when 3 then f3.r when 4 then f4.r when 5 then f5.r when 6 then f6.r || case when f6.z <> '' then ' ' || f6.z else '' end end r from n),
t as (select *, case when r = '' then null when k = 5 then regexp_extract(r, '^(\\d{{2}}):?(\\d{{2}})(?::?(\\d{{2}})(?:[.,](\\d{{1,9}}))?)?()' || '{_TZ}', {_ZN})
 else regexp_extract(r, '^(?:,? ?t|,)? ?(?:kl\\.? ?|at )?{_CLOCK}' || '{_TZ}', {_ZN}) end z, case when length(y) = 2 then 2000 + y::int else y::int end yy,
 coalesce(try_cast(mm as int), element_at({_sql_map(MONTHS)}, mm)[1]) mo from o),
u as (select *, case when z is null then 0 when z.p = '' then z.h::int when z.h::int between 1 and 12 then z.h::int % 12 + case when z.p = 'p' then 12 else 0 end end h,
 case when z is null then 0 else z.i::int end i, case when z is null or z.s = '' then 0 else z.s::int end s, case when z is null then 0 else rpad(left(z.f, 3), 3, '0')::int end f from t where k is not null and (z is null or z.h <> '')),
v as (select *, case when mo between 1 and 12 and yy >= 1 and d between 1 and day(last_day(make_date(yy, mo, 1))) and h between 0 and 23 and i <= 59 and s <= 59
 then (make_date(yy, mo, d) - date '1970-01-01')::bigint * 86400000 + h * 3600000 + i * 60000 + s * 1000 + f end ms, coalesce(nullif(z.zr, ''), nullif(z.zb, '')) region from u),
w as (select v.*, make_timestamp(ms * 1000) ts, x.name, make_date(yy, 3, 31) m31, make_date(yy, 10, 31) o31 from v left join (select name from pg_timezone_names() where contains(name, '/')) x on lower(x.name) = v.region where ms is not null),
g as (select *, case when name is not null then case when timezone(name, timezone(name, ts) - interval 1 hour) = ts then epoch_ms(timezone(name, ts) - interval 1 hour) else epoch_ms(timezone(name, ts)) end end by_region,
 case when ms >= (m31 - dayofweek(m31)::int - date '1970-01-01')::bigint * 86400000 + 10800000 and ms < (o31 - dayofweek(o31)::int - date '1970-01-01')::bigint * 86400000 + 10800000 then 7200000 else 3600000 end dk from w),
j as (select published, case when z is not null and z.sg <> '' then case when z.oh::int <= 18 and coalesce(try_cast(z.om as int), 0) <= 59 then ms - (z.oh::int * 60 + coalesce(try_cast(z.om as int), 0)) * 60000 * case when z.sg = '-' then -1 else 1 end end
 when region is not null then by_region when z is not null and z.za <> '' then ms - element_at({_sql_map(ZONES)}, z.za)[1]::bigint * 60000 else ms - dk end ms from g),
q as (select published, try_cast(regexp_extract(c, '^([+-]?\\d{{1,19}})(?:\\.\\d{{1,9}})?$', 1) as hugeint) e, rpad(left(regexp_extract(c, '\\.(\\d+)$', 1), 3), 3, '0') fr from a where regexp_full_match(c, '[+-]?\\d{{1,19}}(\\.\\d{{1,9}})?') and not regexp_full_match(c, '\\d{{8}}')),
p as (select published, ms from j where ms is not null union all
 select published, case when abs(e) < 100000000000 then e * 1000 + case when e < 0 then -1 else 1 end * fr::int when abs(e) < 100000000000000 then e when abs(e) < 100000000000000000 then case when e < 0 then -((999 - e) // 1000) else e // 1000 end
 else case when e < 0 then -((999999 - e) // 1000000) else e // 1000000 end end::bigint from q where e is not null)
"""
P1_SQL = (
    _P1_SQL
    + """, n1 as (select id, published, fetched_at::varchar::decimal(32, 9) d from articles)
select distinct id, p.ms published_ms, floor(case when abs(d) < 100000000000 then d * 1000 when abs(d) < 100000000000000 then d else d / 1000 end)::bigint fetched_ms from n1 join p using (published) where d is not null"""
)
P1_UNREADABLE_SQL = _P1_SQL + "select x.published, count(*) n from articles x where not exists (select 1 from p where p.published = x.published) group by 1"


#: Calls in which the log of runs is settled; each starts from the state the one before committed.
P3_CALLS = 3


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "items").select("pipeline", "key", "status", "sha256", "attempts", "updated_at", "seq", "loaded_at")
    runs = successful(table(spark, d, "runs"))
    feed = ChangeFeed(spark, scratch(spark, "changes"))
    span = runs.agg(F.min("started_at").alias("a"), F.max("started_at").alias("b")).first()
    if span.a is None:
        return feed.advance(items, runs).select("run_id", "item_key")
    ends = [span.a + (span.b - span.a) * (i + 1) / P3_CALLS for i in range(P3_CALLS - 1)] + [span.b]
    found = [feed.advance(items, runs.where(F.col("started_at") <= end)) for end in ends]
    return reduce(DataFrame.unionByName, found).select("run_id", "item_key").distinct()


P3_SQL = """
with r as (select pipeline, run_id, started_at, row_number() over (partition by pipeline order by started_at, run_id) n
           from (select distinct pipeline, run_id, started_at from runs where ok and finished_at is not null and started_at is not null)),
d as (select i.pipeline, i.key, r.n, max(row(i.updated_at, i.seq, i.status, i.sha256, i.attempts)) w
      from (select distinct pipeline, key, seq, status, sha256, attempts, updated_at, loaded_at from items) i
      asof join r on i.pipeline = r.pipeline and r.started_at >= i.loaded_at group by all),
s as (select pipeline, key, n, max(row(updated_at, seq)) over w o, updated_at, seq, status, sha256, attempts
      from (select pipeline, key, n, w[1] updated_at, w[2] seq, w[3] status, w[4] sha256, w[5] attempts from d)
      window w as (partition by pipeline, key order by n)),
t as (select s.pipeline, s.key, s.n, x.status, x.sha256, x.attempts from s join s x
      on x.pipeline = s.pipeline and x.key = s.key and x.n <= s.n and row(x.updated_at, x.seq) = s.o),
u as (select pipeline, key, n, status, sha256, attempts, lag(row(status, sha256, attempts)) over (partition by pipeline, key order by n) p,
             row(status, sha256, attempts) c from (select distinct * from t))
select r.run_id, u.key item_key from u join r using (pipeline, n) where p is null or p is distinct from c
"""


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    rows, log = table(spark, d, "business_index"), table(spark, d, "snapshots")
    return diff_snapshots(
        rows, log, key="navnelbnr", text=["navn1", "cvrnr", "pnr", "adresse1", "postnr", "bynavn", "branche"],
        exact=["reklame_beskyttelse"], close=["geo_lat", "geo_lng"],
    )


def _norm(c: str) -> str:
    return f"nullif(trim(regexp_replace({c}, '[\\s\\p{{Z}}]+', ' ', 'g')), '')"


_P5_TEXT = ("navn1", "cvrnr", "pnr", "adresse1", "postnr", "bynavn", "branche")
P5_SQL = f"""
with o as (select snap_id, source, kind, row_number() over (partition by source, kind order by fetched_at) n
           from (select distinct snap_id, source, kind, fetched_at from snapshots) where snap_id in (select snap_id from business_index)),
b as (select distinct o.source, o.kind, o.n, {_norm('navnelbnr')} k, {', '.join(_norm(c) + ' ' + c for c in _P5_TEXT)}, reklame_beskyttelse r, geo_lat x, geo_lng y
      from business_index i join o using (snap_id)),
p as (select o.snap_id, o.source, o.kind, o.n from o where n > 1),
a as (select p.snap_id, b.* exclude (source, kind, n) from p join b on b.source = p.source and b.kind = p.kind and b.n = p.n),
z as (select p.snap_id, b.* exclude (source, kind, n) from p join b on b.source = p.source and b.kind = p.kind and b.n = p.n - 1),
keys as (select snap_id, k from a union select snap_id, k from z),
new as (select distinct a.snap_id, a.k from a where not exists (select 1 from z where z.snap_id = a.snap_id and z.k is not distinct from a.k
        and {' and '.join(f'z.{c} is not distinct from a.{c}' for c in (*_P5_TEXT, 'r'))}
        and ((a.x is null and z.x is null) or abs(a.x - z.x) <= 0.00001000001) and ((a.y is null and z.y is null) or abs(a.y - z.y) <= 0.00001000001))),
old as (select distinct z.snap_id, z.k from z where not exists (select 1 from a where z.snap_id = a.snap_id and z.k is not distinct from a.k
        and {' and '.join(f'z.{c} is not distinct from a.{c}' for c in (*_P5_TEXT, 'r'))}
        and ((a.x is null and z.x is null) or abs(a.x - z.x) <= 0.00001000001) and ((a.y is null and z.y is null) or abs(a.y - z.y) <= 0.00001000001)))
select k2.snap_id, k2.k navnelbnr,
       case when not exists (select 1 from z where z.snap_id = k2.snap_id and z.k is not distinct from k2.k) then 'added'
            when not exists (select 1 from a where a.snap_id = k2.snap_id and a.k is not distinct from k2.k) then 'removed' else 'changed' end as change
from (select * from new union select * from old) k2
"""

P6_SETS = ("smiley_analyze", "smiley_translate")


def p6_compacted(spark: SparkSession, d: str, dataset: str) -> DataFrame:
    """The compacted dataset, every report of a finished part once."""
    parts = table(spark, d, "part_files").where(F.col("dataset") == dataset)
    return SizeTieredCompactor(spark, scratch(spark, f"compact-{dataset}")).run(table(spark, d, dataset), parts, "report_id")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    found = []
    for name in P6_SETS:
        kept = p6_compacted(spark, d, name).select("part_file", "row_no")
        stored = table(spark, d, name).select("part_file", "row_no")
        found.append(stored.join(kept, ["part_file", "row_no"], "left_anti").select(F.lit(name).alias("dataset"), "part_file", "row_no"))
    return reduce(DataFrame.unionByName, found).distinct()


def p6_files(spark: SparkSession, d: str) -> DataFrame:
    """Rows of both datasets before and after compaction."""
    out = []
    for name in P6_SETS:
        after = p6_compacted(spark, d, name).agg(F.count("*").alias("n_after"), F.countDistinct(F.trim("report_id")).alias("n_reports"))
        before = table(spark, d, name).agg(F.count("*").alias("n_before"))
        out.append(after.join(before).select(F.lit(name).alias("dataset"), "n_before", "n_after", "n_reports"))
    return reduce(DataFrame.unionByName, out)


def p6_levels(spark: SparkSession, d: str) -> DataFrame:
    """Files and bytes that each merge of the two datasets took and made, level by level."""
    out = []
    for name in P6_SETS:
        c = SizeTieredCompactor(spark, scratch(spark, f"compact-{name}"))
        c.run(table(spark, d, name), table(spark, d, "part_files").where(F.col("dataset") == name), "report_id")
        out.append(c.levels().select(F.lit(name).alias("dataset"), "*"))
    return reduce(DataFrame.unionByName, out)


def p6_increments(spark: SparkSession, d: str) -> DataFrame:
    """Both datasets in two deliveries of parts, the second merged into what the first left: rows, reports and finished parts, and how many parts were merged more than once."""
    out = []
    for name in P6_SETS:
        rows, parts = table(spark, d, name), table(spark, d, "part_files").where(F.col("dataset") == name)
        cut = parts.agg(F.percentile_approx("written_at", 0.5).alias("m")).first().m
        early = parts.where(F.col("written_at") <= cut) if cut is not None else parts
        c = SizeTieredCompactor(spark, scratch(spark, f"increments-{name}"))
        c.run(rows.join(early.select("part_file").distinct(), "part_file", "left_semi"), early, "report_id")
        kept = c.run(rows, parts, "report_id").agg(F.count("*").alias("n_after"), F.countDistinct(F.trim("report_id")).alias("n_reports"))
        taken = spark.read.parquet(*[x["inputs"] for x in c.journal()]).join(parts.select(F.col("part_file").alias("_unit")).distinct(), "_unit", "left_semi")
        times = taken.groupBy("_unit").agg(F.count("*").alias("n")).agg(F.count("*").alias("n_parts"), F.count_if(F.col("n") > 1).alias("merged_again"))
        out.append(kept.join(times).select(F.lit(name).alias("dataset"), "n_after", "n_reports", "n_parts", "merged_again"))
    return reduce(DataFrame.unionByName, out)


P6_SQL = """
with s as (select 'smiley_analyze' dataset, part_file, row_no, trim(report_id) k from smiley_analyze
           union all select 'smiley_translate', part_file, row_no, trim(report_id) from smiley_translate),
w as (select s.*, p.written_at, row_number() over (partition by s.dataset, s.k, s.part_file like '%.tmp' order by p.written_at desc, s.part_file desc, s.row_no desc) n
      from s left join part_files p on p.dataset = s.dataset and p.part_file = s.part_file)
select dataset, part_file, row_no from w where part_file like '%.tmp' or n > 1
"""
P6_FILES_SQL = """
select dataset, n_before, n_reports n_after, n_reports from (
select 'smiley_analyze' dataset, count(*) n_before, count(distinct trim(report_id)) filter (part_file not like '%.tmp') n_reports from smiley_analyze
union all select 'smiley_translate', count(*), count(distinct trim(report_id)) filter (part_file not like '%.tmp') from smiley_translate)
"""

P6_INCREMENTS_SQL = """
select dataset, n_reports n_after, n_reports, (select count(distinct part_file) from part_files p where p.dataset = x.dataset and part_file not like '%.tmp') n_parts, 0::bigint merged_again from (
select 'smiley_analyze' dataset, count(distinct trim(report_id)) filter (part_file not like '%.tmp') n_reports from smiley_analyze
union all select 'smiley_translate', count(distinct trim(report_id)) filter (part_file not like '%.tmp') from smiley_translate) x
"""

QUERIES = {"p1_found": p1_found, "p1_unreadable": p1_unreadable, "p3_found": p3_found, "p5_found": p5_found, "p6_found": p6_found, "p6_files": p6_files, "p6_levels": p6_levels, "p6_increments": p6_increments}
SQL = {"p1_found": P1_SQL, "p1_unreadable": P1_UNREADABLE_SQL, "p3_found": P3_SQL, "p5_found": P5_SQL, "p6_found": P6_SQL, "p6_files": P6_FILES_SQL, "p6_increments": P6_INCREMENTS_SQL}
