"""Status aggregates, rates over a trailing window, and projections."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeline.functions.text import error_signature
from lakeline.operators.findings import has_remarks
from lakeline.session import materialise

RING = 90  # samples that rates are taken over


def extract_stats(extract: DataFrame) -> DataFrame:
    total = lambda c: F.coalesce(F.sum(F.col(c).cast("long")), F.lit(0))
    return extract.agg(
        F.count_if(F.col("doc_type") == "report").alias("reports"), F.count_if(F.col("doc_type") == "placard").alias("placards"),
        total("has_pest").alias("pest"), total("has_indskaerpelse").alias("injunctions"), total("has_gebyr").alias("fees"),
    )


def analyze_stats(findings: DataFrame) -> DataFrame:
    return findings.agg(
        F.coalesce(F.sum(F.col("actual_pest").cast("long")), F.lit(0)).alias("actual_pest"), F.count_if(F.col("severity") == "serious").alias("serious"),
        F.count_if(F.col("severity") == "remarks").alias("remarks"), F.count_if(F.col("max_enforcement").isin("fine", "police", "ban")).alias("enforced"),
    )


def to_analyze(extract: DataFrame) -> DataFrame:
    return extract.where(has_remarks()).agg(F.count("*").alias("to_analyze"))


def top_errors(items: DataFrame, most: int = 10) -> DataFrame:
    """(key, count) of the most frequent kinds of error of failed and skipped items; ties by name."""
    bad = items.where(F.col("status").isin("failed", "skipped") & F.col("error").isNotNull())
    return bad.groupBy(error_signature(F.col("error")).alias("key")).agg(F.count("*").alias("count")).orderBy(F.desc("count"), "key").limit(most)


def status_document(items: DataFrame, extract: DataFrame, findings: DataFrame, memo: DataFrame, total_businesses: int, pdf_bytes: int, now: float, running: dict[str, bool] | None = None) -> DataFrame:
    """The status as one nested row; every part is an aggregate of one row."""
    n = lambda p, s: F.count_if((F.col("pipeline") == p) & (F.col("status") == s))
    queue = items.agg(
        F.struct(n("smiley_business", "done").alias("done"), n("smiley_business", "failed").alias("failed"), F.lit(total_businesses).cast("long").alias("total")).alias("businesses"),
        F.struct(*[n("smiley_report", s).alias(s) for s in ("done", "pending", "failed", "skipped")]).alias("reports"),
        F.struct(n("smiley_report", "done").alias("count"), F.lit(pdf_bytes).cast("long").alias("bytes")).alias("pdfs"),
        n("smiley_extract", "done").alias("extracted"), n("smiley_analyze", "done").alias("analyzed"),
        n("smiley_overlay", "done").alias("o_done"), n("smiley_overlay", "skipped").alias("o_skipped"),
    )
    memo_stats = memo.agg(F.count("*").alias("cache_lines"), F.coalesce(F.sum("hits"), F.lit(0)).alias("cache_reuses"))
    errors = top_errors(items).agg(F.transform(F.reverse(F.array_sort(F.collect_list(F.struct("count", "key")))), lambda x: F.struct(x["key"].alias("key"), x["count"].alias("count"))).alias("errors"))
    ext = extract_stats(extract).select(F.struct("*").alias("e"))
    one = queue.join(ext).join(analyze_stats(findings)).join(to_analyze(extract)).join(memo_stats).join(errors)
    flags = [F.lit(bool((running or {}).get(k))).alias(f"{k}_running") for k in ("harvest", "extract", "analyze", "overlay")]
    return one.select(
        F.lit(now).alias("updated_at"), *flags, "businesses", "reports", "pdfs", F.struct("e.*", "extracted").alias("extract"),
        F.struct("actual_pest", "serious", "remarks", "enforced", "to_analyze", "analyzed").alias("analyze"),
        F.struct(F.col("o_done").alias("done"), F.col("o_skipped").alias("skipped"), "cache_lines", "cache_reuses").alias("overlay"), "errors",
    )


class LastGood:
    """An aggregate that is computed again after ``every`` seconds; while that fails the last good value stays."""

    def __init__(self, compute: Callable[[], object], every: float, clock: Callable[[], float] = time.monotonic):
        self.compute, self.every, self.clock = compute, every, clock
        self.value: object | None = None
        self.error: str | None = None
        self._at: float | None = None

    def __call__(self) -> object | None:
        if self._at is None or self.clock() - self._at >= self.every:
            self._at = self.clock()
            try:
                self.value, self.error = self.compute(), None
            except Exception as e:  # noqa: BLE001 - whatever fails, the last value is better than none
                self.error = f"{type(e).__name__}: {e}"[:200]
        return self.value


def clean_history(history: DataFrame, by: list[str] = ()) -> DataFrame:
    """Samples without a time, and repeats of the sample before in their series, are dropped."""
    w = Window.partitionBy(*by).orderBy("t") if by else Window.orderBy("t")
    return history.where("t <> 0").withColumn("_p", F.lag("t").over(w)).where("_p is null or t <> _p").drop("_p")


def rates(history: DataFrame, by: list[str] = (), ring: int = RING) -> DataFrame:
    """Rates between the first and last of the trailing ``ring`` samples of each series."""
    w = Window.partitionBy(*by).orderBy("t") if by else Window.orderBy("t")
    w = w.rowsBetween(-(ring - 1), 0)
    first = {c: F.first(c).over(w) for c in history.columns if c not in by}
    dt = F.col("t") - first["t"]

    def rate(c: str, digits: int, scale: float = 1.0) -> Column:
        return F.when(dt > 0, F.bround((F.col(c) - first[c]) / dt / scale, digits)).otherwise(F.lit(0.0))

    return history.withColumns({
        "report_rate_per_s": rate("reports_done", 2), "throughput_mb_per_s": rate("pdf_bytes", 2, 1e6), "extract_rate_per_s": rate("extracted", 1),
        "analyze_rate_per_s": rate("analyzed", 1), "overlay_rate_per_s": rate("overlay_done", 2),
    })


def seconds_left(remaining: Column, rate: Column) -> Column:
    return F.when((rate > 0) & (remaining > 0), F.greatest((remaining / F.nullif(rate, F.lit(0.0))).cast("long"), F.lit(0).cast("long")))


def remaining_work(done: Column, pending: Column, failed: Column, skipped: Column, b_done: Column, b_failed: Column, b_total: Column, default_yield: float = 0.0) -> tuple[Column, Column]:
    """(requests still to make, final number of reports): businesses not yet seen yield as many reports as those seen, on average."""
    per = F.coalesce((done + pending + failed + skipped) / F.nullif(b_done, F.lit(0)), F.lit(default_yield))
    unseen = F.greatest(F.lit(0), b_total - b_done) + b_failed
    return pending + failed + unseen * (1 + per), (done + pending + failed + F.bround(per * unseen, 0)).cast("long")


def projections(s: DataFrame) -> DataFrame:
    """Totals and seconds left by stage, from columns done, pending, failed, skipped, b_done, b_failed, b_total, extracted, to_analyze, analyzed, to_overlay, o_done, o_skipped and the rates.

    No stage ends before the harvest it depends on.
    """
    c = F.col
    left, final = remaining_work(c("done"), c("pending"), c("failed"), c("skipped"), c("b_done"), c("b_failed"), c("b_total"))
    s = s.withColumns({"est_total_reports": final, "eta_seconds": seconds_left(left, c("report_rate_per_s"))})
    harvest = F.coalesce("eta_seconds", F.lit(0))
    after = lambda eta: F.when(eta.isNotNull(), F.greatest(eta, harvest))
    share = lambda a, default: F.coalesce(c(a) / F.nullif(c("extracted"), F.lit(0)), F.lit(default))
    s = s.withColumns({"analyze_total": F.bround(share("to_analyze", 0.0) * c("est_total_reports"), 0).cast("long"), "overlay_total": F.bround(share("to_overlay", 1.0) * c("est_total_reports"), 0).cast("long")})
    extract = seconds_left(c("est_total_reports") - c("extracted"), c("extract_rate_per_s"))
    return s.withColumns({
        "extract_eta_seconds": F.when(extract.isNotNull(), F.greatest(extract, harvest)).when(c("est_total_reports") > c("extracted"), F.nullif(harvest, F.lit(0))),
        "analyze_eta_seconds": after(seconds_left(c("analyze_total") - c("analyzed"), c("analyze_rate_per_s"))),
        "overlay_eta_seconds": after(seconds_left(c("overlay_total") - c("o_done") - c("o_skipped"), c("overlay_rate_per_s"))),
    })


def display(s: DataFrame, now: float, stale_after: float = 15.0) -> DataFrame:
    """What a page shows: whether the snapshot is stale, what is left, and how far the bar is."""
    share = F.when(F.col("total") > 0, F.lit(100.0) * F.col("done") / F.nullif(F.col("total"), F.lit(0))).otherwise(0.0)
    return s.withColumns({
        "stale": F.lit(now) - F.col("updated_at") > stale_after,
        "remaining": F.greatest(F.lit(0), F.col("total") - F.col("done") - F.coalesce("skipped", F.lit(0))), "bar": F.least(F.lit(100.0), F.greatest(F.lit(0.0), share)),
    })


def service_up(running: Column, updated_at: Column, now: float, fresh: float = 10.0) -> Column:
    return F.coalesce(running & (updated_at != 0) & (F.lit(now) - updated_at < fresh), F.lit(False))


def enriched(status: DataFrame, derived: DataFrame, rss: DataFrame, control: dict, now: float) -> DataFrame:
    """One row: the status with derived figures, feed archive, services, controls and the server's time."""
    up = lambda name: F.struct(F.lit(name).alias("name"), service_up(F.col(f"{name}_running"), F.col("updated_at"), now).alias("up"))
    one = lambda df, name: df.select(F.struct("*").alias(name))
    services = F.array(*[up(n) for n in ("harvest", "extract", "analyze", "overlay")]).alias("services")
    values = F.struct(*[F.lit(v).alias(k) for k, v in control.items()]).alias("control")
    return status.select("*", services).join(one(derived, "derived")).join(one(rss, "rss")).select("*", values, F.lit(bool(control.get("paused"))).alias("paused"), F.lit(now).alias("server_now"))


def numbered(df: DataFrame, by: list[str], order: list[str], out: str = "_n") -> DataFrame:
    """Number the rows of each series from 1 without gathering a series in one task: ranges are counted, and the counts summed up."""
    part = F.spark_partition_id().alias("_part")
    ranged = materialise(df.repartitionByRange(*by, *order).select("*", part), "ranges")  # a hot series is spread over ranges of its order
    counts = ranged.groupBy(*by, "_part").agg(F.count("*").alias("_c"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(*by, "_part", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_base"))  # a row for each series and range
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*by, "_part")]
    inside = ranged.withColumn("_i", F.row_number().over(Window.partitionBy(*by, "_part").orderBy(*order)))
    return inside.alias("r").join(base.alias("b"), same).select(*[f"r.{c}" for c in df.columns], (F.col("b._base") + F.col("r._i")).alias(out))


def breaker(outcomes: DataFrame, by: list[str], order: list[str], failed: Column, window: int = 40, least: int = 20, trip: float = 0.5, segment: int = 100_000) -> DataFrame:
    """Adds ``ratio`` of failures among the last ``window`` outcomes and ``is_open``: once it trips it stays open.

    A series is cut into segments of ``segment`` rows; each also gets the last window - 1 rows of the one before. ``order`` must tell all rows of a series apart.
    """
    rows = numbered(outcomes.withColumn("_bad", failed.cast("int")), by, order)
    seg = F.floor((F.col("_n") - 1) / segment)
    carried = (F.col("_n") - 1) % segment >= segment - (window - 1)
    spread = rows.select("*", F.explode(F.when(carried, F.array(seg, seg + 1)).otherwise(F.array(seg))).alias("_seg"))
    w = Window.partitionBy(*by, "_seg").orderBy("_n")
    last = w.rowsBetween(-(window - 1), 0)
    seen = spread.withColumn("ratio", F.avg("_bad").over(last)).withColumn("_trip", (F.least(F.col("_n"), F.lit(window)) >= least) & (F.col("ratio") >= trip)).where(F.col("_seg") == seg)
    first = seen.where("_trip").groupBy(*by).agg(F.min("_n").alias("_first"))
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"f.{c}")) for c in by]
    return seen.alias("s").join(first.alias("f"), same, "left").select(*[f"s.{c}" for c in outcomes.columns], "s.ratio", F.coalesce(F.col("s._n") >= F.col("f._first"), F.lit(False)).alias("is_open"))


def run_counters(outcomes: DataFrame) -> DataFrame:
    """One row over (problem, attempts, cache_hits, calls): results and shares in percent."""
    bad = F.col("problem").isNotNull()
    g = outcomes.agg(
        F.count_if(~bad).alias("ok"), F.count_if(bad & (F.col("attempts") + 1 < 3)).alias("err"), F.count_if(bad).alias("skip"),
        F.coalesce(F.sum("cache_hits"), F.lit(0)).alias("cache_hits"), F.coalesce(F.sum("calls"), F.lit(0)).alias("calls"),
    )
    return g.withColumn("hit_pct", F.lit(100.0) * F.col("cache_hits") / F.greatest(F.lit(1), F.col("cache_hits") + F.col("calls")))
