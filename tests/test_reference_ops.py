"""Literal rows for the engine's own operators; expected values are worked out by hand."""

import json

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeline import schemas
from lakeline.functions import text as tx
from lakeline.functions import urls
from lakeline.operators import control, findings, layout, memo, metrics, news, registry, snapshots, state, template
from lakeline.sources import fs, tables
from lakeline.streaming import stream


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr(F.col("x")).alias("y")).first().y


# --- text ------------------------------------------------------------------------------------------


def test_flags_follow_unicode(spark):
    flags = lambda t: spark.createDataFrame([(t,)], "t string").select(tx.pest(F.col("t")).alias("pest"), *[v.alias(k) for k, v in tx.enforcement_flags(F.col("t")).items()]).first().asDict()
    assert flags("PÅBUD og BØDE")["has_paabud"] and flags("PÅBUD og BØDE")["has_boede"]
    assert flags("Spor af mus.")["pest"] and not flags("åmus")["pest"] and flags("Rotterne")["pest"]
    assert not flags("bøder")["has_boede"] and flags("INDSKÆRPET")["has_indskaerpelse"]
    assert flags("registrering er inddraget")["has_autorisation_frataget"] and not flags("")["pest"]


def test_sections(spark):
    t = "Intro\nHygiejne: a \n Import : b\nHygiejne : c\nAndet uden kolon Andet:  d"
    assert one(spark, t, tx.sections) == {"Hygiejne": "Hygiejne: a Hygiejne : c", "Import": "Import : b", "Andet": "Andet:  d"} or one(spark, t, tx.sections)["Hygiejne"] == "Hygiejne: a Hygiejne : c\nAndet uden kolon"
    assert one(spark, "nothing here", tx.sections) == {} and one(spark, "", tx.sections) == {} and one(spark, None, tx.sections) is None
    assert one(spark, "Hygiejne", tx.sections) == {"Hygiejne": "Hygiejne"}  # a text that begins with a header word


def test_scalars(spark):
    assert one(spark, "xx gå til https://findsmiley yy", tx.doc_type) == "placard" and one(spark, "x", tx.doc_type) == "report"
    assert one(spark, "  a  b \u001c c ", tx.memo_key) == "a b c"
    assert one(spark, "Ærø-Å 12!", tx.label_key) == "aeroa12"
    cases = {None: "unknown", "": "unknown", "HTTP  404 x": "HTTP 404", "not a PDF (x)": "invalid id (HTML 'Fejl' page)", "Read TIMEOUT": "timeout", "timed out": "timeout", "Timed out": "Timed out", "Connection reset": "connection error", "x" * 60: "x" * 40}
    for k, v in cases.items():
        assert one(spark, k, tx.error_signature) == v
    assert [one(spark, n, tx.bytes_text, "long") for n in (0, 1023, 1024, 1536, 5 << 30, 3 << 50)] == ["0 B", "1023.0 B", "1.0 KB", "1.5 KB", "5.0 GB", "3072.0 TB"]
    assert [one(spark, n, tx.duration_text, "double") for n in (None, 0.4, 61.0, 3700.0, 90000.0)] == ["–", "0s", "1m 1s", "1h 1m", "1d 1h"]
    assert [one(spark, n, tx.ago_text, "long") for n in (None, 59, 60, 3600)] == ["never", "59s ago", "1m ago", "1h ago"]
    assert one(spark, 3, lambda x: tx.percent(x, F.lit(0)), "int") == 0 and one(spark, 3, lambda x: tx.percent(x, F.lit(4)), "int") == 75


def test_urls(spark):
    assert one(spark, "7", urls.shard) == "007" and one(spark, "12345", lambda x: urls.sharded_path("/p", x)) == "/p/345/12345.pdf"
    assert one(spark, "/a/b.c/12.tar.gz", urls.stem) == "12.tar" and one(spark, "http://h/a/f.xlsx?v=1", urls.basename) == "f.xlsx"
    base = "https://h.example/a/b.html?q"
    got = [one(spark, h, lambda x: urls.absolute(F.lit(base), x)) for h in ("c.xml", "/c.xml", "//o.example/c", "http://z/y", "?p")]
    assert got == ["https://h.example/a/c.xml", "https://h.example/c.xml", "https://o.example/c", "http://z/y", "https://h.example/a/b.html?p"]
    html = "<a href='one.XLSX'>1</a><a class=x href=\"/two-Smiley.xlsx?v=1\">2</a><A HREF='t.xml'>3</A><a href='k.pdf'>4</a>"
    pages = spark.createDataFrame([(base, html), ("https://e.example", ""), ("https://n.example", None)], schemas.PAGES)
    assert {(r.kind, r.href) for r in urls.download_links(pages).collect()} == {("xlsx", "https://h.example/two-Smiley.xlsx?v=1"), ("xml", "https://h.example/a/t.xml")}
    assert one(spark, "kontrolrapport.ASPX?virk12 KontrolRapport.aspx?Virk2 KontrolRapport.aspx?Virk12", urls.report_ids) == ["12", "2"]


# --- findings --------------------------------------------------------------------------------------


@pytest.mark.parametrize("found,want", [
    (None, ("no_remarks", 0, 0, False, "none")), ([], ("no_remarks", 0, 0, False, "none")),
    ([("pest", True, "order", True)], ("no_remarks", 1, 0, False, "none")), ([("pest", True, "order", None)], ("remarks", 1, 1, True, "order")),
    ([("other", True, "ban", False), ("pest", False, "police", False)], ("serious", 2, 1, False, "ban")), ([("other", True, "strange", False)], ("minor", 1, 1, False, "none")),
    ([("other", True, "guidance", False), (None, True, None, False)], ("minor", 2, 2, False, "guidance")), ([("pest", None, "fine", False)], ("no_remarks", 1, 0, False, "none")),
])
def test_severity(spark, found, want):
    f = None if found is None else [(c, None, a, None, e, r) for c, a, e, r in found]
    r = findings.derive(spark.createDataFrame([(f,)], f"findings array<{schemas.FINDING}>")).first()
    assert (r.severity, r.n_findings, r.n_actual_findings, r.actual_pest, r.max_enforcement) == want


# --- keyed state -----------------------------------------------------------------------------------


def fold_by_hand(events):
    out = {}
    for e in sorted(events, key=lambda e: (e["updated_at"], e["seq"])):
        s = out.setdefault((e["pipeline"], e["key"]), {"status": None, "sha256": None, "path": None, "meta": None, "error": None, "attempts": 0, "updated_at": None})
        s["status"], s["updated_at"] = e["status"], e["updated_at"]
        if e["kind"] == "upsert":
            s["error"] = e["error"]
            for c in ("sha256", "path", "meta"):
                s[c] = e[c] if e[c] is not None else s[c]
        s["attempts"] += int(bool(e["bump"]))
    return out


event = st.fixed_dictionaries({
    "pipeline": st.just("p"), "key": st.sampled_from("ab"), "kind": st.sampled_from(["upsert", "touch"]), "status": st.sampled_from(["pending", "done", "failed"]),
    "sha256": st.sampled_from([None, "x", "y"]), "path": st.sampled_from([None, "q"]), "error": st.sampled_from([None, "e"]), "meta": st.none(), "bump": st.sampled_from([True, False, None]), "updated_at": st.sampled_from([1.0, 2.0, 3.0]),
})


@settings(max_examples=4, deadline=None)
@given(st.lists(event, min_size=1, max_size=12))
def test_fold_and_merge(spark, events):
    events = [e | {"seq": i} for i, e in enumerate(events)]
    cols = schemas.ITEM_EVENTS.fieldNames()
    df = spark.createDataFrame([tuple(e[c] for c in cols) for e in events], schemas.ITEM_EVENTS)
    want = fold_by_hand(events)
    got = {(r.pipeline, r.key): {k: v for k, v in r.asDict().items() if k not in ("pipeline", "key")} for r in state.fold_items(df).collect()}
    assert got == want
    early = df.where("updated_at < 2.0")
    merged = {(r.pipeline, r.key): {k: v for k, v in r.asDict().items() if k not in ("pipeline", "key")} for r in state.merge_items(state.fold_items(early), df.where("updated_at >= 2.0")).collect()}
    assert merged == want


def test_queue(spark):
    rows = [(1, "p", "b", "failed", None, None, 2, None, '{"navnelbnr": "7"}', 1.0, 1.0), (2, "p", "a", "pending", None, None, 0, None, "{broken", 1.0, 1.0), (3, "p", "c", "done", None, "x", 0, None, None, 1.0, 1.0), (3, "p", "c", "done", None, "x", 0, None, None, 1.0, 1.0)]
    items = state.latest_items(spark.createDataFrame(rows, schemas.ITEMS))
    assert [r.key for r in state.pending(items, "p").collect()] == ["a", "b"] and state.pending(items, "p", 1).count() == 1 and state.pending(items, "p", 0).count() == 2
    assert [r.key for r in state.with_file(items).collect()] == ["c"]
    assert {r.key: r.n for r in items.select("key", state.parent_key(F.col("meta")).alias("n")).collect()} == {"a": None, "b": "7", "c": None}
    src = spark.createDataFrame([("c",), ("d",), (None,)], "key string")
    assert {r.key for r in state.todo(src, state.done_keys(items, "p"), "key").collect()} == {"d", None}
    new = state.discovery_events(spark.createDataFrame([("c", None), ("z", "{}"), ("z", "{}")], "key string, meta string"), items, "p", F.lit(9.0))
    assert [(r.key, r.status) for r in new.collect()] == [("z", "pending")]
    codes = spark.createDataFrame([(200, True, False), (200, False, False), (404, False, False), (429, None, False), (503, None, False), (None, None, True)], "c int, p boolean, e boolean")
    assert [r[0] for r in codes.select(state.outcome_status(F.col("c"), F.col("p"), F.col("e"))).collect()] == ["done", "skipped", "skipped", "failed", "failed", "failed"]
    assert [one(spark, n, state.retry_status, "int") for n in (0, 1, 2, 9)] == ["failed", "failed", "skipped", "skipped"]


def test_snapshots(spark):
    rows = [(1, "s", "k", 1.0, "u", "p", "A", 1, True), (2, "s", "k", 2.0, "u", "p", "A", 1, True), (3, "s", "k", 3.0, "u", "p", "B", 1, False), (4, "s", "k", 4.0, "u", "p", "A", 1, True), (4, "s", "k", 4.0, "u", "p", "A", 1, True), (5, "t", "k", 0.0, "u", None, "A", 1, True)]
    log = spark.createDataFrame(rows, schemas.SNAPSHOTS)
    assert {r.snap_id: r.is_changed for r in snapshots.with_change(log).collect()} == {1: True, 2: False, 3: True, 4: True, 5: True}
    assert {(r.source, r.sha256) for r in snapshots.latest_version(log).collect()} == {("s", "A"), ("t", "A")}
    files = spark.createDataFrame([("u", "p", bytearray(b"new"))], "url string, path string, content binary")
    assert snapshots.snapshot_row(files, log, 9.0, "s", "k").first().changed


# --- memo ------------------------------------------------------------------------------------------


def test_memo_first_value_stays_and_hits_count_further_puts(spark):
    m = spark.createDataFrame([("a", "A", "one", 2)], "k string, da string, en string, hits long")
    pairs = spark.createDataFrame([("a", "A", "two", 1), ("b", "B", "x", 3), ("b", "B", "y", 2), ("c", "C", None, 0)], "k string, da string, en string, seq long")
    assert {(r.k, r.en, r.hits) for r in memo.merge(m, pairs).collect()} == {("a", "one", 3), ("b", "y", 1), ("c", None, 0)}
    assert memo.stats(m).first().reuses == 2 and memo.stats(m.limit(0)).first().reuses == 0


def test_translate_asks_for_each_missing_text_once_and_splits_failing_batches(spark, tmp_path):
    log = str(tmp_path / "asked")

    def provider(texts):
        if len(texts) > 1 and "bad" in texts:
            raise ValueError
        with open(log, "a") as f:
            f.write("\n".join(texts) + "\n")
        return [None if t == "bad" else t.upper() for t in texts]

    lines = spark.createDataFrame([(i, t) for i, t in enumerate(["x  y", " x y ", "known", "bad", None, "", "z"])], "i int, text string").coalesce(1)
    m = spark.createDataFrame([("known", "known", "KEPT", 0)], "k string, da string, en string, hits long")
    out, pairs = memo.translate(lines, m, provider)
    got = {r.i: r.en for r in out.collect()}
    assert got[0] == got[1] and got[0].split() == ["X", "Y"] and (got[2], got[3], got[4], got[5], got[6]) == ("KEPT", "bad", None, "", "Z")
    assert sorted(open(log).read().split("\n")).count("z") == 1
    replies = spark.createDataFrame([(1, "a", 0), (1, "b", 1), (9, "q", 0)], "id int, en string, pos int")
    req = spark.createDataFrame([(1, "t1"), (2, "t2")], "id int, text string")
    assert {(r.id, r.en) for r in memo.reply_by_id(req, replies).collect()} == {(1, "b"), (2, "t2")}
    blocks = spark.createDataFrame([("r", 2, 0, "c"), ("r", 1, 1, "b"), ("r", 1, 0, "a")], "report_id string, page int, idx int, en string")
    assert memo.report_texts(blocks).first().text_en == "a\nb\n\nc"


# --- news, metrics ---------------------------------------------------------------------------------


def test_new_articles(spark):
    entries = [("s", "", "t", None, "l", None, "u", 1.0, 1), ("s", "l", "again", None, None, None, None, 1.0, 2), ("o", "l", "t", None, None, "p", "u", 1.0, 3), ("s", None, None, None, None, None, None, 1.0, 4)]
    e = spark.createDataFrame(entries, schemas.FEED_ENTRIES)
    none = spark.createDataFrame([], schemas.ARTICLES)
    new = news.insert_new(none, e)
    assert {(r.source, r.entry_id, r.published) for r in new.collect()} == {("s", "l", "u"), ("o", "l", "p"), ("s", "", None)}
    assert news.insert_new(new, e).count() == 0
    assert news.archive_stats(none, None, 5.0).first().archive_age_s is None


def test_history_and_projections(spark):
    h = spark.createDataFrame([(0.0, 0, 0, 0, 0, 0), (10.0, 5, 0, 1, 0, 0), (10.0, 5, 0, 1, 0, 0), (20.0, 31, 25_000_000, 4, 2, 1)], schemas.STATUS_HISTORY)
    r = metrics.rates(metrics.clean_history(h)).orderBy("t").collect()
    assert len(r) == 2 and r[0].report_rate_per_s == 0 and (r[1].report_rate_per_s, r[1].throughput_mb_per_s, r[1].extract_rate_per_s) == (2.6, 2.5, 0.3)
    cols = ["done", "pending", "failed", "skipped", "b_done", "b_failed", "b_total", "extracted", "to_analyze", "analyzed", "to_overlay", "o_done", "o_skipped"]
    row = [40, 10, 5, 5, 10, 1, 20, 20, 10, 5, 15, 3, 1]
    df = spark.createDataFrame([tuple(row)], ", ".join(f"{c} long" for c in cols)).withColumns({"report_rate_per_s": F.lit(2.0), "extract_rate_per_s": F.lit(100.0), "analyze_rate_per_s": F.lit(0.0), "overlay_rate_per_s": F.lit(1.0)})
    p = metrics.projections(df).first()
    # 60 reports of 10 businesses: 6 each; 11 to come: 55 + 66 = 121 reports in the end; (15 + 11 * 7) / 2 = 46 s.
    assert (p.est_total_reports, p.eta_seconds, p.extract_eta_seconds, p.analyze_total, p.analyze_eta_seconds, p.overlay_total, p.overlay_eta_seconds) == (121, 46, 46, 60, None, 91, 87)
    assert metrics.projections(df.withColumn("b_done", F.lit(0))).first().est_total_reports == 55
    s = spark.createDataFrame([(10, 4, 3, 100.0), (0, 4, None, 1.0)], "total long, done long, skipped long, updated_at double")
    assert [(x.stale, x.remaining, x.bar) for x in metrics.display(s, 110.0).collect()] == [(False, 3, 40.0), (True, 0, 0.0)]


def test_breaker_stays_open(spark):
    df = spark.createDataFrame([("a", i, i < 15) for i in range(120)], "k string, i int, bad boolean")
    r = metrics.breaker(df, ["k"], ["i"], F.col("bad")).orderBy("i").collect()
    assert not r[18].is_open and r[19].is_open and r[119].is_open and r[119].ratio == 0


# --- layout ----------------------------------------------------------------------------------------


def line(i, text, x0, y0, x1, size=10.0, color=0, bold=False, page=1):
    return ("r", page, i, 600.0, 800.0, text, x0, y0, x1, y0 + 10, size, color, bold, y0 + 8)


def test_paragraphs_columns_room(spark):
    rows = [
        line(0, "Navn", 50.0, 20.0, 100.0), line(1, "Adresse", 50.0, 32.0, 120.0),  # short lines never merge
        line(2, "En lang linje med tekst", 50.0, 100.0, 400.0), line(3, "og resten", 50.0, 112.0, 150.0), line(4, "ny afsnit", 50.0, 136.0, 400.0, color=0), line(5, "farvet", 50.0, 148.0, 400.0, color=9),
        line(6, "Fod", 60.0, 500.0, 90.0), line(7, "12 345", 50.0, 700.0, 90.0), line(8, "anden side", 50.0, 10.0, 400.0, page=2),
    ]
    lines = layout.paragraphs(layout.text_lines(spark.createDataFrame(rows, schemas.PAGE_LINES)))
    assert [r.para for r in lines.where("page = 1").orderBy("idx").collect()] == [0, 1, 2, 2, 3, 4, 5]
    plan = {(r.page, r.block): r for r in layout.plan(spark.createDataFrame(rows, schemas.PAGE_LINES)).collect()}
    texts = [plan[1, b].text for b in range(5)]
    assert texts == ["Navn", "Adresse", "En lang linje med tekst og resten\nny afsnit", "farvet", "Fod"]
    assert plan[1, 2].bottom == 146.0 and plan[1, 3].bottom == 498.0 and plan[1, 4].bottom == 780.0 and plan[2, 0].bottom == 780.0
    assert plan[1, 2].pitch == 24.0 and plan[1, 2].n_lines == 3 and plan[1, 2].slots == 3 and plan[1, 0].pitch == 0


def test_wrap_and_fit():
    assert layout.wrap("aa bb cc", 2.0, 5.0) == ["aa bb", "cc"] and layout.wrap("", 2.0, 5.0) == []
    assert layout.wrap("x abcdefgh yz", 2.0, 3.0) == ["x", "abc", "def", "gh", "yz"]
    size, lines = layout.fit("aaaa bbbb cccc dddd", 11.0, 45.0, 2)
    assert len(lines) <= 2 and 4 <= size < 11
    assert layout.fit("word " * 200, 11.0, 20.0, 1)[0] == 4.0
    assert layout.fit("a\n\nb", 10.0, 100.0, 5)[1] == ["a", "b"]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab cdef", max_size=60), st.floats(4, 12), st.floats(3, 80))
def test_wrap_loses_nothing(text, size, width):
    lines = layout.wrap(text, size, width)
    assert "".join("".join(lines).split()) == "".join(text.split())
    assert all(len(x) == 1 or layout.even_width(x) * size <= width + 1e-6 for x in lines)


def test_place(spark):
    rows = [("r", 1, 0, "to linjer her", 10.0, 40.0, 3, 12.0, 100.0, 5.0), ("r", 1, 1, "kort", 10.0, 400.0, 1, 0.0, 50.0, 5.0), ("r", 1, 2, " ", 10.0, 400.0, 1, 0.0, 50.0, 5.0)]
    df = spark.createDataFrame(rows, "report_id string, page int, block long, en string, size double, width double, slots long, pitch double, baseline0 double, x0 double")
    got = {(r.block, r.k): (r.line, r.y) for r in layout.place(df).collect()}
    assert got[0, 0] == ("to", 100.0) and got[0, 1] == ("linjer", 112.0) and got[0, 2] == ("her", 124.0) and got[1, 0] == ("kort", 50.0) and len(got) == 4


# --- template --------------------------------------------------------------------------------------


def test_pixels(spark):
    """A 20 x 12 box: green ground, a white letter in rows 4-7, columns 5-9, a rule in row 10."""
    img = np.full((12, 20, 3), (0, 128, 0))
    img[4:8, 5:10] = 255
    img[10, :] = 0
    px = spark.createDataFrame([(1, x, y, *map(int, img[y, x])) for y in range(12) for x in range(20)], "box int, x int, y int, r int, g int, b int")
    fill = template.fills(px)
    assert tuple(fill.first()) == (1, 0, 128, 0)
    ink = template.inks(px, fill)
    assert tuple(ink.first()) == (1, 255, 255, 255)
    t = template.tight_boxes(px, fill).first()
    assert (t.y0, t.y1) == (3, 9) and (t.x0, t.x1) == (0, 20)  # the rule is no letter, but its columns are inked
    assert not template.is_bold(px, fill, ink).first().bold
    edges = spark.createDataFrame([(1, 10, 18)], "box int, x1 int, lim int")
    assert template.room_right(px.where("y between 4 and 7"), fill, edges).first().avail_x1 == 18
    assert template.room_right(px, fill, edges).first().avail_x1 == 10
    tie = spark.createDataFrame([(1, 0, 0, 9, 9, 9), (1, 1, 0, 0, 0, 0)], "box int, x int, y int, r int, g int, b int")
    assert tuple(template.fills(tie).first()) == (1, 0, 0, 0)


def test_labels_and_variants(spark):
    boxes = spark.createDataFrame([("Hygiejne", "Hygiene"), ("Øst 12", "Øst 12"), ("CVR", "Company no."), ("Dato", "Day")], "da string, en string")
    fixed = spark.createDataFrame([("dato", "Date")], "k string, fixed string")
    assert {(r.da, r.en) for r in template.labels(boxes, fixed, ["cvr"]).collect()} == {("Hygiejne", "Hygiene"), ("Dato", "Date")}
    g = np.add.outer(np.arange(96), np.arange(120)) % 97
    assert template.variant_key(g) == template.variant_key(g.astype(float) * 2) != template.variant_key(255 - g)
    seen = spark.createDataFrame([("v", "2"), ("v", "1"), ("w", "3"), ("k", "4")], "variant string, report_id string")
    specs = spark.createDataFrame([("k", 100, 200, 0.0, [([10, 20, 30, 40], "da", "en", 1.0, [0, 0, 0], [1, 1, 1], True, 80, None, 38.0)])], schemas.TEMPLATE_SPECS)
    assert [tuple(r) for r in template.unknown_variants(seen, specs).collect()] == [("v", 2, "1"), ("w", 1, "3")]
    pages = spark.createDataFrame([("r", 1, "k", 0.0, 0.0, 50.0, 100.0), ("r", 2, "x", 0.0, 0.0, 50.0, 100.0)], "report_id string, page int, variant string, rx0 double, ry0 double, rwidth double, rheight double")
    obstacles = spark.createDataFrame([("r", 1, 30.0, 12.0, 18.0), ("r", 1, 20.0, 50.0, 60.0), ("r", 2, 16.0, 12.0, 18.0)], "report_id string, page int, x0 double, y0 double, y1 double")
    p = template.patch_plan(pages, specs, obstacles).collect()
    assert len(p) == 1 and (p[0].x0, p[0].y0, p[0].x1, p[0].limit_x1, p[0].font_pt, p[0].baseline) == (5.0, 10.0, 15.0, 28.0, 10.0, 19.0)
    ids = spark.createDataFrame([(str(i),) for i in range(50)], "report_id string")
    assert template.sample(ids, 5).collect() == template.sample(ids.repartition(7), 5).collect() and template.sample(ids, 99).count() == 50


# --- control, sources, streams, registry -----------------------------------------------------------


def test_control(spark, tmp_path):
    p = f"file://{tmp_path}/control.json"
    assert control.read(spark, p).harvest_rate == 2.6
    c = control.set_values(spark, p, harvest_rate="99", analyze_concurrency="12.9", overlay_concurrency="x")
    assert (c.harvest_rate, c.analyze_concurrency, c.overlay_concurrency) == (10.0, 12, 8) and control.set_values(spark, p, paused=True).effective("harvest_rate") == 0
    fs.write_text(spark, p, "{broken")
    assert control.read(spark, p).analyze_concurrency == 32
    assert [one(spark, v, lambda x: control.clamp(x, 0, 128, 32, whole=True)) for v in ("12.9", "-4", "x", None, "1e9")] == [12, 0, 32, 32, 128]
    m = spark.createDataFrame([({"a": 1, "b": None}, {"a": 7, "b": 8, "c": 9}), (None, {"c": 9})], "d map<string,int>, f map<string,int>")
    assert [r[0] for r in m.select(control.overlay(F.col("d"), F.col("f"))).collect()] == [{"c": 9, "a": 1, "b": None}, {"c": 9}]
    req = spark.createDataFrame([("h", 0.0), ("h", 0.1), ("h", 5.0), ("h", 5.0)], "host string, t double")
    assert [round(r.start_at, 6) for r in control.paced(req, ["host"], "t", 2.0).orderBy("start_at").collect()] == [0.0, 0.5, 5.0, 5.5]


def test_sources(spark, tmp_path):
    root = f"file://{tmp_path}"
    t = spark.createDataFrame([("1", "7", "x")], schemas.TRANSLATIONS)
    tables.append_part(t, f"{root}/parts", schemas.TRANSLATIONS)
    tables.append_part(t, f"{root}/parts", schemas.TRANSLATIONS)
    assert tables.read_table(spark, f"{root}/parts", schemas.TRANSLATIONS).count() == 2
    spark.range(1).selectExpr("'1' report_id", "cast(null as int) navnelbnr", "cast(null as int) text_en").write.parquet(f"{root}/legacy/a.parquet")
    spark.createDataFrame([("1", "7", "t"), ("2", "8", "u")], schemas.TRANSLATIONS).write.parquet(f"{root}/legacy/b.parquet")
    assert tables.read_legacy_parts(spark, f"{root}/legacy/*.parquet", schemas.TRANSLATIONS, "report_id").count() == 2
    tables.write_snapshot(t, f"{root}/snap", "s", "2025-01-01")
    tables.write_snapshot(t, f"{root}/snap", "s", "2025-01-01")
    assert tables.read_snapshots(spark, f"{root}/snap").where("day = '2025-01-01'").count() == 1
    for n, b in (("a", b"%PDF one"), ("b", b"broken")):
        (tmp_path / f"{n}.pdf").write_bytes(b)
    size = tables.folder_size(spark, f"{root}/*.pdf").first()
    assert (size.files, size.bytes) == (2, 14)
    assert {r.report_id for r in tables.stored_ids(spark, f"{root}/*.pdf").collect()} == {"a", "b"}

    def parser(b):
        if not b.startswith(b"%PDF"):
            raise ValueError("not a PDF")
        return [b.decode(), "page 2"]

    got = {r.report_id: (r.text, r.n_pages, r.error) for r in tables.parse_documents(spark.read.format("binaryFile").load(f"{root}/*.pdf"), parser).collect()}
    assert got == {"a": ("%PDF one\npage 2", 2, None), "b": (None, None, "ValueError: not a PDF")}
    tables.write_document(spark.createDataFrame([(1, "æ")], "n int, s string"), f"{root}/doc.json")
    assert tables.read_document(spark, f"{root}/doc.json") == {"n": 1, "s": "æ"} and json.loads((tmp_path / "doc.json").read_text())["s"] == "æ"
    assert tables.read_document(spark, f"{root}/none.json", {"was": 1}) == {"was": 1}


def test_streams(spark, tmp_path):
    root = f"file://{tmp_path}"
    schema = spark.createDataFrame([], "id string, text string").schema
    spark.createDataFrame([("1", "mus"), ("2", "x")], schema).write.parquet(f"{root}/in")
    s = stream.file_stream(spark, f"{root}/in", schema)
    stream.drain(stream.flagged(s).select("id", "has_pest"), f"{root}/out", f"{root}/ck")
    spark.createDataFrame([("3", "rotter")], schema).write.mode("append").parquet(f"{root}/in")
    stream.drain(stream.flagged(s).select("id", "has_pest"), f"{root}/out", f"{root}/ck")
    assert {(r.id, r.has_pest) for r in spark.read.parquet(f"{root}/out").collect()} == {("1", True), ("2", False), ("3", True)}
    took = []
    fs.write_text(spark, f"{root}/control.json", '{"analyze_concurrency": 0}')
    run = lambda: stream.stage(s, lambda df, n, limit: took.append((df.count(), limit)), f"{root}/ck2", "analyze_concurrency", f"{root}/control.json")
    with pytest.raises(Exception, match="paused"):
        run().awaitTermination()
    assert not took
    fs.write_text(spark, f"{root}/control.json", '{"analyze_concurrency": 4}')
    run().awaitTermination()
    assert took == [(3, 4)]


def test_registry(spark):
    reg = spark.createDataFrame([("1", "food"), ("2", "food"), ("3", "cars"), ("4", None)], "cvr string, code string")
    seen = spark.createDataFrame([("1",), (None,)], "cvr string")
    assert [r.cvr for r in registry.without_report(reg, seen, "cvr", "code").collect()] == ["2"]
    known = spark.createDataFrame([("Engvej 1, st.", "1000", 1.0, 2.0), ("engvej  1", "1000 ", 3.0, 4.0), ("Bygade 2", "1000", 5.0, 6.0)], "street string, postcode string, lat double, lng double")
    rows = spark.createDataFrame([("a", "ENGVEJ 1", "1000"), ("b", "Ny 3", "1000"), ("c", "Ny 3", "9999"), ("d", None, None)], "id string, s string, p string")
    assert {r.id: (r.located_by, r.lat) for r in registry.locate(rows, known, street="s", postcode="p").collect()} == {"a": ("address", 2.0), "b": ("postcode", 3.0), "c": (None, None), "d": (None, None)}


def test_prompts_of_reports_without_business(spark, tmp_path):
    from lakeline.plans import reference

    rows = [("1", "b", "report", "x" * 6001), ("2", None, "report", "short"), ("3", None, "placard", "y"), ("4", None, None, None)]
    spark.createDataFrame(rows, "report_id string, navnelbnr string, doc_type string, text string").write.parquet(f"{tmp_path}/smiley_extract.parquet")
    got = reference.QUERIES["report_prompts_all"](spark, str(tmp_path)).collect()
    assert sorted((r.report_id, r.n_chars, len(r.prompt)) for r in got) == [("1", 6001, 6000), ("2", 5, 5)]
    assert [r.report_id for r in reference.QUERIES["report_prompts"](spark, str(tmp_path)).collect()] == ["1"]
