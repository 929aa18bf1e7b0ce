import json

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeline import __main__ as cli
from lakeline import schemas
from lakeline.operators import metrics, news, provider, template
from lakeline.sources import landing


def test_landing(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,Ærø\nx,Fur\n")
    schema = T.StructType.fromDDL("id int, name string")
    got = {(r.id, r.name) for r in landing.read_csv(spark, f"file://{tmp_path}/a.csv", schema).collect()}
    assert got == {(1, "Ærø"), (None, "Fur")}
    (tmp_path / "a.json").write_text('{"id": 1, "name": "a"}\n{broken\n')
    assert [(r.id, r._bad) for r in landing.read_json(spark, f"file://{tmp_path}/a.json", schema).collect()] == [(1, None), (None, "{broken")]
    (tmp_path / "a.xml").write_text('<all><unit no="7"><name>Fur</name></unit><unit no="8"/></all>')
    units = landing.read_xml(spark, f"file://{tmp_path}/a.xml", "unit", T.StructType.fromDDL("_no string, name string"))
    assert {tuple(r) for r in units.collect()} == {("7", "Fur"), ("8", None)}


def test_feed(spark, tmp_path):
    (tmp_path / "avis.1.xml").write_text("<rss><channel><title>Avis</title><item><guid>g1</guid><title>T &amp; U</title><pubDate>Mon, 19 May 2026 23:08 +0200</pubDate></item><item><link>http://l</link><title>V</title></item></channel></rss>")
    e = landing.read_feed(spark, f"file://{tmp_path}/*.xml", 5.0)
    assert {(r.source, r.entry_id, r.title, r.link) for r in e.collect()} == {("avis", "g1", "T & U", None), ("avis", None, "V", "http://l")}
    new = news.insert_new(spark.createDataFrame([], schemas.ARTICLES), e)
    assert {r.entry_id for r in new.collect()} == {"g1", "http://l"}


def test_page_lines_and_variants(spark):
    files = spark.createDataFrame([("/x/1.pdf", bytearray(b"ok")), ("/x/2.pdf", bytearray(b"bad"))], "path string, content binary")

    def parser(b):
        if b == b"bad":
            raise ValueError
        return [(1, 0, 600.0, 800.0, "hej", 0.0, 0.0, 10.0, 10.0, 9.0, 0, False, 8.0)]

    assert [(r.report_id, r.text) for r in landing.page_lines(files, parser).collect()] == [("1", "hej")]
    images = spark.createDataFrame([("1", 1, 700, bytearray([0] * 32 + [255] * 32)), ("1", 2, 130, bytearray(b"icon"))], "report_id string, page int, width int, content binary")
    got = landing.variants(images, lambda b: np.frombuffer(b, np.uint8).reshape(8, 8), template.variant_key).collect()
    assert len(got) == 1 and len(got[0].variant) == 16


def test_provider(spark):
    waits, tries = [], []

    def flaky(x):
        tries.append(x)
        if len(tries) < 3:
            raise OSError("busy")
        return x

    assert provider.with_retries(flaky, sleep=waits.append)("a") == "a" and waits == [2.0, 4.0]
    with pytest.raises(OSError):
        provider.with_retries(lambda: (_ for _ in ()).throw(OSError()), sleep=waits.append)()

    def model(text):
        if "slem" in text:
            return "[]"
        return json.dumps({"overall": "minor", "summary_en": "s", "findings": [{"category": "pest", "description_en": "d", "is_actual_finding": True, "pest_type": None, "enforcement": "ban"}]})

    row = lambda i, text, **f: (i, "7", f.get("kind", "report"), 1, 1, None, None, f.get("pest"), False, False, False, False, False, False, False, text, None)
    reports = spark.createDataFrame([row("1", "Der blev KONSTATERET x"), row("2", "intet"), row("3", "slem", pest=True), row("4", "konstateret", kind="placard"), row("5", None)], schemas.EXTRACT)
    found, problems = provider.analyze(reports, model)
    assert [(r.report_id, r.severity, r.actual_pest, r.n_findings) for r in found.collect()] == [("1", "serious", True, 1)]
    assert [(r.report_id, r.problem) for r in problems.collect()] == [("3", "ValueError: the reply is no object")]


def test_box_specs(spark):
    img = np.full((12, 40, 3), 200)
    img[3:9, 4:20:2] = 0
    img[:, 30] = 0
    cell = lambda x, y: (1, x, y, *map(int, img[y, x]))
    cols = "box int, x int, y int, r int, g int, b int"
    pixels = spark.createDataFrame([cell(x, y) for y in range(12) for x in range(24)], cols)
    band = spark.createDataFrame([cell(x, y) for y in range(12) for x in range(40)], cols)
    boxes = spark.createDataFrame([(1, "gyldig", "valid", 0.9, 0, 0, 24, 12)], "box int, da string, en string, conf double, x0 int, y0 int, x1 int, y1 int")
    r = template.box_specs(boxes, pixels, band, 40).first()
    assert r.bbox == [3, 2, 20, 10] and r.fill == [200, 200, 200] and r.color == [0, 0, 0] and r.bold and r.avail_x1 == 30 and r.font_px == 12 and abs(r.baseline_px - (10 - 0.21 * 12)) < 1e-9
    c = spark.createDataFrame([(0xFF8000,)], "c int").select(template.rgb(F.col("c")).alias("v")).first().v
    assert (c.r, round(c.g, 3), c.b) == (1.0, 0.502, 0.0)


def test_enriched(spark):
    s = spark.createDataFrame([(100.0, True, True, False, True)], "updated_at double, harvest_running boolean, extract_running boolean, analyze_running boolean, overlay_running boolean")
    other = spark.createDataFrame([(1,)], "a int")
    r = metrics.enriched(s, other, other, {"paused": True, "harvest_rate": 1.0}, 105.0).first()
    assert [x.up for x in r.services] == [True, True, False, True] and r.paused and r.derived.a == 1 and r.control.harvest_rate == 1.0
    assert not any(x.up for x in metrics.enriched(s, other, other, {"paused": False}, 200.0).first().services)


def test_command_line(spark, tmp_path, capsys):
    assert cli.main(["list"]) == 0 and "p5_found" in capsys.readouterr().out
    assert cli.main(["control", f"file://{tmp_path}/c.json", "harvest_rate=3", "paused=true"]) == 0
    assert json.loads(capsys.readouterr().out.strip().split("\n")[-1]) == {"paused": True, "harvest_rate": 3.0, "analyze_concurrency": 32, "overlay_concurrency": 8}
    spark.range(30).selectExpr("cast(id % 10 as string) k", "id v").repartition(5).write.parquet(f"{tmp_path}/in")
    assert cli.main(["compact", f"file://{tmp_path}/in", f"file://{tmp_path}/out", "k"]) == 0
    assert spark.read.parquet(f"file://{tmp_path}/out/data").count() == 10


def test_intermediate_tables(spark):
    from lakeline.session import clean, materialise, shared_dir
    from lakeline.sources import fs

    df = materialise(spark.range(3).selectExpr("id", "array(id) a", "cast(null as string) s"), "x")
    assert df.count() == 3 and [n for n in fs.listing(spark, shared_dir(spark)) if n.startswith("lakeline-x-")]
    clean(spark)
    assert not [n for n in fs.listing(spark, shared_dir(spark)) if n.startswith("lakeline-x-")]
