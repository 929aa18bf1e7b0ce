"""Controls that wait, endpoints that may be down, values that outlast failures, and stores that build once."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from lakeline import session
from lakeline.functions.text import label_key
from lakeline.operators import control, memo, metrics, news, provider, template
from lakeline.sources import fs, tables
from lakeline.streaming import stream


def test_last_good_control_document(spark, tmp_path):
    path = f"file://{tmp_path}/control.json"
    reader = control.Reader(spark, path)
    assert reader().harvest_rate == 2.6  # none yet: the defaults
    fs.write_text(spark, path, '{"paused": true, "harvest_rate": 5}')
    assert reader().paused and reader().harvest_rate == 5
    for torn in ('{"paused": fal', "", "[1]"):
        fs.write_text(spark, path, torn)
        assert reader().paused and reader().harvest_rate == 5
    slept = []

    def sleep(s):
        slept.append(s)
        if len(slept) == 2:
            fs.write_text(spark, path, '{"paused": false, "overlay_concurrency": 3}')

    assert reader.wait("overlay_concurrency", sleep=sleep) == 3 and slept == [3.0, 3.0]
    fs.write_text(spark, path, '{"paused": true}')
    assert reader.wait("overlay_concurrency", sleep=sleep, stop=lambda: True) == 0


def test_stage_waits_while_paused_and_gates_its_work(spark, tmp_path):
    root = f"file://{tmp_path}"
    df = spark.range(20).repartition(6)
    df.write.parquet(f"{root}/in")
    s = stream.file_stream(spark, f"{root}/in", df.schema)
    fs.write_text(spark, f"{root}/control.json", '{"paused": true}')
    took = []
    q = stream.stage(s, lambda rows, n, limit: took.append((rows.count(), rows.rdd.getNumPartitions(), limit)), f"{root}/ck", "overlay_concurrency", f"{root}/control.json", wait=True, poll=0.2)
    time.sleep(3)
    assert q.isActive and not took
    fs.write_text(spark, f"{root}/control.json", '{"paused": false, "overlay_concurrency": 2}')
    q.awaitTermination(60)
    assert took and took[0][0] == 20 and took[0][1] <= 2 and took[0][2] == 2
    assert not stream.running(spark, "none")


def test_endpoint_gate(spark):
    df = spark.range(2)
    assert provider.is_up(lambda: True) and not provider.is_up(lambda: 1 / 0) and not provider.is_up(lambda: None)
    assert provider.when_up(df, lambda: 1 / 0, lambda x: x) is None and provider.when_up(df, lambda: True, lambda x: x).count() == 2


def test_stragglers_are_asked_for_once_more(spark):
    def shy(texts):  # gives no answer to words with x unless they come alone
        return [None if "x" in t and len(texts) > 1 or t == "never" else t.upper() for t in texts]

    df = spark.createDataFrame([("a",), ("x1",), ("b",), ("never",)], "da string").coalesce(1)
    assert {r.da: r.en for r in memo.call_again(df.where("da <> 'never'"), shy, "da", "en").collect()} == {"a": "A", "b": "B", "x1": "X1"}
    assert {r.da: r.en for r in memo.call_again(df.where("da <> 'x1'"), shy, "da", "en").collect()} == {"a": "A", "b": "B", "never": None}


def test_aggregate_keeps_its_last_good_value():
    now, calls = [0.0], []

    def compute():
        calls.append(now[0])
        if len(calls) == 2:
            raise OSError("gone")
        return len(calls)

    v = metrics.LastGood(compute, 10.0, lambda: now[0])
    assert v() == 1 and v() == 1 and calls == [0.0]
    now[0] = 10.0
    assert v() == 1 and v.error == "OSError: gone"
    now[0] = 15.0
    assert v() == 1 and len(calls) == 2
    now[0] = 21.0
    assert v() == 3 and v.error is None


def test_labels_are_translated_once_a_wording(spark):
    asked = spark.sparkContext.accumulator(0)

    def say(texts):
        asked.add(len(texts))
        return [None if t == "Gap" else t if t == "https://x" else f"en {t}" for t in texts]

    boxes = spark.createDataFrame([(1, "Dato"), (2, "Dato"), (3, "Gap"), (4, "https://x"), (5, "Fast"), (6, "Behold")], "box int, da string")
    fixed = spark.createDataFrame([("fast", "Fixed")], "k string, fixed string")
    got = {r.box: r.en for r in template.translate_labels(boxes, say, fixed, ["behold"]).collect()}
    assert got == {1: "en Dato", 2: "en Dato", 5: "Fixed"}
    assert spark.range(1).select(label_key(F.lit("Åbn, Ø!")).alias("k")).first().k == "abno"


def test_specs_are_built_once_and_misses_remembered(spark, tmp_path):
    built = []

    def build(v):
        built.append(v)
        if v == "bad":
            raise ValueError("no labels")
        return spark.createDataFrame([(v, 7)], "name string, width int")

    up = [False]
    store = template.SpecStore(spark, f"file://{tmp_path}/specs", build, lambda: up[0])
    assert store.ensure("a") is None and not built  # down: not tried, so tried later
    up[0] = True
    assert store.ensure("a").first().width == 7 and store.ensure("a").first().width == 7 and built == ["a"]
    assert store.ensure("bad") is None and store.ensure("bad") is None and built == ["a", "bad"] and store.unknown == {"a": 1, "bad": 2}
    again = template.SpecStore(spark, f"file://{tmp_path}/specs")
    assert again.load("a").first().name == "a" and again.ensure("new") is None and again.unknown == {"new": 1}


def test_extract_composes_type_sections_and_flags(spark):
    parsed = spark.createDataFrame([
        ("1", "Top\nHygiejne: Der er mus. Andet: Ingen. Hygiejne: PÅBUD.", 2, None), ("2", "Hygiejne: x Scan: gå til y", 1, None), ("3", None, None, "ValueError: no PDF"), ("4", "", 0, None),
    ], "report_id string, text string, n_pages long, error string")
    parents = spark.createDataFrame([("1", "n1"), ("1", "n1"), ("3", "n3")], "report_id string, navnelbnr string")
    got = {r.report_id: r for r in tables.extract(parsed, parents).collect()}
    one = got["1"]
    assert (one.doc_type, one.navnelbnr, one.n_pages, one.has_pest, one.has_paabud, one.has_boede) == ("report", "n1", 2, True, True, False)
    assert one.control_points == ["Andet", "Hygiejne"] and one.sections == {"Hygiejne": "Hygiejne: Der er mus. Hygiejne: PÅBUD.", "Andet": "Andet: Ingen."}
    assert got["2"].doc_type == "placard" and got["2"].sections == {} and got["4"].sections == {} and got["4"].n_chars == 0
    assert got["3"].error == "ValueError: no PDF" and got["3"].doc_type is None and got["3"].sections is None and got["3"].navnelbnr is None


def test_poll_log(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "source string")
    failed = spark.createDataFrame([("z", "timeout"), ("empty", None)], "source string, error string")
    got = {r.source: (r.ran_at, r.entries, r.new, r.error) for r in news.poll_log(a, a.where("source = 'x'"), failed, 5.0).collect()}
    assert got == {"x": (5.0, 2, 2, None), "y": (5.0, 1, 0, None), "z": (5.0, 0, 0, "timeout"), "empty": (5.0, 0, 0, None)}


def test_no_folder_of_this_machine_on_a_cluster():
    class Conf:
        def get(self, *_):
            return None

    class Empty:
        def __getattr__(self, _):
            return lambda: self

        def isEmpty(self):  # noqa: N802
            return True

    class Context:
        master = "spark://host:7077"
        _jsc = Empty()

    class Session:
        conf, sparkContext = Conf(), Context()  # noqa: N815

    with pytest.raises(RuntimeError, match="checkpoint"):
        session.shared_dir(Session())


def test_write_without_overwrite(spark, tmp_path):
    path, won = f"file://{tmp_path}/x/1.json", []

    def one(i):
        try:
            fs.write_text(spark, path, str(i), False)
            won.append(i)
        except FileExistsError:
            pass

    one(0)
    threads = [threading.Thread(target=one, args=(i,)) for i in (1, 2)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert won == [0] and fs.read_text(spark, path) == "0" and fs.listing(spark, f"file://{tmp_path}/x") == ["1.json"]


def test_breaker_over_segments(spark):
    """Cut into segments of any size, the breaker is that of one window over the series."""
    import random

    r = random.Random(3)
    rows = [(s, i, r.random() < (0.2 if s == "calm" else 0.45)) for s, n in (("calm", 90), ("wild", 400), (None, 60), ("few", 5)) for i in range(n)]
    want = {}
    for s in {x[0] for x in rows}:
        bad, open_ = [], False
        for _, i, x in sorted((x for x in rows if x[0] == s), key=lambda x: x[1]):
            bad = [*bad, x][-40:]
            ratio = sum(bad) / len(bad)
            open_ |= len(bad) >= 20 and ratio >= 0.5
            want[s, i] = (round(ratio, 9), open_)
    df = spark.createDataFrame(rows, "s string, i long, bad boolean").repartition(5)
    for segment in (40, 77, 1000):
        got = metrics.breaker(df, ["s"], ["i"], F.col("bad"), segment=segment).collect()
        assert len(got) == len(rows) and {(x.s, x.i): (round(x.ratio, 9), x.is_open) for x in got} == want
    assert metrics.breaker(df.limit(0), ["s"], ["i"], F.col("bad")).count() == 0


def test_command_line_stage(spark, tmp_path):
    from lakeline.__main__ import main

    rows = lambda *x: spark.createDataFrame(list(x), "report_id string, text string").write.mode("append").parquet(f"{tmp_path}/in")
    rows(("1", "mus"), ("2", None))
    for _ in range(2):  # a second look takes only what is new
        assert main(["flags", f"{tmp_path}/in", f"{tmp_path}/out"]) == 0
        rows(("3", "ok"))
    assert sorted((r.report_id, r.has_pest) for r in spark.read.parquet(f"{tmp_path}/out/data").collect()) == [("1", True), ("3", False)]
