import random

import pytest

from lakeline.operators.compact import SizeTieredCompactor, directory_parts
from lakeline.sources import fs

ROWS = "report_id string, v string, m map<string,string>, _k int, part_file string, row_no long"
PARTS = "dataset string, part_file string, written_at double, n_rows long, n_bytes long"


def data(seed, n=36):
    r = random.Random(seed)
    parts = [("d", f"part-{i}{'.tmp' if i % 9 == 0 else ''}", float(r.randrange(5)), 1, r.choice([900, 1500, 90_000, 10_000_000])) for i in range(n)]
    rows = [(r.choice([" a", "b ", "c", "d", None]), f"v{i}", {"k": "v"}, i, parts[i % n][1], i // n) for i in range(n * 4)]
    return rows + [("z", "lost", None, 1, "part-unknown", 0)], parts + parts[:2]


def brute(rows, parts):
    at = {p[1]: p[2] for p in parts}
    best = {}
    for x in rows:
        if x[4].endswith(".tmp"):
            continue
        k, o = x[0].strip(" ") if x[0] is not None else None, (x[4] in at, at.get(x[4], 0), x[4], x[5])
        if k not in best or o > best[k][0]:
            best[k] = (o, x[4], x[5], x[1])
    return sorted(b[1:] for b in best.values())


def kept(df):
    return sorted((x.part_file, x.row_no, x.v) for x in df.collect())


@pytest.mark.parametrize("fan_in", [2, 8, 512])
def test_one_row_a_key_and_every_merge_in_the_journal(spark, tmp_path, fan_in):
    rows, parts = data(fan_in)
    r, p = spark.createDataFrame(rows, ROWS), spark.createDataFrame(parts, PARTS)
    c = SizeTieredCompactor(spark, f"file://{tmp_path}", fan_in=fan_in)
    out = c.run(r, p, "report_id")
    assert kept(out) == brute(rows, parts) and set(out.columns) == set(r.columns)
    done = c.journal()
    assert done[-1]["kind"] == "major" and (fan_in == 512 or len(done) > 1)
    assert all(spark.read.parquet(x["inputs"]).count() == x["files"] for x in done)
    # Once more: nothing is merged again.
    assert kept(c.run(r, p, "report_id")) == brute(rows, parts) and len(c.journal()) == len(done)


def test_resumes_after_a_failure(spark, tmp_path, monkeypatch):
    rows, parts = data(1)
    r, p = spark.createDataFrame(rows, ROWS), spark.createDataFrame(parts, PARTS)
    c = SizeTieredCompactor(spark, f"file://{tmp_path}", fan_in=4)
    write, calls = fs.write_text, []

    def third_fails(*a):
        calls.append(a)
        if len(calls) == 3:
            raise OSError("lost")
        write(*a)

    with monkeypatch.context() as m:
        m.setattr(fs, "write_text", third_fails)
        with pytest.raises(OSError):
            c.run(r, p, "report_id")
    assert len(c.journal()) == 2
    assert kept(c.run(r, p, "report_id")) == brute(rows, parts)


def test_empty(spark, tmp_path):
    c = SizeTieredCompactor(spark, f"file://{tmp_path}")
    assert c.run(spark.createDataFrame([], ROWS), spark.createDataFrame([], PARTS), "report_id").count() == 0


def test_real_files(spark, tmp_path):
    """A folder of many small files, with provenance from the files themselves."""
    src = spark.range(400).selectExpr("cast(id % 300 as string) report_id", "id v")
    src.repartition(40).write.parquet(f"{tmp_path}/in")
    rows, parts = directory_parts(spark, f"{tmp_path}/in", src.schema)
    c = SizeTieredCompactor(spark, f"file://{tmp_path}/out", fan_in=16)
    out = c.run(rows, parts, "report_id")
    assert out.count() == 300 and out.select("report_id").distinct().count() == 300
    assert spark.read.parquet(c.journal()[-1]["outputs"]).count() == 1


def names(spark, entries):
    return [r._unit for x in entries for r in spark.read.parquet(x["inputs"]).collect()]


@pytest.mark.parametrize("fan_in", [2, 512])
def test_added_parts_alone_are_merged(spark, tmp_path, fan_in):
    """A second run takes the added parts and only those compacted files that share a bucket of keys with them."""
    one = lambda i, k, at: ((k, f"v{i}", None, i, f"part-{i}", 0), ("d", f"part-{i}", at, 1, 1000))
    first, more = [one(i, f"k{i}", 1.0) for i in range(24)], [one(90, "k3", 2.0), one(91, " k3", 3.0), one(92, "k3", 0.5)]
    frames = lambda x: (spark.createDataFrame([r for r, _ in x], ROWS), spark.createDataFrame([p for _, p in x], PARTS))
    c = SizeTieredCompactor(spark, f"file://{tmp_path}", fan_in=fan_in, target_bytes=3000)
    c.run(*frames(first), "report_id")
    before = c.journal()
    files = spark.read.parquet(before[-1]["outputs"]).count()
    assert files > 1
    assert kept(c.run(*frames(first + more), "report_id")) == brute([r for r, _ in first + more], [p for _, p in first + more])
    later = [x for x in c.journal() if x not in before]
    taken = names(spark, later)
    assert later and not {f"part-{i}" for i in range(24)} & set(taken) and {"part-90", "part-91", "part-92"} <= set(taken)
    assert sum(before[-1]["txn"] in n for n in taken) == 1  # of all files by key, the one of k3
    every = names(spark, c.journal())
    assert len(every) == len(set(every))
    # Once more: nothing new. The old parts gone: they stay compacted.
    done = len(c.journal())
    assert kept(c.run(*frames(first + more), "report_id")) == kept(c.run(*frames(more), "report_id")) == brute([r for r, _ in first + more], [p for _, p in first + more])
    assert len(c.journal()) == done


def test_growth_and_changed_parts_compact_anew(spark, tmp_path):
    rows, parts = data(3)
    c = SizeTieredCompactor(spark, f"file://{tmp_path}", fan_in=4, target_bytes=1 << 20)
    frames = lambda r, p: (spark.createDataFrame(r, ROWS), spark.createDataFrame(p, PARTS))
    few = [r for r in rows if r[4] in ("part-1", "part-2")]
    assert kept(c.run(*frames(few, parts[1:3]), "report_id")) == brute(few, parts[1:3])
    assert kept(c.run(*frames(rows, parts[:36]), "report_id")) == brute(rows, parts[:36])  # many more buckets
    later = [(*p[:2], p[2] + 7.0, *p[3:]) if p[1] == "part-5" else p for p in parts[:36]]
    fewer = [r for r in rows if r[4] != "part-7"]
    assert kept(c.run(*frames(rows, later), "report_id")) == brute(rows, later)
    assert kept(c.run(*frames(fewer + [r for r in rows if r[4] == "part-7"][:1], later), "report_id")) == brute(fewer + [r for r in rows if r[4] == "part-7"][:1], later)
    assert c.journal()[-1]["gen"] == 3


def test_vacuum_leaves_the_result(spark, tmp_path):
    rows, parts = data(4)
    frames = lambda r, p: (spark.createDataFrame(r, ROWS), spark.createDataFrame(p, PARTS))
    c = SizeTieredCompactor(spark, f"file://{tmp_path}", fan_in=4, target_bytes=1 << 20)
    early = [p for p in parts if int(p[1].split("-")[1].split(".")[0]) < 20]
    c.run(*frames([r for r in rows if r[4] in {p[1] for p in early}], early), "report_id")
    spark.range(3).write.parquet(f"file://{tmp_path}/data/left-by-a-failure/rows")
    want = kept(c.run(*frames(rows, parts), "report_id"))
    assert c.vacuum() > 1 and c.vacuum() == 0
    assert want == brute(rows, parts) == kept(c.run(*frames(rows, parts), "report_id"))
    alone = c.journal()[-1]
    assert all(fs.exists(spark, x["rows"]) == (x["kind"] == "major") for x in c.journal() if x["txn"] != alone["txn"] and x["kind"] == "tier")


def test_levels_tell_files_and_bytes(spark, tmp_path):
    rows, parts = data(5)
    c = SizeTieredCompactor(spark, f"file://{tmp_path}", fan_in=4)
    c.run(spark.createDataFrame(rows, ROWS), spark.createDataFrame(parts, PARTS), "report_id")
    got = c.levels().orderBy("level").collect()
    assert [x.kind for x in got][-1] == "major" and len(got) == len(c.journal()) and got[-1].files_out == 1 and all(x.files_out < x.files_in and x.bytes_out > 0 for x in got)
