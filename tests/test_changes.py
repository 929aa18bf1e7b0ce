import random

import pytest

from lakeline.operators.changes import ChangeFeed, Conflict, successful
from lakeline.sources import fs

ITEMS = "seq long, pipeline string, key string, status string, sha256 string, attempts long, updated_at double, loaded_at double, extra string, w string, s string"
RUNS = "run_id long, pipeline string, started_at double, finished_at double, ok boolean"


def brute(items, runs):
    out = set()
    done = sorted({(r[1], r[2], r[0]) for r in runs if r[4] and r[3] is not None})
    for p in {r[0] for r in done}:
        before = {}
        for _, start, run in (r for r in done if r[0] == p):
            now = {}
            for i in items:
                if i[1] == p and i[2] is not None and i[7] is not None and i[7] <= start:
                    o = (i[6] is not None, i[6] or 0, i[0])
                    if i[2] not in now or o > now[i[2]][0]:
                        now[i[2]] = (o, i[3:6])
            out |= {(run, k) for k, (_, c) in now.items() if k not in before or before[k] != c}
            before = {k: c for k, (_, c) in now.items()}
    return out


def data(n, seed):
    r = random.Random(seed)
    items = []
    for seq in range(n):
        at = r.randrange(50)
        items.append((seq, r.choice("pq"), r.choice(["a", "b", "c", "d", None] if seq % 7 else ["hot"]), r.choice(["done", "failed", None]), r.choice(["x", "y", None]), r.choice([0, 1, None]), float(at) if r.random() < 0.95 else None, float(at + r.randrange(40)) if r.random() < 0.97 else None, None, None, None))
    items += [x for x in items if r.random() < 0.2]
    runs = [(i, r.choice("pqz"), float(i * 9 + r.randrange(5)), None if r.random() < 0.2 else 1.0, r.choice([True, True, False, None])) for i in range(12)]
    return items, runs + runs[:3]


@pytest.mark.parametrize("seed", range(3))
def test_replay_in_several_calls_is_that_of_brute_force(spark, tmp_path, seed):
    items, runs = data(150, seed)
    i, r = spark.createDataFrame(items, ITEMS), successful(spark.createDataFrame(runs, RUNS))
    feed = ChangeFeed(spark, f"file://{tmp_path}/state")
    got = []
    for upto in (30, 30, 70, 1000):  # a call that is repeated settles nothing new
        got += [(x.run_id, x.item_key) for x in feed.advance(i, r.where(f"started_at <= {upto}")).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(items, runs)


def test_failure_before_the_swap_changes_nothing(spark, tmp_path, monkeypatch):
    items, runs = data(80, 5)
    i, r = spark.createDataFrame(items, ITEMS), successful(spark.createDataFrame(runs, RUNS))
    feed = ChangeFeed(spark, f"file://{tmp_path}/state")
    first = {tuple(x)[:2] for x in feed.advance(i, r.where("started_at <= 40")).select("run_id", "item_key").collect()}
    with monkeypatch.context() as m:
        m.setattr(fs, "write_text", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            feed.advance(i, r)
    rest = {tuple(x)[:2] for x in feed.advance(i, r).select("run_id", "item_key").collect()}
    assert first | rest == brute(items, runs) and not first & rest


def test_empty_tables(spark, tmp_path):
    none = spark.createDataFrame([], ITEMS)
    runs = successful(spark.createDataFrame([(1, "p", 1.0, 2.0, True)], RUNS))
    feed = ChangeFeed(spark, f"file://{tmp_path}/state")
    assert feed.advance(none, runs).count() == 0
    assert feed.advance(none, runs.limit(0)).count() == 0
    assert ChangeFeed(spark, f"file://{tmp_path}/other").advance(none, runs.limit(0)).count() == 0


def test_of_two_callers_one_commits(spark, tmp_path, monkeypatch):
    items, runs = data(80, 6)
    i, r = spark.createDataFrame(items, ITEMS), successful(spark.createDataFrame(runs, RUNS))
    root = f"file://{tmp_path}/state"
    one, other = ChangeFeed(spark, root), ChangeFeed(spark, root)
    one.advance(i, r.where("started_at <= 40"))
    began = other._pointer()
    got = {tuple(x)[:2] for x in one.advance(i, r.where("started_at <= 70")).select("run_id", "item_key").collect()}
    with monkeypatch.context() as m:  # the other began before
        m.setattr(other, "_pointer", lambda: began)
        with pytest.raises(Conflict):
            other.advance(i, r.where("started_at <= 60"))
    rest = {tuple(x)[:2] for x in other.advance(i, r).select("run_id", "item_key").collect()}
    assert one._pointer()["version"] == 3 and not got & rest
    first = {tuple(x)[:2] for x in ChangeFeed(spark, f"file://{tmp_path}/again").advance(i, r.where("started_at <= 40")).select("run_id", "item_key").collect()}
    assert first | got | rest == brute(items, runs)


def test_vacuum_keeps_the_state_in_force(spark, tmp_path):
    items, runs = data(80, 7)
    i, r = spark.createDataFrame(items, ITEMS), successful(spark.createDataFrame(runs, RUNS))
    feed = ChangeFeed(spark, f"file://{tmp_path}/state")
    got = [feed.advance(i, r.where(f"started_at <= {x}")).collect() for x in (30, 60)]
    spark.range(1).write.parquet(f"file://{tmp_path}/state/v000003-failed")
    state = sorted(map(repr, feed.state().collect()))
    assert feed.vacuum() == 2 and sorted(map(repr, feed.state().collect())) == state and len(fs.listing(spark, f"file://{tmp_path}/state")) == 2
    got.append(feed.advance(i, r).collect())
    assert {(x.run_id, x.item_key) for g in got for x in g} == brute(items, runs)


def test_bounds_of_arrival_reach_the_scan(spark, tmp_path, capsys, monkeypatch):
    items, runs = data(120, 8)
    spark.createDataFrame(items, ITEMS).write.parquet(f"file://{tmp_path}/items")
    i, r = spark.read.parquet(f"file://{tmp_path}/items"), successful(spark.createDataFrame(runs, RUNS))
    feed = ChangeFeed(spark, f"file://{tmp_path}/state")
    feed.advance(i, r.where("started_at <= 60"))
    seen = []
    where = type(i).where
    monkeypatch.setattr(type(i), "where", lambda df, c: seen.append(where(df, c)) or seen[-1])
    feed.advance(i, r.where("pipeline <> 'z'"))
    seen[[x.columns == i.columns for x in seen].index(True)].explain()
    plan = capsys.readouterr().out
    assert "LessThanOrEqual(loaded_at," in plan and "GreaterThan(loaded_at," in plan
