import random

import pytest

from lakeline.operators.diff import diff_snapshots

ROWS = "snap_id long, row_no long, key string, a string, b string, n int, x double, y double, g string, m string"
LOG = "snap_id long, source string, kind string, fetched_at double, path string"
HOW = dict(key="key", text=["a", "b"], exact=["n"], close=["x", "y"])


def found(spark, rows, log):
    return sorted((r.snap_id, r.key or "", r.change) for r in diff_snapshots(spark.createDataFrame(rows, ROWS), spark.createDataFrame(log, LOG), **HOW).collect())


def norm(s):
    return " ".join(s.replace(" ", " ").split()) or None if s is not None else None


def near(p, q):
    return all((u is None and v is None) or (u is not None and v is not None and abs(u - v) <= 1.000001e-5) for u, v in zip(p[-2:], q[-2:])) and p[:-2] == q[:-2]


def brute(rows, log):
    out = []
    have = {r[0] for r in rows}
    snaps = sorted({(s[1] or "", s[2], s[3], s[0]) for s in log if s[0] in have})
    by = {}
    for r in rows:
        by.setdefault(r[0], {}).setdefault(norm(r[2]), set()).add((norm(r[3]), norm(r[4]), r[5], r[6], r[7]))
    for p, q in zip(snaps, snaps[1:]):
        if p[:2] != q[:2]:
            continue
        old, new = by[p[3]], by[q[3]]
        for k in old.keys() | new.keys():
            if k not in old:
                out.append((q[3], k or "", "added"))
            elif k not in new:
                out.append((q[3], k or "", "removed"))
            elif any(not any(near(u, v) for v in old[k]) for u in new[k]) or any(not any(near(u, v) for v in new[k]) for u in old[k]):
                out.append((q[3], k or "", "changed"))
    return sorted(out)


def test_cases(spark):
    log = [(1, "s", "k", 1.0, "p"), (2, "s", "k", 2.0, None), (3, "s", "k", 3.0, "p"), (3, "s", "k", 3.0, "p"), (4, "s", "k", 4.0, "p")]
    row = lambda s, k, a, x=None, y=None, b=None, n=0: (s, 0, k, a, b, n, x, y, "g", "m")
    rows = [
        row(1, "same", "A  b ", 1.0, 2.0), row(3, " same ", " A b", 1.000004, 2.0), row(4, "same", "A b", 1.000008, 2.0),
        row(1, "gone", "A"), row(3, "new", "A"), row(4, "new", "A", b=""),  # empty equals null
        row(1, "moved", "A", 1.0, 2.0), row(3, "moved", "A", 1.1, 2.0), row(4, "moved", "A", None, 2.0),
        row(1, "twice", "A"), row(3, "twice", "A"), row(3, "twice", "A "), row(4, "twice", "A"), row(4, "twice", "B"),
        row(1, "back", "A"), row(3, "back", "B"), row(4, "back", "A"), row(1, None, "A"), row(3, " ", "A"), row(4, None, "C"),
    ]
    assert found(spark, rows, log) == brute(rows, log)
    assert (3, "moved", "changed") in found(spark, rows, log)


@pytest.mark.parametrize("n", [3, 70])  # more deliveries than bits of one word
def test_random(spark, n):
    r = random.Random(n)
    log = [(i, r.choice(["s", "t"]), "k", float(n - i), None) for i in range(n)]
    rows = [(i, j, r.choice("abcdef") if j else None, r.choice("AB "), r.choice(["", None, "x"]), r.choice([0, 1, None]) if r.random() < 0.1 else 0, r.choice([1.0, 1.000008, 1.000016, None]), 2.0, None, None) for i in range(n) if i % 5 for j in range(6)]
    rows += rows[:9]
    assert found(spark, rows, log) == brute(rows, log)


def test_empty(spark):
    assert found(spark, [], [(1, "s", "k", 1.0, None)]) == [] and found(spark, [], []) == []


def test_hot_key(spark):
    """A third of all rows under one key, all different."""
    log = [(1, "s", "k", 1.0, "p"), (2, "s", "k", 2.0, "p")]
    rows = [(s, i, "hot", f"t{i}", None, 0, 1.0, 1.0, None, None) for s in (1, 2) for i in range(3000)] + [(s, i, f"k{i}", "t", None, 0, None, None, None, None) for s in (1, 2) for i in range(3000)]
    assert found(spark, rows, log) == []
    assert found(spark, rows[1:], log) == [(2, "hot", "changed")]


def test_noisy_copy_beside_an_equal_row(spark):
    """The partner of a noisy copy may be a row that stands in both deliveries, so no residue itself."""
    log = [(i, "s", "k", float(i), "p") for i in (1, 2)]
    row = lambda s, k, x, y=2.0: (s, 0, k, "A", None, 0, x, y, None, None)
    rows = [
        row(1, "copy in new", 1.0), row(2, "copy in new", 1.0), row(2, "copy in new", 1.0 + 2e-7),
        row(1, "copy in old", 1.0), row(1, "copy in old", 1.0 + 2e-7), row(2, "copy in old", 1.0),
        row(1, "no x", None), row(2, "no x", None), row(2, "no x", None, 2.0 + 2e-7),
        row(1, "one far", 1.0), row(2, "one far", 1.0), row(1, "one far", 1.000008), row(2, "one far", 0.999993),  # residues apart, each close to the equal row
        row(1, "far", 1.0), row(2, "far", 1.0), row(2, "far", 1.00002), row(1, "null", 1.0), row(2, "null", 1.0), row(2, "null", None),
    ]
    assert found(spark, rows, log) == brute(rows, log) == [(2, "far", "changed"), (2, "null", "changed")]


@pytest.mark.parametrize("n", [4, 70])
def test_random_copies(spark, n):
    """Few keys and texts, many copies of them within and beyond the tolerance."""
    r = random.Random(n)
    log = [(i, "s", "k", float(i), None) for i in range(n)]
    rows = [(i, j, k, "A", None, 0, r.choice([1.0, 1.000008, 1.000016, 1.00003, None]), r.choice([2.0, 2.0, None]), None, None) for i in range(n) for k in "abcdefgh" for j in range(r.randrange(4))]
    assert found(spark, rows, log) == brute(rows, log)
