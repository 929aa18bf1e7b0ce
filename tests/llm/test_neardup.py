import random

from hypothesis import given, settings
from hypothesis import strategies as st

from lakeline.llm.neardup import duplicate_groups, near_duplicates, words_of

SCHEMA = "id string, title string, summary string, a string, t string, c string"


def brute(rows, num=7, den=10, least=8):
    sets = {(r[0], frozenset(words_of(r[1], r[2]))) for r in rows if r[0] is not None}
    sets = [x for x in sets if len(x[1]) >= least]
    return {(i, j) for i, a in sets for j, b in sets if i < j and len(a & b) * den >= num * len(a | b)}


def got(spark, rows, **how):
    return {tuple(x) for x in near_duplicates(spark.createDataFrame(rows, SCHEMA), **how).collect()}


def edited(r, words):
    w = list(words)
    for _ in range(r.randrange(5)):
        k = r.randrange(3)
        i = r.randrange(len(w))
        if k == 0:
            w[i] = f"w{r.randrange(60)}"
        elif k == 1:
            w.insert(i, f"w{r.randrange(60)}")
        elif len(w) > 1:
            del w[i]
    return " ".join(w)


def corpus(seed, n=150):
    r = random.Random(seed)
    out = []
    for i in range(n):
        base = random.Random(r.randrange(n // 6)).choices([f"w{x}" for x in range(60)], k=r.choice([4, 9, 14, 30]))
        out.append((f"i{i % (n - 10)}", edited(r, base), None if r.random() < 0.1 else edited(r, base), None, None, None))
    return out + out[:10] + [(None, out[0][1], out[0][2], "a", "t", "c"), ("z", None, None, "a", "t", "c"), ("y", "", " ", None, None, None)]


def test_all_pairs_and_no_other(spark):
    for seed in range(2):
        rows = corpus(seed)
        assert got(spark, rows) == brute(rows)
    assert got(spark, rows, threshold=(8, 10), least=1) == brute(rows, 8, 10, 1)


@settings(max_examples=3, deadline=None)
@given(st.integers(0, 10_000))
def test_other_corpora(spark, seed):
    rows = corpus(seed, 60)
    assert got(spark, rows, threshold=(3, 5), least=2) == brute(rows, 3, 5, 2)


def test_words():
    assert words_of("<b>Fisk</b>&amp;Kød", "Régime &lt;x&gt; 2,5 FISK") == sorted(["fisk", "kød", "régime", "x", "2", "5"])
    assert words_of(None, None) == []


def test_copies_and_empty(spark):
    assert got(spark, []) == set()
    text = " ".join(f"ord{i}" for i in range(12))
    rows = [(f"k{i:03d}", text, None, None, None, None) for i in range(40)] + [("long", "x " * 50_000, "y", None, None, None)]
    assert len(got(spark, rows)) == 40 * 39 // 2


def test_groups_are_connected_components(spark):
    rows = corpus(9)
    pairs = brute(rows)
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    want = {}
    for x in sorted(near):
        todo = [x] if x not in want else []
        while todo:
            y = todo.pop()
            if y not in want:
                want[y] = x
                todo += near[y]
    assert {r.id: (r.group, r.links) for r in duplicate_groups(spark.createDataFrame(rows, SCHEMA)).collect()} == {x: (want[x], len(near[x])) for x in near}
