import numpy as np
from pyspark.sql import functions as F

from lakeline.llm import mix, tokens

DOCS = "doc_id long, source string, text string, s string, b long"
WEIGHTS = "source string, weight double, max_uses long"


def data(n=120):
    rows = [(i, ["big", " BIG ", "mid", "tiny", None, "other"][0 if i % 3 == 0 else i % 6], None if i % 17 == 0 else "" if i % 19 == 0 else f"Tekst {i} om ost og brød. " * (1 + i % 7), "clash", 1) for i in range(n)]
    rows += [(1000, "tiny", "En meget lang tekst " * 3000, None, None)]
    return rows, [("Big", 5.0, 2), ("mid", 3.0, 1), ("tiny", 1.0, 3), ("absent", 1.0, 5), (None, 2.0, 1)]


def frames(spark, n=120):
    docs, weights = data(n)
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(weights, WEIGHTS)


def test_blocks_hold_every_token_once(spark):
    docs, weights = frames(spark)
    out = mix.token_blocks(docs, weights, block=16).collect()
    want = {r.s: r.tokens for r in mix.source_tokens(docs, weights).collect()}
    for s in ("big", "mid", "tiny"):
        mine = sorted((r.b, list(r.ids)) for r in out if r.s == s)
        assert [b for b, _ in mine] == list(range(len(mine))) and all(len(x) == 16 for _, x in mine[:-1]) and sum(len(x) for _, x in mine) == want[s]
    enc = tokens.encoder(tokens.read_vocabulary())
    whole = {tuple(enc.bpe.encode_ordinary(t)) for _, s, t, *_ in data()[0] if t and s and s.strip().lower() == "mid"}
    stream = [x for r in sorted((r for r in out if r.s == "mid"), key=lambda r: r.b) for x in r.ids]
    at = 0
    while at < len(stream):  # the stream is whole documents in some order
        doc = next(w for w in sorted(whole, key=len, reverse=True) if tuple(stream[at : at + len(w)]) == w)
        at += len(doc)
    assert {r.s for r in out} == {"big", "mid", "tiny"}


def test_no_block_is_used_more_often_than_allowed_and_evenly(spark):
    docs, weights = frames(spark)
    uses = mix.mix(docs, weights, block=16, shards=7).groupBy("s", "b").agg(F.count("*").alias("n"), F.count_distinct("use").alias("u")).collect()
    limit = {"big": 2, "mid": 1, "tiny": 3}
    assert uses and all(r.n == r.u <= limit[r.s] for r in uses)
    for s in limit:
        n = [r.n for r in uses if r.s == s]
        blocks = max(r.b for r in uses if r.s == s) + 1
        assert max(n) - (min(n) if len(n) >= blocks else 0) <= 1  # no block again before all once


def test_report(spark):
    docs, weights = frames(spark)
    r = {x.source: x for x in mix.report(docs, weights, block=16).collect()}
    assert set(r) == {"Big", "mid", "tiny", "absent"} and r["absent"].short and r["absent"].actual == 0
    total, sums = sum(x.tokens for x in r.values()), 10.0
    limit = {"Big": (5, 2), "mid": (3, 1), "tiny": (1, 3), "absent": (1, 5)}
    assert all(x.short == (limit[s][0] / sums * total > x.tokens * limit[s][1]) for s, x in r.items())
    assert abs(sum(x.actual for x in r.values()) - 1) < 1e-9


def test_draws_keep_shares_and_limits():
    weight, blocks, uses = np.array([5.0, 3, 2, 0]), np.array([4000, 500, 100, 50]), np.array([2, 2, 4, 9])
    n = mix.draw_counts(weight, blocks, uses, 4650, 37, 1)
    assert n.sum() == 4650 and (n.sum(axis=0) <= blocks * uses).all() and (n >= 0).all()
    assert abs(n[:, 2].sum() - 400) <= 40 and n[:, 3].sum() == 0
    assert (n == mix.draw_counts(weight, blocks, uses, 4650, 37, 1)).all()
    assert mix.draw_counts(weight * 0, blocks, uses, 10, 3, 1).sum() == 0


def test_permutation(spark):
    for n in (1, 2, 7, 64, 1000):
        df = spark.range(n).withColumn("n", F.lit(n).cast("long"))
        assert sorted(r[0] for r in df.select(mix.permuted(F.col("id"), F.col("n"), F.lit("key"))).collect()) == list(range(n))


def test_empty(spark):
    docs, weights = frames(spark)
    assert mix.mix(docs.limit(0), weights).count() == 0
    assert all(r.tokens == 0 for r in mix.report(docs.limit(0), weights).collect())
    assert mix.report(docs, weights.limit(0)).count() == 0
