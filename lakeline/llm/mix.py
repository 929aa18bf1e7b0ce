"""Mixing sources to target weights (problem 8).

1. Documents of the listed sources are encoded; each source's tokens, in a pseudorandom but fixed order
   of documents, are one stream, cut into blocks of ``block`` tokens (the last one may be shorter). Offsets are
   prefix sums in two levels: over buckets of documents, then within one bucket, so that no task ever
   holds a source.
2. Slots of the mixture (as many blocks as all listed sources have) are split over output shards. For
   each shard the number of slots by source is drawn from a multinomial distribution; a source whose
   ``max_uses`` are spent gives its slots in excess to sources that still have some.
3. The k-th slot of a source takes block perm(k mod n) of use k div n, where perm is a pseudorandom
   permutation of that source and use (a Feistel network with a short walk): every block is used
   once before any is used again. Slots meet blocks in an equi-join by (source, block).

Only tables of one row a source, and the shards by sources matrix (at most ``SHARDS`` rows) are
held by the driver; both are bounded by parameters, not by the data.

Edge cases: sources are compared trimmed and in lower case; rows without source, and sources that are
not listed or have a null or negative weight take no part; null and empty texts have no tokens; a
source listed twice has its weights added and the smaller max_uses; a null max_uses is 1; listed sources without
documents are reported with share 0; equal documents are separate documents.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeline.llm.tokens import VOCABULARY, count_tokens, encode_column
from lakeline.session import materialise

BLOCK = 256
SHARDS = 1024
BUCKET_DOCS = 2000
SLOTS_A_TASK = 1 << 14


def source_key(c: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(c, r"[\s\p{Z}]+", " ")))


def listed_sources(weights: DataFrame) -> DataFrame:
    """(s, source, weight, max_uses), one row a listed source."""
    w = weights.where("source is not null and weight >= 0").select("source", source_key(F.col("source")).alias("s"), F.col("weight").cast("double"), F.greatest(F.coalesce("max_uses", F.lit(1)), F.lit(0)).cast("long").alias("max_uses"))
    return w.groupBy("s").agg(F.min("source").alias("source"), F.sum("weight").alias("weight"), F.min("max_uses").alias("max_uses"))


def source_tokens(docs: DataFrame, weights: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(source, s, weight, max_uses, tokens, docs) of each listed source; counted over every document."""
    listed = listed_sources(weights)
    mine = docs.select(source_key(F.col("source")).alias("s"), "text").join(listed.select("s"), "s", "left_semi")
    per = count_tokens(mine, "text", vocabulary=vocabulary).groupBy("s").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs"))
    return listed.join(per, "s", "left").withColumns({"tokens": F.coalesce("tokens", F.lit(0)), "docs": F.coalesce("docs", F.lit(0))})


def feasibility(sources: DataFrame) -> DataFrame:
    """Adds target (tokens asked for), most (tokens to be had) and short (the share can't be reached)."""
    sums = sources.agg(F.sum("weight").alias("sum_w"), F.sum("tokens").alias("total"))
    out = sources.join(F.broadcast(sums)).withColumn("target", F.coalesce(F.col("weight") / F.nullif(F.col("sum_w"), F.lit(0.0)) * F.col("total"), F.lit(0.0)))
    out = out.withColumn("most", F.col("tokens") * F.col("max_uses"))
    return out.withColumn("short", F.col("target") > F.col("most")).drop("sum_w", "total")


def packed_documents(docs: DataFrame, weights: DataFrame, vocabulary: str = VOCABULARY, seed: int = 0, ids: bool = True) -> DataFrame:
    """(s, at, n) of each document of a listed source that has tokens, and its ``ids`` if asked for: n tokens from place ``at`` of the source's stream."""
    mine = docs.select("doc_id", source_key(F.col("source")).alias("s"), "text").join(listed_sources(weights).select("s"), "s", "left_semi")
    coded = encode_column(mine, "text", vocabulary=vocabulary).withColumn("n", F.size("ids").cast("long")) if ids else count_tokens(mine, "text", out="n", vocabulary=vocabulary)
    coded = materialise(coded.where("n > 0"), "ids" if ids else "counts")
    buckets = max(1, coded.count() // BUCKET_DOCS)
    # Documents are put in order by a hash of their id; a bucket is a range of it, of about BUCKET_DOCS documents whatever the source.
    coded = coded.withColumn("r", F.xxhash64("doc_id", F.lit(seed))).withColumn("q", F.floor((F.col("r") / F.lit(2.0**64) + 0.5) * buckets).cast("int"))
    sums = materialise(coded.groupBy("s", "q").agg(F.sum("n").alias("n")), "sums")
    by_source = F.expr("sum(n) over (partition by s order by q rows between unbounded preceding and 1 preceding)")
    base = sums.select("s", "q", F.coalesce(by_source, F.lit(0)).alias("base"))
    inside = F.expr(f"sum(n) over (partition by s, q order by r, doc_id, {'ids' if ids else 'n'} rows between unbounded preceding and 1 preceding)")
    placed = coded.withColumn("before", F.coalesce(inside, F.lit(0))).join(base, ["s", "q"])
    return placed.select("s", (F.col("base") + F.col("before")).alias("at"), "n", *(["ids"] if ids else []))


def _cut(placed: DataFrame, block: int) -> DataFrame:
    """A row for each block a document reaches into, with the places low and high of the part in it."""
    first, last = F.floor(F.col("at") / block), F.floor((F.col("at") + F.col("n") - 1) / block)
    cut = placed.select("*", F.explode(F.sequence(first, last)).alias("b"))
    return cut.withColumns({"low": F.greatest(F.col("at"), F.col("b") * block), "high": F.least(F.col("at") + F.col("n"), (F.col("b") + 1) * block)})


def token_blocks(docs: DataFrame, weights: DataFrame, block: int = BLOCK, vocabulary: str = VOCABULARY, seed: int = 0) -> DataFrame:
    """(s, b, ids): block b = 0, 1, ... of each listed source's token stream."""
    cut = _cut(packed_documents(docs, weights, vocabulary, seed), block)
    piece = F.slice("ids", (F.col("low") - F.col("at") + 1).cast("int"), (F.col("high") - F.col("low")).cast("int"))
    return cut.select("s", "b", F.col("low").alias("o"), piece.alias("p")).groupBy("s", "b").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("o", "p"))), lambda x: x["p"])).alias("ids"))


def block_sizes(docs: DataFrame, weights: DataFrame, block: int = BLOCK, vocabulary: str = VOCABULARY, seed: int = 0) -> DataFrame:
    """(s, b, size) of the blocks of ``token_blocks``, packed by the documents' numbers of tokens alone."""
    cut = _cut(packed_documents(docs, weights, vocabulary, seed, ids=False), block)
    return cut.groupBy("s", "b").agg(F.sum(F.col("high") - F.col("low")).alias("size"))


def reachable(weight: np.ndarray, most: np.ndarray, slots: int) -> np.ndarray:
    """Shares of the slots: by weight, sources beyond their ``most`` held to it, the rest shared out again."""
    want, open_ = np.zeros(len(weight)), (weight > 0) & (most > 0)
    left = float(slots)
    while open_.any() and left > 1e-9:
        give = np.where(open_, weight, 0) / weight[open_].sum() * left
        full = open_ & (want + give >= most)
        if not full.any():
            return want + give
        want[full] = most[full]
        open_ &= ~full
        left = slots - want.sum()
    return want


def draw_counts(weight: np.ndarray, blocks: np.ndarray, max_uses: np.ndarray, slots: int, shards: int, seed: int) -> np.ndarray:
    """Slots by shard and source: multinomial draws, no source beyond blocks * max_uses in all."""
    most = (blocks * max_uses).astype(np.int64)
    want = reachable(weight, most.astype(float), slots)
    if not want.sum():
        return np.zeros((shards, len(weight)), np.int64)
    p = want / want.sum()
    sizes = np.full(shards, slots // shards, np.int64)
    sizes[: slots % shards] += 1
    left, out = most.copy(), np.zeros((shards, len(weight)), np.int64)
    for i, size in enumerate(sizes):
        n = np.random.default_rng([seed, i]).multinomial(size, p)
        over = np.maximum(n - left, 0)
        n -= over
        spare = np.where(want > 0, left - n, 0)
        # What spent sources can't give falls to those with the most left in proportion; order decides ties.
        rest = min(int(over.sum()), int(spare.sum()))
        if rest:
            share = np.floor(spare / spare.sum() * rest).astype(np.int64)
            for j in np.argsort(-(spare - share), kind="stable"):
                if share.sum() >= rest:
                    break
                share[j] += min(rest - share.sum(), spare[j] - share[j])
            n += share
        left -= n
        out[i] = n
    return out


def permuted(k: Column, n: Column, key: Column, rounds: int = 4) -> Column:
    """A pseudorandom permutation of 0..n-1 that ``key`` chooses: a Feistel network over the smallest near-square rectangle of n or more, walked until inside."""
    wide = F.greatest(F.lit(1), F.ceil(F.sqrt(n.cast("double")))).cast("long")
    high = F.greatest(F.lit(1), F.ceil(n / wide)).cast("long")

    def once(x: Column) -> Column:
        state = F.struct(F.call_function("div", x, high).alias("l"), (x % high).alias("r"))
        return F.aggregate(
            F.array(*map(F.lit, range(rounds))), state,
            lambda a, i: F.when(i % 2 == 0, F.struct(F.pmod(a["l"] + F.pmod(F.xxhash64(a["r"], i, key), wide), wide).alias("l"), a["r"].alias("r")))
            .otherwise(F.struct(a["l"].alias("l"), F.pmod(a["r"] + F.pmod(F.xxhash64(a["l"], i, key), high), high).alias("r"))),
            lambda a: a["l"] * high + a["r"],
        )

    # Fewer than sqrt(n) + 1 values lie outside, and a walk meets none twice: 24 steps always suffice up to n = 500, beyond it but for a chance of 1e-32.
    return F.aggregate(F.sequence(F.lit(1), F.lit(24)), F.struct(k.cast("long").alias("x"), F.lit(False).alias("ok")), lambda a, _: F.when(a["ok"], a).otherwise(_walked(once(a["x"]), n)), lambda a: a["x"])


def _walked(x: Column, n: Column) -> Column:
    return F.get(F.transform(F.array(x), lambda v: F.struct(v.alias("x"), (v < n).alias("ok"))), F.lit(0))


def mixture_plan(blocks: DataFrame, weights: DataFrame, block: int = BLOCK, shards: int = SHARDS, seed: int = 0) -> DataFrame:
    """(shard, s, use, b): every slot of the mixture and the block it takes."""
    spark = blocks.sparkSession
    have = {r.s: r.n for r in blocks.groupBy("s").agg(F.count("*").alias("n")).collect()}  # one row a listed source
    listed = listed_sources(weights).orderBy("s").collect()
    n = np.array([have.get(r.s, 0) for r in listed], dtype=np.int64)
    slots = int(n.sum())
    shards = max(1, min(shards, slots))
    counts = draw_counts(np.array([r.weight for r in listed], dtype=float), n, np.array([r.max_uses for r in listed], dtype=np.int64), slots, shards, seed)
    base = np.cumsum(counts, axis=0) - counts
    i, j = np.nonzero(counts)
    draws = pd.DataFrame({"shard": i, "s": [listed[x].s for x in j], "n": n[j], "base": base[i, j], "c": counts[i, j]})
    drawn = spark.createDataFrame(draws, "shard int, s string, n long, base long, c long")
    # In two steps, so that no array holds all slots a shard takes from a source; between them the work is spread, a task for every ``SLOTS_A_TASK``.
    end = F.col("base") + F.col("c") - 1
    step = drawn.select("shard", "s", "n", end.alias("end"), F.explode(F.sequence(F.col("base"), end, F.lit(4096).cast("long"))).alias("k0")).repartition(-(-max(slots, 1) // SLOTS_A_TASK), "shard", "s", "k0")
    slot = step.select("shard", "s", "n", F.explode(F.sequence(F.col("k0"), F.least(F.col("k0") + 4095, F.col("end")))).alias("k"))
    use = F.floor(F.col("k") / F.col("n"))
    return slot.select("shard", "s", use.alias("use"), permuted(F.col("k") % F.col("n"), F.col("n"), F.concat_ws("\u0001", "s", use.cast("string"), F.lit(str(seed)))).alias("b"))


def mix(docs: DataFrame, weights: DataFrame, block: int = BLOCK, shards: int = SHARDS, seed: int = 0, vocabulary: str = VOCABULARY) -> DataFrame:
    """(shard, source key s, use, b, ids): the mixture, block by block."""
    blocks = materialise(token_blocks(docs, weights, block, vocabulary, seed), "blocks")
    return mixture_plan(blocks, weights, block, shards, seed).join(blocks, ["s", "b"])


def report(docs: DataFrame, weights: DataFrame, block: int = BLOCK, shards: int = SHARDS, seed: int = 0, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row a listed source: asked and actual share in tokens, uses, and whether its share can't be reached.

    Sizes are those of the packed blocks, which hold every token of the source once.
    """
    blocks = materialise(block_sizes(docs, weights, block, vocabulary, seed), "sizes")
    have = blocks.groupBy("s").agg(F.sum("size").alias("tokens"), F.count("*").alias("blocks"))
    listed = listed_sources(weights).join(have, "s", "left").withColumns({"tokens": F.coalesce("tokens", F.lit(0)), "blocks": F.coalesce("blocks", F.lit(0))})
    listed = feasibility(listed)
    got = mixture_plan(blocks, weights, block, shards, seed).join(blocks, ["s", "b"]).groupBy("s").agg(F.sum("size").alias("got"), (F.max("use") + 1).alias("uses"))
    got = materialise(got, "got")  # one row a source
    sums = got.agg(F.sum("got").alias("all_got"))
    asked = listed.agg(F.sum("weight").alias("sum_w"))
    out = listed.join(got, "s", "left").join(F.broadcast(sums)).join(F.broadcast(asked))
    return out.select(
        "source", F.coalesce(F.col("weight") / F.nullif(F.col("sum_w"), F.lit(0.0)), F.lit(0.0)).alias("asked"),
        F.coalesce(F.col("got") / F.nullif(F.col("all_got"), F.lit(0)), F.lit(0.0)).alias("actual"),
        "tokens", "blocks", F.coalesce("got", F.lit(0)).alias("got"), F.coalesce("uses", F.lit(0)).cast("long").alias("uses"), "max_uses", "short",
    )
