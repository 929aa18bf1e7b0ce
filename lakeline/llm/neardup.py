"""Near-duplicate records with small edits: a grouped prefix join (problem 4).

Exact for Jaccard similarity of word sets. Records with the same word set form one class; words are
ordered from rare to frequent; classes with the same prefix and size form one group. Only groups are
joined, on a rare word or two frequent ones of their prefixes, with filters by length, position and signature; the pairs
of groups that remain are expanded to classes and verified, and only then to records. Text never travels: words are 64-bit
hashes. No side of these joins is broadcast but the vocabulary, and that only below the session's limit.

Edge cases: null texts count as empty; records with fewer than ``least`` distinct words, or without
id, pair with nothing; versions of one id are each compared, and never with one another; repeated
rows change nothing; empty tables give no pairs; markup and entities follow TESTDATA.md.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeline.session import materialise

THRESHOLD = (7, 10)
LEAST_WORDS = 8
RARE = 64  # classes a word may stand in to be a key by itself; any number gives the same pairs
_TAG = re.compile(r"<[^<>]*>")
_WORD = re.compile(r"[^\W_]+")


def words_of(title: str | None, summary: str | None) -> list[str]:
    """Distinct words, sorted: tags to blanks, entities to characters, NFC, lower case, runs of letters or digits."""
    text = f"{title or ''} {summary or ''}"
    text = unicodedata.normalize("NFC", html.unescape(_TAG.sub(" ", text))).lower()
    return sorted(set(_WORD.findall(text)))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _words(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for title, summary in batches:
        yield pd.Series([words_of(a, b) for a, b in zip(title, summary)])


def need(size: Column, num: int, den: int) -> Column:
    """Smallest size of a set that can be num/den similar to one of ``size``: ceil(num * size / den)."""
    return F.floor((size * num + (den - 1)) / den).cast("int")


def word_classes(df: DataFrame, id_: str, title: str, summary: str, least: int) -> tuple[DataFrame, DataFrame]:
    """(members: id, c) and (classes: c, t) of records with the same word set; t holds word hashes."""
    w = df.where(F.col(id_).isNotNull()).select(F.col(id_).alias("id"), _words(F.col(title), F.col(summary)).alias("w")).where(F.size("w") >= least)
    rows = materialise(w.select("id", F.unhex(F.md5(F.array_join("w", " "))).alias("c"), F.transform("w", lambda x: F.xxhash64(x)).alias("t")), "words")
    return rows.select("id", "c").distinct(), rows.groupBy("c").agg(F.first("t").alias("t"))


def merge_join(a: DataFrame, b: DataFrame, on: str | Column | list, how: str = "inner") -> DataFrame:
    """A join by shuffle and merge whatever the estimate. The sides here are explodes, or Parquet that dictionaries
    make small: their estimates are far too low for a broadcast to be decided on. Skewed partitions are split at run time."""
    return a.hint("merge").join(b.hint("merge"), on, how)


def _keys(groups: DataFrame, prefix: Column, side: str) -> DataFrame:
    """(w, g, n, r, sig) of each key of a prefix; r bounds the words a set can share if this key is the first it shares.

    A rare word is a key by itself; a frequent one only together with each word after it.
    """
    words = groups.select("g", "n", "sig", prefix.alias("p")).select("*", F.posexplode("p").alias("i", "x")).where(F.col("i") + 1 < F.size("p"))
    after = F.transform(F.slice("p", F.col("i") + 2, F.size("p")), lambda y, k: F.struct(F.xxhash64("x.w", y["w"]).alias("w"), (F.col("n") - F.col("i") - k).alias("r")))
    alone = F.array(F.struct(F.xxhash64("x.w").alias("w"), (F.col("n") - F.col("i")).alias("r")))
    keys = words.select("g", "n", "sig", F.inline(F.when(F.col("x.df") <= RARE, alone).otherwise(after)))
    return keys.select("w", *[F.col(c).alias(f"{c}{side}") for c in ("g", "n", "r", "sig")])


def similar_classes(classes: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): classes a < b whose sets share at least num/den (over a half) of the words either has.

    Sets that share k words share two of them within their first n - k + 2, counted from the rarest, and one within the
    first n - k + 1. The key is the first shared word where that is rare (in at most ``RARE`` classes), and else the first
    two: keys stay selective where the vocabulary does not grow with the corpus.
    """
    words = classes.select("c", F.explode("t").alias("w"))
    df = materialise(words.groupBy("w").agg(F.count("*").alias("df")), "vocabulary")
    # The written vocabulary has a known size: below the session's limit it is broadcast, and a class is put together again before it is shuffled.
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("w").bitwiseAND(63).cast("int"))
    ordered = words.join(df, "w").groupBy("c").agg(F.array_sort(F.collect_list(F.struct("df", "w"))).alias("s"), F.bit_xor(bit).alias("sig"))
    n = F.size("s")
    # Of a pair a has no more words than b. With b at least num/den n_b words are shared, with a at least 2 num / (num + den) n_a.
    longer, shorter = n - need(n, num, den) + 2, n - need(n, 2 * num, num + den) + 2
    ordered = ordered.select("c", "sig", F.transform("s", lambda x: x["w"]).alias("t"), n.alias("n"), F.slice("s", 1, longer).alias("p"), F.least(shorter, n).alias("short"))
    ordered = materialise(ordered.select("c", F.xxhash64("n", "p").alias("g"), "n", "t", "p", "short", "sig"), "ordered")
    # A group is a size and a prefix. Its label may by chance be that of another one too: that adds candidates, it loses none.
    groups = ordered.groupBy("g", "n", "p", "short").agg(F.count("*").alias("m"), F.min("sig").alias("sig"))
    # The parities of 64 parts of the vocabulary tell apart what differs too much; a group of several sets has no one signature.
    groups = materialise(groups.withColumn("sig", F.when(F.col("m") == 1, F.col("sig"))), "groups")

    a = _keys(groups, F.slice("p", 1, F.col("short")), "a")
    b = _keys(groups, F.col("p"), "b")
    shared = F.floor(((F.col("na") + F.col("nb")) * num + (num + den - 1)) / (num + den))
    near = (F.col("na") * den >= F.col("nb") * num) & ((F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("ga") < F.col("gb")))) & (F.least("ra", "rb") >= shared)
    alike = F.coalesce(F.bit_count(F.col("siga").bitwiseXOR(F.col("sigb"))) <= F.col("na") + F.col("nb") - 2 * shared, F.lit(True))
    pairs = merge_join(a, b, "w").where(near & alike).select("ga", "gb").distinct()
    # A group of several classes is also held against itself.
    own = groups.groupBy("g").agg(F.sum("m").alias("m")).where("m > 1").select(F.col("g").alias("ga"), F.col("g").alias("gb"))
    x = ordered.select(F.col("g").alias("ga"), F.col("c").alias("ca"), F.col("t").alias("ta"))
    y = ordered.select(F.col("g").alias("gb"), F.col("c").alias("cb"), F.col("t").alias("tb"))
    both = merge_join(merge_join(pairs.unionByName(own), x, "ga"), y, "gb").where((F.col("ga") != F.col("gb")) | (F.col("ca") < F.col("cb")))
    common = F.size(F.array_intersect("ta", "tb"))
    close = both.where(common * den >= (F.size("ta") + F.size("tb") - common) * num)
    return close.select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b"))


def near_duplicates(df: DataFrame, *, id_: str = "id", title: str = "title", summary: str = "summary", threshold: tuple[int, int] = THRESHOLD, least: int = LEAST_WORDS) -> DataFrame:
    """(id_a, id_b), id_a < id_b: every pair of records that is similar enough."""
    members, classes = word_classes(df, id_, title, summary, least)
    if 2 * threshold[0] <= threshold[1]:
        raise ValueError("the threshold must exceed a half")
    links = similar_classes(classes, *threshold)
    a, b = members.select(F.col("id").alias("x"), F.col("c").alias("a")), members.select(F.col("id").alias("y"), F.col("c").alias("b"))
    apart = merge_join(merge_join(links, a, "a"), b, "b").where("x <> y").select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))
    same = merge_join(a, b, F.col("a") == F.col("b")).where("x < y").select(F.col("x").alias("id_a"), F.col("y").alias("id_b"))
    return apart.unionByName(same).distinct()


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(v, label): smallest node that can be reached. Labels spread over edges and jump to the label of their label, each round written
    to the shared folder, until none changes: rounds grow with the logarithm of the longest path."""
    both = materialise(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v"))).distinct(), "edges")
    labels = nodes.select("v", F.col("v").alias("label"))
    while True:
        near = merge_join(both, labels, "v").groupBy(F.col("u").alias("v")).agg(F.min("label").alias("m"))
        step = materialise(merge_join(labels, near, "v", "left").select("v", F.least("label", "m").alias("l"), F.col("label").alias("was")), "labels")
        jump = merge_join(step, step.select(F.col("v").alias("l"), F.col("l").alias("far")), "l", "left").select("v", F.coalesce("far", "l").alias("label"), "was")
        labels = materialise(jump, "labels")
        if not labels.where("label <> was").limit(1).count():
            return labels.select("v", "label")
        labels = labels.drop("was")


def duplicate_groups(df: DataFrame, *, id_: str = "id", title: str = "title", summary: str = "summary", threshold: tuple[int, int] = THRESHOLD, least: int = LEAST_WORDS) -> DataFrame:
    """(id, group, links) of each record that is similar to another: the smallest id it is connected to, and to how many it is similar.

    Works on classes of equal texts; copies are counted, not expanded into pairs.
    """
    members, classes = word_classes(df, id_, title, summary, least)
    links = materialise(similar_classes(classes, *threshold), "links")
    # Versions of one id connect their classes.
    first = members.groupBy("id").agg(F.min("c").alias("a"), F.count("*").alias("versions"))
    held = materialise(merge_join(members, first, "id"), "members")
    versions = held.where("a <> c").select("a", F.col("c").alias("b"))
    label = components(classes.select(F.col("c").alias("v")), links.unionByName(versions))
    labelled = merge_join(held, label, held["c"] == label["v"]).select("id", "label").distinct()
    group = labelled.groupBy("label").agg(F.min("id").alias("group"))
    placed = merge_join(labelled, group, "label").groupBy("id").agg(F.min("group").alias("group"))
    # Classes a record is similar to: its own and those linked to them.
    around = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).unionByName(classes.select(F.col("c").alias("a"), F.col("c").alias("b")))
    reach = held.select("id", F.col("versions").alias("own"), F.col("c").alias("from"))
    reach = merge_join(reach, around, F.col("from") == F.col("a")).select("id", "own", F.col("b").alias("c")).distinct()
    single = held.where("versions = 1").groupBy("c").agg(F.count("*").alias("k"))
    counted = merge_join(reach, single, "c").groupBy("id", "own").agg(F.sum("k").alias("k")).select("id", (F.col("k") - F.when(F.col("own") == 1, 1).otherwise(0)).alias("k"))
    # Ids with several versions may be reached through more than one; those few are told apart by name.
    several = merge_join(reach, held.where("versions > 1").select("c", F.col("id").alias("other")), "c").where("id <> other").groupBy("id").agg(F.count_distinct("other").alias("k"))
    total = counted.unionByName(several).groupBy("id").agg(F.sum("k").alias("links")).where("links > 0")
    return merge_join(total, placed, "id").select("id", "group", "links")
