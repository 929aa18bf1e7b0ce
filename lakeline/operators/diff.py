"""What changed between consecutive full snapshots (problem 5).

Rows are normalised and hashed; identical rows of one delivery count once. EXCEPT ALL between each
delivery and the one before it, both ways, is one aggregation: every distinct row version carries a
bit mask of the deliveries it stands in (32 deliveries a word, with the last of the word before as
bit 0), so a bit that is set where its neighbour is not *is* the residue of that pair in that
direction. A row that never changes is shuffled once, not once per pair. The residues alone are then
joined in full by (pair, key) and labelled.

Coordinates only differ beyond a tolerance. That relation is not transitive, so row versions are
compared pairwise: a residue is void if any row of the other side, itself a residue or not, has the
same text and coordinates within it.

A key with several distinct rows in a delivery is changed if any of its rows has no equal on the
other side, added or removed only if the other side has no row of that key at all. Rows whose key
is null or blank form one key, null. Deliveries without rows repeat the content before them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeline.session import materialise

WORD = 32
_BLANKS = r"[\s\p{Z}\u0085\u001c-\u001f]+"


def clean_text(c: Column) -> Column:
    """White space runs (no-break too) as one blank, trimmed; empty is null."""
    return F.nullif(F.trim(F.regexp_replace(c, _BLANKS, " ")), F.lit(""))


def order_deliveries(log: DataFrame, rows: DataFrame, snap: str, group: list[str], at: str) -> DataFrame:
    """(snap, g, n): deliveries that have rows, numbered within their group by time. A small table: one row per delivery."""
    have = rows.select(snap).distinct()
    kept = log.groupBy(snap).agg(*[F.min(c).alias(c) for c in group], F.min(at).alias(at)).join(have, snap, "left_semi")
    g = F.concat_ws("\u0001", *[F.coalesce(c, F.lit("\u0002")) for c in group])
    return kept.select(snap, g.alias("g"), F.row_number().over(Window.partitionBy(g).orderBy(at, snap)).alias("n"))


def diff_snapshots(
    rows: DataFrame, log: DataFrame, *, key: str, text: list[str], exact: list[str] = (), close: list[str] = (), tolerance: float = 1e-5,
    snap: str = "snap_id", group: tuple[str, ...] = ("source", "kind"), at: str = "fetched_at",
) -> DataFrame:
    """(snap, key, change): added, removed or changed by each delivery against the one before."""
    order = materialise(order_deliveries(log, rows, snap, list(group), at), "deliveries")  # one row a delivery
    pieces = [F.coalesce(clean_text(F.col(f"`{c}`")), F.lit("")) for c in text] + [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\u0002")) for c in exact]
    near = [f"x{i}" for i in range(len(close))]
    slim = rows.select(
        F.col(snap).alias("snap"), clean_text(F.col(f"`{key}`")).alias("k"), F.xxhash64(*pieces).alias("h1"), F.xxhash64(F.lit("again"), *pieces).alias("h2"),
        *[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")).alias(x) for c, x in zip(close, near)],
    ).join(order.withColumnRenamed(snap, "snap"), "snap")
    # n = 1.. ; bit b of word w is delivery w * 32 + b, bit 0 the last one of the word before.
    word = F.floor((F.col("n") - 1) / WORD).cast("int")
    bit = F.col("n") - word * WORD
    one = F.lit(1).cast("long")
    slots = F.when(bit == WORD, F.array(F.struct(word.alias("w"), F.lit(1 << WORD).cast("long").alias("m")), F.struct((word + 1).alias("w"), one.alias("m")))).otherwise(
        F.array(F.struct(word.alias("w"), F.call_function("shiftleft", one, bit.cast("int")).alias("m")))
    )
    versions = slim.select("g", "k", "h1", "h2", *near, F.explode(slots).alias("z")).groupBy("g", "z.w", "k", "h1", "h2", *near).agg(F.bit_or("z.m").alias("m"))

    # Read by several branches below; written once, so that the deliveries are scanned and normalised once.
    versions = materialise(versions, "versions")

    # What stands in a delivery up to the tolerance: the bits of all row versions of the same key and text that are close.
    cover = versions.withColumn("c", F.col("m"))
    if near:
        same = [F.col(f"p.{c}").eqNullSafe(F.col(f"q.{c}")) for c in ("g", "w", "k", "h1", "h2")]
        close_to = [(F.col(f"p.{x}").isNull() & F.col(f"q.{x}").isNull()) | F.coalesce(F.abs(F.col(f"p.{x}") - F.col(f"q.{x}")) <= tolerance * (1 + 1e-7), F.lit(False)) for x in near]
        pairs = versions.alias("p").join(versions.alias("q"), [*same, *close_to]).select("p.*", F.col("q.m").alias("c"))
        cover = pairs.groupBy("g", "w", "k", "h1", "h2", *near).agg(F.first("m").alias("m"), F.bit_or("c").alias("c"))

    # Residues of EXCEPT ALL: new ones stand in the delivery and not the one before, the others the other way.
    has = lambda c, bit: F.col(c).bitwiseAND(bit) != 0
    bits = F.array(*[F.struct(F.lit(b).alias("b"), F.lit(1 << b).cast("long").alias("v"), F.lit(1 << (b - 1)).cast("long").alias("p")) for b in range(1, WORD + 1)])
    signed = F.transform(
        F.filter(bits, lambda x: (has("m", x["v"]) & ~has("c", x["p"])) | (has("m", x["p"]) & ~has("c", x["v"]))),
        lambda x: F.struct((F.col("w") * WORD + x["b"]).alias("n"), has("m", x["v"]).alias("new")),
    )
    # Delivery 1 has none before it; a delivery beyond the last does not exist.
    last = order.groupBy("g").agg(F.max("n").alias("last"))
    residues = cover.select("g", "k", F.explode(signed).alias("r")).select("g", "k", "r.n", "r.new").join(last, "g").where("n > 1 and n <= last").drop("last")
    open_ = residues.select("g", "n", "k", F.col("new").alias("plus"), (~F.col("new")).alias("minus"))
    # The full join of both residues by key, as one aggregation over their union.
    sides = open_.groupBy("g", "n", "k").agg(F.max("plus").alias("plus"), F.max("minus").alias("minus")).withColumn("w", F.floor((F.col("n") - 1) / WORD).cast("int"))
    present = versions.groupBy("g", "w", "k").agg(F.bit_or("m").alias("have"))
    s, p = sides.alias("s"), present.alias("p")
    both = s.join(p, [F.col("s.g") == F.col("p.g"), F.col("s.w") == F.col("p.w"), F.col("s.k").eqNullSafe(F.col("p.k"))]).select("s.*", "p.have")
    at_bit = lambda d: F.col("have").bitwiseAND(F.call_function("shiftleft", one, (F.col("n") - F.col("w") * WORD - d).cast("int"))) != 0
    label = F.when(~at_bit(1), "added").when(~at_bit(0), "removed").otherwise("changed")
    return both.withColumn("change", label).join(order, ["g", "n"]).select(F.col(snap), F.col("k").alias(key), "change")
