"""From positioned text lines to a layout plan: paragraphs, columns, room, pitch and line placement.

Lines are rows (report_id, page, idx, page_width, page_height, text, x0, y0, x1, y1, size, color, bold,
baseline); pages are the unit of partitioning, so no window or join is larger than a page.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeline.functions.text import has_letters, strip

PAGE = ("report_id", "page")
WIDE = 0.30  # of the page's width: what counts as running text
LEAST_SIZE, MOST_SIZE, STEP = 4.0, 11.0, 0.25


def text_lines(lines: DataFrame) -> DataFrame:
    """Lines with letters; numbers, rules and blanks are left alone."""
    return lines.where((strip(F.col("text")) != "") & has_letters(F.col("text")))


def islands(df: DataFrame, by: list[str], order: list[str], joins: Column, out: str) -> DataFrame:
    """Number runs of rows from 0: a row belongs to the run before it where ``joins`` holds (over columns and F.lag)."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_b", F.when(F.coalesce(joins, F.lit(False)), 0).otherwise(1)).withColumn(out, F.sum("_b").over(w) - 1).drop("_b")


def _same_style(prev: Callable[[str], Column], size: str = "size") -> Column:
    return (F.abs(F.col(size) - prev(size)) < 0.6) & (F.col("color") == prev("color")) & (F.col("bold") == prev("bold"))


def paragraphs(lines: DataFrame) -> DataFrame:
    """Adds ``para``: consecutive lines of one left edge, style and regular pitch, as long as the line before is wide."""
    w = Window.partitionBy(*PAGE).orderBy("idx")
    prev = lambda c: F.lag(c).over(w)
    pitch = F.col("y0") - prev("y0")
    joins = (
        (F.abs(F.col("x0") - prev("x0")) < 2.0) & _same_style(prev) & (pitch > 0) & (pitch < 3.0 * F.greatest("size", F.lit(1.0)))
        & (prev("x1") - prev("x0") > WIDE * F.col("page_width"))
    )
    return islands(lines, list(PAGE), ["idx"], joins, "para")


def _ordered_text(col: str, sep: str) -> Column:
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", col))), lambda x: x[col]), sep)


def paragraph_table(lines: DataFrame) -> DataFrame:
    """One row a paragraph: bounds, style of its first line, text joined with blanks."""
    return lines.groupBy(*PAGE, "para").agg(
        F.min("idx").alias("idx"), F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.min("y0").alias("y0"), F.max("y1").alias("y1"), F.count("*").alias("n_lines"),
        *[F.min_by(c, "idx").alias(c) for c in ("size", "color", "bold", "page_width", "page_height")], _ordered_text("text", " ").alias("text"),
    )


def columns(paras: DataFrame) -> DataFrame:
    """Adds ``block``: neighbouring wide paragraphs of one left edge and style with a small gap flow together."""
    w = Window.partitionBy(*PAGE).orderBy("para")
    prev = lambda c: F.lag(c).over(w)
    wide = WIDE * F.col("page_width")
    gap = F.col("y0") - prev("y1")
    joins = (
        (F.col("x1") - F.col("x0") > wide) & (prev("x1") - prev("x0") > wide) & (F.abs(F.col("x0") - prev("x0")) < 2.0) & _same_style(prev)
        & (gap >= 0) & (gap < 2.5 * F.greatest("size", F.lit(1.0)))
    )
    return islands(paras, list(PAGE), ["para"], joins, "block")


def room_limit(blocks: DataFrame, lines: DataFrame, margin: float = 20.0) -> DataFrame:
    """Adds ``bottom``: down to the nearest other text below that shares more than one point of width, else the margin.

    ``lines`` carry their block. Equi-join on the page with the geometry as residual condition.
    """
    b, r = blocks.alias("b"), lines.select(*PAGE, F.col("block").alias("r_block"), F.col("x0").alias("rx0"), F.col("x1").alias("rx1"), F.col("y0").alias("ry0")).alias("r")
    below = (
        reduce(lambda p, q: p & q, [F.col(f"b.{k}") == F.col(f"r.{k}") for k in PAGE]) & (F.col("b.block") != F.col("r_block"))
        & (F.col("ry0") >= F.col("b.y1") - 1.0) & (F.least("b.x1", "rx1") - F.greatest("b.x0", "rx0") > 1.0)
    )
    near = b.join(r, below).groupBy(*[F.col(f"b.{k}").alias(k) for k in PAGE], F.col("b.block").alias("block")).agg(F.min(F.col("ry0") - 2.0).alias("_near"))
    return blocks.join(near, [*PAGE, "block"], "left").withColumn("bottom", F.least(F.col("page_height") - margin, F.col("_near"))).drop("_near")


def upper_median(values: Column) -> Column:
    """Element n // 2 of the sorted array; null for an empty one."""
    s = F.array_sort(values)
    return F.get(s, F.floor(F.size(s) / 2).cast("int"))


def pitch_table(lines: DataFrame, by: list[str]) -> DataFrame:
    """(by, pitch, baseline0, last_baseline, n_lines): the upper median of the steps between baselines, 0 for a lone line."""
    w = Window.partitionBy(*by).orderBy("idx")
    steps = lines.withColumn("_s", F.col("baseline") - F.lag("baseline").over(w))
    return steps.groupBy(*by).agg(
        F.coalesce(upper_median(F.collect_list("_s")), F.lit(0.0)).alias("pitch"), F.min_by("baseline", "idx").alias("baseline0"),
        F.max_by("baseline", "idx").alias("last_baseline"), F.count("*").alias("n_lines"),
    )


def box(blocks: DataFrame) -> DataFrame:
    """Adds width and slots: a lone line may grow right by 55, a block by 8; as many lines as the room below has, at least those it had."""
    slack = F.when(F.col("n_lines") == 1, 55.0).otherwise(8.0)
    last = F.when(F.coalesce(F.col("bottom"), F.lit(0.0)) != 0, F.col("bottom")).otherwise(F.col("last_baseline"))
    room = F.when(F.col("pitch") > 0, ((last - F.col("baseline0")) / F.nullif(F.col("pitch"), F.lit(0.0))).cast("long") + 1)
    return blocks.withColumn("width", F.least(F.col("x1") + slack, F.col("page_width") - 6) - F.col("x0")).withColumn("slots", F.greatest(F.col("n_lines"), F.coalesce(room, F.lit(0))))


#: Width of a text at size 1; a font's measure goes here.
Measure = Callable[[str], float]


def even_width(s: str) -> float:
    """Half the size a character."""
    return 0.5 * len(s)


def wrap(text: str, size: float, width: float, measure: Measure = even_width, known: dict[str, float] | None = None) -> list[str]:
    """Fill lines with whole words; a word wider than a line is cut into the longest pieces that fit, of one character at least."""
    known = {} if known is None else known

    def unit(s: str) -> float:
        if s not in known:
            known[s] = measure(s)
        return known[s]

    most = width / size
    lines: list[str] = []
    line, used = "", 0.0
    for word in text.split():
        if line and used + unit(" ") + unit(word) <= most:
            line, used = f"{line} {word}", used + unit(" ") + unit(word)
            continue
        if line:
            lines.append(line)
        while len(word) > 1 and unit(word) > most:
            n = next((n for n in range(len(word) - 1, 1, -1) if unit(word[:n]) <= most), 1)
            lines.append(word[:n])
            word = word[n:]
        line, used = word, unit(word)
    return [*lines, line] if line else lines


def fit(text: str, size: float, width: float, slots: int, measure: Measure = even_width) -> tuple[float, list[str]]:
    """(size, lines): paragraphs wrapped apart, the size reduced by steps until the lines fit the slots or it is least."""
    known: dict[str, float] = {}
    size = min(size, MOST_SIZE)
    while True:
        lines = [x for para in text.split("\n") if para.strip() for x in wrap(para, size, width, measure, known)]
        if len(lines) <= slots or size <= LEAST_SIZE:
            return size, lines
        size -= STEP


def fit_one(text: str, size: float, width: float, measure: Measure = even_width) -> float:
    """Size at which one line has the width, or the least size."""
    size, one = min(size, MOST_SIZE), measure(text)
    while size > LEAST_SIZE and one * size > width:
        size -= STEP
    return size


def label_size(one: Column, width: Column, font_pt: Column) -> Column:
    """Size of a one-line label: 80 % of the original's, at most 11, scaled down to the width but not under 3.2."""
    size = F.least(font_pt * 0.80, F.lit(11.0))
    return F.when(one * size > width, F.greatest(F.lit(3.2), width / one)).otherwise(size)


def place(blocks: DataFrame, en: str = "en", measure: Measure = even_width) -> DataFrame:
    """(report_id, page, block, k, line, x, y, size): each line at baseline0 + k * pitch. Blocks of no text or no width give none."""
    cols = [*PAGE, "block", en, "size", "width", "slots", "pitch", "baseline0", "x0"]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            out = []
            for r in p.itertuples(index=False):
                text = getattr(r, en)
                if not text or not text.strip() or r.width <= 2:
                    continue
                if r.pitch <= 0:
                    out.append((r.report_id, r.page, r.block, 0, text, r.x0, r.baseline0, fit_one(text, r.size, r.width, measure)))
                    continue
                size, lines = fit(text, r.size, r.width, r.slots, measure)
                out += [(r.report_id, r.page, r.block, k, x, r.x0, r.baseline0 + k * r.pitch, size) for k, x in enumerate(lines)]
            yield pd.DataFrame(out, columns=["report_id", "page", "block", "k", "line", "x", "y", "size"])

    return blocks.select(*cols).mapInPandas(run, "report_id string, page int, block long, k int, line string, x double, y double, size double")


def plan(lines: DataFrame) -> DataFrame:
    """Blocks of a report's pages with all that ``place`` needs but the translation; ``text`` has a line end between paragraphs."""
    lines = paragraphs(text_lines(lines))
    paras = columns(paragraph_table(lines))
    lines = lines.join(paras.select(*PAGE, "para", "block"), [*PAGE, "para"])
    blocks = paras.groupBy(*PAGE, "block").agg(
        F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.min("y0").alias("y0"), F.max("y1").alias("y1"),
        *[F.min_by(c, "para").alias(c) for c in ("size", "color", "bold", "page_width", "page_height")],
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("para", "text"))), lambda x: x["text"]), "\n").alias("text"),
    )
    blocks = room_limit(blocks, lines).join(pitch_table(lines, [*PAGE, "block"]), [*PAGE, "block"])
    return box(blocks)
