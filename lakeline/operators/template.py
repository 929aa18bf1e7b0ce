"""Template labels from pixels: colours, tight boxes, room to the right, weight, and the plan of patches.

Pixels are rows (box, x, y, r, g, b) of the crop of one label; a label is small, so all its
aggregates are by (box) or (box, row) and combined before any shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeline.functions.text import has_descender, label_key
from lakeline.operators.memo import call_again
from lakeline.sources import fs

INK = 90  # summed difference from the fill beyond which a pixel is ink
RULE = 0.65  # share of a row from which its ink is a printed rule, not a letter
LEAST_INK = 0.02
BOLD = 0.295
HASH_SIDE = 48
LEAST_WIDTH = 600


def _distance(a: tuple[str, str, str], b: tuple[Column, Column, Column]) -> Column:
    return sum((F.abs(F.col(x) - y) for x, y in zip(a, b)), F.lit(0))


def fills(pixels: DataFrame) -> DataFrame:
    """(box, fr, fg, fb): the most frequent colour in steps of 8; of equals the smallest."""
    q = [(F.floor(F.col(c) / 8) * 8).cast("int").alias(f"f{c}") for c in "rgb"]
    n = pixels.groupBy("box", *q).agg(F.count("*").alias("n"))
    return n.groupBy("box").agg(F.max(F.struct("n", *[(-F.col(f"f{c}")).alias(f"m{c}") for c in "rgb"])).alias("w")).select("box", *[(-F.col(f"w.m{c}")).alias(f"f{c}") for c in "rgb"])


def inks(pixels: DataFrame, fill: DataFrame) -> DataFrame:
    """(box, tr, tg, tb): the pixel furthest from the fill; of equals the first in reading order."""
    d = _distance(("r", "g", "b"), tuple(F.col(f"f{c}") for c in "rgb"))
    w = F.max(F.struct(d.alias("d"), (-F.col("y")).alias("y"), (-F.col("x")).alias("x"), "r", "g", "b"))
    return pixels.join(fill, "box").groupBy("box").agg(w.alias("w")).select("box", *[F.col(f"w.{c}").alias(f"t{c}") for c in "rgb"])


def coverage(pixels: DataFrame, fill: DataFrame, axis: str) -> DataFrame:
    """(box, axis, cov): share of ink by row (axis y) or column (axis x)."""
    ink = _distance(("r", "g", "b"), tuple(F.col(f"f{c}") for c in "rgb")) > INK
    return pixels.join(fill, "box").groupBy("box", axis).agg(F.avg(ink.cast("int")).alias("cov"))


def tight_boxes(pixels: DataFrame, fill: DataFrame) -> DataFrame:
    """(box, x0, y0, x1, y1), ends exclusive: around rows with letters and columns with ink, one pixel wider where that is no rule.

    Boxes without such rows or columns keep their bounds.
    """
    whole = pixels.groupBy("box").agg(F.min("x").alias("bx0"), F.min("y").alias("by0"), F.max("x").alias("bx1"), F.max("y").alias("by1"))

    def bounds(axis: str, guard: bool) -> DataFrame:
        cov = coverage(pixels, fill, axis)
        used = (F.col("cov") > LEAST_INK) & ((F.col("cov") < RULE) if guard else F.lit(True))
        ends = cov.where(used).groupBy("box").agg(F.min(axis).alias("lo"), F.max(axis).alias("hi"))
        free = cov.where(F.col("cov") < RULE) if guard else cov
        # The neighbour rows are looked up by key: one row before the first, one after the last.
        wider = ends.join(free.select("box", F.col(axis).alias("n")), "box").groupBy("box", "lo", "hi").agg(F.max((F.col("n") == F.col("lo") - 1).cast("int")).alias("a"), F.max((F.col("n") == F.col("hi") + 1).cast("int")).alias("b"))
        return wider.select("box", (F.col("lo") - F.col("a")).alias(f"{axis}0"), (F.col("hi") + F.col("b") + 1).alias(f"{axis}1"))

    j = whole.join(bounds("y", True), "box", "left").join(bounds("x", False), "box", "left")
    ok = F.col("y0").isNotNull() & F.col("x0").isNotNull()
    return j.select("box", *[F.when(ok, F.col(c)).otherwise(F.col(f"b{c}") + (1 if c[1] == "1" else 0)).alias(c) for c in ("x0", "y0", "x1", "y1")])


def room_right(band: DataFrame, fill: DataFrame, edges: DataFrame) -> DataFrame:
    """(box, avail_x1): first column from x1 on with any ink, before ``lim``; else ``lim``. edges: (box, x1, lim)."""
    d = _distance(("r", "g", "b"), tuple(F.col(f"f{c}") for c in "rgb"))
    ink = band.join(fill, "box").where(d > INK).join(edges, "box").where("x >= x1 and x < lim").groupBy("box").agg(F.min("x").alias("hit"))
    return edges.join(ink, "box", "left").select("box", F.coalesce("hit", "lim").alias("avail_x1"))


def is_bold(pixels: DataFrame, fill: DataFrame, ink: DataFrame) -> DataFrame:
    """(box, bold): more than a set share of the pixels is nearer to the ink than to the fill."""
    near = _distance(("r", "g", "b"), tuple(F.col(f"t{c}") for c in "rgb")) < _distance(("r", "g", "b"), tuple(F.col(f"f{c}") for c in "rgb"))
    return pixels.join(fill, "box").join(ink, "box").groupBy("box").agg((F.avg(near.cast("int")) > BOLD).alias("bold"))


def baseline(text: Column, y1: Column, loose_height: Column) -> Column:
    """Bottom of the tight box, less the part of descenders if the text has any."""
    return y1 - F.when(has_descender(text), loose_height * 0.21).otherwise(0.0)


def labels(boxes: DataFrame, overrides: DataFrame, keep: list[str]) -> DataFrame:
    """Boxes (da, en) with fixed wordings (k, fixed) in place of the model's, kept labels as they are; without those that stay the same."""
    k = label_key(F.col("da"))
    named = boxes.withColumn("k", k).join(overrides.select("k", "fixed"), "k", "left")
    en = F.when(F.col("k").isin(*keep) if keep else F.lit(False), F.col("da")).otherwise(F.coalesce("fixed", "en", "da"))
    return named.withColumn("en", en).where(label_key(F.col("en")) != F.col("k")).drop("k", "fixed")


def rgb(color: Column) -> Column:
    """0xRRGGBB as a struct of shares from 0 to 1."""
    part = lambda n: F.shiftright(color, n).bitwiseAND(255) / 255.0
    return F.struct(part(16).alias("r"), part(8).alias("g"), part(0).alias("b"))


def box_specs(boxes: DataFrame, pixels: DataFrame, band: DataFrame, image_width: int) -> DataFrame:
    """(box, da, en, conf, bbox, fill, color, bold, avail_x1, font_px, baseline_px) of recognised labels.

    boxes: (box, da, en, conf, x0, y0, x1, y1), pixels: those of the loose boxes, band: those of the box's rows to the right edge.
    Colours, size and baseline come from the loose box, the cover from the tight one; tight boxes under 3 pixels are dropped.
    """
    fill = fills(pixels)
    ink = inks(pixels, fill)
    tight = tight_boxes(pixels, fill).where("x1 - x0 >= 3 and y1 - y0 >= 3")
    inner = pixels.join(tight, "box").where("x >= x0 and x < x1 and y >= y0 and y < y1").select(*pixels.columns)
    edges = tight.select("box", F.col("x1").alias("x1"), F.lit(image_width - 2).alias("lim"))
    rows = band.join(tight.select("box", F.col("y0").alias("_a"), F.col("y1").alias("_b")), "box").where("y >= _a and y < _b").drop("_a", "_b")
    loose = boxes.select("box", "da", "en", "conf", (F.col("y1") - F.col("y0")).cast("double").alias("font_px"))
    j = loose.join(tight, "box").join(fill, "box").join(ink, "box").join(is_bold(inner, fill, ink), "box", "left").join(room_right(rows, fill, edges), "box")
    return j.select(
        "box", "da", "en", "conf", F.array("x0", "y0", "x1", "y1").alias("bbox"), F.array("fr", "fg", "fb").alias("fill"), F.array("tr", "tg", "tb").alias("color"),
        F.coalesce("bold", F.lit(False)).alias("bold"), "avail_x1", "font_px", baseline(F.col("da"), F.col("y1").cast("double"), F.col("font_px")).alias("baseline_px"),
    )


def variant_key(gray: np.ndarray) -> str:
    """Hash of an image's layout: reduced to 48 x 48 by bilinear sampling, which cells are lighter than the mean."""
    h, w = gray.shape
    ys, xs = (np.arange(HASH_SIDE) + 0.5) * h / HASH_SIDE - 0.5, (np.arange(HASH_SIDE) + 0.5) * w / HASH_SIDE - 0.5
    y0, x0 = np.clip(np.floor(ys).astype(int), 0, h - 1), np.clip(np.floor(xs).astype(int), 0, w - 1)
    y1, x1 = np.minimum(y0 + 1, h - 1), np.minimum(x0 + 1, w - 1)
    fy, fx = np.clip(ys - y0, 0, 1)[:, None], np.clip(xs - x0, 0, 1)[None, :]
    g = gray.astype(np.float32)
    small = (g[np.ix_(y0, x0)] * (1 - fx) + g[np.ix_(y0, x1)] * fx) * (1 - fy) + (g[np.ix_(y1, x0)] * (1 - fx) + g[np.ix_(y1, x1)] * fx) * fy
    return hashlib.sha256((small > small.mean()).tobytes()).hexdigest()[:16]


def backgrounds(images: DataFrame) -> DataFrame:
    """Full-page images, told by the listed width before anything is decoded."""
    return images.where(F.col("width") >= LEAST_WIDTH)


def unknown_variants(seen: DataFrame, specs: DataFrame) -> DataFrame:
    """(variant, n, example) of variants without a spec, most frequent first."""
    return seen.join(specs.select("variant"), "variant", "left_anti").groupBy("variant").agg(F.count("*").alias("n"), F.min_by("report_id", "report_id").alias("example")).orderBy(F.desc("n"), "variant")


def translate_labels(boxes: DataFrame, provider: Callable[[list[str]], list[str | None]], overrides: DataFrame, keep: list[str]) -> DataFrame:
    """Boxes (da, ...) with ``en``: each distinct wording is asked for once, gaps keep the text, fixed wordings win; without labels that stay the same."""
    wordings = call_again(boxes.select("da").distinct(), provider, "da", "en")
    return labels(boxes.join(wordings, "da", "left"), overrides, keep)


class SpecStore:
    """Specs of variants as a Parquet folder, a file set a variant; a variant is built at most once and misses are remembered.

    ``unknown`` counts how often a variant was asked for in vain.
    """

    def __init__(self, spark: SparkSession, root: str, build: Callable[[str], DataFrame] | None = None, is_up: Callable[[], bool] = lambda: True):
        self.spark, self.root, self.build, self.is_up = spark, root, build, is_up
        self._known: dict[str, DataFrame | None] = {}
        self._tried: set[str] = set()
        self.unknown: dict[str, int] = {}

    def load(self, variant: str) -> DataFrame | None:
        """The spec, or None; either is looked up once."""
        if variant not in self._known:
            path = f"{self.root}/variant={variant}"
            self._known[variant] = self.spark.read.option("basePath", self.root).parquet(path) if fs.exists(self.spark, f"{path}/_SUCCESS") else None
        return self._known[variant]

    def ensure(self, variant: str) -> DataFrame | None:
        """The spec, built and stored on first sight. A variant that can't be built is not tried again by this store, unless the provider was down."""
        spec = self.load(variant)
        if spec is not None:
            return spec
        if self.build is not None and variant not in self._tried and self.is_up():
            self._tried.add(variant)
            try:
                self.build(variant).write.mode("overwrite").parquet(f"{self.root}/variant={variant}")
                del self._known[variant]
                return self.load(variant)
            except Exception:  # noqa: BLE001 - an unknown variant must not end the job
                pass
        self.unknown[variant] = self.unknown.get(variant, 0) + 1
        return None


def sample(ids: DataFrame, n: int = 600, seed: int = 11, key: str = "report_id") -> DataFrame:
    """``n`` rows in the order of a seeded hash: without replacement, the same at each call."""
    return ids.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)


def patch_plan(pages: DataFrame, specs: DataFrame, obstacles: DataFrame) -> DataFrame:
    """Labels to cover and write: pages (report_id, page, variant, rx0, ry0, rwidth, rheight) by their variant's boxes.

    A label may grow right to its band's end, or to two points before the page's own text on the same band.
    """
    j = pages.join(specs.select("variant", "width", "height", F.posexplode("boxes").alias("box", "b")), "variant")
    sx, sy = F.col("rwidth") / F.col("width"), F.col("rheight") / F.col("height")
    at = lambda i: F.element_at("b.bbox", i + 1)
    j = j.select(
        "report_id", "page", "box", (F.col("rx0") + at(0) * sx).alias("x0"), (F.col("ry0") + at(1) * sy).alias("y0"), (F.col("rx0") + at(2) * sx).alias("x1"), (F.col("ry0") + at(3) * sy).alias("y1"),
        (F.col("rx0") + F.col("b.avail_x1") * sx).alias("avail"), F.col("b.en").alias("en"), F.col("b.bold").alias("bold"), F.col("b.fill").alias("fill"), F.col("b.color").alias("color"),
        (F.coalesce("b.font_px", (at(3) - at(1)).cast("double")) * sy).alias("font_pt"), (F.col("ry0") + F.coalesce("b.baseline_px", at(3).cast("double")) * sy).alias("baseline"),
    )
    o = obstacles.select(F.col("report_id").alias("o_id"), F.col("page").alias("o_page"), F.col("x0").alias("ox0"), F.col("y0").alias("oy0"), F.col("y1").alias("oy1"))
    hit = (F.col("report_id") == F.col("o_id")) & (F.col("page") == F.col("o_page")) & (F.col("ox0") >= F.col("x1") - 1) & (F.col("oy1") > F.col("y0") + 1) & (F.col("oy0") < F.col("y1") - 1)
    stop = j.join(o, hit).groupBy("report_id", "page", "box").agg(F.min(F.col("ox0") - 2).alias("stop"))
    out = j.join(stop, ["report_id", "page", "box"], "left")
    return out.withColumn("limit_x1", F.greatest(F.least("avail", "stop"), F.col("x1"))).drop("avail", "stop")
