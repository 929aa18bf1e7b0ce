"""Live control values, and pacing of requests."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeline.sources import fs

# Defaults of the controls, and the limits of those set from outside.
DEFAULTS = {"paused": False, "harvest_rate": 2.6, "analyze_concurrency": 32, "overlay_concurrency": 8}
LIMITS = {"harvest_rate": (0.0, 10.0, float), "analyze_concurrency": (0, 128, int), "overlay_concurrency": (0, 64, int)}


def clamp(value: Column, low: float, high: float, default: float, whole: bool = False) -> Column:
    """The number within its limits; text that is no number gives the default. ``whole`` cuts decimals off."""
    n = value.try_cast("double")
    if whole:
        n = n.try_cast("int")
    return F.when(n.isNull(), F.lit(default)).otherwise(F.least(F.lit(high), F.greatest(F.lit(low), n)))


def overlay(document: Column, defaults: Column) -> Column:
    """Map ``defaults`` with the entries of ``document`` over them."""
    base = F.map_filter(defaults, lambda k, v: ~F.coalesce(F.map_contains_key(document, k), F.lit(False)))
    return F.map_concat(base, F.coalesce(document, F.map_filter(defaults, lambda k, v: F.lit(False))))


@dataclass(frozen=True)
class Control:
    """One reading of the control document."""

    paused: bool
    harvest_rate: float
    analyze_concurrency: int
    overlay_concurrency: int

    def effective(self, knob: str) -> float:
        """0 while everything is paused or the knob itself is 0: the stage then takes no batch."""
        return 0 if self.paused else getattr(self, knob)


def values(doc: object) -> Control:
    """Defaults where the document is no object or lacks a value; present values are clamped."""
    got = DEFAULTS | (doc if isinstance(doc, dict) else {})
    for k, (low, high, kind) in LIMITS.items():
        try:
            got[k] = min(high, max(low, kind(float(got[k]))))
        except (TypeError, ValueError):
            got[k] = DEFAULTS[k]
    return Control(bool(got["paused"]), got["harvest_rate"], got["analyze_concurrency"], got["overlay_concurrency"])


def read(spark: SparkSession, path: str) -> Control:
    """Defaults where the document is missing, broken or no object; present values are clamped."""
    try:
        return values(json.loads(fs.read_text(spark, path) or "{}"))
    except ValueError:
        return values({})


class Reader:
    """Readings of one control document that keep the last good value while it is missing, torn or no object."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self._last = spark, path, None

    def __call__(self) -> Control:
        try:
            doc = json.loads(fs.read_text(self.spark, self.path) or "")
        except Exception:  # noqa: BLE001 - whatever stands in the way of reading it while it is being replaced
            doc = None
        if isinstance(doc, dict) or self._last is None:
            self._last = values(doc)
        return self._last

    def wait(self, knob: str, poll: float = 3.0, sleep: Callable[[float], None] = time.sleep, stop: Callable[[], bool] = lambda: False) -> float:
        """The knob's value as soon as it is above 0 and nothing is paused; 0 only if ``stop`` says so meanwhile."""
        while (value := self().effective(knob)) <= 0 and not stop():
            sleep(poll)
        return value


def set_values(spark: SparkSession, path: str, **values: object) -> Control:
    """Merge values into the document; numbers are clamped, what is no number is left as it was."""
    now = asdict(read(spark, path))
    for k, v in values.items():
        if k == "paused":
            now[k] = bool(v)
        elif k in LIMITS:
            low, high, kind = LIMITS[k]
            try:
                now[k] = min(high, max(low, kind(float(v))))  # type: ignore[arg-type]
            except (TypeError, ValueError):
                pass
    fs.write_text(spark, path, json.dumps(now))
    return read(spark, path)


def paced(requests: DataFrame, by: list[str], at: str | list[str], rate: float, out: str = "start_at") -> DataFrame:
    """When each request may start if none may within 1/rate of the one before; ``at`` is the arrival, and what settles ties if given.

    start(i) = max(arrival(i), start(i-1) + 1/rate) = i/rate + max over j <= i of (arrival(j) - j/rate): a running maximum.
    """
    order = [at] if isinstance(at, str) else at
    at = order[0]
    w = Window.partitionBy(*by).orderBy(*order)
    df = requests.withColumn("_i", F.row_number().over(w) / F.lit(float(rate)))
    return df.withColumn(out, F.col("_i") + F.max(F.col(at) - F.col("_i")).over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_i")
