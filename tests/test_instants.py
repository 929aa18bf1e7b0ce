from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeline.operators.instants import number_ms, with_instant


def utc(*a, offset=0):
    return int((datetime(*a, tzinfo=timezone.utc) - timedelta(minutes=offset)).timestamp() * 1000)


CASES = {
    "Tue, 19 May 2026 23:08:02 EEST": utc(2026, 5, 19, 23, 8, 2, offset=180),
    "Mon, 19 May 2026 23:08 +0200": utc(2026, 5, 19, 23, 8, offset=120),  # a wrong weekday is ignored
    "Fri, 18 Jul 25 00:39:27 CET": utc(2025, 7, 18, 0, 39, 27, offset=60),
    "Wed Nov 26 13:11:16 2025": utc(2025, 11, 26, 13, 11, 16, offset=60),
    "Sun, 26 Oct 2025 19:33:55 CET": utc(2025, 10, 26, 19, 33, 55, offset=60),
    "2025-10-11 21:31:27 UTC": utc(2025, 10, 11, 21, 31, 27),
    "2025-02-27 10:54:34,828999+00:00": utc(2025, 2, 27, 10, 54, 34) + 828,
    "2025-03-06T04:00:46.038000+05:30": utc(2025, 3, 6, 4, 0, 46, offset=330) + 38,
    "2025-02-23T10:55:06−01:00": utc(2025, 2, 23, 10, 55, 6, offset=-60),
    "2026-03-16t03:47:56.2z": utc(2026, 3, 16, 3, 47, 56) + 200,
    "2026-05-02T04:29+02": utc(2026, 5, 2, 4, 29, offset=120),
    "2025-03-04 15:16:34 +12:45": utc(2025, 3, 4, 15, 16, 34, offset=765),
    "20250711T002511Z": utc(2025, 7, 11, 0, 25, 11),
    "20260414T122529+0200": utc(2026, 4, 14, 12, 25, 29, offset=120),
    "2026-03-29T00:14:08+01:00[Europe/Copenhagen]": utc(2026, 3, 29, 0, 14, 8, offset=60),
    "2026-03-13 14:02:53 Europe/Copenhagen": utc(2026, 3, 13, 14, 2, 53, offset=60),
    "2026-02-02T19:51:23 America/New_York": utc(2026, 2, 2, 19, 51, 23, offset=-300),
    "16 Jul 2025 10:39:18 Europe/London": utc(2025, 7, 16, 10, 39, 18, offset=60),
    "July 31, 2025 8:42 PM": utc(2025, 7, 31, 20, 42, offset=120),
    "January 1, 2026 12:05 AM": utc(2026, 1, 1, 0, 5, offset=60),
    "Sep 4, 2025, 8:03 a.m. GMT+2": utc(2025, 9, 4, 8, 3, offset=120),
    "lørdag den 22. marts 2025 kl. 09:37:47": utc(2025, 3, 22, 9, 37, 47, offset=60),
    "3. maj 2026 kl. 19.08": utc(2026, 5, 3, 19, 8, offset=120),
    "17. apr. 2025, 09.49": utc(2025, 4, 17, 9, 49, offset=120),
    "29.04.2026 kl. 12.09": utc(2026, 4, 29, 12, 9, offset=120),
    "30/03/2025 04:57:58": utc(2025, 3, 30, 4, 57, 58, offset=120),
    "26-06-25 07:37": utc(2025, 6, 26, 7, 37, offset=120),
    "2025/06/16 04:19:38": utc(2025, 6, 16, 4, 19, 38, offset=120),
    " 2025-09-26\n": utc(2025, 9, 26, offset=120),
    "13. april 2025": utc(2025, 4, 13, offset=120),
    "14.04.2026": utc(2026, 4, 14, offset=120),
    "20250623": utc(2025, 6, 23, offset=120),
    "20251345": 20251345000,  # eight digits that spell no date are an epoch time
    "1777614449": 1777614449000,
    "1736751025.9109": 1736751025910,
    "1760900120255": 1760900120255,
    "1758119340553999": 1758119340553,
    # Civil time in Denmark: the first pass of the repeated hour; the skipped hour moves on.
    "2025-10-26 02:30:00": utc(2025, 10, 26, 0, 30),
    "2025-10-26 03:00:00": utc(2025, 10, 26, 2, 0),
    "2025-03-30 02:21:32.000": utc(2025, 3, 30, 1, 21, 32),
    "2025-03-30 01:59:59": utc(2025, 3, 30, 0, 59, 59),
    "2025-03-30 03:00:00": utc(2025, 3, 30, 1, 0),
    "1985-07-01 12:00": utc(1985, 7, 1, 10, 0),
    # Nothing that exists.
    "2025-02-30 10:15:00": None, "31. april 2025": None, "2025-13-08T25:61:00Z": None, "0000-00-00 00:00:00": None, "2025-02-29": None,
    "i går": None, "for to timer siden": None, "n/a": None, "": None, " \t": None, "2025-05-05 10:00 XYZT": None, "2025-05-05 10:00 Mars/Olympus": None, "May 5, 2025 13:00 PM": None,
    None: None, "x" * 200_000: None, "9" * 30: None, "2024-02-29": utc(2024, 2, 29, offset=60),
}


def test_forms(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(CASES)], "n int, t string")
    got = {r.n: r.ms for r in with_instant(df, "t", "ms").collect()}
    wrong = {str(t)[:60]: (got[i], want) for i, (t, want) in enumerate(CASES.items()) if got[i] != want}
    assert not wrong


def test_keeps_columns_and_rows(spark):
    df = spark.createDataFrame([("2025-01-01", 1, "a"), ("2025-01-01", 1, "a"), (None, None, None)], "t string, _t int, `_tY` string")
    out = with_instant(df, "t", "ms")
    assert out.columns == ["t", "_t", "_tY", "ms"] and out.count() == 3
    assert with_instant(df.limit(0), "t", "ms").count() == 0


def test_numbers(spark):
    cases = [(1756671406.668, 1756671406668), (1780053595105.0, 1780053595105), (1762951909996000.0, 1762951909996), (1753486416.0855, 1753486416085), (float("nan"), None), (None, None), (0.0, 0)]
    got = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(cases)], "n int, x double").select("n", number_ms(F.col("x")).alias("ms")).collect()
    assert {r.n: r.ms for r in got} == {i: w for i, (_, w) in enumerate(cases)}


@settings(max_examples=1, deadline=None)
@given(st.lists(st.datetimes(datetime(1997, 1, 1), datetime(2037, 12, 31)), min_size=300, max_size=300))
def test_danish_civil_time_is_that_of_the_zone_database(spark, times):
    rows = [(t.strftime("%Y-%m-%d %H:%M:%S"), int(t.replace(microsecond=0, fold=0, tzinfo=ZoneInfo("Europe/Copenhagen")).timestamp()) * 1000) for t in times]
    bad = with_instant(spark.createDataFrame(rows, "t string, w long"), "t", "ms").where("not (ms <=> w)").collect()
    assert not bad


@pytest.mark.parametrize("zone,hours", [("UTC", 0), ("Asia/Tokyo", 9)])
def test_other_default_zone(spark, zone, hours):
    df = spark.createDataFrame([("2025-06-01 09:00",)], "t string")
    assert with_instant(df, "t", "ms", zone).first().ms == utc(2025, 6, 1, 9 - hours)
