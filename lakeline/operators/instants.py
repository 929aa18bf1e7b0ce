"""Mixed timestamp formats, precisions and zones to one unambiguous instant (problem 1).

Every written form is one alternative of a single regular expression with named groups. One
``regexp_replace`` over it extracts all components at once; calendar ranges are then checked and
the instant is assembled with integer day arithmetic, all inside JVM expressions: no shuffle, no
Python, one pass.

Rules. No time of day: 00:00. No zone: Danish civil time (first pass of a repeated hour; a skipped
time moves on by the gap). Zone abbreviations: their usual fixed offset. Numeric dates start with
the year or else the day; two-digit years are 20yy; weekdays are not checked. Digits alone are
an epoch time (s, ms, us, ns by magnitude) unless eight of them spell a date. Anything else, dates
or times that do not exist, unknown zones, null and empty text give null. Fractions are cut off.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Month names and their usual short forms (Danish, English, Norwegian, Swedish, German).
MONTHS = {
    "jan": 1, "januar": 1, "january": 1, "januari": 1,
    "feb": 2, "februar": 2, "february": 2, "februari": 2, "febr": 2,
    "mar": 3, "marts": 3, "march": 3, "mars": 3, "märz": 3,
    "apr": 4, "april": 4,
    "maj": 5, "may": 5, "mai": 5,
    "jun": 6, "juni": 6, "june": 6,
    "jul": 7, "juli": 7, "july": 7,
    "aug": 8, "august": 8, "augusti": 8,
    "sep": 9, "sept": 9, "september": 9,
    "okt": 10, "oct": 10, "oktober": 10, "october": 10,
    "nov": 11, "november": 11,
    "dec": 12, "december": 12, "des": 12, "desember": 12, "dez": 12, "dezember": 12,
}

# Minutes east of UTC of zone abbreviations.
ZONES = {
    "z": 0, "utc": 0, "ut": 0, "gmt": 0, "wet": 0, "west": 60, "bst": 60, "ist": 330,
    "cet": 60, "cest": 120, "met": 60, "mest": 120, "mez": 60, "mesz": 120,
    "eet": 120, "eest": 180, "msk": 180, "jst": 540, "kst": 540, "hkt": 480, "aest": 600, "aedt": 660, "nzst": 720, "nzdt": 780,
    "nst": -210, "ndt": -150, "ast": -240, "adt": -180, "est": -300, "edt": -240, "cst": -360, "cdt": -300,
    "mst": -420, "mdt": -360, "pst": -480, "pdt": -420, "akst": -540, "akdt": -480, "hst": -600,
}

_NAME = r"\p{L}{3,9}"
_WEEKDAY = r"(?:\p{L}{2,9}(?:\.?, ?|\.? )(?:den |d\. ?)?)?"


def _time(g: str) -> str:
    return rf"(?<h{g}>\d{{1,2}})[:.](?<i{g}>\d{{2}})(?:[:.](?<s{g}>\d{{2}})(?:[.,](?<f{g}>\d{{1,9}}))?)?(?: ?(?<p{g}>[ap])\.? ?m(?![a-z])\.?)?"


def _zone(g: str) -> str:
    offset = rf"(?:gmt|utc|ut)?(?<sg{g}>[+-])(?<oh{g}>\d{{1,2}})(?::?(?<om{g}>\d{{2}}))?"
    region = rf"(?<zr{g}>[a-z_]{{2,20}}(?:/[a-z0-9_+-]{{2,30}}){{1,2}})"
    return rf"(?: ?(?:{offset}|{region}|(?<za{g}>[a-z]{{1,5}})))?(?: ?\[(?<zb{g}>[a-z0-9_/+-]{{2,60}})\])?(?: ?\([^()]{{1,40}}\))?"


#: Dates that a time of day may follow.
_DATES = (
    r"(?<ya>\d{4})(?<q>[-/.])(?<oa>\d{1,2})\k<q>(?<da>\d{1,2})",
    _WEEKDAY + r"(?<dc>\d{1,2})(?<w>[-/.])(?<oc>\d{1,2})\k<w>(?<yc>\d{4}|\d{2})",
    _WEEKDAY + rf"(?<de>\d{{1,2}})(?:\.|st|nd|rd|th)?[ -]?(?:of )?(?<ne>{_NAME})\.?,?[ -]?(?<ye>\d{{4}}|\d{{2}})",
    _WEEKDAY + rf"(?<ng>{_NAME})\.? (?<dg>\d{{1,2}})(?:st|nd|rd|th)?,? (?<yg>\d{{4}})",
)
_FULL = (
    r"(?:" + "|".join(_DATES) + r")(?:(?:,? ?t|,)? ?(?:kl\.? ?|at )?" + _time("t") + _zone("t") + r")?",
    r"(?<yb>\d{4})(?<ob>\d{2})(?<db>\d{2})[t ](?<hb>\d{2}):?(?<ib>\d{2})(?::?(?<sb>\d{2})(?:[.,](?<fb>\d{1,9}))?)?" + _zone("b"),
    rf"\p{{L}}{{2,9}}\.?,? (?<nf>{_NAME})\.? (?<df>\d{{1,2}}) " + _time("f") + r"(?: (?<zaf>[a-z]{1,5}))? (?<yf>\d{4})",
    r"(?<ep>[+-]?\d{1,19})(?:\.(?<ef>\d{1,9}))?",
)
#: Component -> the named groups that may hold it; at most one takes part in a match.
_PARTS = {
    "y": "ya yc ye yg yb yf", "o": "oa oc ob", "n": "ne ng nf", "d": "da dc de dg db df",
    "h": "ht hb hf", "i": "it ib if", "s": "st sb sf", "f": "ft fb ff", "p": "pt pf",
    "sg": "sgt sgb", "oh": "oht ohb", "om": "omt omb", "zr": "zrt zrb", "za": "zat zab zaf", "zb": "zbt zbb",
    "ep": "ep", "ef": "ef",
}
PATTERN = "(?iu)^(?:" + "|".join(_FULL) + ")$"
_MARK = "\u0001"
_REPLACEMENT = _MARK + _MARK.join("".join(f"${{{g}}}" for g in groups.split()) for groups in _PARTS.values())


def days_from_civil(y: Column, m: Column, d: Column) -> Column:
    """Days since 1970-01-01 of a proleptic Gregorian date with y >= 1, by integers alone."""
    y2 = F.when(m <= 2, y - 1).otherwise(y)
    m2 = (m + 9) % 12
    year_days = y2 * 365 + F.floor(y2 / 4) - F.floor(y2 / 100) + F.floor(y2 / 400)
    return (year_days + F.floor((m2 * 153 + 2) / 5) + d - 1 - 719468).cast("long")


def days_in_month(y: Column, m: Column) -> Column:
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    return F.when(m == 2, F.when(leap, 29).otherwise(28)).when(m.isin(4, 6, 9, 11), 30).otherwise(31)


def _last_sunday(y: Column, month: int) -> Column:
    """Day number of the last Sunday of a month of 31 days."""
    last = days_from_civil(y, F.lit(month), F.lit(31))
    return last - (last + 4) % 7  # day 0 was a Thursday


def danish_offset_ms(y: Column, local_ms: Column) -> Column:
    """Milliseconds Danish civil time is ahead of UTC at a local time, under the rule valid from 1996."""
    start = _last_sunday(y, 3) * 86_400_000 + 3 * 3_600_000
    end = _last_sunday(y, 10) * 86_400_000 + 3 * 3_600_000
    return F.when((local_ms >= start) & (local_ms < end), 7_200_000).otherwise(3_600_000)


def _int(c: Column, kind: str = "long") -> Column:
    return F.nullif(c, F.lit("")).try_cast(kind)


def _lookup(values: dict[str, int], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), key)


def epoch_ms(whole: Column, fraction: Column | None = None) -> Column:
    """Milliseconds of an integer epoch time whose unit follows from its magnitude."""
    size = F.abs(whole)
    sec = whole * 1000
    if fraction is not None:
        milli = F.rpad(F.substring(F.coalesce(fraction, F.lit("")), 1, 3), 3, "0").try_cast("long")
        sec = sec + F.when(whole < 0, -milli).otherwise(milli)
    return (
        F.when(size < 100_000_000_000, sec)
        .when(size < 100_000_000_000_000, whole)
        .when(size < 100_000_000_000_000_000, F.floor(whole / F.lit(1000).cast("decimal(20,0)")).cast("long"))
        .otherwise(F.floor(whole / F.lit(1_000_000).cast("decimal(20,0)")).cast("long"))
    )


def number_ms(x: Column) -> Column:
    """Epoch milliseconds of a double in seconds, ms or us; by its shortest decimal form, cut off."""
    d = x.try_cast("decimal(32,9)")
    size = F.abs(d)
    return F.floor(F.when(size < 100_000_000_000, d * 1000).when(size < 100_000_000_000_000, d).otherwise(d / 1000)).cast("long")


def _regions(df: DataFrame) -> list[str]:
    """Zone regions this JVM knows; a name outside them is no zone."""
    ids = df.sparkSession.sparkContext._jvm.java.time.ZoneId.getAvailableZoneIds()
    return sorted(z for z in ids.toString().strip("[]").split(", ") if "/" in z)


def _staged(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Add columns computed once each: the generator keeps later expressions from repeating them."""
    return df.select("*", F.inline(F.array(F.struct(*[v.alias(k) for k, v in values.items()]))))


def with_instant(df: DataFrame, text: str, out: str, default_zone: str = "Europe/Copenhagen") -> DataFrame:
    """Add ``out`` (epoch milliseconds, long) for the written time in column ``text``."""
    kept = df.columns
    t = "_t"
    while any(c.lower().startswith(t) for c in kept):
        t = "_" + t
    clean = F.translate(F.trim(F.regexp_replace(F.col(f"`{text}`"), r"[\s\p{Z}\u001c-\u001f\u0085]+", " ")), "−‐‑", "---")
    df = _staged(df, {f"{t}a": F.split(F.regexp_replace(clean, PATTERN, _REPLACEMENT), _MARK)})
    # A text that does not match stays as it is: it has no mark, or is the wrong number of pieces.
    ok = (F.size(f"{t}a") == len(_PARTS) + 1) & (F.get(f"{t}a", F.lit(0)) == "")
    df = _staged(df, {f"{t}_{k}": F.when(ok, F.lower(F.get(f"{t}a", F.lit(i + 1)))) for i, k in enumerate(_PARTS)})
    part = {k: F.col(f"{t}_{k}") for k in _PARTS}

    spells = (F.length(part["ep"]) == 8) & part["ep"].rlike("^[0-9]") & (part["ef"] == "")
    at = {"y": (1, 4), "o": (5, 2), "d": (7, 2)}
    num = {k: F.when(spells, _int(F.substring(part["ep"], *at[k]))).otherwise(_int(part[k])) if k in at else _int(part[k]) for k in ("y", "o", "d", "h", "i", "s", "oh", "om")}
    milli = F.rpad(F.coalesce(part["f"], F.lit("")), 3, "0").try_cast("long")
    df = _staged(df, {f"{t}v{k}": v for k, v in num.items()} | {f"{t}vf": milli, f"{t}vn": _lookup(MONTHS, part["n"]), f"{t}ve": _int(part["ep"])})
    n = {k: F.col(f"{t}v{k}") for k in (*num, "f", "n", "e")}
    half = part["p"]
    zero = F.lit(0).cast("long")
    df = _staged(df, {
        f"{t}Y": F.when(F.length(part["y"]) == 2, n["y"] + 2000).otherwise(n["y"]),
        f"{t}O": F.coalesce(n["o"], n["n"].cast("long")),
        f"{t}H": F.when(part["h"] == "", zero).when(half == "", n["h"]).when(n["h"].between(1, 12), n["h"] % 12 + F.when(half == "p", 12).otherwise(0)),
        f"{t}I": F.coalesce(n["i"], zero), f"{t}S": F.coalesce(n["s"], zero),
        f"{t}off": F.when((part["sg"] != "") & (n["oh"] <= 18) & (F.coalesce(n["om"], zero) <= 59), (n["oh"] * 60 + F.coalesce(n["om"], zero)) * F.when(part["sg"] == "-", -1).otherwise(1)),
        f"{t}zone": F.coalesce(F.nullif(part["zr"], F.lit("")), F.nullif(part["zb"], F.lit(""))),
    })
    y, o, d, h, i, s = (F.col(f"{t}{k}") for k in ("Y", "O", "vd", "H", "I", "S"))
    exists = (y >= 1) & o.between(1, 12) & (d >= 1) & (d <= days_in_month(y, o)) & h.between(0, 23) & (i <= 59) & (s <= 59)
    df = _staged(df, {f"{t}day": F.when(exists, days_from_civil(y, o, d))})
    df = _staged(df, {f"{t}local": F.col(f"{t}day") * 86_400_000 + h * 3_600_000 + i * 60_000 + s * 1000 + n["f"]})
    local = F.col(f"{t}local")
    lower = {z.lower(): z for z in _regions(df)}
    named = F.try_element_at(F.map_from_arrays(F.array(*map(F.lit, lower)), F.array(*map(F.lit, lower.values()))), F.col(f"{t}zone"))
    df = _staged(df, {f"{t}region": F.when(F.col(f"{t}zone").isNotNull(), named), f"{t}abbr": F.when(part["za"] != "", _lookup(ZONES, part["za"]).cast("long"))})

    def by_region(zone: Column) -> Column:
        return F.unix_millis(F.to_utc_timestamp(F.timestamp_millis(local), zone))

    civil = by_region(F.lit(default_zone))
    if default_zone == "Europe/Copenhagen":
        civil = F.when(y >= 1996, local - danish_offset_ms(y, local)).otherwise(civil)
    dated = (
        F.when(part["sg"] != "", local - F.col(f"{t}off") * 60_000)
        .when(F.col(f"{t}zone").isNotNull(), F.when(F.col(f"{t}region").isNotNull(), by_region(F.coalesce(f"{t}region", F.lit("UTC")))))
        .when(part["za"] != "", local - F.col(f"{t}abbr") * 60_000)
        .otherwise(civil)
    )
    value = F.when(local.isNotNull(), dated).when(n["e"].isNotNull(), epoch_ms(n["e"], part["ef"]))
    return df.select(*[F.col(f"`{c}`") for c in kept if c != out], value.alias(out))
