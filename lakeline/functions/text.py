"""Scalar text functions as Column expressions (JVM side)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Section headers, in the order in which a section is matched against them.
CONTROL_POINTS = (
    "Hygiejne", "Virksomhedens egenkontrol", "Godkendelser m.v.", "Mærkning og information", "Emballage m.v.",
    "Særlige mærkningsordninger", "Tilsætningsstoffer m.v.", "Import", "Andet", "Offentliggørelse af kontrolrapport",
)
# What the flags look for. (?iuU) makes case and word borders follow Unicode.
PEST = r"(?iuU)\b(rotte\w*|mus|mose\w*|skadedyr\w*|kakerlak\w*|insekt\w*|fluer|gnaver\w*)\b"
ENFORCEMENT = {
    "indskaerpelse": r"(?iuU)indskærp",
    "paabud": r"(?iuU)påbud",
    "forbud": r"(?iuU)forbud",
    "boede": r"(?iuU)\bbøde\b",
    "gebyr": r"(?iuU)gebyr",
    "politianmeldelse": r"(?iuU)politianmeld",
    "autorisation_frataget": r"(?iuU)(autorisation|registrering)\s+\w*\s*(frataget|inddrag)",
}
# Marks of a placard.
PLACARD = ("Scan: gå til", "gå til https://findsmiley")
LETTER = "[A-Za-zÆØÅæøå]"


def strip(c: Column) -> Column:
    """Without white space at both ends, of any kind."""
    return F.regexp_replace(c, r"(?U)^[\s\x{1c}-\x{1f}]+|[\s\x{1c}-\x{1f}]+$", "")


def doc_type(text: Column) -> Column:
    """'placard' if the text has a mark of one, else 'report'."""
    hit = F.lit(False)
    for mark in PLACARD:
        hit = hit | text.contains(mark)
    return F.when(hit, "placard").otherwise("report")


def sections(text: Column) -> Column:
    """Map of control point to its text: cut before 'header :', pieces of one header joined with a blank."""
    heads = "|".join(re.escape(h) for h in CONTROL_POINTS)
    first = "".join(sorted({h[0] for h in CONTROL_POINTS}))  # looked at before the headers themselves are tried
    pieces = F.filter(F.transform(F.split(text, rf"(?=[{first}])(?=(?:{heads})\s*:)"), strip), lambda x: x != "")
    owner = lambda x: F.coalesce(*[F.when(x.startswith(h), h) for h in CONTROL_POINTS])
    owned = F.filter(F.transform(pieces, lambda x: F.struct(owner(x).alias("h"), x.alias("t"))), lambda z: z["h"].isNotNull())
    names = F.array_distinct(F.transform(owned, lambda z: z["h"]))
    return F.map_from_entries(F.transform(names, lambda n: F.struct(n, F.array_join(F.transform(F.filter(owned, lambda z: z["h"] == n), lambda z: z["t"]), " "))))


def pest(text: Column) -> Column:
    return text.rlike(PEST)


def enforcement_flags(text: Column) -> dict[str, Column]:
    """has_... -> whether the text speaks of that measure."""
    return {f"has_{k}": text.rlike(p) for k, p in ENFORCEMENT.items()}


def has_letters(text: Column) -> Column:
    return text.rlike(LETTER)


def has_descender(text: Column) -> Column:
    return text.rlike("[gjpqy]")


def memo_key(text: Column) -> Column:
    """White space runs as one blank, none at the ends; case is kept."""
    return F.trim(F.regexp_replace(text, r"(?U)[\s\x{1c}-\x{1f}]+", " "))


def label_key(text: Column) -> Column:
    """Lower case, Danish letters folded (ae, o, a), letters and digits only."""
    s = F.lower(text)
    for a, b in (("æ", "ae"), ("ø", "o"), ("å", "a")):
        s = F.replace(s, F.lit(a), F.lit(b))
    return F.regexp_replace(s, r"[^\p{L}\p{N}]", "")


def error_signature(message: Column) -> Column:
    """What kind of error a message tells of; the first rule that fits counts."""
    code = F.regexp_extract(message, r"HTTP\s*(\d{3})", 1)
    return (
        F.when(message.isNull() | (message == ""), "unknown")
        .when(code != "", F.concat(F.lit("HTTP "), code))
        .when(message.contains("not a PDF"), "invalid id (HTML 'Fejl' page)")
        .when(F.lower(message).contains("timeout") | message.contains("timed out"), "timeout")
        .when(message.contains("onnection"), "connection error")
        .otherwise(F.left(message, F.lit(40)))
    )


def first_given(*values: Column) -> Column:
    """The first value that is neither null nor empty; empty text where there is none."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values], F.lit(""))


def is_pdf(content_type: Column, content: Column) -> Column:
    return F.coalesce(content_type.contains("application/pdf"), F.lit(False)) | F.coalesce(F.hex(F.substring(content, 1, 4)) == "25504446", F.lit(False))


def bytes_text(n: Column) -> Column:
    """1536 -> '1.5 KB'."""
    power = F.least(F.lit(4), F.floor(F.log(F.greatest(n, F.lit(1))) / F.log(F.lit(1024.0)) + 1e-12)).cast("int")
    unit = F.element_at(F.array(*map(F.lit, ("B", "KB", "MB", "GB", "TB"))), power + 1)
    return F.when(n.isNull() | (n == 0), "0 B").otherwise(F.concat(F.format_string("%.1f", n / F.pow(F.lit(1024.0), power)), F.lit(" "), unit))


def duration_text(seconds: Column) -> Column:
    """Two largest of days, hours, minutes, seconds."""
    s = F.greatest(F.lit(0), F.round(seconds)).cast("long")
    d, h, m = F.floor(s / 86400), F.floor(s % 86400 / 3600), F.floor(s % 3600 / 60)
    text = lambda a, x, b, y: F.concat(a.cast("string"), F.lit(x), b.cast("string"), F.lit(y))
    return F.when(seconds.isNull(), "–").when(d > 0, text(d, "d ", h, "h")).when(h > 0, text(h, "h ", m, "m")).when(m > 0, text(m, "m ", s % 60, "s")).otherwise(F.concat(s.cast("string"), F.lit("s")))


def ago_text(seconds: Column) -> Column:
    s = seconds.cast("long")
    return (
        F.when(s.isNull(), "never").when(s < 60, F.concat(s.cast("string"), F.lit("s ago")))
        .when(s < 3600, F.concat(F.floor(s / 60).cast("string"), F.lit("m ago"))).otherwise(F.concat(F.floor(s / 3600).cast("string"), F.lit("h ago")))
    )


def percent(a: Column, b: Column) -> Column:
    return F.when(F.coalesce(b, F.lit(0)) != 0, F.lit(100.0) * a / b).otherwise(F.lit(0.0))
