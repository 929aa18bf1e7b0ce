"""Addresses and paths that follow from ids, and links found in pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPORT_LINK = r"(?i)KontrolRapport\.aspx\?Virk(\d+)"


def shard(id_: Column) -> Column:
    """The last three characters, padded with zeros on the left: a folder of bounded size."""
    return F.lpad(F.right(id_, F.lit(3)), 3, "0")


def sharded_path(root: str, id_: Column, suffix: str = ".pdf") -> Column:
    return F.concat(F.lit(root.rstrip("/") + "/"), shard(id_), F.lit("/"), id_, F.lit(suffix))


def url_for(template: str, id_: Column) -> Column:
    """``template`` with {} in place of the id."""
    a, b = template.split("{}", 1)
    return F.concat(F.lit(a), id_, F.lit(b))


def stem(path: Column) -> Column:
    """File name without its last suffix: the inverse of ``sharded_path``."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def basename(url: Column) -> Column:
    return F.element_at(F.split(F.regexp_replace(url, r"[?#].*$", ""), "/"), -1)


def absolute(base: Column, href: Column) -> Column:
    """``href`` seen from the page ``base``: absolute, scheme-relative, rooted or beside the page (dot segments stay)."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    host = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(?:/[^?#]*/|/)?)", 1)
    folder = F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/")))
    page = F.regexp_replace(base, r"[?#].*$", "")
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(host, href))
        .when(href.startswith("?") | href.startswith("#") | (href == ""), F.concat(page, href))
        .otherwise(F.concat(folder, href))
    )


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(url, pos, href): every link of every page, in order, made absolute."""
    found = pages.select(F.col(url), F.posexplode(F.regexp_extract_all(F.col(html), F.lit(r"""(?i)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["']"""), F.lit(1))).alias("pos", "raw"))
    return found.select(F.col(url), "pos", absolute(F.col(url), F.col("raw")).alias("href"))


def download_links(pages: DataFrame, kinds: tuple[str, ...] = ("xlsx", "xml"), preferred: str = "smiley") -> DataFrame:
    """(url, kind, href): of each kind of file a page links to, the first whose address has ``preferred`` in it, else the first."""
    links = page_links(pages)
    low = F.lower("href")
    kind = F.coalesce(*[F.when(low.endswith("." + k) | low.contains(f".{k}?"), k) for k in kinds])
    return links.withColumn("kind", kind).where("kind is not null").groupBy("url", "kind").agg(F.min_by("href", F.struct(~F.lower("href").contains(preferred), "pos")).alias("href"))


def report_ids(html: Column, pattern: str = REPORT_LINK) -> Column:
    """Sorted distinct report ids a page links to."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(html, F.lit(pattern), F.lit(1))))
