"""Joins across datasets: companies and units, what has no report yet, and where an address lies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def star(facts: DataFrame, dimensions: list[tuple[DataFrame, str, str]], how: str = "left") -> DataFrame:
    """Facts joined to each dimension (table, fact key, dimension key). Spark broadcasts dimensions below the session's limit and splits hot keys beyond."""
    for table, a, b in dimensions:
        facts = facts.join(table.withColumnRenamed(b, a) if a != b else table, a, how)
    return facts


def without_report(registry: DataFrame, inspected: DataFrame, key: str, industry: str) -> DataFrame:
    """Registry rows of industries that occur among the inspected, which are not inspected themselves."""
    seen = inspected.select(key).where(F.col(key).isNotNull()).distinct()
    codes = registry.join(seen, key, "left_semi").select(industry).where(F.col(industry).isNotNull()).distinct()
    return registry.join(codes, industry, "left_semi").join(seen, key, "left_anti")


def address_key(street: Column, postcode: Column) -> Column:
    """Lower case, one blank between words, without floor and door, with the postcode."""
    s = F.trim(F.regexp_replace(F.lower(street), r"[\s\p{Z}]+", " "))
    return F.concat(F.regexp_replace(s, ",.*$", ""), F.lit("|"), F.trim(postcode))


def locate(rows: DataFrame, addresses: DataFrame, *, street: str, postcode: str, lat: str = "lat", lng: str = "lng") -> DataFrame:
    """Adds lat, lng and ``located_by``: own address, else the mean of the postcode's addresses, else null. addresses: (street, postcode, lat, lng)."""
    known = addresses.where("lat is not null and lng is not null")
    by_address = known.groupBy(address_key(F.col("street"), F.col("postcode")).alias("_k")).agg(F.avg("lat").alias("_a"), F.avg("lng").alias("_b"))
    by_code = known.groupBy(F.trim("postcode").alias("_p")).agg(F.avg("lat").alias("_c"), F.avg("lng").alias("_d"))
    j = rows.withColumn("_k", address_key(F.col(street), F.col(postcode))).withColumn("_p", F.trim(postcode)).join(by_address, "_k", "left").join(by_code, "_p", "left")
    how = F.when(F.col("_a").isNotNull(), "address").when(F.col("_c").isNotNull(), "postcode")
    return j.withColumns({lat: F.coalesce("_a", "_c"), lng: F.coalesce("_b", "_d"), "located_by": how}).drop("_k", "_p", "_a", "_b", "_c", "_d")
