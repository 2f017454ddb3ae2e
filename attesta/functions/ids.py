"""Identifiers, area codes and links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.scale import lookup


def mint_id(source: Column, key: Column) -> Column:
    """Own id from the source and its key: ``p`` and ten hex digits of the SHA-1."""
    return F.concat(F.lit("p"), F.substring(F.sha1(F.concat_ws(":", source, key)), 1, 10))


def area_of(district_id: Column) -> Column:
    """Area part of a district id; legislative ids carry a prefix."""
    return F.when(district_id.startswith("ly-"), F.split_part(district_id, F.lit("-"), F.lit(2))).otherwise(
        F.split_part(district_id, F.lit("-"), F.lit(1))
    )


def parse_area(name: Column, areas: list[str], at_large: str) -> Column:
    """``<area> <n>`` → (area, district id); district 1 when no number is given, null for at-large seats."""
    area = F.regexp_extract(name, r"^(\S+?)(?:\s+(\d+))?$", 1)
    number = F.coalesce(F.nullif(F.regexp_extract(name, r"^(\S+?)(?:\s+(\d+))?$", 2), F.lit("")), F.lit("1"))
    known = area.isin(areas) & ~name.contains(at_large)
    return F.struct(
        F.when(known, F.lower(area)).alias("area"),
        F.when(known, F.concat(F.lit("ly-"), F.lower(area), F.lit("-"), F.lpad(number, 2, "0"))).alias("district_id"),
    )


def village_code(province: Column, city: Column, dept: Column, village: Column) -> Column:
    """Composite code; the first digit of the village part is a check on the layout and not part of it."""
    whole = F.concat(province, city, dept, village.substr(F.lit(2), F.length(village)))
    return F.when(F.substring(village, 1, 1) == "0", whole)


def session_slug(session: Column, regular: str) -> Column:
    """Digits joined by hyphens and a suffix: r for regular sessions, t otherwise."""
    digits = F.regexp_replace(F.regexp_replace(session, r"\D+", "-"), "^-|-$", "")
    return F.concat(digits, F.when(session.contains(regular), F.lit("r")).otherwise(F.lit("t")))


def page_link(url: Column, page: Column) -> Column:
    return F.when(page.isNotNull(), F.concat(url, F.lit("#page="), page.cast("string"))).otherwise(url)


def time_link(url: Column, seconds: Column) -> Column:
    """Media link starting at an offset; an existing query string is kept."""
    sep = F.when(url.contains("?"), F.lit("&")).otherwise(F.lit("?"))
    return F.when(seconds.isNotNull(), F.concat(url, sep, F.lit("t="), F.floor(seconds).cast("string"))).otherwise(url)


def safe_url(url: Column) -> Column:
    """Only http(s) links pass; http is upgraded."""
    return F.when(url.rlike("^https?://"), F.regexp_replace(url, "^http://", "https://"))


def publisher_of(df: DataFrame, url: str, publishers: DataFrame) -> DataFrame:
    """Label by host: the exact host or its longest dot suffix in ``publishers(host, label)``.

    The host's suffixes are exploded (one per label of the host name) and equi-joined, so the publisher table can grow.
    """
    host = F.try_parse_url(F.col(url), F.lit("HOST"))
    hosts = df.select(host.alias("host")).filter(F.col("host").isNotNull()).distinct()
    labels = F.split("host", r"\.")
    suffix = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    hits = (
        hosts.select("host", F.posexplode(suffix).alias("at", "suffix"))
        .join(publishers.select(F.col("host").alias("suffix"), "label"), "suffix")
        .groupBy("host")
        .agg(F.min_by("label", "at").alias("publisher"))
    )
    return lookup(df.withColumn("host", host), hits, ["host"])
