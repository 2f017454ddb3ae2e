"""Landed inputs → rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attesta.scale import each, lookup


def keyed_groups(docs: DataFrame, body: str, row_schema: str) -> DataFrame:
    """``{group: [row, …]}`` documents → one row per element, with its group."""
    parsed = F.from_json(F.col(body), f"map<string,array<{row_schema}>>")
    groups = docs.select(F.explode(parsed).alias("group", "rows"))
    return groups.select("group", F.inline("rows"))


def tagged_union(parts: Sequence[tuple[str, DataFrame]], tag: str = "kind") -> DataFrame:
    """Several inputs of one meaning, each marked with where it came from."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in parts]
    out = tagged[0]
    for df in tagged[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def page_rows(pages: DataFrame) -> DataFrame:
    """(listing, page, total, rows[]) → rows in page order."""
    return pages.select("listing", "page", F.posexplode("rows").alias("pos", "row")).select(
        "listing", "page", "pos", "row.*"
    )


def page_completeness(pages: DataFrame) -> DataFrame:
    """Rows received against the total each page declares; one total per listing, and no page past the window."""
    return (
        pages.groupBy("listing")
        .agg(
            F.count(F.lit(1)).alias("pages"),
            F.sum(F.size("rows")).alias("rows"),
            F.max("total").alias("total"),
            F.min("total").alias("least_total"),
        )
        .select(
            "listing", "pages", "rows", "total",
            ((F.col("rows") == F.col("total")) & (F.col("total") == F.col("least_total"))).alias("complete"),
        )
    )


def require_complete(pages: DataFrame) -> DataFrame:
    """Rows of complete listings; an incomplete one fails the job."""
    state = page_completeness(pages).select("listing", "complete")
    rows = lookup(page_rows(pages), state, ["listing"], "inner")
    fail = F.raise_error(F.concat(F.lit("incomplete listing "), F.col("listing"))).cast("boolean")
    return rows.filter(F.when(F.col("complete"), F.lit(True)).otherwise(fail)).drop("complete")


def repeated_rows(
    docs: DataFrame, body: str, pattern: str, fields: Sequence[str], anchor: str, carry: Sequence[str]
) -> DataFrame:
    """One row per match of a repeating pattern; ``ok`` is false when the page has more anchors than parsed rows."""
    cols = [F.regexp_extract_all(F.col(body), F.lit(pattern), F.lit(i + 1)).alias(f) for i, f in enumerate(fields)]
    # matched once per page, before the matches are exploded
    found = docs.select(*carry, F.regexp_count(F.col(body), F.lit(anchor)).alias("__anchors"), F.arrays_zip(*cols).alias("__hits"))
    found = found.withColumn("ok", F.col("__anchors") == F.size("__hits"))
    return each(found, [*carry, "ok"], F.col("__hits"), "hit", "pos").select(*carry, "ok", "pos", "hit.*")


def sectioned_rows(docs: DataFrame, body: str, section: str, hit: str, carry: Sequence[str]) -> DataFrame:
    """Split on section markers (group 1 is the section id) and give every hit the section it stands in."""
    plain = section.replace("(", "(?:", 1)
    ids = F.regexp_extract_all(F.col(body), F.lit(section), F.lit(1))
    bodies = F.split(F.col(body), plain)
    zipped = F.arrays_zip(ids.alias("section"), F.slice(bodies, F.lit(2), F.size(ids) + 1).alias("part"))
    parts = each(docs, carry, zipped, "s", "section_no")
    found = F.regexp_extract_all(F.col("s.part"), F.lit(hit), F.lit(1))
    return each(parts, [*carry, "section_no", F.col("s.section").alias("section")], found, "hit", "hit_no")


def declared_list(text: Column, label: str, total: str, delimiter: str) -> Column:
    """``label a, b, … total N`` → (items, declared)."""
    pattern = f"(?s){label}\\s*(.*?)\\s*{total}\\s*(\\d+)"
    items = F.filter(F.split(F.regexp_extract(text, pattern, 1), delimiter), lambda x: F.length(F.trim(x)) > 0)
    return F.struct(items.alias("items"), F.nullif(F.regexp_extract(text, pattern, 2), F.lit("")).cast("int").alias("declared"))


def curated_csv(
    spark: SparkSession, path: str, schema: str, key: Sequence[str], required: Sequence[str] = (), allowed: dict | None = None
) -> DataFrame:
    """Hand-kept table: malformed rows, missing values, unknown words and repeated keys all fail the read."""
    df = spark.read.csv(path, schema=schema, header=True, mode="FAILFAST", enforceSchema=False)
    for column in {*required, *key}:
        df = df.withColumn(
            column,
            F.when(F.col(column).isNotNull(), F.col(column)).otherwise(
                F.raise_error(F.lit(f"{column} is missing")).cast(df.schema[column].dataType)
            ),
        )
    for column, words in (allowed or {}).items():
        df = df.withColumn(
            column,
            F.when(F.col(column).isin(*words), F.col(column)).otherwise(
                F.raise_error(F.concat(F.lit(f"{column} not allowed: "), F.col(column).cast("string"))).cast(
                    df.schema[column].dataType
                )
            ),
        )
    return unique_or_fail(df, key)


def unique_or_fail(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per key; a repeated key fails the job."""
    others = [c for c in df.columns if c not in key]
    out = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"), *[F.any_value(c).alias(c) for c in others])
    repeated = F.raise_error(F.concat_ws(" ", F.lit("repeated key"), *[F.col(k).cast("string") for k in key]))
    return out.filter(F.when(F.col("__n") == 1, F.lit(True)).otherwise(repeated.cast("boolean"))).select(*df.columns)


def latest_snapshot(spark: SparkSession, base: str, expected: T.StructType) -> DataFrame:
    """Newest ``ds`` of a snapshot table; columns added to the schema since are null, so reloading is repeatable."""
    snap = spark.read.parquet(base)
    newest = snap.agg(F.max("ds").alias("ds"))
    rows = snap.filter(F.col("ds") == newest.scalar()).drop("ds")
    for field in expected.fields:
        if field.name not in rows.columns:
            rows = rows.withColumn(field.name, F.lit(None).cast(field.dataType))
    return rows.select(*[f.name for f in expected.fields])


def unseen(listing: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose natural key is not stored yet."""
    return lookup(listing, known.select(*keys).distinct(), keys, "left_anti")


def newest_until_known(
    listing: DataFrame, known: DataFrame, source: str, key: str, order: str, covered: DataFrame, wanted: DataFrame, member: str
) -> DataFrame:
    """Per source, the rows newer than its newest stored row; every unseen row where the covered set has grown."""
    grown = wanted.join(covered, [source, member], "left_anti").select(source).distinct().withColumn("__grew", F.lit(True))
    mark = known.groupBy(source).agg(F.max(order).alias("__mark"))
    fresh = listing.join(known.select(key), key, "left_anti")  # the key is unique on both sides
    j = lookup(fresh, mark.join(grown, source, "full_outer"), [source])
    newer = F.col("__mark").isNull() | (F.col(order) > F.col("__mark"))
    return j.filter(F.col("__grew").isNotNull() | newer).drop("__mark", "__grew")
