"""Rows → published documents and snapshots."""

from __future__ import annotations

import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attesta.scale import OrderedGroups, days, digits_pos, lookup

# fixed values: columns that never leave a working table, facts in one document part
SENSITIVE = ("birth_date", "birth_year")
FACTS_PER_PART = 10_000


def without_fields(value, names: frozenset[str]):
    """A parsed JSON value without the named fields, at any depth."""
    if isinstance(value, dict):
        return {k: without_fields(v, names) for k, v in value.items() if k not in names}
    return [without_fields(v, names) for v in value] if isinstance(value, list) else value


def redacted(payload: Column, sensitive: Sequence[str]) -> Column:
    """JSON text without the sensitive fields; a payload that names none of them, or is no JSON, stays as it is."""
    names = frozenset(sensitive)

    @F.pandas_udf(T.StringType())
    def clean(texts: pd.Series) -> pd.Series:
        def one(text):
            try:
                return json.dumps(without_fields(json.loads(text), names), ensure_ascii=False, separators=(",", ":"))
            except ValueError:
                return text

        return texts.map(one, na_action="ignore")

    named = payload.contains("\\u")  # a name may be written with escapes
    for n in names:
        named = named | payload.contains(n)
    return F.when(named, clean(F.when(named, payload))).otherwise(payload)


def write_snapshot(df: DataFrame, base: str, ds: str, sensitive: Sequence[str] = SENSITIVE, payloads: Sequence[str] = ()) -> None:
    """The only snapshot writer: sensitive columns become null, and sensitive fields leave the JSON columns ``payloads``, at any
    depth, before anything is written."""
    kinds = dict(df.dtypes)
    for column in payloads:
        df = df.withColumn(column, redacted(F.col(column), sensitive))
    for column in sensitive:
        if column in kinds:
            df = df.withColumn(column, F.lit(None).cast(kinds[column]))
    df.write.mode("overwrite").parquet(f"{base}/ds={ds}")


def entity_docs(facts: DataFrame, per_part: int = FACTS_PER_PART, key_prefix: int = 0) -> DataFrame:
    """Documents of one person: facts by kind, newest first, undated last, ties by key.

    A kind with more than ``per_part`` facts continues in further parts, so no document outgrows a task.
    ``key_prefix`` is the length of the prefix all keys share before their number.
    """
    newest = F.coalesce(-days("date"), F.lit(1 << 40))
    numbered = OrderedGroups(
        facts.withColumn("__newest", newest), ["person_id", "kind"], ["__newest", "fact_key"], "__newest",
        digits_pos("fact_key", key_prefix),
    ).number("rank")
    entry = F.struct("rank", "fact_key", "date", "data", "source_url", "fetched_at")
    return (
        numbered.rows()
        .withColumn("part", F.floor((F.col("rank") - 1) / per_part))
        .groupBy("person_id", "kind", "part")
        .agg(F.array_sort(F.collect_list(entry)).alias("facts"))
    )


def person_documents(docs: DataFrame) -> DataFrame:
    """Parts of all kinds of a person in one map per part number (kinds are a fixed short list)."""
    return docs.groupBy("person_id", "part").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("kind", "facts")))).alias("facts")
    )


def write_documents(docs: DataFrame, path: str, by: str) -> None:
    """JSON lines, partitioned by a low-cardinality column."""
    docs.write.mode("overwrite").partitionBy(by).json(path)


def district_docs(districts: DataFrame, members: DataFrame, key: str, member: str, per_part: int = FACTS_PER_PART) -> DataFrame:
    """District with its members in id order, in parts; a member of an unknown district fails the job."""
    known = districts.select(key).withColumn("__known", F.lit(True))
    checked = lookup(members, known, [key]).filter(
        F.when(F.col("__known").isNotNull(), F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("unknown district "), F.col(key).cast("string"))).cast("boolean")
        )
    )
    ranked = OrderedGroups(checked.drop("__known"), [key], [member], member).number("rank").rows()
    parts = (
        ranked.withColumn("part", F.floor((F.col("rank") - 1) / per_part))
        .groupBy(key, "part")
        .agg(F.array_sort(F.collect_list(F.struct("rank", *[c for c in members.columns if c != key]))).alias("people"))
    )
    return districts.join(parts, key, "left").withColumn("part", F.coalesce("part", F.lit(0).cast("long")))


def pivot_map(rows: DataFrame, group: str, key: str, value: str, source: str) -> DataFrame:
    """Per group: map key → value (the keys are a short fixed list) and the distinct sources."""
    one = rows.groupBy(group, key).agg(F.max(value).alias("v"))
    maps = one.groupBy(group).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, "v")))).alias("values"))
    sources = rows.select(group, source).distinct().groupBy(group).agg(F.array_sort(F.collect_list(source)).alias("sources"))
    return maps.join(sources, group)


def catalogue(areas: DataFrame, districts: DataFrame, flags: DataFrame, area: str, order: str) -> DataFrame:
    """Area, its districts in order (a dimension of fixed size), and the coverage flags."""
    children = districts.groupBy(area).agg(
        F.array_sort(F.collect_list(F.struct(order, *[c for c in districts.columns if c not in (area, order)]))).alias(
            "districts"
        )
    )
    names = [c for c in flags.columns if c != area]
    j = areas.join(children, area, "left").join(flags, area, "left")
    return j.withColumns({c: F.coalesce(c, F.lit(False)) for c in names})
