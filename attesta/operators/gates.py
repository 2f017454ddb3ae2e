"""Quality gates.

Each gate states a rule and the scope it rejects: a row, a group (table, file, meeting) or a whole batch.  ``split``
turns a frame with a ``reason`` column into what passes and what does not.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attesta.scale import lookup


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected with its reason)."""
    return df.filter(F.col("reason").isNull()).drop("reason"), df.filter(F.col("reason").isNotNull())


def first_reason(*rules: tuple[str, Column]) -> Column:
    """Name of the first rule that is broken; null when none is."""
    out = None
    for name, broken in rules:
        out = F.when(broken, name) if out is None else out.when(broken, name)
    return out


def require_empty(problems: DataFrame, what: str) -> DataFrame:
    """A report that must have no rows; the first row fails the job."""
    told = F.concat_ws(" ", F.lit(what), F.to_json(F.struct(*problems.columns)))
    return problems.filter(F.raise_error(told).cast("boolean"))


def row_constraints(
    df: DataFrame, ident: str, required: Sequence[str] = (), url: str | None = None, json: str | None = None,
    foreign: Sequence[tuple[str, DataFrame, str]] = (),
) -> DataFrame:
    """(id, violated constraint), one row per violation."""
    checks = [F.when(F.col(c).isNull(), F.lit(f"{c} is null")) for c in required]
    if url:
        checks.append(F.when(~F.coalesce(F.col(url).rlike("^https?://"), F.lit(False)), F.lit(f"{url} is no link")))
    if json:
        checks.append(F.when(F.try_parse_json(json).isNull(), F.lit(f"{json} is no JSON")))
    out = df.select(ident, F.explode(F.filter(F.array(*checks), lambda c: c.isNotNull())).alias("violation"))
    for column, parent, key in foreign:
        known = parent.select(F.col(key).alias(column)).distinct()
        orphans = lookup(df.filter(F.col(column).isNotNull()), known, [column], "left_anti")
        out = out.unionByName(orphans.select(ident, F.lit(f"{column} unknown").alias("violation")))
    return out


def declared_count(members: DataFrame, headers: DataFrame, key: str, member: str, declared: str) -> DataFrame:
    """The names listed must be as many as stated, none twice."""
    each = members.groupBy(key, member).agg(F.count(F.lit(1)).alias("n"))
    listed = each.groupBy(key).agg(F.sum("n").alias("listed"), F.max("n").alias("most"))
    j = headers.join(listed, key, "left").fillna(0, ["listed"])
    reason = first_reason(
        ("no list", F.col("listed") == 0), ("repeated name", F.col("most") > 1), ("count differs", F.col("listed") != F.col(declared))
    )
    return j.withColumn("reason", reason).select(key, "listed", declared, "reason")


def detail_against_total(details: DataFrame, totals: DataFrame, key: Sequence[str], has_absent: str) -> DataFrame:
    """Marks of a row against its printed total: blank, absent_without_column, duplicate or mismatch."""
    d = details.groupBy(*key).agg(F.count(F.lit(1)).alias("marks"), F.sum("present").alias("present"), F.sum("absent").alias("absent"))
    t = totals.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"), F.min("total").alias("total"), F.bool_or(has_absent).alias("has_absent"))
    j = t.join(d, list(key), "left")
    reason = first_reason(
        ("duplicate", F.col("copies") > 1),
        ("blank", F.col("marks").isNull()),
        ("absent_without_column", ~F.col("has_absent") & (F.col("absent") > 0)),
        ("mismatch", F.col("present") + F.col("absent") != F.col("total")),
    )
    return j.withColumn("reason", reason).select(*key, "reason")


def equal_sums(columns: DataFrame, table: str, value: Column) -> DataFrame:
    """Every column of a table must have the same sum, else the table is rejected."""
    g = columns.groupBy(table).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    return g.select(table, first_reason(("column sums differ", F.col("lo") != F.col("hi"))).alias("reason"))


def all_known(rows: DataFrame, batch: str, known: Column) -> DataFrame:
    """One unknown name rejects its batch."""
    g = rows.groupBy(batch).agg(F.count(F.lit(1)).alias("rows"), F.count_if(~known).alias("unknown"))
    return g.withColumn("reason", first_reason(("unknown name", F.col("unknown") > 0)))


def reject_rate(rows: DataFrame, file: str, bad: Column, name_only: Column, least: int = 2, share: float = 0.2) -> DataFrame:
    """A file with at least ``least`` and more than ``share`` bad rows, or mostly bare names, is dropped."""
    g = rows.groupBy(file).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("bad"), F.count_if(name_only).alias("name_only")
    )
    reason = first_reason(
        ("too many rejects", (F.col("bad") >= least) & (F.col("bad") / F.col("rows") > share)),
        ("names only", F.col("name_only") * 2 > F.col("rows")),
    )
    return g.withColumn("reason", reason)


def cardinality(rows: DataFrame, group: str, low: int, high: int) -> DataFrame:
    g = rows.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("reason", first_reason(("implausible count", ~F.col("n").between(low, high))))


def shrink_guard(listing: DataFrame, stored: DataFrame, source: str, floor: int) -> DataFrame:
    """A new listing must reach the floor and must not be shorter than what is stored."""
    n = listing.groupBy(source).agg(F.count(F.lit(1)).alias("listed"))
    s = stored.groupBy(source).agg(F.count(F.lit(1)).alias("stored"))
    j = n.join(s, source, "full_outer").fillna(0, ["listed", "stored"])
    return j.withColumn("reason", first_reason(("below floor", F.col("listed") < floor), ("shrank", F.col("listed") < F.col("stored"))))


def identity_agreement(rows: DataFrame, ref: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Fields compared in order with the reference row; the first that disagrees is the reason."""
    r = ref.select(key, F.struct(*fields).alias("__ref"))
    j = rows.join(r, key, "left")
    rules = [(f"{f} differs", ~F.col(f).eqNullSafe(F.col(f"__ref.{f}"))) for f in fields]
    return j.withColumn("reason", first_reason(("no reference", F.col("__ref").isNull()), *rules)).drop("__ref")


def field_chain(df: DataFrame, value: str, *evidence: tuple[str, Column]) -> DataFrame:
    """A field keeps its value only when no evidence speaks against it; the first reason wins."""
    out = df.withColumn("reason", first_reason(*evidence))
    return out.withColumn(value, F.when(F.col("reason").isNull(), F.col(value)))


def both_lists(present: DataFrame, leave: DataFrame, key: Sequence[str], note: str) -> DataFrame:
    """Status from two lists: on both is present with a partial-leave note, an error without one."""
    p = present.select(*key).distinct().withColumn("__p", F.lit(True))
    g = leave.groupBy(*key).agg(F.max(note).alias("note"))
    j = p.join(g.withColumn("__l", F.lit(True)), list(key), "full_outer")
    both = F.col("__p").isNotNull() & F.col("__l").isNotNull()
    status = F.when(both & F.col("note").isNull(), "error").when(F.col("__p").isNotNull(), "present").otherwise("leave")
    return j.select(*key, status.alias("status"), (both & F.col("note").isNotNull()).alias("partial"))


def field_names(schema: T.DataType, prefix: str = "") -> Iterable[str]:
    """Every field name of a schema, nested ones with their path."""
    if isinstance(schema, T.StructType):
        for f in schema.fields:
            yield prefix + f.name
            yield from field_names(f.dataType, f"{prefix}{f.name}.")
    elif isinstance(schema, T.ArrayType):
        yield from field_names(schema.elementType, prefix)
    elif isinstance(schema, T.MapType):
        yield from field_names(schema.valueType, prefix)


def forbidden_fields(df: DataFrame, forbidden: Sequence[str]) -> list[str]:
    return sorted(n for n in field_names(df.schema) if n.split(".")[-1] in forbidden)


def payload_fields(rows: DataFrame, ident: str, payload: str) -> DataFrame:
    """(id, path, field): every field of a JSON payload, at any depth, with the path to it; other texts have none.

    The payload is walked level by level as a variant, until a level holds no fields or elements.
    """
    level = rows.select(ident, F.lit("").alias("path"), F.try_parse_json(payload).alias("v"))
    found = None
    while True:
        inner = level.lateralJoin(rows.sparkSession.tvf.variant_explode(F.col("v").outer()))
        step = F.coalesce(F.col("key"), F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]")))
        level = inner.select(ident, F.concat_ws(".", F.nullif("path", F.lit("")), step).alias("path"), F.col("value").alias("v"), "key")
        fields = level.filter(F.col("key").isNotNull()).select(ident, "path", F.col("key").alias("field"))
        found = fields if found is None else found.unionByName(fields)
        level = level.select(ident, "path", "v").filter(F.schema_of_variant("v").rlike("^(OBJECT|ARRAY)<."))
        if level.isEmpty():
            return found


def publish_invariants(
    facts: DataFrame, exported: DataFrame, candidates: DataFrame, persons: DataFrame, forbidden: Sequence[str], payload: str | None = None
) -> DataFrame:
    """(check, violations): sensitive fields, missing provenance, export set, dangling references.

    With ``payload``, the name of a JSON column of the facts, each sensitive field inside a payload is a violation too.
    """
    from attesta.operators.joins import reconcile

    sensitive = len(forbidden_fields(facts, forbidden)) + len(forbidden_fields(exported, forbidden))
    no_source = ~F.coalesce(F.col("source_url").rlike("^https?://"), F.lit(False)) | F.col("fetched_at").isNull()
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check"), "violations")
    fixed = facts.sparkSession.createDataFrame([("sensitive fields", sensitive)], "check string, violations long")
    sides = reconcile(exported.select("person_id"), candidates.select("person_id"), ["person_id"]).filter("side <> 'both'")
    dangling = lookup(facts, persons.select("person_id").distinct(), ["person_id"], "left_anti")
    inside = [count(payload_fields(facts, "fact_key", payload).filter(F.col("field").isin(*forbidden)), "sensitive payload fields")] if payload else []
    parts = [*inside, count(facts.filter(no_source), "provenance"), count(sides, "exported set"), count(dangling, "references")]
    for p in parts:
        fixed = fixed.unionByName(p)
    return fixed


def suspects(rows: DataFrame, roster: DataFrame, group: str, name: str, least: int) -> DataFrame:
    """Unlisted speakers with many rows are reported, never attributed."""
    unlisted = lookup(rows, roster.select(name).distinct(), [name], "left_anti")
    return unlisted.groupBy(group, name).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


def stray(edits: DataFrame, run: DataFrame, key: Sequence[str]) -> DataFrame:
    """Edits that name nothing of this run; none are allowed."""
    return lookup(edits, run.select(*key).distinct(), key, "left_anti")


def one_summary_row(rows: DataFrame, table: str, page: str, is_summary: Column, meetings: str) -> DataFrame:
    """Each page group has one summary row, and all groups of a table state the same number of meetings."""
    pages = rows.groupBy(table, page).agg(F.count_if(is_summary).alias("s"), F.max(F.when(is_summary, F.col(meetings))).alias("m"))
    g = pages.groupBy(table).agg(F.bool_and(F.col("s") == 1).alias("single"), F.min("m").alias("lo"), F.max("m").alias("hi"))
    reason = first_reason(("not one summary row", ~F.col("single")), ("meeting counts differ", F.col("lo") != F.col("hi")))
    return g.select(table, reason.alias("reason"))


def listing_agrees(listing: DataFrame, detail: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Detail rows joined to their listing entry; a disagreement fails the job, as the index may have shifted."""
    d = detail.select(key, F.struct(*fields).alias("__d"))
    j = listing.join(d, key)
    bad = ~F.struct(*fields).eqNullSafe(F.col("__d"))
    fail = F.raise_error(F.concat_ws(" ", F.lit("listing and detail differ at"), F.col(key).cast("string")))
    return j.filter(F.when(bad, fail.cast("boolean")).otherwise(True)).drop("__d")
