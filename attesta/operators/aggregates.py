"""Counts, rates and roll-ups with explicit denominators; every one is a map-side combined aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.scale import OrderedGroups, lookup

PART = 10_000  # offsets listed in one row


def ratio(n: Column, d: Column) -> Column:
    """n / d, 0 when there is nothing to divide by."""
    return F.when(d != 0, n / d).otherwise(F.lit(0.0))


def status_rates(entities: DataFrame, facts: DataFrame, key: str, present: Column, leave: Column) -> DataFrame:
    """Present and leave over all rows of an entity; entities without rows stay, at zero."""
    n = facts.groupBy(key).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(present).alias("present"), F.count_if(leave).alias("leave")
    )
    j = entities.join(n, key, "left").fillna(0, ["total", "present", "leave"])
    return j.withColumns(
        {"present_rate": ratio(F.col("present"), F.col("total")), "leave_rate": ratio(F.col("leave"), F.col("total"))}
    )


# fixed values: kinds of leave and of duty, in the order they are shown
LEAVE_TYPES, DUTY_TYPES = ("請假", "病假", "喪假", "事假"), ("公差", "公假")


def typed_totals(column: str, kinds: Sequence[str]) -> Column:
    """Sums over a map column as [(kind, n)], in the order of the list, without zeros."""
    sums = [F.struct(F.lit(k).alias("kind"), F.coalesce(F.sum(F.try_element_at(F.col(column), F.lit(k))), F.lit(0)).cast("long").alias("n")) for k in kinds]
    return F.filter(F.array(*sums), lambda s: s["n"] != 0)


def attendance_totals(facts: DataFrame, key: str) -> DataFrame:
    """Sums of meetings, present, leave and duty, the last two also by kind; absence counts only over tables that have the column.

    Duty is official business and no leave; ``duty``, and the maps ``leave_types`` and ``duty_types`` from a kind to its marks,
    may be missing as a whole.
    """
    given = set(facts.columns)
    kinds = {c: typed_totals(c, k).alias(c) for c, k in (("leave_types", LEAVE_TYPES), ("duty_types", DUTY_TYPES)) if c in given}
    duty = [F.sum("duty").alias("duty")] if "duty" in given else []
    has = F.col("absent").isNotNull()
    t = facts.groupBy(key).agg(
        F.sum("meetings").alias("total"),
        F.coalesce(F.sum(F.when(has, F.col("meetings"))), F.lit(0)).alias("absent_total"),
        F.sum("present").alias("present"),
        F.sum("leave").alias("leave"),
        *duty,
        F.coalesce(F.sum("absent"), F.lit(0)).alias("absent"),
        *kinds.values(),
    )
    return t.withColumns(
        {
            "present_rate": ratio(F.col("present"), F.col("total")),
            "leave_rate": ratio(F.col("leave"), F.col("total")),
            **({"duty_rate": ratio(F.col("duty"), F.col("total"))} if duty else {}),
            "absent_rate": ratio(F.col("absent"), F.col("absent_total")),
        }
    )


def segments(totals: DataFrame, shown: Sequence[str], rest: str = "unlisted") -> DataFrame:
    """Named segments and the remainder; ``absent`` is a segment only when every table has it."""
    parts = [F.struct(F.lit(s).alias("label"), F.col(s).cast("long").alias("n")) for s in shown]
    absent = F.when(
        F.col("absent_total") == F.col("total"),
        F.array(F.struct(F.lit("absent").alias("label"), F.col("absent").cast("long").alias("n"))),
    ).otherwise(F.array().cast("array<struct<label:string,n:bigint>>"))
    listed = F.concat(F.array(*parts), absent)
    left = F.col("total") - F.aggregate(listed, F.lit(0).cast("long"), lambda a, s: a + s["n"])
    out = totals.withColumn("segments", listed).withColumn("rest", left)
    extra = F.array(F.struct(F.lit(rest).alias("label"), F.col("rest").cast("long").alias("n")))
    return out.withColumn(
        "segments", F.when(F.col("rest") > 0, F.concat("segments", extra)).otherwise(F.col("segments"))
    ).drop("rest")


def category_counts(facts: DataFrame, key: Sequence[str], category: str, categories: Sequence[str]) -> DataFrame:
    """A count for every listed category, zeros included, in the given order, and the remainder."""
    listed = F.col(category).isin(*categories)
    return facts.groupBy(*key).agg(
        F.array(*[F.count_if(F.col(category) == c) for c in categories]).alias("counts"),
        F.count_if(~F.coalesce(listed, F.lit(False))).alias("other"),
    )


def counts_by_spec(facts: DataFrame, key: Sequence[str], spec: Sequence[tuple[str, str]]) -> DataFrame:
    """One count per (id, predicate) of a specification, all in one pass."""
    return facts.groupBy(*key).agg(*[F.count_if(F.expr(p)).alias(name) for name, p in spec])


def attendance_by_session(persons: DataFrame, meetings: DataFrame, lists: DataFrame) -> DataFrame:
    """One row per person and session of the person's council.

    persons(council, person), meetings(council, session, meeting, leave_printed), lists(council, meeting, person,
    status).  Leave and duty stay null when no meeting of the session printed a list; a member on no list is not absent.
    """
    sessions = meetings.groupBy("council", "session").agg(
        F.count(F.lit(1)).alias("meetings"), F.bool_or("leave_printed").alias("printed")
    )
    dated = lookup(lists, meetings.select("council", "meeting", "session"), ["council", "meeting"], "inner")
    listed = dated.groupBy("council", "session", "person").agg(
        *[F.count_if(F.col("status") == s).alias(s) for s in ("present", "leave", "duty")]
    )
    j = persons.join(sessions, "council").join(listed, ["council", "session", "person"], "left")
    known = lambda c: F.when(F.col("printed"), F.coalesce(F.col(c), F.lit(0)))
    return j.select(
        "council", "session", "person", "meetings",
        F.coalesce("present", F.lit(0)).alias("present"), known("leave").alias("leave"), known("duty").alias("duty"),
    )


def null_preserving_sum(df: DataFrame, key: Sequence[str], listed: Column, value: Column, out: str) -> DataFrame:
    """Null, not zero, where no row of the group had the column at all."""
    s = F.when(F.bool_or(listed), F.coalesce(F.sum(F.when(listed, value)), F.lit(0)))
    return df.groupBy(*key).agg(s.alias(out))


def mark_histogram(df: DataFrame, ident: str, marks: str, symbols: dict[str, str]) -> DataFrame:
    """Occurrences of each symbol in a string of marks."""
    n = lambda s: F.length(marks) - F.length(F.translate(marks, s, ""))
    return df.select(ident, *[n(s).cast("long").alias(name) for name, s in symbols.items()])


def count_against_published(rows: DataFrame, published: DataFrame, key: str, total: str) -> DataFrame:
    """Grouped count next to the printed total; a group on one side only is a difference too."""
    n = rows.groupBy(key).agg(F.count(F.lit(1)).alias("counted"))
    j = n.join(published.select(key, total), key, "full_outer")
    state = (
        F.when(F.col(total).isNull(), "not published")
        .when(F.col("counted").isNull(), "no rows")
        .when(F.col("counted") == F.col(total), "agrees")
        .otherwise("differs")
    )
    return j.withColumn("state", state)


def drop_repeated(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key occurs once; all copies of a repeated key go.  No window: copies are counted, not gathered."""
    rest = [c for c in df.columns if c not in key]
    one = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"), *[F.any_value(c).alias(c) for c in rest])
    return one.filter("__n = 1").select(*df.columns)


def keep_first(df: DataFrame, key: Sequence[str], order: str, payload: Sequence[str]) -> DataFrame:
    """First row per key, flagged when a later copy says something else."""
    rest = [c for c in df.columns if c not in key and c != order]
    p = F.struct(*payload)
    out = df.groupBy(*key).agg(
        F.min(F.struct(order, *rest)).alias("__f"), (F.min(p) != F.max(p)).alias("differs"), F.count(F.lit(1)).alias("copies")
    )
    return out.select(*key, "__f.*", "differs", "copies")


def mode_or_null(df: DataFrame, key: Sequence[str], value: str, tie: str = "null") -> DataFrame:
    """Most frequent value; a tie gives null (or the smallest value with ``tie='least'``)."""
    n = df.filter(F.col(value).isNotNull()).groupBy(*key, value).agg(F.count(F.lit(1)).alias("n"))
    top = n.groupBy(*key).agg(F.min(F.struct(-F.col("n"), value)).alias("lo"), F.max(F.struct("n", value)).alias("hi"))
    mode = F.col(f"lo.{value}")
    if tie == "null":
        mode = F.when(F.col(f"lo.{value}") == F.col(f"hi.{value}"), mode)
    return top.select(*key, mode.alias("mode"))


def modal_offset(df: DataFrame, key: Sequence[str], value: Column) -> DataFrame:
    """Rows with a flag: does the row's offset equal the most frequent one of its group?"""
    d = df.withColumn("offset", value)
    return lookup(d, mode_or_null(d, key, "offset", tie="least"), key, "inner").withColumn("ok", F.col("offset") == F.col("mode"))


def median_outliers(df: DataFrame, key: Sequence[str], date: str, days: int = 45) -> DataFrame:
    """Upper median ``sorted[n // 2]`` of the dates and a flag for rows too far from it.

    The aggregate keeps counts per distinct date, so a large group costs its number of dates, not of rows.
    """
    med = df.groupBy(*key).agg(F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY unix_date({date}) DESC)").alias("m"))
    j = lookup(df, med, key, "inner").withColumn("median", F.date_from_unix_date(F.col("m").cast("int"))).drop("m")
    return j.withColumn("outlier", F.abs(F.datediff(date, "median")) > days)


def argmax(df: DataFrame, key: Sequence[str], by: Sequence[Column], take: Sequence[str]) -> DataFrame:
    """The row with the largest ``by`` per group."""
    order = [b.alias(f"__b{i}") for i, b in enumerate(by)]
    return df.groupBy(*key).agg(F.max(F.struct(*order, *take)).alias("__m")).select(
        *key, *[F.col(f"__m.{c}").alias(c) for c in take]
    )


def set_equality(a: DataFrame, b: DataFrame, key: Sequence[str], member: str) -> DataFrame:
    """Distinct members on one side only, per group; equal when there are none."""
    tag = lambda df, l, r: df.select(*key, member, F.lit(l).alias("l"), F.lit(r).alias("r"))
    sides = tag(a, True, False).unionByName(tag(b, False, True)).groupBy(*key, member).agg(
        F.bool_or("l").alias("l"), F.bool_or("r").alias("r")
    )
    return sides.groupBy(*key).agg(
        F.count_if(F.col("l") & ~F.col("r")).alias("only_a"),
        F.count_if(F.col("r") & ~F.col("l")).alias("only_b"),
        F.bool_and(F.col("l") & F.col("r")).alias("equal"),
    )


def reject_report(rejects: DataFrame, reasons: str, *extra: str) -> DataFrame:
    return rejects.select(*extra, F.explode(reasons).alias("reason")).groupBy(*extra, "reason").agg(F.count(F.lit(1)).alias("n"))


def speaker_profile(turns: DataFrame, key: Sequence[str], speaker: str, owner: str, text: str, page: str) -> DataFrame:
    """Per attributed speaker: own turns and characters, official turns, pages touched."""
    per_page = turns.filter(F.col(speaker).isNotNull()).groupBy(*key, speaker, page).agg(
        F.count_if(F.col(owner) == F.col(speaker)).alias("own"),
        F.count_if(~F.col(owner).eqNullSafe(F.col(speaker))).alias("official"),
        F.sum(F.when(F.col(owner) == F.col(speaker), F.length(text)).otherwise(0)).alias("chars"),
    )
    return per_page.groupBy(*key, speaker).agg(
        F.sum("own").alias("own_turns"), F.sum("official").alias("official_turns"), F.sum("chars").alias("own_chars"),
        F.count(F.lit(1)).alias("pages"), F.min(page).alias("first_page"), F.max(page).alias("last_page"),
    )


def roll_up_files(df: DataFrame, key: Sequence[str], file: str, date: str) -> DataFrame:
    """One row per key with its distinct files (a short list by nature) and the earliest readable date."""
    per_file = df.groupBy(*key, file).agg(F.min(date).alias("d"))
    return per_file.groupBy(*key).agg(F.array_sort(F.collect_list(file)).alias("files"), F.min("d").alias("date"))


def offset_lists(df: DataFrame, key: Sequence[str], start: str, per_row: int = PART) -> DataFrame:
    """Distinct offsets in order, ``per_row`` to a row; ``part`` numbers the rows of a key."""
    distinct = df.select(*key, start).distinct()
    ranked = OrderedGroups(distinct, list(key), [start], start).number("rank").rows()
    return (
        ranked.withColumn("part", F.floor((F.col("rank") - 1) / per_row))
        .groupBy(*key, "part")
        .agg(F.array_sort(F.collect_list(start)).alias("starts"))
    )
