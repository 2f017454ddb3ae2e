"""Joins with the shapes the record model needs; every one keeps an equality key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.scale import OrderedGroups, lookup, stored

COMMON = 1_000  # a member of more groups of a kind is counted only where it can decide

def suppress(items: DataFrame, withheld: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(published, withheld items kept for the report)."""
    listed = withheld.select(*keys).distinct()
    return lookup(items, listed, keys, "left_anti"), lookup(items, listed, keys, "left_semi")


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer comparison of two key sets: both, only_left or only_right, with the rows on each side.

    One tagged union and one combined aggregate, so a key repeated any number of times costs one row per task.
    """
    l = left.select(*keys, F.lit(1).alias("l"), F.lit(0).alias("r"))
    r = right.select(*keys, F.lit(0).alias("l"), F.lit(1).alias("r"))
    both = l.unionByName(r).groupBy(*keys).agg(F.sum("l").alias("n_left"), F.sum("r").alias("n_right"))
    side = F.when(F.col("n_right") == 0, "only_left").when(F.col("n_left") == 0, "only_right").otherwise("both")
    return both.withColumn("side", side)


def drop_contradicted(
    a: DataFrame, b: DataFrame, on: Sequence[str], sentence: str
) -> DataFrame:
    """Rows of ``b`` without those ``a`` contradicts, and without any row that shares a sentence with one of them."""
    struck = lookup(b, a.select(*on).distinct(), on, "left_semi").select(sentence).distinct()
    return lookup(b, struck, [sentence], "left_anti")


def sole_owner(claims: DataFrame, item: str, owner: str) -> DataFrame:
    """Claims on items that one owner claims; an item with several owners is dropped for all."""
    owners = claims.groupBy(item).agg(F.min(owner).alias("lo"), F.max(owner).alias("hi"))
    return lookup(claims, owners.filter("lo = hi").select(item), [item], "left_semi")


def all_or_nothing(members: DataFrame, doc: str, resolved: Column) -> DataFrame:
    """Documents every member of which is resolved."""
    state = members.groupBy(doc).agg(F.bool_and(resolved).alias("__all"), F.count(F.lit(1)).alias("members"))
    return state.filter("__all").drop("__all")


def call_then_label(calls: DataFrame, labels: DataFrame, keys: Sequence[str], pos: str) -> DataFrame:
    """Announcements with the first own label that follows them, per (document, name).

    Both kinds go through one ordered pass: each call sees the nearest label after it, no pairs are built.
    """
    both = calls.select(*keys, pos, F.lit(True).alias("is_call")).unionByName(
        labels.select(*keys, pos, F.lit(False).alias("is_call"))
    )
    # a label at the position of its call does not follow it: calls sort behind labels there
    seen = OrderedGroups(both, keys, [F.col(pos), F.col("is_call")], pos).next_seen(
        "label_pos", F.when(~F.col("is_call"), F.col(pos))
    )
    return seen.rows().filter(F.col("is_call") & F.col("label_pos").isNotNull()).drop("is_call").withColumnRenamed(
        pos, "call_pos"
    )


def day_session_names(media: DataFrame, records: DataFrame, keys: Sequence[str], name: str, order: str) -> DataFrame:
    """Media of a day and session with the distinct names of its records in first-mention order.

    The names of one day and session are a roster-sized list: they are made distinct before they are collected.
    """
    first = records.groupBy(*keys, name).agg(F.min(order).alias("__first"))
    listed = first.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("__first", name))).alias("__names"))
    listed = listed.withColumn("names", F.transform("__names", lambda s: s[name])).drop("__names")
    return lookup(media, listed, keys, "inner")


def overlap_scores(docs: DataFrame, groups: DataFrame, kind: str, doc: str, group: str, member: str, common: int = COMMON) -> DataFrame:
    """(kind, doc, group, score): members shared, for every pair that can be a document's best.

    Members of more than ``common`` groups of a kind are set aside.  The others give each pair a partial score and each
    document the score its best group has at least; a pair can gain no more than the document's number of common members.  So a
    pair whose bound lies below the best partial score is hopeless and never counted further, and groups that meet a document
    in common members only are paired with it only if those could be enough.
    """
    d, g = docs.select(kind, doc, member).distinct(), groups.select(kind, group, member).distinct()
    many = g.groupBy(kind, member).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > common).select(kind, member)
    many = stored(many, "common-members")  # at most memberships / common rows
    of = lambda rows, how: rows.join(many, [kind, member], how)
    partial = of(d, "left_anti").join(of(g, "left_anti"), [kind, member]).groupBy(kind, doc, group).agg(F.count(F.lit(1)).alias("__p"))
    if many.isEmpty():
        return partial.withColumnRenamed("__p", "score")
    partial, d_common, g_common = stored(partial, "partial-overlap"), of(d, "left_semi"), of(g, "left_semi")
    least = partial.groupBy(kind, doc).agg(F.max("__p").alias("__best"))
    more = d_common.groupBy(kind, doc).agg(F.count(F.lit(1)).alias("__h"))
    bound = more.join(least, [kind, doc], "full_outer").fillna(0, ["__h", "__best"])
    hopeful = partial.join(bound, [kind, doc]).filter(F.col("__p") + F.col("__h") >= F.col("__best")).drop("__best")
    # documents whose common members alone may decide: all their groups; for the others the hopeful pairs only
    open_docs = bound.filter(F.col("__h") >= F.greatest("__best", F.lit(1))).select(kind, doc)
    by_common = d_common.join(open_docs, [kind, doc], "left_semi").join(g_common, [kind, member]).select(kind, doc, group)
    closed = hopeful.filter("__h > 0").join(open_docs, [kind, doc], "left_anti").select(kind, doc, group)
    added = closed.join(d_common, [kind, doc]).join(g_common, [kind, group, member], "left_semi").select(kind, doc, group)
    counted = by_common.unionByName(added).groupBy(kind, doc, group).agg(F.count(F.lit(1)).alias("__c"))
    both = hopeful.select(kind, doc, group, F.col("__p").alias("score")).unionByName(counted.select(kind, doc, group, F.col("__c").alias("score")))
    return both.groupBy(kind, doc, group).agg(F.sum("score").alias("score"))


def best_overlap(
    docs: DataFrame, groups: DataFrame, kind: str, doc: str, group: str, member: str, doc_date: Column, group_date: Column
) -> DataFrame:
    """For each document the groups sharing the most members; those of one of its dates if any is, else all of them.

    Dates are sets of their own: a document without a date keeps all its best groups, and one with several is not counted
    once per date.
    """
    score = stored(overlap_scores(docs, groups, kind, doc, group, member, COMMON), "overlap")
    top = score.groupBy(kind, doc).agg(F.max("score").alias("__top"))
    score = lookup(score, top, [kind, doc], "inner").filter(F.col("score") == F.col("__top")).drop("__top")
    days_of = docs.select(kind, doc, doc_date.alias("__date")).distinct()
    same = (
        score.select(kind, doc, group).join(days_of, [kind, doc])
        .join(groups.select(kind, group, group_date.alias("__date")).distinct(), [kind, group, "__date"])
        .select(kind, doc, group, F.lit(True).alias("same_date")).distinct()
    )
    score = score.join(same, [kind, doc, group], "left").withColumn("same_date", F.coalesce("same_date", F.lit(False)))
    any_same = score.groupBy(kind, doc).agg(F.max("same_date").alias("__any"))
    return lookup(score, any_same, [kind, doc], "inner").filter(F.col("same_date") == F.col("__any")).drop("__any")


def _nodes(start: Column, end: Column) -> Column:
    """The fewest aligned ranges (level, place) of 2 ** level characters that make up [start, end): two a level at most."""

    def at(level: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1).cast("long"), level)
        low, high = F.floor((start + size - 1) / size).cast("long"), F.floor(end / size).cast("long")
        node = lambda i: F.struct(level.cast("int").alias("level"), i.alias("place"))
        odd = lambda x: x % 2 == 1
        return F.filter(F.array(F.when((low < high) & odd(low), node(low)), F.when((low < high) & odd(high), node(high - 1))), lambda x: x.isNotNull())

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(50)), at))


def enclosing_spans(points: DataFrame, spans: DataFrame, doc: str, pos: str, start: str, end: str) -> DataFrame:
    """Points with the spans ``start <= pos < end`` around them.

    Spans that begin behind all earlier ones do not overlap: merged with the points in their order, each is one row however
    long it is, and a point belongs to the last one that began.  Spans that begin inside an earlier one are cut into aligned
    ranges, two for each doubling of their length, which meet the points in an equi-join.  Positions count from 0.
    """
    carried = [c for c in spans.columns if c != doc]
    s = spans.filter(F.col(start) < F.col(end)).select(doc, F.struct(*carried).alias("__s"))
    begin, stop = F.col("__s")[start].cast("long"), F.col("__s")[end].cast("long")
    g = OrderedGroups(s.withColumns({"__b": begin, "__e": stop}), [doc], ["__b", "__e", "__s"], "__b", "__e").running_max("__reach", F.col("__e"))
    g = g.previous("__before", F.col("__reach")).rows()
    apart = F.coalesce(F.col("__before") <= F.col("__b"), F.lit(True))
    heads, inner = g.filter(apart), g.filter(~apart)
    p = points.select(doc, F.struct(*[c for c in points.columns if c != doc]).alias("__p"), F.col(pos).cast("long").alias("__b"))
    merged = p.withColumn("__s", F.lit(None).cast(s.schema["__s"].dataType)).unionByName(heads.select(doc, F.lit(None).cast(p.schema["__p"].dataType).alias("__p"), "__b", "__s"))
    is_point = F.col("__p").isNotNull().alias("__point")
    swept = OrderedGroups(merged.select("*", is_point), [doc], ["__b", "__point"], "__b").last_seen("__in", F.col("__s")).rows()
    hits = swept.filter("__point").filter(F.col("__in")[end] > F.col("__b")).select(doc, "__p", F.col("__in").alias("__s"))
    ranges = inner.select(doc, "__s", F.explode(_nodes(begin, stop)).alias("__n"))
    levels = [r[0] for r in ranges.select(F.col("__n.level")).distinct().collect()]  # 51 at most
    if levels:
        place = lambda level: F.struct(level.alias("level"), F.call_function("shiftright", F.col("__b"), level).alias("place"))
        up = p.select(doc, "__p", F.explode(F.transform(F.array(*[F.lit(x) for x in sorted(levels)]), place)).alias("__n"))
        hits = hits.unionByName(up.join(ranges, [doc, "__n"]).select(doc, "__p", "__s"))
    return hits.select(doc, "__p.*", "__s.*")


def first_match(src: DataFrame, media: DataFrame, keys: Sequence[str], order: Sequence[str], take: Sequence[str]) -> DataFrame:
    """First media row per null-safe key, looked up from ``src``; the media side is reduced before the join."""
    whole = F.struct(*keys).alias("__key")  # structs compare equal where their null fields agree
    best = media.groupBy(whole).agg(F.min(F.struct(*order, *take)).alias("__best"))
    return lookup(src.select("*", whole), best, ["__key"]).select(*src.columns, *[F.col(f"__best.{c}").alias(c) for c in take])


def covering_file(targets: DataFrame, files: DataFrame, office: str, area: str, number: str) -> DataFrame:
    """The preferred file that covers the target's office, area and number range.

    Files: (office, areas[], lo, hi, preference, path).  Files are a catalogue of some hundred rows exploded to
    (office, area, number), so the range test becomes an equi-join.
    """
    spread = files.select(
        F.col("office").alias(office), F.explode("areas").alias(area), "lo", "hi", "preference", "path"
    ).select(office, area, F.explode(F.sequence("lo", "hi")).alias(number), "preference", "path")
    best = spread.groupBy(office, area, number).agg(F.min(F.struct("preference", "path")).alias("__f"))
    return lookup(targets, best, [office, area, number]).select(*targets.columns, F.col("__f.path").alias("path"))


def scoped_fixes(rows: DataFrame, fixes: DataFrame, doc: str, raw: str) -> DataFrame:
    """Spelling fixes, each valid only in its own document."""
    return lookup(rows, fixes, [doc, raw]).withColumn("name", F.coalesce("fixed", raw)).drop("fixed")
