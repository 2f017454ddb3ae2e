"""Operators over ordered rows, built on ``OrderedGroups`` so that no group has to fit one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.functions import text as tx
from attesta.scale import OrderedGroups, each, lookup

# fixed values: owners of a turn that are not members
CHAIR, OUTSIDER = "CHAIR", "OTHER"
VERBATIM_MIN = 10  # shorter texts are never taken for copies
UNNUMBERED = 1 << 40  # place of rows without a number: after all others


def latest_state(events: DataFrame, key: Sequence[str], order: Sequence[str], state: str) -> DataFrame:
    return events.groupBy(*key).agg(F.max_by(state, F.struct(*order)).alias("state"))


def earliest(rows: DataFrame, key: Sequence[str], order: Sequence[Column], take: Sequence[str], same: str | None = None) -> DataFrame:
    """First row per key in the given order (a preference may come first); ``conflict`` when ``same`` varies."""
    first = F.min(F.struct(*[o.alias(f"__o{i}") for i, o in enumerate(order)], *take))
    flags = [(F.min(same) != F.max(same)).alias("conflict")] if same else []
    out = rows.groupBy(*key).agg(first.alias("__f"), *flags)
    return out.select(*key, *[F.col(f"__f.{c}").alias(c) for c in take], *(["conflict"] if same else []))


def earliest_or_fail(rows: DataFrame, key: Sequence[str], order: Sequence[Column], take: Sequence[str], same: str) -> DataFrame:
    found = earliest(rows, key, order, take, same)
    fail = F.raise_error(F.concat_ws(" ", F.lit("conflicting rows for"), *[F.col(k).cast("string") for k in key]))
    return found.filter(F.when(F.col("conflict"), fail.cast("boolean")).otherwise(True)).drop("conflict")


def attribute(turns: DataFrame, key: Sequence[str], pos: str, owner: str) -> DataFrame:
    """Owner labels → the member each turn belongs to.

    Chair rows belong to nobody and leave the state alone; a member sets it; an outsider clears it; rows without a
    label inherit it.
    """
    o = F.col(owner)
    # an outsider writes a token of its own, so "cleared" is told from "nothing seen yet"
    token = F.when(o == OUTSIDER, F.struct(F.lit(None).cast("string").alias("m"))).when(
        o.isNotNull() & (o != CHAIR), F.struct(o.alias("m"))
    )
    seen = OrderedGroups(turns, key, [pos], pos).last_seen("__state", token).rows()
    return seen.withColumn("attributed", F.when(o.eqNullSafe(CHAIR), None).otherwise(F.col("__state.m"))).drop("__state")


def runs(rows: DataFrame, key: Sequence[str], order: Sequence[str], pos: Column | str, label: str, take: str) -> DataFrame:
    """Consecutive rows with one label → (key, run, label, first ``take``, n)."""
    g = OrderedGroups(rows, key, order, pos).previous("__prev", F.col(label))
    change = (~F.col("__prev").eqNullSafe(F.col(label))).cast("long")
    g = g.running_sum("run", change)
    return g.rows().groupBy(*key, "run", label).agg(F.min(take).alias("start"), F.count(F.lit(1)).alias("n"))


def longest_own_run(run_rows: DataFrame, key: Sequence[str], label: str, name: Column, allowed: Column) -> DataFrame:
    """Start and size of the block around the longest own run, widened over allowed neighbours on both sides.

    The block starts at its first own run; ``n`` counts the own rows in it.
    """
    own = F.col(label) == name
    marked = run_rows.withColumn("__own", own).withColumn("__in", own | allowed)
    # allowed runs between two others share the number of excluded runs before them
    block = OrderedGroups(marked, key, ["run"], "run").running_sum("__block", (~F.col("__in")).cast("long")).rows()
    per_block = block.filter("__in").groupBy(*key, "__block").agg(
        F.max(F.when(F.col("__own"), F.struct("n", (-F.col("run")).alias("r")))).alias("best"),
        F.min(F.when(F.col("__own"), F.struct("run", "start"))).alias("first"),
        F.sum(F.when(F.col("__own"), F.col("n")).otherwise(0)).alias("own_n"),
    )
    top = per_block.filter(F.col("best").isNotNull()).groupBy(*key).agg(F.max(F.struct("best", "first", "own_n")).alias("t"))
    return top.select(*key, F.col("t.first.start").alias("start"), F.col("t.own_n").alias("n"))


def interleave(rows: DataFrame, key: Sequence[str], order: Sequence[str], pos: Column | str, label: str) -> DataFrame:
    """Label changes beyond the ones an orderly succession needs."""
    g = OrderedGroups(rows, key, order, pos).previous("__prev", F.col(label)).rows()
    changed = F.col("__prev").isNotNull() & (F.col("__prev") != F.col(label))
    per_label = g.groupBy(*key, label).agg(F.count_if(changed).alias("c"))
    changes, labels = F.sum("c"), F.count(F.lit(1))
    return per_label.groupBy(*key).agg((changes - F.greatest(labels - 1, F.lit(0))).alias("interleave"))


def meetings_since_first_listing(meetings: DataFrame, lists: DataFrame, scope: str, meeting: str, person: str) -> DataFrame:
    """Denominator of a replacement member: the meetings from the first one that lists them.

    Meetings are numbered per scope; the count follows from the number of the first listing, so persons and meetings
    are never paired.
    """
    numbered = OrderedGroups(meetings, [scope], [meeting], meeting).number("no").rows()
    totals = meetings.groupBy(scope).agg(F.count(F.lit(1)).alias("all_meetings"))
    first = lists.groupBy(scope, person).agg(F.min(meeting).alias(meeting), F.count(F.lit(1)).alias("listed"))
    j = first.join(numbered.select(scope, meeting, "no"), [scope, meeting]).join(totals, scope)
    return j.select(scope, person, F.col(meeting).alias("start"), (F.col("all_meetings") - F.col("no") + 1).alias("meetings"), "listed")


def before_successor(lists: DataFrame, successions: DataFrame, person: str, date: str) -> DataFrame:
    """A predecessor's listing counts only before the successor's first one."""
    first = lists.groupBy(person).agg(F.min(date).alias("__cut")).withColumnRenamed(person, "successor")
    cut = successions.join(first, "successor", "left").select(F.col("predecessor").alias(person), "__cut")
    j = lookup(lists, cut, [person])
    return j.withColumn("ok", F.col("__cut").isNull() | (F.col(date) < F.col("__cut"))).drop("__cut")


def first_verbatim(docs: DataFrame, ident: str, order: Sequence[str], text: str) -> DataFrame:
    """Later copies of a text are rejected, white space aside; short texts are never copies.

    The first copy is found by a combined minimum per text digest and joined back by id, so a text that fills a third
    of the table never gathers in one task.
    """
    squashed = tx.squash(F.col(text))
    digest = F.when(F.length(squashed) >= VERBATIM_MIN, F.sha2(squashed, 256))
    d = docs.select(ident, *[o for o in order if o != ident], digest.alias("__digest"))
    first = d.groupBy("__digest").agg(F.min(F.struct(*order, F.col(ident).alias("__id")))["__id"].alias(ident))
    j = d.join(first.select(ident, F.lit(True).alias("__first")), ident, "left")
    return j.select(ident, (F.col("__digest").isNull() | F.col("__first").isNotNull()).alias("accepted"))


def carry_blanks(rows: DataFrame, table: Sequence[str], order: str, cell: str) -> DataFrame:
    """Blank cells take the value above them, within their own table only."""
    filled = F.when(F.trim(F.col(cell)) != "", F.col(cell))
    return OrderedGroups(rows, table, [order], order).last_seen("filled", filled).rows()


def cut(docs: DataFrame, carry: Sequence[str], items: str, opens: str, out: str) -> DataFrame:
    """Array column cut before every element whose flag is set; elements before the first flag are dropped.

    The lines of a document live in its row, so cutting them there needs no shuffle.  The places to cut are a column of
    their own, as an expression inside the lambda would be computed again for every piece.
    """
    at = F.filter(F.transform(opens, lambda o, i: F.when(o, i)), lambda i: i.isNotNull())
    d = docs.select(*carry, items, at.alias("__at"))
    after = lambda k: F.coalesce(F.get("__at", k + 1), F.size(items))
    return d.select(*carry, F.transform("__at", lambda start, k: F.slice(items, start + 1, after(k) - start)).alias(out))


def _parts(docs: DataFrame, key: Sequence[str], sep: str) -> DataFrame:
    """(key, part, lines, text) from the columns ``items`` and ``opens``."""
    p = each(cut(docs, key, "items", "opens", "cuts"), key, F.col("cuts"), "ls", "at")
    return p.select(
        *key, (F.col("at") + 1).cast("long").alias("part"), F.size("ls").cast("long").alias("lines"), F.array_join("ls", sep).alias("text")
    )


def merge_continuations(docs: DataFrame, key: Sequence[str], names: Column, texts: Column) -> DataFrame:
    """A row continues the one above when its name is blank, or is the same and the text above ends no sentence.

    ``names`` and ``texts`` are the cells of one table in order, across its page breaks.
    """
    d = docs.select(*key, names.alias("names"), texts.alias("items"))
    blank = lambda n: F.trim(F.coalesce(n, F.lit(""))) == ""
    unfinished = lambda i: ~F.get("items", i - 1).rlike(r"[.!?。]\s*$")
    joins = lambda n, i: (i > 0) & (blank(n) | ((n == F.get("names", i - 1)) & unfinished(i)))
    opens = F.transform("names", lambda n, i: ~F.coalesce(joins(n, i), F.lit(False)))
    return _parts(d.withColumn("opens", opens), key, "")


def merge_bullets(docs: DataFrame, key: Sequence[str], lines: Column, bullet: str) -> DataFrame:
    """Wrapped lines → items: a line that opens with a bullet starts an item."""
    d = docs.select(*key, lines.alias("items"))
    return _parts(d.withColumn("opens", F.transform("items", lambda s: s.rlike(bullet))), key, " ")


def blocks(docs: DataFrame, key: Sequence[str], lines: Column, is_heading) -> DataFrame:
    """(key, block, heading, body): lines by the heading they stand under, the heading first; what precedes the first
    heading is dropped."""
    d = docs.select(*key, lines.alias("items"))
    d = cut(d.withColumn("opens", F.transform("items", is_heading)), key, "items", "opens", "cuts")
    return each(d, key, F.col("cuts"), "body", "at").select(
        *key, (F.col("at") + 1).cast("long").alias("block"), F.get("body", F.lit(0)).alias("heading"), "body"
    )


def gap_clusters(rows: DataFrame, key: Sequence[str], order: Sequence[str], x: Column, gap: int) -> DataFrame:
    """Sorted values; a gap larger than ``gap`` opens a new cluster.  Mean in whole units."""
    r = rows.withColumn("__x", x)
    g = OrderedGroups(r, key, ["__x", *order], "__x").previous("__p", F.col("__x"))
    opens = (F.col("__p").isNull() | (F.col("__x") - F.col("__p") > gap)).cast("long")
    g = g.running_sum("cluster", opens)
    return g.rows().groupBy(*key, "cluster").agg(
        F.count(F.lit(1)).alias("n"), F.min("__x").alias("first"), F.max("__x").alias("last"),
        F.expr("CAST(sum(CAST(__x AS DECIMAL(20,0))) div count(1) AS BIGINT)").alias("mean"),
    )


def nearest_within(points: DataFrame, marks: DataFrame, key: Sequence[str], x: str, tolerance: int) -> DataFrame:
    """The mark within the tolerance of each point if there is exactly one, else null.

    Two marks on either side decide, and one ordered pass over points and marks brings them to the point, so the marks
    around a point are never paired with it.
    """
    m = OrderedGroups(marks.select(*key, x).distinct(), key, [x], x)
    m = m.previous("p", F.col(x)).following("f", F.col(x)).rows()
    m = m.select(*key, x, F.lit(False).alias("is_point"), F.struct(F.col(x).alias("c"), "p", "f").alias("mark"))
    ident = [c for c in points.columns if c not in (*key, x)]
    p = points.withColumn("is_point", F.lit(True))
    both = m.unionByName(p, allowMissingColumns=True)
    g = OrderedGroups(both, key, [x, "is_point"], x).last_seen("l", F.col("mark")).next_seen("r", F.col("mark"))
    near = F.array(F.col("l.c"), F.col("l.p"), F.col("r.c"), F.col("r.f"))
    hits = F.filter(near, lambda c: c.isNotNull() & (F.abs(c - F.col(x)) <= tolerance))
    out = g.rows().filter("is_point").withColumn("__h", hits)
    return out.select(*ident, *key, x, F.when(F.size("__h") == 1, F.get("__h", F.lit(0))).alias("mark"))


def sequence_key(session: Column, meeting: Column, afternoon: Column, slot: Column) -> Column:
    """Total order of same-day items: session, meeting, half of the day, slot."""
    return ((session * 100 + meeting) * 2 + afternoon.cast("int")) * 100 + slot


def poisoned(rows: DataFrame, group: str, bad: Column) -> DataFrame:
    """Every row of a group that holds a bad row is flagged."""
    struck = rows.filter(bad).select(group).distinct().withColumn("poisoned", F.lit(True))
    return lookup(rows, struck, [group]).withColumn("poisoned", F.coalesce("poisoned", F.lit(False)))


def number_citations(refs: DataFrame, doc: Sequence[str], key: Sequence[str], pos: str) -> DataFrame:
    """References with the same key share a number; numbers follow first appearance."""
    first = refs.groupBy(*doc, *key).agg(F.min(pos).alias("__first"))
    numbered = OrderedGroups(first, doc, ["__first"], "__first").number("number").rows().drop("__first")
    return lookup(refs, numbered, [*doc, *key], "inner")


def newest_n(rows: DataFrame, key: Sequence[str], newest: Sequence[Column], n: int) -> DataFrame:
    """The ``n`` newest rows of each list and how many more there are.

    A row_number filter is pruned inside each task before the shuffle, so a long list sends ``n`` rows per task.
    """
    from pyspark.sql import Window

    w = Window.partitionBy(*key).orderBy(*newest)
    shown = rows.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= n)
    total = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("__total"))
    return shown.join(total, list(key)).withColumn("hidden", F.greatest(F.col("__total") - n, F.lit(0))).drop("__total")
