"""Ordered work over groups of any size.

A window partitioned by a key puts the whole group into one task, so a key that holds a third of the rows stalls the
job.  ``OrderedGroups`` counts rows per key first (map-side combined), and cuts only the large groups into blocks along
the ordering, by rows: quantile sketches, merged by aggregation, say where.  Windows run per (key, block); what a block
needs from the blocks before it is a single row per block.  Without large groups nothing is added to the plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from attesta.session import scratch

ROWS_PER_BLOCK = "attesta.rows.per.block"
BLOCK, HOT = "__blk", "__hot"
CUTS, SKETCH, ROUNDS = 256, 4096, 6  # most parts of a block in one round, size of a sketch, most rounds
BROADCAST_ROWS = 200_000  # rows with a key and a few numbers, or their arrays of at most CUTS numbers


def rows_per_block(spark: SparkSession) -> int:
    return int(spark.conf.get(ROWS_PER_BLOCK, "1000000"))


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join in which null keys are equal; the keys of the right side are dropped."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    return left.join(renamed, same, how).drop(*[f"__r_{k}" for k in keys if how not in ("left_semi", "left_anti")])


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows as a written table: read often, worked out once, and joined with skewed sides by adaptive execution."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _hinted(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def digits_pos(col: Column | str, skip: int = 0) -> Column:
    """A number that never falls as a text of the form ``<prefix><digits>…`` rises; ``skip`` is the prefix length.

    Written in base 12: 0 for the end of the text or a character below the digits, 1-10 for the digits, 11 for a
    character above them, where reading stops.
    """
    col = F.col(col) if isinstance(col, str) else col
    rest = F.substring(col, skip + 1, 14)
    digits = F.regexp_extract(rest, "^[0-9]*", 0)
    after = F.when(F.regexp_extract(rest, "^[0-9]*(.)", 1) > F.lit("9"), F.lit("b")).otherwise(F.lit("0"))
    code = F.concat(F.translate(digits, "0123456789", "123456789a"), after)
    return F.conv(F.substring(F.rpad(code, 14, "0"), 1, 14), 12, 10).cast("long")


class OrderedGroups:
    """Rows of each group in ascending ``order``.

    ``pos`` is a whole number that never falls along that order (a null comes first); where many rows share one ``pos``,
    ``tie`` is a number that never falls among them, so that such rows can be cut apart as well.

    A group of more than ``attesta.rows.per.block`` rows is cut at quantiles of its own rows, so clustered positions fill as
    many blocks as they need, and rows without a date or number, all at one position, get blocks of their own.  What is
    still twice too large is cut again.  A null key is a group like any other.  Only rows that agree in position and tie
    stay together.
    """

    def __init__(
        self, df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], pos: Column | str, tie: Column | str | None = None
    ):
        self.keys = list(keys)
        self.order = [F.col(o) if isinstance(o, str) else o for o in order]
        pos = F.coalesce((F.col(pos) if isinstance(pos, str) else pos).cast("long"), F.lit(-(1 << 63)))
        tie = F.lit(0) if tie is None else F.col(tie) if isinstance(tie, str) else tie
        limit = rows_per_block(df.sparkSession)
        self.df = df.withColumn(BLOCK, F.lit(0).cast("long")).withColumn(HOT, F.lit(False))
        self.blocks = 0  # of large groups: at most a few times total / limit
        for i in range(ROUNDS):
            cuts = self._cuts(pos, F.coalesce(tie.cast("long"), F.lit(-(1 << 63))), limit if i == 0 else 2 * limit, limit)
            if cuts is None:
                break
            cuts, n, parts = cuts
            self.blocks += parts
            value = F.when(F.col("__by_pos"), pos).otherwise(tie)
            below = F.size(F.filter("__cuts", lambda c: c < value))
            part = F.coalesce(2 * below + F.array_contains("__heavy", value).cast("int"), F.lit(0))
            found = null_safe_join(self.df, _hinted(cuts, n), [*self.keys, BLOCK])
            found = found.withColumn(BLOCK, F.col(BLOCK) * (4 * CUTS) + part).withColumn(HOT, F.col(HOT) | F.col("__by_pos").isNotNull())
            self.df = found.drop("__by_pos", "__cuts", "__heavy")

    def _cuts(self, pos: Column, tie: Column, most: int, limit: int) -> tuple[DataFrame, int, int] | None:
        """Where to cut the blocks of more than ``most`` rows, how many they are and into how many parts; None if there are none."""
        keys = [*self.keys, BLOCK]
        sizes = self.df.filter(HOT) if self.blocks else self.df
        sizes = sizes.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), (F.min(pos) < F.max(pos)).alias("__by_pos"), (F.min(tie) < F.max(tie)).alias("__by_tie"))
        large = sizes.filter((F.col("__n") > most) & (F.col("__by_pos") | F.col("__by_tie"))).drop("__by_tie")
        if large.isEmpty():
            return None
        large = stored(large, "large-groups")
        n = large.count()
        rows = null_safe_join(self.df, _hinted(large, n), keys, "inner")
        sketch = F.kll_sketch_agg_bigint(F.when(F.col("__by_pos"), pos).otherwise(tie), SKETCH)
        sketches = rows.groupBy(*keys, "__n", "__by_pos").agg(sketch.alias("__s"))
        parts = F.least(F.ceil(F.col("__n") * 3 / (2 * limit)), F.lit(CUTS)).cast("int")
        grid = F.kll_sketch_get_quantile_bigint("__s", F.array(*[F.lit(i / (4 * CUTS)) for i in range(1, 4 * CUTS)]))  # fixed ranks only
        all_cuts = F.transform(
            F.sequence(F.lit(1), F.greatest(parts - 1, F.lit(1))),
            lambda i: F.element_at("__grid", F.least((F.round(i * 4 * CUTS / parts)).cast("int"), F.lit(4 * CUTS - 1))),
        )
        sketches = sketches.withColumn("__grid", grid)
        cuts = sketches.select(*keys, "__by_pos", all_cuts.alias("__all")).select(
            *keys, "__by_pos", F.array_distinct("__all").alias("__cuts"),
            # a value that fills a part by itself is cut off on both sides
            F.array_distinct(F.filter("__all", lambda c, i: (i > 0) & (F.element_at("__all", F.greatest(i, F.lit(1))) == c))).alias("__heavy"),
        )
        cuts = stored(cuts, "cuts")
        total = cuts.agg(F.sum(2 * F.size("__cuts") + 1)).first()[0]
        return cuts, n, total

    @property
    def window(self):
        return Window.partitionBy(*self.keys, BLOCK).orderBy(*self.order)

    @property
    def _blocks(self):
        return Window.partitionBy(*self.keys).orderBy(BLOCK)

    def _carry(self, per_block: Column, across: Column) -> DataFrame:
        """One row per block of a large group with what the earlier or later blocks hand over."""
        summary = self.df.filter(HOT).groupBy(*self.keys, BLOCK).agg(per_block.alias("__part"))
        return _hinted(summary.withColumn("__carry", across).drop("__part"), self.blocks)

    def _passed(self, out: str, local: Column, per_block: Column, across: Column, value: Column) -> OrderedGroups:
        """The value within the block, joined with what other blocks hand over; without large groups the first is final."""
        carry = self._carry(per_block, across) if self.blocks else None
        self.df = self.df.withColumn(out, local)
        if carry is not None:
            self.df = null_safe_join(self.df, carry, [*self.keys, BLOCK]).withColumn(out, value).drop("__carry")
        return self

    def _rank(self, value: Column) -> Column:
        return F.when(value.isNotNull(), F.struct(*self.order))

    def running_sum(self, out: str, value: Column) -> OrderedGroups:
        before = F.sum("__part").over(self._blocks.rowsBetween(Window.unboundedPreceding, -1))
        local = F.sum(value).over(self.window.rowsBetween(Window.unboundedPreceding, 0))
        return self._passed(out, local, F.sum(value), before, F.col(out) + F.coalesce(F.col("__carry"), F.lit(0)))

    def running_max(self, out: str, value: Column) -> OrderedGroups:
        """Greatest value up to and including the row."""
        before = F.max("__part").over(self._blocks.rowsBetween(Window.unboundedPreceding, -1))
        local = F.max(value).over(self.window.rowsBetween(Window.unboundedPreceding, 0))
        return self._passed(out, local, F.max(value), before, F.greatest(F.col(out), F.col("__carry")))

    def number(self, out: str) -> OrderedGroups:
        """1-based position in the group."""
        return self.running_sum(out, F.lit(1).cast("long"))

    def last_seen(self, out: str, value: Column) -> OrderedGroups:
        """Most recent non-null value up to and including the row."""
        local = F.last(value, ignorenulls=True).over(self.window.rowsBetween(Window.unboundedPreceding, 0))
        before = F.last("__part", ignorenulls=True).over(self._blocks.rowsBetween(Window.unboundedPreceding, -1))
        return self._passed(out, local, F.max_by(value, self._rank(value)), before, F.coalesce(F.col(out), F.col("__carry")))

    def next_seen(self, out: str, value: Column) -> OrderedGroups:
        """Nearest non-null value at or after the row."""
        local = F.first(value, ignorenulls=True).over(self.window.rowsBetween(0, Window.unboundedFollowing))
        after = F.first("__part", ignorenulls=True).over(self._blocks.rowsBetween(1, Window.unboundedFollowing))
        return self._passed(out, local, F.min_by(value, self._rank(value)), after, F.coalesce(F.col(out), F.col("__carry")))

    def previous(self, out: str, value: Column) -> OrderedGroups:
        """Value of the row before; null at the start of the group."""
        boxed = F.struct(value.alias("v"))
        before = F.lag("__part").over(self._blocks)
        self._passed(out, F.lag(boxed).over(self.window), F.max_by(boxed, F.struct(*self.order)), before, F.coalesce(F.col(out), F.col("__carry")))
        self.df = self.df.withColumn(out, F.col(out)["v"])
        return self

    def following(self, out: str, value: Column) -> OrderedGroups:
        """Value of the row after; null at the end of the group."""
        boxed = F.struct(value.alias("v"))
        after = F.lead("__part").over(self._blocks)
        self._passed(out, F.lead(boxed).over(self.window), F.min_by(boxed, F.struct(*self.order)), after, F.coalesce(F.col(out), F.col("__carry")))
        self.df = self.df.withColumn(out, F.col(out)["v"])
        return self

    def rows(self) -> DataFrame:
        return self.df.drop(BLOCK, HOT)


def lookup(
    rows: DataFrame, index: DataFrame, keys: Sequence[str], how: str = "left", hot: DataFrame | None = None
) -> DataFrame:
    """Join many rows to an index with at most one row per key (left, inner, left_semi or left_anti).

    Keys that hold more rows than a block are few (at most total / limit), so their index rows are broadcast and their
    rows stay where they are; all other keys meet in an ordinary shuffle join.  AQE drops the first half when no key is
    large.  ``hot`` passes such keys in where they are known already; it must be as small.
    """
    keys = list(keys)
    if hot is None:
        limit = rows_per_block(rows.sparkSession)
        hot = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > limit).select(*keys)
    hot = F.broadcast(hot)
    many = rows.join(hot, keys, "left_semi").join(F.broadcast(index.join(hot, keys, "left_semi")), keys, how)
    rest = rows.join(hot, keys, "left_anti").join(index, keys, how)
    return rest.unionByName(many)


def each(df: DataFrame, carry: Sequence[Column | str], array: Column, item: str, at: str | None = None) -> DataFrame:
    """One row per element of a costly array.

    The plain explode lets the optimizer test the array for emptiness below, which computes it a second time; the outer
    form does not, and its null rows are dropped here.
    """
    out = df.select(*carry, F.posexplode_outer(array).alias("__at", item)).filter(F.col("__at").isNotNull())
    return out.withColumnRenamed("__at", at) if at else out.drop("__at")


def micros(col: Column | str) -> Column:
    """Timestamp (with or without zone) → microseconds since the epoch."""
    col = F.col(col) if isinstance(col, str) else col
    return F.unix_micros(col.cast("timestamp"))


def days(col: Column | str) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.unix_date(col.cast("date")).cast("long")
