"""Line dedup by distinct-site spread.

Each line's sites go into a HyperLogLog sketch per line hash; sketches merge by aggregation.  Lines whose estimate is
clearly above the threshold are boilerplate, lines clearly below are not, and the lines between get an exact distinct
count.  Of a boilerplate line the occurrences in the document with the smallest doc_id stay, all others are removed.

Copies of one line on one site are combined before the shuffle, so a line that stands in a third of all rows costs a sketch
per task.  Texts meet the marks once, on the document's key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.llm.common import BLANKS
from attesta.session import scratch

LOG_K = 8  # 256 registers
ERROR = 1.04 / 2 ** (LOG_K / 2)  # relative standard error of the estimate
SIGMAS = 4


KEY, CUT, LINES = "__row_key", "__cut", "__lines"


def has_word(line: Column) -> Column:
    return F.length(F.translate(line, BLANKS, "")) > 0


def line_key(line: Column) -> Column:
    """Two 64-bit hashes; null for a line without a word."""
    return F.when(has_word(line), F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b")))


def row_key() -> Column:
    """Of doc_id and text, so that a row without doc_id has one as well."""
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.md5(F.coalesce("text", F.lit(""))))


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.col("source").alias("site"), "text", row_key().alias("key"))


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _lines(rows: DataFrame, *columns: str) -> DataFrame:
    lines = F.transform(F.split("text", "\n", -1), line_key)
    # the outer form keeps the optimizer from splitting every text a second time to test for emptiness
    out = rows.select(*columns, F.posexplode_outer(lines).alias("at", "line"))
    return out.filter(F.col("line").isNotNull())


def boilerplate(docs: DataFrame, min_sites: int) -> DataFrame:
    """line (hash), first (smallest doc_id): lines on at least ``min_sites`` distinct sites.  A null site is no site."""
    lines = _lines(_rows(docs).filter("text is not null"), "doc_id", "site")
    spread = lines.groupBy("line").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LOG_K))).alias("sites"), F.min("doc_id").alias("first")
    )
    width = SIGMAS * ERROR
    # written, so that adaptive execution can send a small list to all tasks, or split the occurrences of a hot line over tasks
    likely = _stored(spread.filter(F.col("sites") >= F.lit(min_sites * (1 - width))), "line-spread")
    clear = likely.filter(F.col("sites") > F.lit(min_sites * (1 + width))).select("line", "first")
    near = likely.filter(F.col("sites") <= F.lit(min_sites * (1 + width))).select("line", "first")
    exact = (
        lines.select("line", "site").join(near, "line")
        .groupBy("line", "site").agg(F.min("first").alias("first"))
        .groupBy("line").agg(F.count("site").alias("sites"), F.min("first").alias("first"))
        .filter(F.col("sites") >= min_sites)
    )
    return clear.unionByName(exact.select("line", "first"))


def drop_boilerplate(docs: DataFrame, min_sites: int = 10) -> DataFrame:
    """The rows of ``docs`` with their texts cut, plus n_lines (lines with a word) and n_removed.

    Lines are cut at \\n; lines without a word always stay.  A null text stays null with 0 and 0, an empty one empty.  The
    occurrences in the document with the smallest doc_id stay, several in it as well; rows that share that doc_id all keep
    the line.  A row without doc_id never counts as first, unless no row with the line has one: then all keep it.
    Repeated rows are cut alike.  An empty table gives no rows.  Other columns pass through, but columns of the names
    n_lines and n_removed are replaced.
    """
    rows = _rows(docs)
    marks = (
        _lines(rows.filter("text is not null"), "doc_id", "key")
        .join(_stored(boilerplate(docs, min_sites), "boilerplate"), "line")
        .filter(F.col("first").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("first")))
        .groupBy("key").agg(F.collect_set("at").alias("cut"))  # at most the lines of one text
        .select(F.col("key").alias(KEY), F.col("cut").alias(CUT))
    )
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    wide = docs.select(*[F.col(f"`{c}`") for c in names], row_key().alias(KEY)).join(marks, KEY, "left")
    wide = wide.withColumn(LINES, F.split("text", "\n", -1))
    stay = F.array_except(F.sequence(F.lit(0), F.size(LINES) - 1), F.col(CUT))  # by a hash set, in order
    text = F.when(F.col(CUT).isNull(), F.col("text")).otherwise(F.array_join(F.transform(stay, lambda i: F.col(LINES)[i]), "\n"))
    n_lines = F.size(F.filter(LINES, has_word))
    return wide.select(
        *[text.alias(c) if c == "text" else F.col(f"`{c}`") for c in names],
        F.coalesce(F.when(F.col("text").isNotNull(), n_lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size(CUT), F.lit(0)).cast("long").alias("n_removed"),
    )
