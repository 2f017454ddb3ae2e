from pyspark.sql import functions as F

from attesta.operators import aggregates as agg
from attesta.operators import sequence as seq
from helpers import rows


def test_attribution_rules(spark, blocks):
    owners = [None, "CHAIR", "A", None, "CHAIR", None, "OTHER", None, "B", None]
    want = [None, None, "A", "A", None, "A", None, None, "B", "B"]
    df = spark.createDataFrame([("c", i, o) for i, o in enumerate(owners)], "conv string, pos long, owner string")
    got = seq.attribute(df, ["conv"], "pos", "owner").orderBy("pos")
    assert [r.attributed for r in got.collect()] == want


def test_longest_block_is_widened_over_allowed_neighbours(spark, blocks):
    said = list("XAABXAGAAAGBAX") + list("AAX")
    df = spark.createDataFrame([("d", i, s) for i, s in enumerate(said)], "doc string, pos long, who string")
    r = seq.runs(df, ["doc"], ["pos"], "pos", "who", "pos")
    got = seq.longest_own_run(r, ["doc"], "who", F.lit("A"), F.col("who").isin("G", "B"))
    assert rows(got) == [("d", 5, 5)]


def test_interleave(spark, blocks):
    df = spark.createDataFrame([("d", i, s) for i, s in enumerate("AABBAB")] + [("e", i, s) for i, s in enumerate("AAB")], "doc string, pos long, who string")
    assert rows(seq.interleave(df, ["doc"], ["pos"], "pos", "who")) == [("d", 2), ("e", 0)]


def test_carry_stays_within_its_table(spark, blocks):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, " "), ("a", 3, None), ("b", 1, ""), ("b", 2, "y")], "t string, pos long, cell string")
    assert rows(seq.carry_blanks(df, ["t"], "pos", "cell").select("t", "pos", F.coalesce("filled", F.lit("-")))) == [
        ("a", 1, "x"), ("a", 2, "x"), ("a", 3, "x"), ("b", 1, "-"), ("b", 2, "y")]


def test_continuations(spark):
    df = spark.sql("SELECT 1 AS doc, array('A', '', 'A', 'A', 'B', 'B') AS n, array('one', ' two.', 'three', ' four.', 'five', ' six') AS t")
    got = seq.merge_continuations(df, ["doc"], F.col("n"), F.col("t"))
    assert rows(got.select("part", "lines", "text")) == [(1, 2, "one two."), (2, 2, "three four."), (3, 2, "five six")]


def test_bullets_and_blocks(spark):
    df = spark.sql("SELECT 1 AS doc, array('intro', '- a', 'b', '- c') AS ls, array('x', '# A', 'p', 'q', '# B') AS hs")
    assert rows(seq.merge_bullets(df, ["doc"], F.col("ls"), "^-").select("part", "text")) == [(1, "- a b"), (2, "- c")]
    got = seq.blocks(df, ["doc"], F.col("hs"), lambda s: s.startswith("#"))
    assert rows(got.select("block", "heading", F.size("body"))) == [(1, "# A", 3), (2, "# B", 1)]


def test_first_copy_is_by_order_not_by_arrival(spark):
    df = spark.createDataFrame([(3, 1, "the very same text"), (1, 9, "the  very same\ntext"), (2, 5, "short"), (4, 6, "short")], "id long, date long, text string")
    got = seq.first_verbatim(df, "id", ["date", "id"], "text")
    assert rows(got) == [(1, False), (2, True), (3, True), (4, True)]


def test_nearest_needs_exactly_one(spark, blocks):
    points = spark.createDataFrame([(1, "d", 100), (2, "d", 200), (3, "d", 300), (4, "d", 400)], "id int, doc string, x long")
    marks = spark.createDataFrame([("d", 95), ("d", 198), ("d", 203), ("d", 320), ("d", 400)], "doc string, x long")
    got = seq.nearest_within(points, marks, ["doc"], "x", 10).fillna(-1)
    assert rows(got.select("id", "mark")) == [(1, 95), (2, -1), (3, -1), (4, 400)]


def test_replacement_counts_from_the_first_listing(spark, blocks):
    meetings = spark.createDataFrame([("c", d) for d in range(1, 9)], "council string, day long")
    lists = spark.createDataFrame([("c", 3, "p"), ("c", 5, "p"), ("c", 1, "q")], "council string, day long, who string")
    got = seq.meetings_since_first_listing(meetings, lists, "council", "day", "who")
    assert rows(got.select("who", "meetings", "listed")) == [("p", 6, 2), ("q", 8, 1)]


def test_newest_and_hidden(spark):
    df = spark.createDataFrame([("k", i) for i in range(25)], "k string, d long")
    got = seq.newest_n(df, ["k"], [F.desc("d")], 20)
    assert got.count() == 20 and got.agg(F.min("d"), F.max("hidden")).first()[:] == (5, 5)


def test_null_is_not_zero(spark):
    df = spark.createDataFrame([("a", False, None), ("b", True, 0), ("c", True, None)], "k string, listed boolean, n long")
    got = {r.k: r.leave for r in agg.null_preserving_sum(df, ["k"], F.col("listed"), F.col("n"), "leave").collect()}
    assert got == {"a": None, "b": 0, "c": 0}


def test_absence_has_its_own_denominator(spark):
    df = spark.createDataFrame([("p", 10, 8, 1, None), ("p", 5, 4, 0, 1)], "k string, meetings long, present long, leave long, absent long")
    r = agg.segments(agg.attendance_totals(df, "k"), ["present", "leave"]).first()
    assert (r.total, r.absent_total, r.absent, r.absent_rate) == (15, 5, 1, 0.2)
    assert [tuple(s) for s in r.segments] == [("present", 12), ("leave", 1), ("unlisted", 2)]


def test_mode_and_median(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y"), ("b", "x"), ("b", "y")], "k string, v string")
    assert {r.k: r.mode for r in agg.mode_or_null(df, ["k"], "v").collect()} == {"a": "x", "b": None}
    days = spark.createDataFrame([("a", f"2024-01-{d:02d}") for d in (1, 2, 20, 28)] + [("a", "2024-06-01")], "k string, d string").withColumn("d", F.to_date("d"))
    got = agg.median_outliers(days, ["k"], "d")
    assert rows(got.filter("outlier").select(F.col("d").cast("string"), F.col("median").cast("string"))) == [("2024-06-01", "2024-01-20")]
    even = agg.median_outliers(days.filter("d < '2024-05-01'"), ["k"], "d").first()
    assert str(even.median) == "2024-01-20"  # sorted[n // 2]


def test_attendance_by_kind_of_leave_and_duty(spark):
    df = spark.sql("""SELECT 'm' AS k, 10L AS meetings, 5L AS present, 3L AS leave, 2L AS duty, 0L AS absent, map('病假', 1L, '事假', 2L) AS leave_types, map('公假', 2L) AS duty_types
        UNION ALL SELECT 'm', 10, 9, 1, 0, NULL, map('病假', 1L, 'unknown', 9L), NULL""")
    r = agg.attendance_totals(df, "k").first()
    assert [tuple(x) for x in r.leave_types] == [("病假", 2), ("事假", 2)] and [tuple(x) for x in r.duty_types] == [("公假", 2)]
    assert (r.duty, r.duty_rate, r.leave_rate, r.absent_total) == (2, 0.1, 0.2, 10)
