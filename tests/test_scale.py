"""Ordered groups and lookups against plain Python, with one key holding a third of the rows."""

import random

import pytest
from pyspark.sql import functions as F

from attesta import scale
from attesta.scale import OrderedGroups, digits_pos, lookup
from helpers import rows


def skewed(n=300, seed=5):
    rnd = random.Random(seed)
    data = [("hot" if i % 3 == 0 else f"k{rnd.randrange(40)}", rnd.randrange(60), i, rnd.choice(["a", "b", None])) for i in range(n)]
    rnd.shuffle(data)
    return data


def test_ordered_passes_match_python(spark, blocks):
    data = skewed()
    df = spark.createDataFrame(data, "k string, x long, id long, v string")
    g = OrderedGroups(df, ["k"], ["x", "id"], "x")
    g = g.number("no").previous("prev", F.col("v")).following("nxt", F.col("v")).last_seen("last", F.col("v"))
    g = g.next_seen("next", F.col("v")).running_sum("total", F.col("x"))
    got = {r.id: (r.no, r.prev, r.nxt, r["last"], r["next"], r.total) for r in g.rows().collect()}
    assert len(got) == len(data)
    groups = {}
    for row in sorted(data, key=lambda r: (r[1], r[2])):
        groups.setdefault(row[0], []).append(row)
    for group in groups.values():
        seen, total = None, 0
        for i, (_, x, ident, v) in enumerate(group):
            seen, total = v or seen, total + x
            after = next((r[3] for r in group[i:] if r[3]), None)
            prev = group[i - 1][3] if i else None
            nxt = group[i + 1][3] if i + 1 < len(group) else None
            assert got[ident] == (i + 1, prev, nxt, seen, after, total)


def test_result_does_not_depend_on_input_order(spark, blocks):
    data = skewed()
    runs = []
    for seed in (1, 2):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k string, x long, id long, v string").repartition(seed + 2)
        runs.append(rows(OrderedGroups(df, ["k"], ["x", "id"], "x").number("no").rows().select("id", "no")))
    assert runs[0] == runs[1]


def test_rows_sharing_one_position_are_cut_by_the_tie(spark, tiny_blocks):
    df = spark.createDataFrame([("hot", 7, f"event:{i:03d}") for i in range(40)], "k string, d long, key string")
    g = OrderedGroups(df, ["k"], ["d", "key"], "d", digits_pos("key", len("event:")))
    assert g.df.select("__blk").distinct().count() > 5
    assert [r.no for r in g.number("no").rows().orderBy("key").collect()] == list(range(1, 41))


def block_sizes(g):
    return [r["count"] for r in g.df.groupBy("k", "__blk").count().collect()]


@pytest.mark.parametrize("shape", ["even", "clustered", "undated", "null key", "one far away"])
def test_blocks_are_cut_by_rows(spark, shape):
    rnd = random.Random(7)
    key = None if shape == "null key" else "hot"
    place = {
        "even": lambda i: i, "clustered": lambda i: rnd.randrange(50) if i % 10 else 10**6 * i, "null key": lambda i: rnd.randrange(10**9),
        "undated": lambda i: 1 << 40 if i % 2 else rnd.randrange(2000), "one far away": lambda i: -(1 << 50) if i == 0 else rnd.randrange(3000),
    }[shape]
    data = [(key, place(i), i) for i in range(1000)] + [(f"k{i % 50}", i, 2000 + i) for i in range(300)]
    rnd.shuffle(data)
    spark.conf.set(scale.ROWS_PER_BLOCK, "20")
    try:
        g = OrderedGroups(spark.createDataFrame(data, "k string, x long, id long"), ["k"], ["x", "id"], "x", "id")
        sizes = block_sizes(g)
        assert max(sizes) <= 40 and len(sizes) >= 50 + 25
        got = {r.id: r.no for r in g.number("no").rows().collect()}
    finally:
        spark.conf.unset(scale.ROWS_PER_BLOCK)
    groups = {}
    for k, _, i in sorted(data, key=lambda r: (r[1], r[2])):
        groups.setdefault(k, []).append(i)
    assert got == {i: n + 1 for group in groups.values() for n, i in enumerate(group)}


def test_blocks_are_cut_again_until_they_fit(spark, monkeypatch):
    monkeypatch.setattr(scale, "CUTS", 4)
    spark.conf.set(scale.ROWS_PER_BLOCK, "20")
    try:
        g = OrderedGroups(spark.range(1500).selectExpr("1 AS k", "id * id AS x", "id"), ["k"], ["x"], "x")
        assert max(block_sizes(g)) <= 40
        assert g.number("no").rows().filter("no <> id + 1").count() == 0
    finally:
        spark.conf.unset(scale.ROWS_PER_BLOCK)


def test_plan_without_large_groups_has_no_join(spark):
    g = OrderedGroups(spark.createDataFrame(skewed(), "k string, x long, id long, v string"), ["k"], ["x", "id"], "x").number("no")
    assert "Join" not in g.rows()._jdf.queryExecution().optimizedPlan().toString()


def test_digits_pos_follows_text_order(spark):
    keys = ["event:", "event:1", "event:10:p3", "event:1:p5", "event:1-2", "event:2", "event:19:p1", "event:x", "event:007:p2", "event:99999999999999999"]
    df = spark.createDataFrame([(k,) for k in keys], "key string")
    got = [r[0] for r in df.select("key", digits_pos("key", 6).alias("p")).orderBy("key").select("p").collect()]
    assert got == sorted(got) and len(set(got)) >= 8


def test_lookup_equals_join(spark, blocks):
    df = spark.createDataFrame(skewed(), "k string, x long, id long, v string")
    index = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("zz", 4)], "k string, n long")
    for how in ("left", "inner", "left_semi", "left_anti"):
        cols = ["k", "x", "id"] + (["n"] if how in ("left", "inner") else [])
        a = lookup(df, index, ["k"], how).select(*cols)
        b = df.join(index, ["k"], how).select(*cols)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, how


def test_lookup_compares_nulls_inside_a_key_struct(spark, blocks):
    df = spark.createDataFrame([(None, 1), ("a", 2)], "k string, id long").withColumn("key", F.struct("k"))
    index = spark.createDataFrame([(None, 9)], "k string, n long").select(F.struct("k").alias("key"), "n")
    assert rows(lookup(df, index, ["key"]).select("id", "n"), "id") == [(1, 9), (2, None)]
