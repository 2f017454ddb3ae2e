import pathlib
import re
import time

import pytest
from pyspark.sql import functions as F

from attesta.operators import sequence as seq
from attesta.session import scratch
from attesta.streaming import jobs
from helpers import rows


def feed(spark, path, batches, schema):
    """One file per micro-batch, read in the order of their times."""
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)


def files(path):
    return {str(p): p.stat().st_size for p in pathlib.Path(path).rglob("*") if p.is_file()}


FACTS = "k long, kind string, v string, fetched_at int"


def test_merge_over_several_batches_and_a_replay(spark):
    base = scratch(spark, "merge")
    batches = [[(1, "a:b", "x", 1), (2, None, "y", 1), (None, "b", "n", 1)], [(1, "a:b", "x", 2), (3, "a:b", "n", 2), (2, None, "z", 2)], [(1, "a:b", "q", 3)]]
    feed(spark, f"{base}/in", batches, FACTS)
    sink = jobs.merge_facts(f"{base}/facts", ["kind", "k"], buckets=8)
    jobs.run_available(jobs.read_stream(spark, f"{base}/in", files_per_batch=1), f"{base}/cp", sink=sink)
    stored = lambda: sorted((tuple(r) for r in spark.read.parquet(f"{base}/facts").select("k", "kind", "v", "fetched_at").collect()), key=repr)
    want = sorted([(1, "a:b", "q", 3), (2, None, "z", 2), (3, "a:b", "n", 2), (None, "b", "n", 1)], key=repr)
    assert stored() == want
    wrong = spark.createDataFrame([(1, "a:b", "WRONG", 9)], FACTS)
    sink(wrong, 2)  # batches that were already merged
    sink(wrong, 1)
    assert stored() == want


def test_a_batch_rewrites_its_own_buckets_and_a_torn_overwrite_is_mended(spark):
    base = scratch(spark, "merge")
    sink = jobs.merge_facts(f"{base}/facts", ["kind", "k"], buckets=8)
    sink(spark.createDataFrame([(i, "a", "x", 1) for i in range(200)], FACTS), 0)
    before = files(f"{base}/facts")
    sink(spark.createDataFrame([(7, "a", "new", 2)], FACTS), 1)
    after = files(f"{base}/facts")
    gone = {pathlib.Path(f).parent.name for f in before if f not in after and "bucket=" in f}
    assert len(gone) == 1
    for f in after:  # the old bucket is deleted and the new one not yet moved in
        if gone & set(pathlib.Path(f).parts):
            pathlib.Path(f).unlink()
    sink(spark.createDataFrame([(7, "a", "new", 2)], FACTS), 1)
    got = {r.k: r.v for r in spark.read.parquet(f"{base}/facts").collect()}
    assert got == {i: "new" if i == 7 else "x" for i in range(200)}


def attribution(spark, batches):
    base = scratch(spark, "turns")
    feed(spark, f"{base}/in", batches, "conv string, pos long, label string")
    turns = jobs.read_stream(spark, f"{base}/in", files_per_batch=1)
    with jobs.stateful(spark):
        stream = jobs.running_attribution(turns, ["conv"], "pos", F.col("label"))
        jobs.run_available(stream, f"{base}/cp", path=f"{base}/out")
    whole = spark.createDataFrame([r for b in batches for r in b], "conv string, pos long, owner string")
    streamed = jobs.latest(spark.read.parquet(f"{base}/out"), ["conv"], "pos")
    shape = lambda df: sorted((tuple(r) for r in df.select("conv", "pos", "owner", "attributed").collect()), key=repr)
    return base, shape(streamed), shape(seq.attribute(whole, ["conv"], "pos", "owner"))


OWNERS = [None, "CHAIR", "A", None, "CHAIR", None, "OTHER", None, "B", None]


@pytest.mark.parametrize("order", [[0, 1, 2, 3], [2, 0, 3, 1]])
def test_attribution_continues_across_batches_in_any_order(spark, order):
    parts = [[(c, j, OWNERS[j]) for c in ("c1", "c2", None) for j in range(i, min(i + 3, 10))] for i in range(0, 10, 3)]
    _, streamed, batch = attribution(spark, [parts[i] for i in order])
    assert streamed == batch and len(batch) == 30


def test_state_written_follows_the_batch(spark):
    large = [(f"c{i}", j, OWNERS[j]) for i in range(400) for j in range(10)]
    base, streamed, batch = attribution(spark, [large, [("c1", 10, None)], [("c2", 10, "B")]])
    assert streamed == batch
    written = files(f"{base}/cp/state")
    size = {n: sum(s for f, s in written.items() if re.search(rf"/{n}(_[^/]*)?\.(changelog|zip)$", f)) for n in (1, 2, 3)}
    assert size[1] > 5 * size[2] > 0 and size[3] > 0


def test_repeats_across_batches_are_dropped(spark):
    base = scratch(spark, "dedupe")
    for i in range(3):
        spark.createDataFrame([(1, "2024-01-01 10:00:00"), (10 + i, "2024-01-01 11:00:00")], "id long, ts string").withColumn(
            "ts", F.to_timestamp("ts")).coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = jobs.read_stream(spark, f"{base}/in", files_per_batch=1)
    jobs.run_available(jobs.first_seen(stream, ["id"], "ts", "1 day"), f"{base}/cp", path=f"{base}/out")
    assert rows(spark.read.parquet(f"{base}/out").select("id")) == [(1,), (10,), (11,), (12,)]
