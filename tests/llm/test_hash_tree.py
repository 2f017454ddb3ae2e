import zlib
from collections import Counter, defaultdict

import pytest

from attesta.llm import hash_tree as h


def test_slots_sizes_and_growth(spark, table):
    root = h.tree(2, 3, 4)
    got = h.assign(table("documents"), root, h.grow(root), rows_per_block=3).collect()
    text = {r.doc_id: r.text for r in table("documents").collect()}
    slots = defaultdict(list)
    for r in got:
        assert r.size == len(text[r.doc_id].encode()) + 8 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode())
        assert r.law == "key" and 0 <= r.shard < 24 and r.grown_shard in (r.shard, 24)
        slots[r.shard].append(r.slot)
    assert len(got) == len(text) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert any(r.grown_shard == 24 for r in got)


def test_weights_draw_their_share_and_confine_moves(spark):
    root = h.tree(2, 2, 2)
    heavy = h.reweigh(root, {5: 3.0})
    keys = spark.range(20_000)
    rows = keys.select(h.shard_of(root, keys.id).alias("a"), h.shard_of(heavy, keys.id).alias("b")).collect()
    share = Counter(r.b for r in rows)
    assert 0.27 < share[5] / len(rows) < 0.33  # 3 of 10
    assert all(0.08 < share[k] / len(rows) < 0.12 for k in range(8) if k != 5)
    # rows come into region 1 (shards 4-7) and, there, into rack 2 (shards 4, 5); nothing else moves
    for r in rows:
        assert r.a == r.b or r.b // 4 == 1
        assert not (r.a // 4 == 1 and r.a != r.b and r.b // 2 != 2)
    empty = h.reweigh(root, {0: 0.0})
    moved = keys.select(h.shard_of(root, keys.id).alias("a"), h.shard_of(empty, keys.id).alias("b")).collect()
    assert all(r.b != 0 for r in moved)
    with pytest.raises(ValueError):
        h.shard_of(h.reweigh(h.tree(1, 1, 1), {0: 0.0}), keys.id)


def test_awkward_rows(awkward):
    root = h.tree(1, 2, 2)
    got = h.assign(awkward, root, h.grow(root)).collect()
    assert len(got) == awkward.count()
    by = Counter((r.shard, r.slot) for r in got)
    assert max(by.values()) == 1
    assert {r.shard for r in got if r.doc_id == 8} == {next(r.shard for r in got if r.doc_id == 8)}
    assert [(r.size, r.text_crc32) for r in got if r.doc_id == 1] == [(8, 0)]
    assert h.assign(awkward.limit(0), root).count() == 0
    assert all(r.grown_shard is None for r in h.assign(awkward, root).collect())


def test_written_shards(awkward, tmp_path, spark):
    h.write_shards(awkward.drop("shard"), h.tree(1, 2, 2), str(tmp_path / "out"), files_per_shard=2)
    assert spark.read.parquet(str(tmp_path / "out")).count() == awkward.count()
