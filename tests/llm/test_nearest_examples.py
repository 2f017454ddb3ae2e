import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from attesta.llm import nearest_examples as ne

DATA = "/root/testdata/sf0.1"


def dense(at, w, size):
    out = np.zeros(size)
    out[at] = w
    return out


@pytest.mark.parametrize("seed", range(5))
def test_index_finds_the_nearest_and_all_ties(seed):
    rng = np.random.default_rng(seed)
    terms, vectors = 40, []
    for _ in range(500):
        at = np.sort(rng.choice(terms + 1, rng.integers(1, 6), replace=False))
        w = rng.integers(1, 4, len(at)).astype(float)
        vectors.append((at, w / np.sqrt((w * w).sum())))
    votes = [(int(rng.integers(1, 4)), 0, i) for i in range(500)]
    index = ne.BlockMaxIndex(vectors, votes, terms)
    number = {int(i): p for p, i in enumerate(index.votes[:, 2])}
    for i in range(0, 500, 7):
        at, w = vectors[i]
        k = int(rng.integers(1, 60))
        places, sims = index.similar(at, w, k)
        all_sims = np.zeros(500)
        for j, (a, x) in enumerate(vectors):
            all_sims[number[j]] = dense(a, x, terms + 1) @ dense(at, w, terms + 1)
        assert np.allclose(all_sims[places], sims) and (np.diff(sims) <= 0).all()
        counts = index.votes[:, 0]
        assert counts[places].sum() >= min(k, counts[all_sims > 0].sum())
        left = np.setdiff1d(np.arange(500), places)
        assert (all_sims[left] < sims[-1] + 1e-12).all()  # what is left out is no nearer
        assert counts[places[sims > sims[-1]]].sum() < k  # and no more is read than k and the ties need


def test_curve_rises_and_pools_neighbours():
    xs, ys = ne.isotonic([0.1, 0.1, 0.4, 0.5, 0.9, 0.9], [0, 0, 1, 0, 1, 1])
    assert (np.diff(xs) > 0).all() and (np.diff(ys) >= 0).all() and len(xs) == 3
    assert ne.isotonic([], [])[1].tolist() == [0.5]


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{n}.parquet") for n in ("documents", "labels"))
    return docs, labels, {r.doc_id: r for r in ne.score(docs, labels).collect()}


def test_held_out_accuracy(scored):
    docs, labels, got = scored
    rows = [(got[r.doc_id], r.toxic) for r in labels.collect() if got[r.doc_id].held_out]
    assert all(zlib.crc32(str(g.doc_id).encode()) % 3 == 1 for g, _ in rows)
    toxic, clean = [g for g, y in rows if y], [g for g, y in rows if not y]
    assert sum(g.predicted for g in toxic) >= 0.85 * len(toxic)
    assert sum(g.predicted for g in clean) <= 0.005 * len(clean)
    for lo in (0.0, 0.7):  # a score is a probability
        part = [(g.score, y) for g, y in rows if lo <= g.score < lo + 0.31]
        assert abs(np.mean([s for s, _ in part]) - np.mean([y for _, y in part])) < 0.1
    assert len(got) == docs.count() and all(0 <= g.score <= 1 and g.predicted == (g.score >= 0.7) for g in got.values())
    assert all(g.found for g in got.values() if g.predicted)


def test_held_out_labels_and_other_columns_do_not_matter(scored):
    docs, labels, got = scored
    other = labels.withColumn("toxic", F.when(ne.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    changed = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    assert {r.doc_id: r.score for r in ne.score(changed, other).collect()} == {i: r.score for i, r in got.items()}


def test_awkward_rows(awkward, spark):
    labels = spark.createDataFrame([(1, 0), (4, 1), (4, 0), (5, None), (None, 1), (7, 0), (8, 1), (99, 1)], "doc_id long, toxic int").withColumn("text", F.lit("clash"))
    got = ne.score(awkward.withColumn("toxic", F.lit("clash")), labels).collect()
    assert len(got) == awkward.count() and all(0 <= r.score <= 1 for r in got)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add(r.score)
    assert len(by[1]) == len(by[2]) == 1 and by[1] == by[2] == by[3] and by[5] == by[6] and by[None] == by[4]
    assert {r.score for r in ne.score(awkward, labels.limit(0)).collect()} == {0.5}
    assert ne.score(awkward.limit(0), labels).count() == 0
