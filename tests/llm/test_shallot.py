import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from attesta.llm import shallot as s


def brute(rows, k=16, rounds=3):
    """Plain k-means in Python integers over (vec_id, floats)."""
    kept = [(i, [math.floor(64 * x) for x in e]) for i, e in rows if e is not None and len(e) == 64 and all(x is not None and math.isfinite(x) for x in e)]
    drawn = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    cents = [v for _, v in drawn[:k]]

    def near(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c)), j) for j, c in enumerate(cents))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for j, g in groups.items():
            cents[j] = [sum(c) // len(g) for c in zip(*g)]
    last = [(i, *reversed(near(v))) for i, v in kept]
    per = {}
    for _, j, d in last:
        per[j] = per.get(j, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(((i, j, d, per[j], sum(per.values()), sha[j]) for i, j, d in last), key=repr)


def run(df, **kw):
    return sorted((tuple(r) for r in s.cluster(df, **kw).collect()), key=repr)


def test_table_equals_plain_search(table):
    df = table("embeddings")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert run(df) == brute(rows)


@pytest.mark.parametrize("seed", range(4))
def test_ties_and_few_values_equal_plain_search(spark, seed):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([0.0, 1 / 64, -1 / 64]) if j < 3 else 0.0 for j in range(64)]) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert run(df) == brute(rows)
    assert run(df, rounds=6, k=5) == brute(rows, 5, 6)


def test_awkward_rows(spark):
    ok = [0.25] * 64
    rows = [(1, ok), (1, ok), (1, [0.5] * 64), (2, None), (3, []), (4, ok[:-1]), (5, [None] + ok[1:]), (6, [float("nan")] + ok[1:]),
            (7, [float("inf")] + ok[1:]), (8, [-1e-9] * 64), (None, [0.75] * 64), (9, ok + [0.1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for name in ("v", "near", "e", "cluster", "distance", "upper"):
        df = df.withColumn(name, F.lit("clash"))
    assert run(df) == brute(rows)
    assert run(df, k=1) == brute(rows, 1)
    assert run(df.limit(0)) == []
    assert run(df.filter("vec_id = 8")) == brute([(8, [-1e-9] * 64)])
    wide = spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="beyond"):
        run(wide)


def test_bounds_spare_work_and_stay_true():
    rng = np.random.default_rng(1)
    centres = rng.integers(-60, 60, (16, 64))
    v = (centres[rng.integers(0, 16, 4000)] + rng.integers(-6, 7, (4000, 64))).astype(np.int64)
    c = s.Centroids.of(v[:16])
    state = [np.zeros(4000, np.int32), np.ones(4000, np.int32), np.full(4000, np.inf), np.zeros(4000)]
    works = []
    for _ in range(5):
        *state, exact, work = s.nearest(v, c, *state)
        works.append(work)
        d = ((v[:, None, :] - c.at[None]) ** 2).sum(2)
        assert (state[0] == d.argmin(1)).all()
        rest = np.sqrt(np.where(np.arange(16) == state[0][:, None], np.inf, d).min(1))
        assert (state[2] >= np.sqrt(d.min(1))).all() and (state[3] <= rest).all()
        assert ((exact == -1) | (exact == d.min(1))).all()
        c = s.Centroids.of([v[state[0] == j].sum(0) // max(1, (state[0] == j).sum()) if (state[0] == j).any() else c.at[j] for j in range(16)], c)
    assert works[0] < 16 * 4000 and works[-1] < 0.3 * 16 * 4000  # all distances would be 16 * 4000
