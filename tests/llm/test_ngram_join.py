import random
from collections import defaultdict

import numpy as np
import pytest

from attesta.llm import ngram_join as nj
from attesta.llm.common import folded_words
from attesta.llm.components import components


def brute(rows, threshold=0.8, n=5):
    """class and links by comparing every pair."""
    grams = []
    for doc, text in rows:
        w = folded_words(text)
        grams.append({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    links, parent = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = grams[i], grams[j]
            if a and b and len(a & b) >= threshold * len(a | b) - 1e-9:
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((doc, least.get(find(i)) if grams[i] else doc, links[i]) for i, (doc, _) in enumerate(rows)), key=repr)


def found(df, **kw):
    return sorted((tuple(r) for r in nj.ngram_join(df, **kw).collect()), key=repr)


def variants(seed=3):
    rng, rows = random.Random(seed), []
    for group in range(6):
        base = [f"g{group}w{rng.randrange(400)}" for _ in range(rng.randrange(30, 160))]
        for _ in range(rng.randrange(1, 14)):
            words = list(base)
            for _ in range(rng.randrange(0, 4)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(words)))
        rows.append((len(rows), rows[-1][1]))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [192, 4])
def test_against_all_pairs(documents, block):
    rows = variants()
    assert found(documents(*rows), block=block) == brute(rows)


def test_tables_against_all_pairs(spark, table):
    rows = [(r.doc_id, r.text) for r in table("documents").collect()]
    assert found(table("documents")) == brute(rows)


def test_bands_reach_the_recall():
    bands = nj.choose_bands(0.8, 0.9995)
    assert 1 - (1 - 0.8**5) ** bands >= 0.9995 > 1 - (1 - 0.8**5) ** (bands - 1)


def test_minhash_estimates_jaccard():
    a, b = np.arange(1000, dtype=np.uint64), np.arange(200, 1200, dtype=np.uint64)
    a, b = nj.mix(a), nj.mix(b)
    same = np.mean(nj.band_hashes(a, 2000, 1) == nj.band_hashes(b, 2000, 1))
    assert abs(same - 800 / 1200) < 0.05


def test_overlaps_by_matrix_and_by_pairs():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 500, 200).astype(np.uint64)) for _ in range(30)]
    want = np.array([[len(np.intersect1d(a, b)) if i != j else len(a) for j, b in enumerate(sets)] for i, a in enumerate(sets)])
    assert (nj.overlaps(sets) == want).all()
    small = nj.overlaps(sets[:4])
    assert (small + np.diag(np.diag(want)[:4]) == want[:4, :4]).all()


def test_components_against_union_find(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100 + rng.randrange(80), 100 + rng.randrange(80)) for _ in range(60)] + [(7, 7), (None, 3)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "u long, v long")).collect())
    near = defaultdict(set)
    for u, v in edges:
        if u is not None and u != v:
            near[u].add(v)
            near[v].add(u)
    for node in near:
        seen, todo = {node}, [node]
        while todo:
            for x in near[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        assert got[node] == min(seen)
    assert set(got) == set(near)


def test_awkward_rows(awkward):
    rows = [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]
    assert found(awkward) == brute(rows)
    assert nj.ngram_join(awkward.limit(0)).count() == 0
    kept = nj.one_per_class(awkward, nj.ngram_join(awkward))
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert 6 not in ids and 5 in ids and None in ids and {1, 2, 3, 7, 9, 10} <= set(ids)
    assert kept.columns == awkward.columns
