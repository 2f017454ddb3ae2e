import re

import numpy as np
import pytest

from attesta.llm import line_labels as ll

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    lines, dup = [x for x in text.split("\n") if WORD.search(x)], 0
    for i, x in enumerate(lines):
        dup += x in lines[:i]
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), n < 10 or 100 * len(covered) > 20 * n


def test_base_columns(spark, table):
    docs = table("documents").filter("length(text) < 6000")
    field = ll.fit(table("documents"), table("labels"), max_docs=100)
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in ll.label_documents(docs, field).collect():
        assert brute(text[r.doc_id]) == (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert not (r.base_failed and r.kept)


def paths(x, field):
    """All labellings and their scores."""
    n = len(x)
    for code in range(2**n):
        y = [code >> i & 1 for i in range(n)]
        s = field.start[y[0]] + sum(x[i] @ field.emit[:, y[i]] for i in range(n)) + sum(field.move[a, b] for a, b in zip(y, y[1:]))
        yield y, s


def test_viterbi_and_gradient_against_all_paths():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5):
        x = rng.normal(size=(n, 11))
        field = ll.Field(rng.normal(size=(11, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
        best = max(paths(x, field), key=lambda p: p[1])
        assert list(ll.viterbi(x, field)) == best[0]
        total = np.logaddexp.reduce([s for _, s in paths(x, field)])
        padded, mask = np.zeros((1, n + 2, 11)), np.zeros((1, n + 2), bool)
        padded[0, :n], mask[0, :n] = x, True
        gold = np.zeros((1, n + 2), int)
        gold[0, :n] = best[0]
        like, g = ll.gradient(padded, gold, mask, field)
        assert like == pytest.approx(best[1] - total)
        step = 1e-5
        for part, grad in ((field.emit, g.emit), (field.move, g.move), (field.start, g.start)):
            k = tuple(rng.integers(0, s) for s in part.shape)
            part[k] += step
            up = ll.gradient(padded, gold, mask, field)[0]
            part[k] -= step
            assert (up - like) / step == pytest.approx(grad[k], abs=1e-3)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    train, test = labels.filter("doc_id % 2 = 0"), labels.filter("doc_id % 2 = 1")
    field = ll.fit(docs, train, max_docs=400)
    got = ll.label_documents(docs, field).join(test, "doc_id").filter("n_words >= 10").collect()
    right = [r.kept == (r.quality == 1) for r in got]
    assert len(got) > 100 and np.mean(right) > 0.95
    clean = [r.kept for r in got if r.quality == 1 and not r.base_failed]
    assert np.mean(clean) > 0.98


def test_awkward_rows(awkward, spark):
    labels = spark.createDataFrame([(4, 1), (None, 0), (9, 0), (5, 2), (5, None)], "doc_id long, quality int")
    field = ll.fit(awkward, labels)
    got = {(r.doc_id, r.n_words): r for r in ll.label_documents(awkward, field).collect()}
    assert got[1, 0].base_failed and got[2, 0].base_failed and got[3, 0].base_failed and not got[1, 0].kept
    assert (None, 7) in got and got[5, 61_500].n_dup_lines == 499
    kept = ll.keep_documents(awkward, field)
    assert kept.columns == awkward.columns and kept.count() == sum(r.kept for r in ll.label_documents(awkward, field).collect())
    assert ll.label_documents(awkward.limit(0), field).count() == 0
    untrained = ll.fit(awkward, labels.limit(0))
    assert all(r.kept != r.base_failed for r in ll.label_documents(awkward, untrained).collect())
