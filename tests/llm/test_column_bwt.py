import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from attesta.llm import column_bwt as cb


def brute(rows, width=50):
    texts = [(doc, (text or "").encode()) for doc, text in rows]
    first = {}
    for doc, data in texts:
        if doc is not None:
            for i in range(len(data) - width + 1):
                s = data[i : i + width]
                first[s] = min(doc, first.get(s, doc))
    out = []
    for doc, data in texts:
        gone = bytearray(len(data))
        if doc is not None:
            for i in range(len(data) - width + 1):
                if first[data[i : i + width]] < doc:
                    gone[i : i + width] = b"\x01" * width
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(df, **kw):
    return sorted((tuple(r) for r in cb.remove_repeats(df, **kw).collect()), key=repr)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.binary(max_size=12).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=12))
def test_transform_against_sorted_suffixes(strings):
    bwt, lcp = cb.transform(strings)
    where = {int(a): (int(k), n) for n, (who, at) in enumerate(cb.walk(bwt, len(strings))) for k, a in zip(who, at)}
    order = sorted((s[i:], k, len(s) - i) for k, s in enumerate(strings) for i in range(len(s) + 1))
    assert [(k, n) for _, k, n in order] == [where[i] for i in range(len(order))]
    symbols = {b: i + 1 for i, b in enumerate(sorted({b for s in strings for b in s}))}
    want = [0 if n == len(strings[k]) else symbols[strings[k][len(strings[k]) - n - 1]] for _, k, n in order]
    assert bwt.tolist() == want
    for i in range(1, len(order)):
        a, b = order[i - 1][0], order[i][0]
        same = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert lcp[i] == same


def test_equal_windows_have_equal_anchors():
    rng = random.Random(1)
    shared = bytes(rng.randrange(97, 100) for _ in range(120))
    texts = [bytes(rng.randrange(97, 123) for _ in range(rng.randrange(0, 90))) + shared + bytes(rng.randrange(97, 123) for _ in range(30)) for _ in range(5)]
    doc, first, count, h = cb.all_anchors(texts)
    anchor = {}
    for d, f, c, k in zip(doc.tolist(), first.tolist(), count.tolist(), h.tolist()):
        assert c <= 50 - cb.GRAM + 1
        for i in range(f, f + c):
            anchor.setdefault(texts[d][i : i + 50], set()).add(k)
    assert all(len(v) == 1 for v in anchor.values())
    assert int(count.sum()) == sum(max(0, len(t) - 49) for t in texts)


def passages(seed=4):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 8)))
    shared = [" ".join(word() for _ in range(rng.randrange(8, 60))) for _ in range(6)]
    rows = []
    for doc in range(60):
        parts = [" ".join(word() for _ in range(rng.randrange(0, 30))) for _ in range(3)]
        for _ in range(rng.randrange(0, 3)):
            s = rng.choice(shared)
            parts.insert(rng.randrange(len(parts)), s[rng.randrange(0, 20) : len(s) - rng.randrange(0, 20)])
        rows.append((doc, " ".join(parts)))
    rows += [(100, rows[3][1]), (101, rows[3][1]), (102, rows[3][1] + "!")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("bucket", [12 << 20, 500])
def test_against_all_windows(documents, bucket, monkeypatch):
    rows = passages()
    assert found(documents(*rows).repartition(5), bucket_bytes=bucket) == brute(rows)


def test_tables_against_all_windows(spark, table):
    docs = table("documents").filter("length(text) < 4000")
    assert found(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_periodic_texts(documents):
    rows = [(1, "ab" * 200), (2, "a" * 300), (3, "a" * 49), (4, "a" * 50), (5, "ba" * 60), (6, "a" * 299 + "b"), (0, "a" * 60)]
    assert found(documents(*rows)) == brute(rows)


def test_awkward_rows(awkward):
    rows = [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]
    short = [(d, t) for d, t in rows if len(t or "") < 9_000]
    got = found(awkward)
    assert [x for x in got if x[1] < 9_000] == brute(short)
    size = len(next(t for d, t in rows if d == 5).encode())
    assert [x[1:4] for x in got if x[0] == 6] == [(size, size, 1)] and [x[2] for x in got if x[0] == 5] == [0]
    assert cb.remove_repeats(awkward.limit(0)).count() == 0


def test_kept_bytes(documents):
    long = "these words are repeated in the second document, every one of them, to the end"
    got = {r.doc_id: bytes(r.kept) for r in cb.remove_repeats(documents((1, long), (2, "new " + long + " and more")), with_bytes=True).collect()}
    assert got == {1: long.encode(), 2: b"new " + b" and more"}


def test_spans():
    runs = [np.array([[0, 1], [60, 2]]), np.array([[30, 1]])]
    assert cb.removed_spans(200, runs, 50).tolist() == [[0, 111]]


def crowded(n, seed=7):
    """Segments of texts that share an anchor and more or fewer bytes around it, one passage of all and some of a few."""
    rng = random.Random(seed)
    word = lambda k: bytes(rng.randrange(97, 123) for _ in range(k))
    passage, common, ends = word(90), word(20), [word(12) for _ in range(5)]
    texts = []
    for _ in range(n):
        texts.append(word(40) + common + word(40))
        texts.append(word(rng.randrange(30)) + passage + word(rng.randrange(30)))
        texts.append(word(30) + rng.choice(ends)[rng.randrange(12) :] + passage[20:60] + rng.choice(ends)[: rng.randrange(12)] + word(30))
    doc, first, count, h, gram = cb.all_grams(texts)
    strings = {}
    for d, f, c, k, g in zip(doc.tolist(), first.tolist(), count.tolist(), h.tolist(), gram.tolist()):
        at = strings.setdefault(texts[d][f : f + c + 49], [k & 0xFFFFFFFF, g - f, rng.randrange(1000)])
        at[2] = min(at[2], rng.randrange(1000))
    key, gram, docs = np.array(list(strings.values()), np.int64).T
    return list(strings), key, gram, docs


def first_of(strings, key, gram, docs, **kw):
    size = np.array([len(s) for s in strings])
    return cb.earliest(b"".join(strings), np.cumsum(size) - size, size, key, gram, docs, **kw).tolist()


@pytest.mark.parametrize("most", [4, 3_000])
def test_collections_are_bounded_and_hold_only_what_may_be_shared(most, monkeypatch):
    strings, key, gram, docs = crowded(150)
    assert np.unique(key, return_counts=True)[1].max() > 100  # strings on one anchor
    least = {}
    for s, d in zip(strings, docs.tolist()):
        for i in range(len(s) - 49):
            least[s[i : i + 50]] = min(d, least.get(s[i : i + 50], d))
    built, build = [], cb.transform
    monkeypatch.setattr(cb, "transform", lambda some: built.append(some) or build(some))
    got = first_of(strings, key, gram, docs, most=most)
    assert got == [least[s[i : i + 50]] for s in strings for i in range(len(s) - 49)]
    assert max(map(len, built)) < 2 * most and max(len(s) for some in built for s in some) <= 58
    built.clear()
    alone = [k for k, s in enumerate(strings) if all(least[s[i : i + 50]] == docs[k] for i in range(len(s) - 49))]
    other = [strings[k] for k in alone], key[alone], gram[alone], docs[alone]
    first_of(*other)
    assert sum(map(len, built)) < len(alone) / 2


def test_equal_hashes_of_different_strings(monkeypatch):
    strings, key, gram, docs = crowded(20)
    want = first_of(strings, key, gram, docs)
    monkeypatch.setattr(cb, "_hashed", lambda h, word: np.zeros_like(h))
    assert first_of(strings, key, gram, docs) == want
    data = b"".join(strings)
    begin, size = np.arange(0, 3_000, 10) % 970, np.full(300, 40)
    which, some = cb.distinct(data, begin, size)
    text = [data[b : b + 40] for b in begin.tolist()]
    assert len(some) == len(set(text)) and [text[some[k]] for k in which.tolist()] == text


def test_passage_of_many_documents(documents):
    rng = random.Random(11)
    word = lambda k: "".join(rng.choice("abcdefgh") for _ in range(k))
    passage = word(120)
    rows = [(doc, word(rng.randrange(60)) + passage[rng.randrange(30) :] + word(rng.randrange(60))) for doc in rng.sample(range(1_000), 200)]
    rows += [(rows[0][0], rows[1][1]), rows[2], (None, rows[3][1])]
    assert found(documents(*rows).repartition(7), bucket_bytes=800) == brute(rows)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(1, 5)), min_size=1, max_size=8))
def test_spans_against_bytes(runs):
    gone = np.zeros(102, np.int8)
    for first, number in runs:
        gone[1 + first : 1 + first + number + 9] = 1
    want = np.flatnonzero(np.diff(gone)).reshape(-1, 2)
    assert cb.removed_spans(100, [np.array([r]) for r in runs], 10).tolist() == want.tolist()
