import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from attesta.llm import latent_leaks as ll
from attesta.llm.common import folded_words


def table_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=80), st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=80))
def test_common_subsequence(a, b):
    assert ll.common_subsequence(ll.places(a), len(a), b) == table_lcs(a, b)


def test_nystrom_finds_the_leading_directions():
    rng = np.random.default_rng(0)
    ll_features, dims = ll.FEATURES, 8
    c = rng.poisson(0.2, (400, 60)).astype(float)
    idf = rng.uniform(0.5, 3, ll_features)
    test = rng.standard_normal((ll_features, dims + 52))
    full = np.zeros((400, ll_features))
    full[:, :60] = c
    got = ll.nystrom(idf, full.T @ (full @ test), test, dims)
    want = np.linalg.svd(full * idf, full_matrices=False)[1][:dims]
    assert np.allclose(got.values, want, rtol=0.02)


def brute(docs, items, share=0.7):
    """Item leaked if its words are a long subsequence of some stretch of twice its length."""
    out = set()
    for d, text in docs:
        words = folded_words(text)
        for i, item in items:
            n, masks = len(item), ll.places(item)
            for s in range(0, max(1, len(words) - n), 4):
                if ll.common_subsequence(masks, n, words[s : s + n + 16]) >= share * n:
                    out.add((d, i))
                    break
    return out


def test_recall_against_all_stretches(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in ll.leaks(docs, bench, ll.fit(docs)).collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows, [(r.item_id, folded_words(r.text)) for r in bench.collect()])
    assert len(want) >= 20 and len(got & want) >= 0.95 * len(want)
    assert got <= want | {(r.doc_id, r.item_id) for r in ll.leaks(docs, bench, ll.fit(docs)).filter("answer_found").collect()}


def test_altered_items_against_all_windows(spark):
    rng = random.Random(5)
    bench = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()]
    corpus = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = [r.text for r in corpus.orderBy("doc_id").limit(90).collect()]
    other = [w for t in texts[80:] for w in t.split()]
    docs, planted = [], set()
    for d, text in enumerate(texts[:80]):
        item, words = bench[d % len(bench)][1].split(), text.split()
        q = ll.queries_of(0, " ".join(item), None, 8)[0]
        kept = max(len(q.answer), math.ceil(rng.uniform(0.45, 0.7) * len(q.words)))
        lost = set(rng.sample(range(len(item) - len(q.answer)), len(item) - kept))
        docs.append((d, " ".join(words[:40] + [rng.choice(other) if i in lost else w for i, w in enumerate(item)] + words[40:])))
        planted.add((d, bench[d % len(bench)][0]))
    want = set()
    for d, text in docs:
        words = folded_words(text)
        for i, item in bench:
            for q in ll.queries_of(i, item, None, 8):
                n = len(q.words)
                w = min((ll.CHUNK * k for k in ll.SCALES), key=lambda w: abs(math.log(n / w)))
                margin, masks, said = ll.CHUNK + max(0, n - w), ll.places(q.words), ll.places(q.answer)
                for s in range(0, len(words), ll.CHUNK):
                    passage = words[max(0, s - margin) : s + w + margin]
                    share = ll.common_subsequence(masks, n, passage) / n
                    answered = ll.common_subsequence(said, len(q.answer), passage) >= 0.8 * len(q.answer)
                    if share >= 0.7 or share >= 0.45 and answered:
                        want.add((d, i))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = ll.leaks(frame, spark.createDataFrame(bench, "item_id long, text string"), ll.fit(corpus), exact=True)
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    assert got == want and planted <= got


def test_recall_of_the_search_by_band(spark):
    """Against the search of all windows, short and long items, by the share of words kept; the cosine decides."""
    rng = random.Random(6)
    bench = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet").orderBy("item_id").collect()]
    corpus = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = [r.text for r in corpus.filter("length(text) > 400").orderBy("doc_id").limit(500).collect()]
    other = [w for t in texts[400:] for w in t.split()]
    docs, plants = [], {}
    for band, (low, high) in enumerate(((0.45, 0.6), (0.6, 0.7), (0.7, 1.0))):
        for d in range(400):
            item_id, text = bench[d % len(bench)]
            item, words = text.split(), texts[d].split()
            answer = len(ll.queries_of(0, text, None, 8)[0].answer)
            kept = max(answer, math.ceil(rng.uniform(low, high) * len(item)))
            lost = set(rng.sample(range(len(item) - answer), len(item) - kept))
            at = rng.randrange(len(words))
            docs.append((len(docs), " ".join(words[:at] + [rng.choice(other) if i in lost else w for i, w in enumerate(item)] + words[at:])))
            plants[docs[-1][0]] = band, len(item) < 24, item_id
    frame, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
    space = ll.fit(corpus)
    search = lambda **more: {(r.doc_id, r.item_id) for r in ll.leaks(frame, items, space, **more).collect()}
    got, want = search(), search(exact=True)
    assert got <= want and search(min_cosine=0.6) < got and not search(min_cosine=9.0)
    for band in range(3):
        for short in (True, False):
            there = {(d, i) for d, (b, s, i) in plants.items() if (b, s) == (band, short)} & want
            recall = len(there & got) / len(there)
            print(f"band {band} {'short' if short else 'long'} of {len(there)}: {recall:.3f}")
            assert len(there) >= 60 and recall >= 0.9
    assert len(got) >= 0.95 * len(want)


def test_short_items_are_runs_of_words(documents, spark):
    bench = spark.createDataFrame(
        [(1, "Who wrote Middlemarch?", None), (2, "What boils first?", "ether"), (3, "Why?", "because it rained"), (4, "Why?", None), (5, "so it goes", None)],
        "item_id long, text string, answer string",
    )
    filler = "many other words stand here "
    docs = documents(
        (1, filler + "who wrote Middlemarch, they asked"),
        (2, filler + "who never wrote middlemarch"),
        (3, filler + "what boils first? Ether does"),
        (4, filler + "what boils first " + filler * 5 + "ether"),
        (5, filler + "Why? Because it rained."),
        (6, "why " + filler),
        (7, "he ends with so it"),
        (8, "goes on"),
        (9, "so it goes so it goes"),
    )
    found = ll.leaks(docs, bench, ll.fit(docs, 8)).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 1), (3, 2), (5, 3), (9, 5)}
    assert [(r.start_word, r.end_word, r.lcs_share, r.cosine) for r in found if r.doc_id == 9] == [(0, 3, 1.0, 1.0)]


def test_runs_with_equal_codes_are_checked_on_their_words(monkeypatch):
    monkeypatch.setattr(ll, "run_codes", lambda f, n: ll.np.zeros(max(0, len(f) - n + 1), ll.np.uint64))
    text = b"a b c a b d"
    f, begin, end = ll.features(text)
    held = ll.Held([7], ll.np.array([6]), text, f, begin, end)
    runs = ll.Runs([ll.Query(1, (b"a", b"b", b"d"), ()), ll.Query(2, (b"a", b"b", b"x"), ())], 0.8)
    assert [(d, q.item, s) for d, q, s, _ in runs.found(held)] == [(0, 1, 3)]


def test_sums_of_many_tasks_add_up_in_two_levels(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(6, "doc_id")
    whole = ll.fit(docs, 8)
    monkeypatch.setattr(ll, "TASKS_PER_SUM", 2)
    assert np.allclose(ll.fit(docs, 8).values, whole.values, rtol=1e-4)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c", b"d"]), min_size=1, max_size=64), st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=90))
def test_common_subsequence_of_many_passages(a, b):
    ids = {w: k for k, w in enumerate((b"a", b"b", b"c", b"d"))}
    number = np.array([[ids[w] + 1] if w in a else [0] for w in ids], np.uint8)
    where = np.zeros((1, 5), np.uint64)
    for i, w in enumerate(a):
        where[0, ids[w] + 1] |= np.uint64(1 << i)
    text = np.array([ids[w] for w in b] + [3], np.uint16)
    first, long = np.array([0, 0, len(b) // 2]), np.array([len(b), len(b) // 2, len(b) - len(b) // 2])
    got = ll._common(text, first, long, number, np.zeros(3, np.int64), where, np.full(3, len(a)))
    assert got.tolist() == [table_lcs(a, b), table_lcs(a, b[: len(b) // 2]), table_lcs(a, b[len(b) // 2 :])]


@pytest.fixture
def planted(documents, spark):
    rng = random.Random(2)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in "nrst"]
    say = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [say(n) for n in (9, 14, 25, 37, 59, 150)]
    rows = [(d, " ".join(say(rng.randrange(20, 400)))) for d in range(40)]
    cut = lambda k, w: " ".join(say(30) + w + say(30))
    for k, w in enumerate(items):
        rows.append((100 + k, cut(k, w)))
    swapped = [x if i % 3 else rng.choice(vocabulary) for i, x in enumerate(items[3][:-8])] + items[3][-8:]
    rows.append((200, cut(3, swapped)))  # a paraphrase that keeps the answer
    rows.append((201, cut(5, items[5][40:110])))  # part of a long item
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)] + [(90, None), (91, "too short"), (None, "no id " * 9)], "item_id long, text string")
    return documents(*rows), bench


def test_planted_items(planted):
    docs, bench = planted
    got = {(r.doc_id, r.item_id) for r in ll.leaks(docs, bench, ll.fit(docs, 32)).collect()}
    assert {(100 + k, k) for k in range(6)} | {(200, 3), (201, 5)} == got


def test_answer_column(documents, spark):
    words = " ".join(f"question{i}" for i in range(20))
    bench = spark.createDataFrame([(1, words, "forty two"), (2, words, "never said")], "item_id long, text string, answer string")
    docs = documents((1, "some words before it " + " ".join(f"question{i}" if i % 2 else f"other{i}" for i in range(20)) + " forty two"), *[(k, f"filler text number {k} " * 9) for k in range(2, 30)])
    got = {(r.doc_id, r.item_id, r.answer_found) for r in ll.leaks(docs, bench, ll.fit(docs, 16), min_cosine=0.3).collect()}
    assert got == {(1, 1, True)}


def test_awkward_rows(awkward, spark):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight"), (1, "line line line line line line line line")], "item_id long, text string")
    space = ll.fit(awkward, 8)
    got = ll.leaks(awkward, bench, space, min_cosine=0.2)
    ids = {r.doc_id for r in got.collect()}
    assert ids >= {4, None} and not ids & {1, 2, 3, 7}
    assert ll.leaks(awkward, bench.limit(0), space).count() == 0
    assert ll.leaks(awkward.limit(0), bench, ll.fit(awkward.limit(0), 8)).count() == 0
    kept = ll.drop_leaking(awkward, got)
    assert kept.columns == awkward.columns and {r.doc_id for r in kept.select("doc_id").collect()} >= {None, 1, 2, 3}


def test_words_of_a_block_of_text(monkeypatch):
    text = b"  ab c  ab " + b"x" * 100 + b" ab " + bytes("née", "utf-8") + b" " + b"ab " * 60
    whole = ll.features(text)
    assert [text[i:j] for i, j in zip(whole[1], whole[2])] == text.split()
    assert len({f for f, w in zip(whole[0].tolist(), text.split()) if w == b"ab"}) == 1
    monkeypatch.setattr(ll, "SEGMENT", 16)  # words at the cuts and words longer than a segment
    cut = ll.features(text)
    assert all((a == b).all() for a, b in zip(whole, cut))
    assert [len(x) for x in ll.features(b"")] == [0, 0, 0]
