import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from attesta.llm import tier_packing as tp

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 5000), max_size=60))
def test_each_token_once_and_windows_full(lengths):
    seen, short = defaultdict(list), 0
    for tier, pieces in tp.pack_lengths(lengths):
        assert sum(n for _, _, n in pieces) == tier
        short += tier not in tp.TIERS
        for doc, at, n in pieces:
            seen[doc].append((at, n))
    for doc, size in enumerate(lengths):
        at = 0
        for a, n in sorted(seen[doc]):
            assert a == at and n > 0
            at += n
        assert at == size
    assert short < 8


def test_groups_have_equal_tokens_and_like_cost():
    rng = np.random.default_rng(0)
    windows = tp.pack_lengths(rng.integers(1, 1500, 3000).tolist())
    group = tp.balance(windows, 8192)
    cost, count = defaultdict(int), defaultdict(int)
    for g, (tier, pieces) in zip(group, windows):
        count[tier, g] += 1
        cost[tier, g] += sum(n * n for _, _, n in pieces)
    for tier in tp.TIERS:
        sizes = [n for (t, _), n in count.items() if t == tier]
        assert not sizes or max(sizes) - min(sizes) <= 1 and max(sizes) * tier <= 8192
    full = [c for (t, _), c in cost.items() if t == 1024]
    assert max(full) < 1.1 * min(full)


def test_pieces_hold_the_tokenizer_ids(spark, table):
    docs = table("documents")
    tokenizer, text = Tokenizer.from_file(PATH), {r.doc_id: r.text for r in docs.collect()}
    got, at = tp.pack(docs, PATH, block_tokens=30_000, with_ids=True).collect(), defaultdict(list)
    by_doc = defaultdict(list)
    for r in got:
        assert list(r.ids) and len(r.ids) == r.length and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at[r.sequence_id].append(r)
        by_doc[r.doc_id].append(r)
    for doc, pieces in by_doc.items():
        pieces.sort(key=lambda r: r.start)
        ids = [x for r in pieces for x in r.ids]
        assert ids == tokenizer.encode(text[doc], add_special_tokens=False).ids + [0]
        assert {r.doc_tokens for r in pieces} == {len(ids)}
    padding = total = 0
    for pieces in at.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == np.cumsum([0, *[r.length for r in pieces]])[:-1].tolist()
        size = sum(r.length for r in pieces)
        assert size <= 1024 and len({(r.window, r.step_group) for r in pieces}) == 1
        total += size
        padding += 0 if size & (size - 1) == 0 else 1024 - size
    assert len(by_doc) == len(text) and padding == 0 and total


def test_ids_of_every_character():
    own = tp.Encoder(PATH)
    points = [c for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(points), 4000):
        texts = [f"a{chr(c)} b {chr(c)}{chr(c)}1 {chr(c)}  x" for c in points[i : i + 4000]]
        want = own.tokenizer.encode_batch(texts, add_special_tokens=False)
        assert all(own.encode(t).tolist() == w.ids for t, w in zip(texts, want))


@settings(max_examples=300, deadline=None)
@given(st.text("ab'stre 1\n\té<|>", max_size=30) | st.sampled_from(["a <|endoftext|> b", "", " ", "<|endoftext|>"]))
def test_ids_of_odd_texts(text):
    own = tp.encoder(PATH)
    assert own.encode(text).tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids


def test_awkward_rows(awkward):
    got = tp.pack(awkward, PATH).collect()
    assert [(r.length, r.doc_tokens) for r in got if r.doc_id == 1] == [(1, 1)]
    assert sum(r.length for r in got if r.doc_id == 4) == 2 * next(r.doc_tokens for r in got if r.doc_id == 4)
    assert any(r.doc_id is None for r in got)
    assert tp.pack(awkward.limit(0), PATH).count() == 0
