"""Hierarchical packing of documents into windows of several lengths.

Every task packs its own documents, a block of them at a time, so nothing is shuffled and no task needs another's result:

1. whole windows of the longest tier are cut off each document, the rest goes to the shortest tier that holds it;
2. tiers are packed from long to short: a window starts with the longest piece of its tier, and its gap is filled with the
   longest pieces of that tier and the shorter ones that fit, at last with the front of a cut piece;
3. so every window is full, but for the last of a block, which is cut into shorter windows, at last of powers of two;
4. windows of a tier are dealt to step groups of equal tokens, balanced by attention cost (the sum of squared lengths).
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from attesta.llm.common import arrow_schema, batch, own, rows_of

TIERS = (1024, 512, 256, 128)
OUT = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "window int, step_group long"
)
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
_LOADED: dict[str, Encoder] = {}


def byte_of_char() -> dict[str, int]:
    """The characters in which a byte-level vocabulary writes bytes: visible ones for themselves, the others from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = (b for b in range(256) if b not in visible)
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Encoder:
    """Token ids of a byte-level tokenizer file, special tokens in a text included.

    The file's own vocabulary and merge order are read by tiktoken, which gives the ids of ``tokenizers`` in a quarter of the
    time; a text with a special token goes through ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        if file["pre_tokenizer"] != BYTE_LEVEL or file.get("normalizer"):
            raise ValueError(f"{path} is not a plain byte-level tokenizer")
        self.special = [t["content"] for t in file["added_tokens"]]
        chars = byte_of_char()
        ranks = {bytes(chars[c] for c in t): i for t, i in file["model"]["vocab"].items() if t not in self.special}
        self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if any(t in text for t in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=())


def encoder(path: str) -> Encoder:
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


class _Shelf:
    """Pieces (length, document, start) in order of length."""

    def __init__(self):
        self.pieces: list[tuple[int, int, int]] = []

    def put(self, piece: tuple[int, int, int]) -> None:
        insort(self.pieces, piece)

    def longest_within(self, gap: int) -> tuple[int, int, int] | None:
        at = bisect_right(self.pieces, (gap + 1,)) - 1
        return self.pieces.pop(at) if at >= 0 else None


def pack_lengths(lengths: Iterable[int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Windows (tier, pieces); a piece is (document index, start, length).  Each token lies in exactly one piece."""
    longest, windows, shelf = tiers[0], [], _Shelf()
    rest = []
    for doc, n in enumerate(lengths):
        whole = n - n % longest
        windows += [(longest, [(doc, at, longest)]) for at in range(0, whole, longest)]
        if n > whole:
            rest.append((n - whole, doc, whole))
    shelf.pieces = sorted(rest)
    for k, tier in enumerate(tiers):
        below = tiers[k + 1] if k + 1 < len(tiers) else 0
        while shelf.pieces and (shelf.pieces[-1][0] > below):
            gap, pieces = tier, []
            while gap and shelf.pieces:
                found = shelf.longest_within(gap)
                if found is None:  # every piece is longer than the gap: cut the shortest
                    n, doc, at = shelf.pieces.pop(0)
                    found = (gap, doc, at)
                    shelf.put((n - gap, doc, at + gap))
                n, doc, at = found
                pieces.append((doc, at, n))
                gap -= n
            windows += [(tier, pieces)] if not gap else _cut_down(pieces, tiers[k:])
    return windows


def _cut_down(pieces: list[tuple[int, int, int]], tiers: tuple[int, ...]) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """The last pieces of a block as full windows of shorter tiers and, below the shortest, of powers of two."""
    out, left = [], list(pieces)
    for tier in (*tiers, *(1 << k for k in reversed(range((tiers[-1] - 1).bit_length())))):
        while sum(n for _, _, n in left) >= tier:
            gap, taken = tier, []
            while gap:
                doc, at, n = left.pop(0)
                taken.append((doc, at, min(n, gap)))
                if n > gap:
                    left.insert(0, (doc, at + gap, n - gap))
                gap -= min(n, gap)
            out.append((tier, taken))
    return out


def balance(windows: list[tuple[int, list[tuple[int, int, int]]]], step_tokens: int) -> list[int]:
    """A step group for each window: windows of one tier, ``step_tokens`` tokens each, dealt to and fro by falling cost."""
    group, first = [0] * len(windows), 0
    for tier in sorted({t for t, _ in windows}, reverse=True):
        own_ = [i for i, (t, _) in enumerate(windows) if t == tier]
        own_.sort(key=lambda i: (-sum(n * n for _, _, n in windows[i][1]), i))
        groups = -(-len(own_) * tier // step_tokens)
        for rank, i in enumerate(own_):
            turn, at = divmod(rank, groups)
            group[i] = first + (at if turn % 2 == 0 else groups - 1 - at)
        first += groups
    return group


def pack(
    docs: DataFrame,
    tokenizer: str,
    tiers: tuple[int, ...] = TIERS,
    end_id: int = 0,
    block_tokens: int = 4_000_000,
    step_tokens: int = 32_768,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, window, step_group (and ids).

    Each document is the ids of its text and then ``end_id``; a null or empty text is that id alone.  A null doc_id is
    passed through, and each of several rows with one doc_id is packed by itself.  An empty table gives no rows.  Further
    columns are ignored.  A block holds ``block_tokens`` tokens and at least one document; ``tokenizer`` is a path that every
    executor can open.  Sequences are numbered by input partition, so the same partitions give the same numbers again.
    """
    ddl = OUT + (", ids array<int>" if with_ids else "")
    schema = arrow_schema(ddl)

    def flush(keys: list, tokens: list[np.ndarray], first: int) -> tuple[pa.RecordBatch, int]:
        windows = pack_lengths([len(t) for t in tokens], tiers)
        groups = balance(windows, step_tokens)
        out: list[tuple] = []
        for k, (tier, pieces) in enumerate(windows):
            offset = 0
            for doc, at, n in pieces:
                ids = tokens[doc][at : at + n]
                crc = zlib.crc32(ids.astype("<u4").tobytes())
                row = (keys[doc], at, n, crc, len(tokens[doc]), first + k, offset, tier, first + groups[k])
                out.append((*row, ids.astype(np.int32)) if with_ids else row)
                offset += n
        return batch(schema, list(zip(*out))), first + len(windows)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, own_encoder = TaskContext.get(), encoder(tokenizer)
        first, keys, tokens, held = (context.partitionId() if context else 0) << 40, [], [], 0
        for key, text in rows_of(batches):
            ids = np.append(own_encoder.encode(text or ""), np.uint32(end_id))
            keys.append(key)
            tokens.append(ids)
            held += len(ids)
            if held >= block_tokens:
                out, first = flush(keys, tokens, first)
                yield out
                keys, tokens, held = [], [], 0
        if keys:
            yield flush(keys, tokens, first)[0]

    return own(docs, doc_id="doc_id", text="text").mapInArrow(run, ddl)
