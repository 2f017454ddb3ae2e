"""Removal of long repeated byte strings by a column-wise Burrows-Wheeler construction over many documents.

A window is a string of ``width`` bytes.  Its anchor is the leftmost of its 16-byte grams with the least hash, so equal
windows have equal anchors wherever they stand; consecutive windows on one anchor form a segment of a document.  That lets
Spark bring together, by anchor, everything that can be equal:

1. documents are dealt into groups; each group sends its anchors, each once, to buckets by hash, and is told which of them
   other groups have as well; anchors that stand in one document only are done;
2. segments on shared anchors are shuffled by anchor, equal ones of a group as one.  In a bucket they are cut into parts, and
   parts that have the same bytes around their anchor are brought together, all but eight bytes of a window; a part alone
   with its bytes is done.  Some of these sets make a collection of short strings that is built column by column: every round puts
   one more symbol in front of each string's suffix, finds where the longer suffixes belong from the ranks in the
   transform so far, and merges them into the transform and its common-prefix array in one sequential pass;
3. runs of common prefixes of ``width`` or more are classes of equal windows; a window goes if its class starts in a document
   with a smaller doc_id;
4. the windows to remove meet their documents again, and bytes are removed.

Rounds number at most ``width`` + 8 whatever the length of the documents.  Copies are combined before each shuffle: of equal
anchors or equal segments of a group only one travels, and of segments that of the smallest doc_id; the others are settled where
they are.  A bucket is about ``bucket_bytes`` of text, so the columns stay in memory and spill is left to Spark's own shuffle files.
A set of parts that is too large for a collection is cut into shorter parts, so collections are bounded; the distinct segments
on one anchor still meet in one task, which holds their text and places.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.llm.common import arrow_schema, batch, mix, rows_of, spans, text_bytes

WIDTH, GRAM = 50, 16
PIECE_BYTES = 1 << 16
PARTS = 4  # buckets of segments for each bucket of anchors
ZONE = 9  # distances of a window's anchor that are looked at together
COLLECTION = 3_000  # strings that are built together: their columns fit a processor's cache
A, B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)  # odd multipliers, any would do


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number; nothing is copied."""
    return np.ndarray((max(0, len(data) - 7),), "<u8", buffer=data, strides=(1,))


def anchors(data: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Segments of one byte string: first window, number of windows, hash of the anchor gram, its place."""
    n = len(data) - width + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    x = _words(data)
    h = mix(x[:-8] * A + x[8:] * B)
    low = h & np.uint64(0xFFFFFFFF00000000) | np.arange(len(h), dtype=np.uint64)
    reach, grams = 1, width - GRAM + 1
    while reach < grams:  # least of a sliding range, by doubling
        step = min(reach, grams - reach)
        low = np.minimum(low[:-step], low[step:])
        reach += step
    at = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    return first, np.diff(np.append(first, n)), h[at[first]], at[first]


def all_anchors(texts: list[bytes], width: int = WIDTH):
    """Segments of many strings: document, first window, windows, hash."""
    return all_grams(texts, width)[:4]


def all_grams(texts: list[bytes], width: int = WIDTH):
    """The same and the place of the anchor gram.  Short texts are hashed together."""
    out: list[tuple[np.ndarray, ...]] = []
    run: list[int] = []

    def done() -> None:
        sizes = np.array([len(texts[i]) for i in run], np.int64)
        ends = np.cumsum(sizes)
        first, count, h, at = anchors(np.frombuffer(b"".join(texts[i] for i in run), np.uint8), width)
        # windows that cross an end are cut off: a segment is split at ends and clipped to the windows inside one text
        doc_lo = np.searchsorted(ends, first, "right")
        doc_hi = np.searchsorted(ends, first + count - 1, "right") if len(first) else doc_lo
        reps = doc_hi - doc_lo + 1
        doc = spans(doc_lo, reps)
        first, last, h, at = (np.repeat(x, reps) for x in (first, first + count - 1, h, at))
        begin = ends - sizes
        if len(doc):
            first, last = np.maximum(first, begin[doc]), np.minimum(last, ends[doc] - width)
            keep = last >= first
            doc, first, last, h, at = doc[keep], first[keep], last[keep], h[keep], at[keep]
            out.append((np.array(run, np.int64)[doc], first - begin[doc], last - first + 1, h, at - begin[doc]))

    held = 0
    for i, t in enumerate(texts):
        if len(t) < width:
            continue
        run.append(i)
        held += len(t)
        if held >= PIECE_BYTES:
            done()
            run, held = [], 0
    if run:
        done()
    if not out:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.int64))
    return tuple(np.concatenate(c) for c in zip(*out))


def transform(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Burrows-Wheeler transform of a collection and its common prefixes (up to 255), in suffix order.

    Symbols are numbered from 1 in byte order, 0 is the end of a string; ends are ordered by string.
    """
    m = len(strings)
    sizes = np.array([len(s) for s in strings], np.int64)
    flat = np.frombuffer(b"".join(strings) + b"\0", np.uint8)
    code = np.zeros(256, np.uint8)
    used = np.unique(flat[:-1])
    code[used] = np.arange(1, len(used) + 1)
    flat, ends = code[flat], np.cumsum(sizes)

    def symbol(who: np.ndarray, back: int) -> np.ndarray:
        """The symbol ``back`` before the end, 0 before the start."""
        return np.where(sizes[who] >= back, flat[np.maximum(ends[who] - back, 0)], 0).astype(np.uint8)

    who = np.arange(m)
    bwt, lcp = symbol(who, 1), np.zeros(m, np.uint8)
    fresh = np.flatnonzero(bwt)  # places of the suffixes that were put in last and go on, and their strings
    who = who[fresh]
    for t in range(1, int(sizes.max(initial=0)) + 1):
        n = len(bwt)
        order = np.argsort(bwt, kind="stable")
        ended = n - int(np.count_nonzero(bwt))
        new = np.zeros(n, bool)
        new[fresh] = True
        rank = np.flatnonzero(new[order])  # in the order of the longer suffixes
        source = order[rank]
        # common prefixes of the longer suffixes with those before and behind them, where the first symbol is the same
        near = np.zeros(n + 1, bool)
        near[rank] = near[rank + 1] = True
        touched = np.flatnonzero(near[:n])
        here, before = order[touched], order[touched - 1]
        value = np.zeros(len(touched), np.uint8)
        k = np.flatnonzero((bwt[here] == bwt[before]) & (touched > ended))
        if len(k):
            lo, hi = before[k] + 1, here[k] + 1
            by = np.argsort(lo, kind="stable")
            pairs = np.stack([lo[by], hi[by]], 1).ravel()
            least = np.minimum.reduceat(np.append(lcp, 0), pairs)[::2]
            value[k[by]] = np.minimum(least, 254) + 1
        string = np.empty(n, np.int64)
        string[fresh] = who
        who = string[source]
        place = m - ended + rank
        old = np.ones(n + len(place), bool)
        old[place] = False
        added = symbol(who, t + 1)
        longer, common = np.empty(len(old), np.uint8), np.empty(len(old), np.uint8)
        longer[old], longer[place], common[old] = bwt, added, lcp
        common[m - ended + touched] = value
        bwt, lcp = longer, common
        fresh, who = place[added != 0], who[added != 0]
    return bwt, lcp


def walk(bwt: np.ndarray, strings: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Strings and the places of their suffixes of length 0, 1, 2, ..., read off the finished transform."""
    order = np.argsort(bwt, kind="stable")
    longer = np.empty(len(bwt), np.int64)  # place of the suffix that is one symbol longer
    longer[order] = np.arange(len(bwt)) + strings - (len(bwt) - np.count_nonzero(bwt))
    who = at = np.arange(strings)
    while len(at):
        yield who, at
        go = bwt[at] != 0
        who, at = who[go], longer[at[go]]


def first_documents(strings: list[bytes], docs: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """For each string's 1st, 2nd, ... window, one string after the other, the smallest document that an equal window
    starts in."""
    bwt, lcp = transform(strings)
    sizes = np.array([len(s) - width + 1 for s in strings], np.int64)
    last = np.cumsum(sizes) - 1
    found = [(who, at) for t, (who, at) in enumerate(walk(bwt, len(strings))) if t >= width]
    doc = np.full(len(bwt), np.iinfo(np.int64).max, np.int64)
    for who, at in found:
        doc[at] = docs[who]
    apart = lcp < width
    least = np.minimum.reduceat(doc, np.flatnonzero(apart))
    group = np.cumsum(apart) - 1
    out = np.empty(int(sizes.sum()), np.int64)
    for t, (who, at) in enumerate(found):
        out[last[who] - t] = least[group[at]]
    return out


ASKED = "bucket int, grp int, a binary"
MOVED = "bucket int, kind int, grp int, a binary, b binary, c binary"
FOUND = "grp int, a binary"
OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _runs(changes: np.ndarray) -> list[tuple[int, int]]:
    return list(zip(changes[:-1].tolist(), changes[1:].tolist()))


def _cuts(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows of sorted columns begin, and the end."""
    n = len(columns[0])
    change = np.zeros(n, bool)
    change[:1] = True
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(change), n)


def distinct(data: bytes, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers strings of eight bytes or more in ``data`` so that equal ones, and no others, have one number: the number of each
    string, and one string of each number."""
    words, ahead = _words(np.frombuffer(data, np.uint8)), range(0, int(size.max(initial=0)), 8)
    h, last = size.astype(np.uint64), begin + size - 8
    for k in ahead:
        h = _hashed(h, words[np.minimum(begin + k, last)])
    _, some, which = np.unique(h, return_index=True, return_inverse=True)
    like = some[which]
    copy = np.flatnonzero(like != np.arange(len(like)))
    like = like[copy]
    if (size[copy] != size[like]).any() or any(
        (words[np.minimum(begin[copy] + k, last[copy])] != words[np.minimum(begin[like] + k, last[like])]).any() for k in ahead
    ):  # different strings with one hash
        number: dict[bytes, int] = {}
        strings = _strings(data, begin, size)
        which = np.fromiter((number.setdefault(x, len(number)) for x in strings), np.int64, len(strings))
        some = np.unique(which, return_index=True)[1]
    return which, some


def _hashed(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    h = (h ^ word) * B
    return h ^ h >> np.uint64(29)


def _strings(data: bytes, begin: np.ndarray, size: np.ndarray) -> list[bytes]:
    return [data[x:y] for x, y in zip(begin.tolist(), (begin + size).tolist())]


def _numbered(docs: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """A number for each row of a group, one for equal (doc_id, tag) and the same each time, and a row of each number."""
    doc, tag = docs.column("doc_id").to_numpy(), docs.column("tag").to_numpy()
    order = np.lexsort((tag, doc))
    cuts = _cuts(doc[order], tag[order])
    number = np.empty(len(doc), np.int64)
    number[order] = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    return number, order[cuts[:-1]]


def _texts(docs: pa.Table) -> tuple[int, np.ndarray, list[bytes]]:
    """Group, and doc_id and text by number; repeated rows are looked at once."""
    rows, text = _numbered(docs)[1], docs.column("text")
    return docs.column("grp")[0].as_py(), docs.column("doc_id").to_numpy()[rows], [text[i].as_py().encode("utf-8", "replace") for i in rows]


def _keys(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and 32 bits of each anchor; its hash is a least one, so its high bits are mostly 0 and are spread anew."""
    return (h % np.uint64(buckets)).astype(np.int64) << 32 | (h * A >> np.uint64(32)).astype(np.int64)


def _send_anchors(buckets: int, width: int):
    """The anchors of a group, each once."""
    schema = arrow_schema(ASKED)

    def run(docs: pa.Table) -> pa.Table:
        group, _, texts = _texts(docs)
        key = np.sort(_keys(all_anchors(texts, width)[3], buckets))
        key = key[_cuts(key)[:-1]]
        low = key.astype("<u4")
        out = [(int(key[lo] >> 32), group, low[lo:hi].tobytes()) for lo, hi in _runs(_cuts(key >> 32))]
        return pa.Table.from_batches([batch(schema, list(zip(*out)) if out else [[]] * len(schema))])

    return run


def _shared_anchors():
    """Of a bucket: the anchors that two groups or more have, for each of them."""
    schema = arrow_schema(ASKED)

    def run(table: pa.Table) -> pa.Table:
        bucket, groups = table.column("bucket")[0].as_py(), table.column("grp").to_pylist()
        low = [np.frombuffer(a, "<u4") for a in table.column("a").to_pylist()]
        row = np.repeat(np.arange(len(low), dtype=np.uint64), [len(x) for x in low])
        pair = np.sort(np.concatenate(low).astype(np.uint64) << np.uint64(32) | row)
        same = np.append(pair[1:] >> np.uint64(32) == pair[:-1] >> np.uint64(32), False)
        pair = pair[same | np.append(False, same[:-1])]
        pair = np.sort(pair << np.uint64(32) | pair >> np.uint64(32))
        row, low = (pair >> np.uint64(32)).astype(np.int64), pair.astype("<u4")
        out = [(bucket, groups[row[lo]], _packed(low[lo:hi].tobytes())) for lo, hi in _runs(_cuts(row))]
        return pa.Table.from_batches([batch(schema, list(zip(*out)) if out else [[]] * len(schema))])

    return run


_ZSTD = zstandard.ZstdCompressor(level=1)


def _packed(data: bytes) -> bytes:
    return _ZSTD.compress(data)


def _answers(group: np.ndarray, number: np.ndarray, first: np.ndarray, windows: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Rows (group, runs of windows of its documents)."""
    order = np.argsort(group, kind="stable")
    values = np.stack([number, first, windows])[:, order].astype("<u4")
    cuts = _cuts(group[order])
    for lo, hi in _runs(cuts):
        yield int(group[order[lo]]), _packed(values[:, lo:hi].tobytes())


def _send_segments(buckets: int, parts: int, width: int):
    """Kind 0: distinct segments on shared anchors with their places in the smallest document of the group; kind 1: windows of
    the other copies, which all go."""
    schema = arrow_schema(MOVED)

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if docs.num_rows:
            group, ids, texts = _texts(docs)
            doc, first, count, h, gram = all_grams(texts, width)
            key = _keys(h, buckets)
            order = np.argsort(key)
            cuts = _cuts(key[order])
            if len(order):
                d = ids[doc[order]]
                shared = np.minimum.reduceat(d, cuts[:-1]) != np.maximum.reduceat(d, cuts[:-1])
                pairs = zip(answers.column("bucket").to_pylist(), answers.column("a").to_pylist())
                told = [np.frombuffer(zstandard.decompress(a), "<u4").astype(np.int64) | b << 32 for b, a in pairs]
                if told:
                    shared[np.searchsorted(key[order[cuts[:-1]]], np.concatenate(told))] = True
                order = order[np.repeat(shared, np.diff(cuts))]
                found = doc[order], first[order], count[order], key[order], gram[order] - first[order]
                out = _segments(group, ids, texts, *found, parts, width)
        return pa.Table.from_batches([batch(schema, list(zip(*out)) if out else [[]] * len(schema))])

    return run


def _segments(group, ids, texts, doc, first, count, key, gram, parts, width) -> list[tuple]:
    lengths, data = np.array([len(t) for t in texts], np.int64), b"".join(texts)
    begin, size = (np.cumsum(lengths) - lengths)[doc] + first, count + width - 1
    which, some = distinct(data, begin, size)
    some = some[by := np.argsort(key[some])]  # strings in the order of their anchors
    number = np.empty(len(some), np.int64)
    number[by] = np.arange(len(some))
    which = number[which]
    least = np.full(len(some), np.iinfo(np.int64).max, np.int64)
    np.minimum.at(least, which, ids[doc])
    other = ids[doc] > least[which]  # after a copy in a smaller document: all of its windows go
    runs = _answers(np.full(int(other.sum()), group), doc[other], first[other], count[other])
    bucket = (key[some] >> 32) * parts + ((key[some] & 0xFFFFFFFF) * parts >> 32)
    out = [(g % parts, 1, g, a, None, None) for g, a in runs]
    place = np.flatnonzero(~other)
    place = place[np.argsort(which[place], kind="stable")]
    strings = _strings(data, begin[some], size[some])
    of = np.stack([size[some], key[some] & 0xFFFFFFFF, gram[some]]).astype("<u4")
    cuts = _cuts(bucket)
    for (lo, hi), (x, y) in zip(_runs(cuts), _runs(np.searchsorted(which[place], cuts))):
        at = place[x:y]
        about = ids[doc[at]].astype("<i8").tobytes() + np.stack([which[at] - lo, doc[at], first[at]]).astype("<u4").tobytes()
        text = b"".join(strings[lo:hi])
        out.append((int(bucket[lo]), 0, group, _packed(text), _packed(of[:, lo:hi].tobytes()), _packed(about)))
    return out


def collections(anchors_of: np.ndarray, among: np.ndarray, strings: int = COLLECTION) -> Iterator[np.ndarray]:
    """Strings by number, in collections of about ``strings``: those of one anchor stay together, and a string that is alone
    on its anchor can share no window with another and is left out."""
    order = among[np.argsort(anchors_of[among], kind="stable")]
    cuts = _cuts(anchors_of[order])
    held: list[np.ndarray] = []
    size = 0
    for lo, hi in _runs(cuts):
        if hi - lo > 1:
            held.append(order[lo:hi])
            size += hi - lo
        if size >= strings:
            yield np.concatenate(held)
            held, size = [], 0
    if held:
        yield np.concatenate(held)


def earliest(
    data: bytes, begin: np.ndarray, size: np.ndarray, key: np.ndarray, gram: np.ndarray, docs: np.ndarray,
    width: int = WIDTH, zone: int = ZONE, most: int = COLLECTION,
) -> np.ndarray:
    """As ``first_documents``, for distinct strings of ``data`` on many anchors: ``key`` numbers a string's anchor, ``gram`` is
    the anchor's place in it.

    Windows that have their anchor ``zone`` x k to ``zone`` x (k + 1) - 1 bytes behind their start have ``width`` - ``zone`` + 1
    bytes around it in common.  A part of a string, its windows of one k, can share a window with another string only if
    that has the same bytes there.  Parts that have a partner by the hash of these bytes are collected; more than
    ``most`` distinct ones on the same bytes are cut once more.  In zones of 1 parts on the same bytes are equal.
    """
    windows, text_begin = size - width + 1, begin
    begin = np.cumsum(windows) - windows
    out = np.repeat(docs, windows)
    low = (gram - windows + 1) // zone
    reps = gram // zone - low + 1
    string, behind = np.repeat(np.arange(len(size)), reps), zone * spans(low, reps)
    core, common = (text_begin + gram)[string] - behind, width - zone + 1
    words = _words(np.frombuffer(data, np.uint8))
    h = mix(key[string].astype(np.uint64) + A * behind.astype(np.uint64))
    for k in dict.fromkeys([*range(0, common - 7, 8), common - 8]):
        h = _hashed(h, words[core + k])
    _, group, many = np.unique(h, return_inverse=True, return_counts=True)
    some = many[group] > 1
    string, behind, group = string[some], behind[some], group[some]
    first = np.maximum(gram[string] - behind - zone + 1, 0)
    number = np.minimum(gram[string] - behind + 1, windows[string]) - first

    which, part = distinct(data, text_begin[string] + first, number + width - 1)
    least = np.full(len(part), np.iinfo(np.int64).max, np.int64)
    np.minimum.at(least, which, docs[string])
    on, of, start = group[part], string[part], text_begin[string[part]] + first[part]
    found, end = np.repeat(least, number[part]), np.cumsum(number[part])
    many = np.bincount(on)[on] if len(on) else on

    def settle(chosen: np.ndarray, values: np.ndarray) -> None:
        found[spans(end[chosen] - number[part[chosen]], number[part[chosen]])] = values

    large = (many > most) & (zone > 1)
    for chosen in collections(on, np.flatnonzero(~large), most):
        settle(chosen, first_documents(_strings(data, start[chosen], number[part[chosen]] + width - 1), least[chosen], width))
    if len(x := np.flatnonzero(large)):
        again = start[x], number[part[x]] + width - 1, on[x], gram[of[x]] - first[part[x]], least[x]
        settle(x, earliest(data, *again, width, zone // 3, most))
    out[spans(begin[string] + first, number)] = found[spans((end - number[part])[which], number)]
    return out


def _after_others(data, begin, size, key, gram, least, width) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs (string, first window, number) of windows that a document before the string's first one has as well."""
    order = np.argsort(key, kind="stable")
    many = np.diff(_cuts(key[order]))
    some = np.sort(order[np.repeat(many, many) > 1])  # the others are alone on their anchors
    first = earliest(data, begin[some], size[some], key[some], gram[some], least[some], width)
    windows = size[some] - width + 1
    end = np.cumsum(windows + 1)
    gone = np.zeros(int((windows + 1).sum()) + 1, np.int8)  # a zero after each string parts the runs
    gone[1:][spans(end - windows - 1, windows)] = first < np.repeat(least[some], windows)
    edge = np.flatnonzero(np.diff(gone)).reshape(-1, 2)
    of = np.searchsorted(end, edge[:, 0], "right")
    return some[of], edge[:, 0] - (end - windows - 1)[of], edge[:, 1] - edge[:, 0]


def _repeated_windows(width: int):
    """Of a bucket: the windows to remove, by group, as runs (document, first, number)."""
    schema = arrow_schema(FOUND)

    def run(table: pa.Table) -> pa.Table:
        out, texts, strings, places, known = [], [], [], [], 0
        for row in table.to_pylist():
            if row["kind"]:
                out.append((row["grp"], row["a"]))
                continue
            texts.append(zstandard.decompress(row["a"]))
            strings.append(np.frombuffer(zstandard.decompress(row["b"]), "<u4").reshape(3, -1).astype(np.int64))
            about = zstandard.decompress(row["c"])
            n = len(about) // 20
            place = np.empty((5, n), np.int64)  # group, doc_id, string, document, first window
            place[0], place[1], place[2:] = row["grp"], np.frombuffer(about, "<i8", n), np.frombuffer(about, "<u4", offset=8 * n).reshape(3, n)
            place[2] += known
            known += strings[-1].shape[1]
            places.append(place)
        if places:
            data, (size, key, gram), place = b"".join(texts), np.concatenate(strings, 1), np.concatenate(places, 1)
            begin = np.cumsum(size) - size
            which, some = distinct(data, begin, size)
            group, doc, string, at, first = place[0], place[1], which[place[2]], place[3], place[4]
            least = np.full(len(some), np.iinfo(np.int64).max, np.int64)
            np.minimum.at(least, string, doc)
            # copies of a string that stands in a smaller document go whole
            whole = doc > least[string]
            gone = [(group[whole], at[whole], first[whole], size[some][string[whole]] - width + 1)]
            rest = np.flatnonzero(~whole)
            rest = rest[np.argsort(string[rest], kind="stable")]
            of, start, number = _after_others(data, begin[some], size[some], key[some], gram[some], least, width)
            lo, hi = np.searchsorted(string[rest], of), np.searchsorted(string[rest], of, "right")
            mine = rest[spans(lo, hi - lo)]
            start, number = np.repeat(start, hi - lo), np.repeat(number, hi - lo)
            gone.append((group[mine], at[mine], first[mine] + start, number))
            out += _answers(*map(np.concatenate, zip(*gone)))
        return pa.Table.from_batches([batch(schema, list(zip(*out)) if out else [[]] * len(schema))])

    return run


def removed_spans(n: int, runs: list[np.ndarray], width: int) -> np.ndarray:
    """Maximal removed runs (begin, end) of a text of ``n`` bytes from runs of removed windows (first, number)."""
    if not runs:
        return np.zeros((0, 2), np.int64)
    run = np.concatenate(runs)
    run = run[np.argsort(run[:, 0], kind="stable")]
    begin, reach = run[:, 0], np.maximum.accumulate(np.minimum(run[:, 0] + run[:, 1] + width - 1, n))
    apart = np.append(True, begin[1:] > reach[:-1])[: len(run)]
    return np.column_stack([begin[apart], reach[np.append(apart[1:], True)[: len(run)]]])


def remove_repeats(docs: DataFrame, width: int = WIDTH, bucket_bytes: int = 12 << 20, with_bytes: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept, the bytes that stay).

    Each byte covered by a ``width``-byte string that also starts in a document with a smaller doc_id is removed; overlaps
    count, and strings are judged on the input.  A null text is empty.  Texts shorter than ``width`` stay whole.  A row
    without doc_id stays whole and removes nothing elsewhere; rows with the same doc_id do not remove from each other, and
    repeated rows get equal results.  An empty table gives no rows.  Further columns are ignored.
    """
    ddl = OUT + (", kept binary" if with_bytes else "")
    schema = arrow_schema(ddl)
    buckets = max(2, -(-text_bytes(docs, "text") // (bucket_bytes * PARTS)))
    body = F.coalesce("text", F.lit(""))
    # doc_id without an alias: then the three readings of the texts below share one exchange
    base = docs.select("doc_id", F.xxhash64(body).alias("tag"), body.alias("text"))
    keyed = base.filter("doc_id is not null").select(
        F.pmod(F.hash("doc_id", "tag"), F.lit(buckets * PARTS)).alias("grp"), "doc_id", "tag", "text"
    )

    def row(doc: int | None, text: str, runs: list[np.ndarray]) -> tuple:
        data = text.encode("utf-8", "replace")
        span = removed_spans(len(data), runs, width)
        edges = [0, *span.ravel().tolist(), len(data)]
        kept = b"".join(data[x:y] for x, y in zip(edges[::2], edges[1::2]))
        out = (doc, len(data), len(data) - len(kept), len(span), hashlib.sha256(kept).hexdigest())
        return (*out, kept) if with_bytes else out

    def cut(texts: pa.Table, answers: pa.Table) -> pa.Table:
        values = [np.frombuffer(zstandard.decompress(a), "<u4").reshape(3, -1) for a in answers.column("a").to_pylist()]
        number = _numbered(texts)[0] if texts.num_rows else np.zeros(0, np.int64)
        of, *runs = np.concatenate([np.zeros((3, 0), "<u4"), *values], 1).astype(np.int64)
        order = np.argsort(of, kind="stable")
        runs = np.column_stack(runs)[order]
        lo, hi = (np.searchsorted(of[order], number, side).tolist() for side in ("left", "right"))
        rows = rows_of(texts.select(["doc_id", "text"]).to_batches())
        out = [row(doc, text, [runs[x:y]] if y > x else []) for (doc, text), x, y in zip(rows, lo, hi)]
        return pa.Table.from_batches([batch(schema, list(zip(*out)) if out else [[]] * len(schema))])

    def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield batch(schema, list(zip(*[row(doc, text, []) for doc, text in rows_of([b])])))

    by_group = keyed.groupBy("grp")
    sent = by_group.applyInArrow(_send_anchors(buckets, width), ASKED)
    shared = sent.groupBy("bucket").applyInArrow(_shared_anchors(), ASKED)
    segments = by_group.cogroup(shared.groupBy("grp")).applyInArrow(_send_segments(buckets, PARTS, width), MOVED)
    gone = segments.groupBy("bucket").applyInArrow(_repeated_windows(width), FOUND)
    kept = by_group.cogroup(gone.groupBy("grp")).applyInArrow(cut, ddl)
    return kept.unionByName(base.filter("doc_id is null").select("doc_id", "text").mapInArrow(whole, ddl))
