"""Benchmark decontamination by latent semantic retrieval.

1. One pass over all documents, cut into passages of ``PASSAGE`` words, counts in how many passages each hashed word stands
   and multiplies the passages' count matrix with a random test matrix and back; the tasks' sums add up by blocks of rows.
2. From these sums the randomised (single-pass, Nyström) eigendecomposition of the TF-IDF Gram matrix gives the right
   singular vectors and values of the passages' TF-IDF matrix; its size is features × dimensions, whatever the corpus.
3. A second pass maps every chunk of ``CHUNK`` words into the latent space; windows of several lengths are sums of chunks, and
   their cosines with the benchmark items are one matrix product per block.  Windows near an item are its candidates.
4. A candidate is a leak if the longest common subsequence of its words and the item's is long enough, or, for a paraphrase,
   if it is shorter but the item's answer (its last words, or its own column) is there as well.  Counts of common words, which
   no subsequence exceeds, settle most candidates.

The cosine decides what is tested: at ``MIN_COSINE`` it passes over about 87 of 100 windows, and some altered items with them.
``exact`` tests every window instead; the tests measure the recall of the search against it.  Items too short for a latent
vector are looked for word by word.

Nothing of the documents reaches the driver; the benchmark is the stated query set and its size is checked.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.llm.common import arrow_schema, batch, folded, folded_words, rows_of

FEATURES, EXTRA, PASSAGE, CHUNK = 8192, 8, 32, 8
SCALES = (2, 4, 8)  # window lengths in chunks
ROW_BLOCK = 256  # rows of the sums that travel together
HOLD_BYTES, SLICE, ITEMS = 1 << 20, 4096, 128
MAX_QUERIES = 200_000
MIN_COSINE = 0.2
TASKS_PER_SUM = 1024  # tasks whose sums are added up first


BLANK, SEGMENT = 32, 1 << 16
BASE = np.uint32(0x9E3779B1)
INVERSE = np.uint32(pow(int(BASE), -1, 1 << 32))


def powers(base: np.uint32, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint32)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint32)


_POWERS = powers(BASE, SEGMENT), powers(INVERSE, SEGMENT)


def features(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature, first byte and end of every word of a folded text: polynomial hashes as differences of running sums."""
    found, begins, ends = [], [], []
    lo = 0
    while lo < len(text):
        hi = len(text)
        if hi - lo > SEGMENT:  # cut at a blank; a longer word is a segment of its own
            hi = text.rfind(b" ", lo, lo + SEGMENT) + 1 or text.find(b" ", lo + SEGMENT) + 1 or len(text)
        part = np.frombuffer(text, np.uint8, hi - lo, lo)
        up, down = _POWERS if len(part) <= SEGMENT else (powers(BASE, len(part)), powers(INVERSE, len(part)))
        solid = np.zeros(len(part) + 2, bool)
        np.not_equal(part, BLANK, out=solid[1:-1])
        edges = np.flatnonzero(solid[1:] != solid[:-1])
        begin, end = edges[::2], edges[1::2]
        total = np.zeros(len(part) + 1, np.uint32)
        np.cumsum(part * up[: len(part)], dtype=np.uint32, out=total[1:])
        h = (total[end] - total[begin]) * down[begin]
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        h = (h ^ (h >> np.uint32(12))) * np.uint32(0x297A2D39)
        found.append(((h >> np.uint32(16)) % FEATURES).astype(np.uint16))
        begins.append(begin + lo)
        ends.append(end + lo)
        lo = hi
    if not found:
        return np.zeros(0, np.uint16), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(begins), np.concatenate(ends)


def test_matrix(dims: int) -> np.ndarray:
    return np.random.default_rng(7).standard_normal((FEATURES, dims + EXTRA)).astype(np.float32)


@dataclass(frozen=True)
class Latent:
    """What a word adds to a passage's latent vector (one more row, of zeros, pads)."""

    words: np.ndarray
    values: np.ndarray

    def vector(self, words: Sequence[bytes]) -> np.ndarray:
        v = self.words[features(b" ".join(words))[0]].sum(0)
        return v / max(float(np.linalg.norm(v)), 1e-12)


@dataclass(frozen=True)
class Held:
    """Texts of some rows, one after the other: folded bytes, and the feature, first byte and end of each word."""

    keys: list
    sizes: np.ndarray
    text: bytes
    features: np.ndarray
    begins: np.ndarray
    ends: np.ndarray

    def words(self, lo: int, hi: int) -> list[bytes]:
        return self.text[self.begins[lo] : self.ends[hi - 1]].split() if hi > lo else []


def _held(batches: Iterable[pa.RecordBatch]) -> Iterator[Held]:
    def done() -> Iterator[Held]:
        text = b" ".join(texts)
        f, begin, end = features(text)
        stops = np.cumsum([len(t) + 1 for t in texts])
        last = np.searchsorted(begin, stops)
        sizes = np.diff(last, prepend=0)
        worded = np.flatnonzero(sizes)
        if len(worded):
            yield Held([keys[i] for i in worded.tolist()], sizes[worded], text, f, begin, end)

    keys, texts, held = [], [], 0
    for key, text in rows_of(batches):
        if text:
            keys.append(key)
            texts.append(folded(text))
            held += len(texts[-1])
        if held >= HOLD_BYTES:
            yield from done()
            keys, texts, held = [], [], 0
    if texts:
        yield from done()


def _add_rows(out: np.ndarray, to: np.ndarray, table: np.ndarray, rows: np.ndarray) -> None:
    """out[to] += table[rows] for a sorted ``to``, in slices that stay in a processor's cache."""
    buffer = np.empty((SLICE, table.shape[1]), table.dtype)
    for lo in range(0, len(rows), SLICE):
        target = to[lo : lo + SLICE]
        part = np.take(table, rows[lo : lo + SLICE], axis=0, out=buffer[: len(target)], mode="clip")
        cuts = np.flatnonzero(np.append(True, target[1:] != target[:-1]))
        out[target[cuts]] += np.add.reduceat(part, cuts, axis=0)


def fit(docs: DataFrame, dims: int = 64) -> Latent:
    """The latent space of all passages of ``docs``.  Null texts have no passages; without any the space is empty."""
    ddl = "block int, passages long, counts binary, sums binary"
    schema, width = arrow_schema(ddl), dims + EXTRA
    test = docs.sparkSession.sparkContext.broadcast(test_matrix(dims))  # fixed size

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        omega, passages = test.value, 0
        counts, sums = np.zeros(FEATURES, np.int64), np.zeros((FEATURES, width), np.float64)
        for held in _held(batches):
            sizes, f = held.sizes, held.features
            per_doc = -(-sizes // PASSAGE)
            first = np.cumsum(per_doc) - per_doc
            begin = np.cumsum(sizes) - sizes
            passage = np.repeat(first, sizes) + (np.arange(len(f)) - np.repeat(begin, sizes)) // PASSAGE
            z = np.zeros((int(per_doc.sum()), width), np.float32)
            _add_rows(z, passage, omega, f)
            order = np.argsort(f, kind="stable")
            f, passage = f[order], passage[order]
            part = np.zeros((FEATURES, width), np.float32)
            _add_rows(part, f, z, passage)
            sums += part
            once = np.append(True, (f[1:] != f[:-1]) | (passage[1:] != passage[:-1]))
            counts += np.bincount(f[once], minlength=FEATURES)
            passages += int(per_doc.sum())
        if passages:
            for b in range(0, FEATURES, ROW_BLOCK):
                part = sums[b : b + ROW_BLOCK].astype(np.float32)
                yield batch(schema, [[b], [passages], [counts[b : b + ROW_BLOCK].tobytes()], [part.tobytes()]])

    def add(table: pa.Table, kind: type) -> pa.Table:
        total = [0, 0, 0]
        for block, passages, counts, sums in rows_of(table.select(["block", "passages", "counts", "sums"]).to_batches()):
            total[0] += passages
            total[1] = total[1] + np.frombuffer(counts, np.int64)
            total[2] = total[2] + np.frombuffer(sums, kind).astype(np.float64)
        return pa.Table.from_batches([batch(schema, [[block], [total[0]], [total[1].tobytes()], [total[2].tobytes()]])])

    def add_parts(table: pa.Table) -> pa.Table:
        return add(table, np.float32)

    def add_sums(table: pa.Table) -> pa.Table:
        return add(table, np.float64)

    parts = docs.select(F.lit(None).cast("long").alias("key"), F.col("`text`").alias("text")).mapInArrow(run, ddl)
    some = F.floor(F.spark_partition_id() / TASKS_PER_SUM)
    sums = parts.withColumn("some", some).groupBy("block", "some").applyInArrow(add_parts, ddl)
    rows = sorted(sums.groupBy("block").applyInArrow(add_sums, ddl).collect(), key=lambda r: r["block"])  # FEATURES / ROW_BLOCK rows
    test.unpersist()
    if not rows:
        return Latent(np.zeros((FEATURES + 1, dims), np.float32), np.zeros(dims))
    counts = np.concatenate([np.frombuffer(r["counts"], np.int64) for r in rows])
    sums = np.concatenate([np.frombuffer(r["sums"], np.float64).reshape(-1, width) for r in rows])
    idf = np.log((1 + rows[0]["passages"]) / (1 + counts)) + 0.1
    return nystrom(idf, sums, test_matrix(dims).astype(np.float64), dims)


def nystrom(idf: np.ndarray, sums: np.ndarray, test: np.ndarray, dims: int) -> Latent:
    """Leading eigenvectors of G = D C'C D from Y = C'C T, where D = diag(idf): G X = D Y for X = D^-1 T."""
    x, y = test / idf[:, None], sums * idf[:, None]
    q, r = np.linalg.qr(x)  # an orthonormal test matrix
    y = np.linalg.solve(r.T, y.T).T
    shift = 1e-10 * float(np.linalg.norm(y)) + 1e-12
    y = y + shift * q
    core = q.T @ y
    value, base = np.linalg.eigh((core + core.T) / 2)
    good = value > 1e-9 * value.max()
    half = y @ (base[:, good] / np.sqrt(value[good]))
    u, s, _ = np.linalg.svd(half, full_matrices=False)
    u, s = u[:, :dims], np.sqrt(np.maximum(s[:dims] ** 2 - shift, 1e-12))
    words = np.zeros((FEATURES + 1, dims), np.float32)
    words[:FEATURES, : u.shape[1]] = idf[:, None] * u / s  # whitened: every direction counts alike
    return Latent(words, s)


def common_subsequence(masks: dict[bytes, int], n: int, words: Iterable[bytes]) -> int:
    """Length of the longest common subsequence, a bit per word of the first sequence (``masks`` has its places)."""
    full = (1 << n) - 1
    v = full
    for w in words:
        m = masks.get(w)
        if m:
            u = v & m
            v = (v + u | v - u) & full
    return n - v.bit_count()


def places(words: Sequence[bytes]) -> dict[bytes, int]:
    out: dict[bytes, int] = {}
    for i, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << i
    return out


def _running(member: np.ndarray, f: np.ndarray) -> np.ndarray:
    """How many words before each chunk an item has, by item; modulo 256, as no passage has that many words."""
    out = np.zeros((len(f) // CHUNK + 1, member.shape[1]), np.uint8)
    for i in range(CHUNK):
        out[1:] += member[f[i::CHUNK]]
    return np.cumsum(out, axis=0, dtype=np.uint8, out=out)


def _common(features_: np.ndarray, first: np.ndarray, long: np.ndarray, number: np.ndarray, item: np.ndarray, where: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``common_subsequence`` of many passages at once, by the words' features: an item's have a number, a number has places."""
    out = np.zeros(len(first), np.int64)
    for lo in range(0, len(first), SLICE):
        order = lo + np.argsort(-long[lo : lo + SLICE], kind="stable")
        at, j, size = first[order], item[order], long[order]
        full = ~np.uint64(0) >> (64 - n[order]).astype(np.uint64)
        v = full.copy()
        for i in range(int(size[0])):
            live = np.searchsorted(-size, -i)  # longer than i
            m = where[j[:live], number[features_[at[:live] + i], j[:live]]]
            u = v[:live] & m
            v[:live] = v[:live] + u | v[:live] - u
        out[order] = n[order] - np.bitwise_count(v & full)
    return out


def _said(has: np.ndarray, features_: np.ndarray, first: np.ndarray, long: np.ndarray, item: np.ndarray) -> np.ndarray:
    """How many words of each passage are among the answer's of its item."""
    out = np.zeros(len(first), np.int64)
    order = np.argsort(-long, kind="stable")
    at, j, size = first[order], item[order], long[order]
    for i in range(int(size[0]) if len(size) else 0):
        live = np.searchsorted(-size, -i)  # longer than i
        out[order[:live]] += has[features_[at[:live] + i], j[:live]]
    return out


@dataclass(frozen=True)
class Query:
    """An item, or a part of a long one."""

    item: int
    words: tuple[bytes, ...]
    answer: tuple[bytes, ...]


def queries_of(item: int, text: str | None, answer: str | None, min_words: int) -> list[Query]:
    words = folded_words(text)
    if len(words) < min_words:
        return []
    longest = CHUNK * SCALES[-1]
    if len(words) <= longest:
        parts = [words]
    else:
        half = longest // 2
        parts = [words[i : i + longest] for i in range(0, len(words) - half, half)]
    said = folded_words(answer)
    return [Query(item, tuple(p), tuple(said or p[-max(4, len(p) // 5) :])) for p in parts]


def run_of(item: int, text: str | None, answer: str | None, min_words: int, min_run: int) -> Query | None:
    """A short item as a run of words; one under ``min_run`` words is sought with its answer behind it."""
    words, said = folded_words(text), folded_words(answer)
    if len(words) >= min_words:
        return None
    if len(words) < min_run:
        words, said = words + said, []
    return Query(item, tuple(words), tuple(said)) if len(words) >= min_run else None


def run_codes(features_: np.ndarray, n: int) -> np.ndarray:
    """A number for every run of ``n`` features."""
    out = np.zeros(max(0, len(features_) - n + 1), np.uint64)
    for i in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + features_[i : i + len(out)] + np.uint64(1)
    return out


class Runs:
    """Exact search of short items in the words of held texts."""

    def __init__(self, wanted: Sequence[Query], answer_share: float):
        self.by_length: dict[int, tuple[np.ndarray, dict[int, list[Query]]]] = {}
        self.answer_share = answer_share
        for n in sorted({len(q.words) for q in wanted}):
            coded: dict[int, list[Query]] = {}
            for q in wanted:
                if len(q.words) == n:
                    coded.setdefault(int(run_codes(features(b" ".join(q.words))[0], n)[0]), []).append(q)
            self.by_length[n] = np.array(sorted(coded), np.uint64), coded

    def found(self, held: Held) -> Iterator[tuple[int, Query, int, bool]]:
        """Text, item, first word and whether an answer is near."""
        begin = np.cumsum(held.sizes) - held.sizes
        for n, (codes, coded) in self.by_length.items():
            code = run_codes(held.features, n)
            at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
            for i in np.flatnonzero(codes[at] == code).tolist():
                d = int(np.searchsorted(begin, i, "right")) - 1
                start, size, first = i - int(begin[d]), int(held.sizes[d]), int(begin[d])
                if start + n > size:  # the run goes on in the next text
                    continue
                words = tuple(held.words(i, i + n))
                for q in coded[int(code[i])]:
                    if q.words != words:
                        continue
                    around = held.words(first + max(0, start - CHUNK), first + min(size, start + n + CHUNK + len(q.answer)))
                    near = common_subsequence(places(q.answer), len(q.answer), around) >= self.answer_share * len(q.answer)
                    if near:
                        yield d, q, start, bool(q.answer)


OUT = "doc_id long, item_id long, start_word long, end_word long, cosine double, lcs long, lcs_share double, answer_found boolean"


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    latent: Latent,
    min_cosine: float = MIN_COSINE,
    min_share: float = 0.7,
    paraphrase_share: float = 0.45,
    answer_share: float = 0.8,
    min_words: int = 8,
    min_run: int = 3,
    exact: bool = False,
) -> DataFrame:
    """One row per row of ``docs`` and item that it leaks, with the best passage: OUT.

    Words are lower-case without ASCII punctuation.  Items need an item_id and text; an ``answer`` column is used where there
    is one.  Items of fewer than ``min_words`` words are looked for word by word, as a run without gaps, with their answer
    near it where the column gives one (cosine and share are 1); items under ``min_run`` words only with their answer right
    behind them, and if that makes fewer than ``min_run`` words or the item is null not at all, as it names no passage.  Items
    of more than 64 words are looked for in overlapping parts, and the best part counts.  Items repeated under one item_id are
    all looked for.  ``exact`` tests every window, whatever its cosine.  Null and empty texts leak nothing; a null doc_id is passed through; repeated rows leak alike; empty
    tables give no rows.  Further columns are ignored.  Of equally good passages the first counts.
    """
    columns = [F.col("`item_id`"), F.col("`text`"), F.col("`answer`") if "answer" in benchmark.columns else F.lit(None).cast("string")]
    items = benchmark.filter("item_id is not null and text is not null").select(*columns).limit(MAX_QUERIES + 1).collect()
    if len(items) > MAX_QUERIES:
        raise ValueError(f"more than {MAX_QUERIES} benchmark items; search them in several calls")
    asked = sorted({q for i, t, a in items for q in queries_of(i, t, a, min_words)}, key=lambda q: (q.item, q.words, q.answer))
    short = {run_of(i, t, a, min_words, min_run) for i, t, a in items} - {None}
    schema = arrow_schema(OUT)
    shared = docs.sparkSession.sparkContext.broadcast((latent, asked, short))  # bounded by FEATURES and MAX_QUERIES

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, wanted, brief = shared.value
        if not wanted and not brief:
            return
        runs = Runs(sorted(brief, key=lambda q: (q.item, q.words, q.answer)), answer_share)
        vectors = np.array([space.vector(q.words) for q in wanted], np.float32).reshape(len(wanted), space.words.shape[1])
        size = np.array([len(q.words) for q in wanted], np.int64)
        near = [np.abs(np.log(size / (CHUNK * s))) for s in SCALES]  # each item at the scale nearest its length
        scale = np.argmin(np.stack(near), 0)
        margin = CHUNK + np.maximum(0, size - CHUNK * np.array(SCALES)[scale])  # words tested on both sides of a window
        around = -(-margin // CHUNK)
        sought: list[list] = [[] for _ in SCALES]  # items of one scale and margin: margin in chunks, items
        for k, m in sorted(set(zip(scale.tolist(), around.tolist()))):
            x = np.flatnonzero((scale == k) & (around == m))
            sought[k] += [(m, x[i : i + ITEMS]) for i in range(0, len(x), ITEMS)]
        masks, said = [places(q.words) for q in wanted], [places(q.answer) for q in wanted]
        forms, answers = [], [features(b" ".join(q.answer))[0] for q in wanted]
        where = np.zeros((len(wanted), CHUNK * SCALES[-1] + 1), np.uint64)  # places of an item's features, a bit per word
        for i, q in enumerate(wanted):
            found, number = np.unique(features(b" ".join(q.words))[0], return_inverse=True)
            forms.append(found)
            np.bitwise_or.at(where[i], number + 1, np.uint64(1) << np.arange(len(number), dtype=np.uint64))
        for held in _held(batches):
            sizes = held.sizes
            chunks = -(-sizes // CHUNK)
            first = np.cumsum(chunks) - chunks
            f = np.full(int(chunks.sum()) * CHUNK, FEATURES, np.int64)  # padded with the row of zeros
            begin = np.cumsum(sizes) - sizes
            f[np.repeat(first * CHUNK - begin, sizes) + np.arange(int(sizes.sum()))] = held.features
            dims = space.words.shape[1]
            v, buffer = np.zeros((len(f) // CHUNK, dims), np.float32), np.empty((SLICE, dims), np.float32)
            for lo in range(0, len(f), SLICE):
                part = np.take(space.words, f[lo : lo + SLICE], axis=0, out=buffer[: len(f[lo : lo + SLICE])], mode="clip")
                v[lo // CHUNK : lo // CHUNK + len(part) // CHUNK] = part.reshape(-1, CHUNK, dims).sum(1)
            left = np.repeat(first + chunks, chunks) - np.arange(len(v))  # chunks of the document from here on
            doc_of, first_of = np.repeat(np.arange(len(sizes)), chunks), first
            best: dict[tuple[int, int], tuple] = {}

            def note(key: tuple[int, int], found: tuple) -> None:
                if key not in best or found < best[key]:
                    best[key] = found

            for d, query, start, answered in runs.found(held):
                n = len(query.words)
                note((d, query.item), (-1.0, start, start + n, 1.0, n, answered))
            done = 1
            for k, span in enumerate(SCALES):
                while done < span:  # windows of twice the length: a window and the one behind it
                    v[:-done] += np.where((left > done)[:-done, None], v[done:], 0)
                    done *= 2
                if not len(sought[k]):
                    continue
                unit = v / np.maximum(np.sqrt(np.einsum("ij,ij->i", v, v)), np.float32(1e-12))[:, None]
                for m, some in sought[k]:
                    number, has = np.zeros((FEATURES + 1, len(some)), np.uint8), np.zeros((FEATURES + 1, len(some)), np.uint8)
                    for j, q in enumerate(some.tolist()):
                        number[forms[q], j] = np.arange(1, len(forms[q]) + 1)
                        has[answers[q], j] = 1
                    n, a = size[some], np.array([len(wanted[q].answer) for q in some.tolist()])
                    least, most = (np.ceil(x * n - 1e-9).astype(np.int64) for x in (paraphrase_share, min_share))
                    told = np.ceil(answer_share * a - 1e-9).astype(np.int64)
                    few, member, asked_for = least.astype(np.uint8), (number > 0).view(np.uint8), vectors[some].T
                    picked = []
                    for lo in range(0, len(v), SLICE):
                        hi = min(lo + SLICE, len(v))
                        here = np.arange(lo, hi)
                        cos = unit[lo:hi] @ asked_for
                        from_ = np.maximum(first_of[doc_of[lo:hi]], here - m)
                        to = np.minimum(here + left[lo:hi], here + span + m)
                        base, top = int(from_[0]), int(to.max())
                        words = _running(member, f[base * CHUNK : top * CHUNK])
                        words = words[to - base] - words[from_ - base]  # at least the common words of passage and item
                        likely = words >= few
                        if not exact:
                            likely &= cos >= min_cosine
                        near_i, near_j = np.divmod(np.flatnonzero(likely), len(some))
                        picked.append((near_i + lo, near_j, cos[near_i, near_j], words[near_i, near_j]))
                    near_i, near_j, cosines, words = (np.concatenate(x) for x in zip(*picked))
                    d, q = doc_of[near_i], some[near_j]
                    s = (near_i - first_of[d]) * CHUNK
                    from_, to = np.maximum(0, s - margin[q]), np.minimum(sizes[d], s + CHUNK * span + margin[q])
                    # too few words of the item for its own sake need its answer
                    open_ = np.flatnonzero(words < most[near_j])
                    answer = _said(has, held.features, begin[d[open_]] + from_[open_], (to - from_)[open_], near_j[open_])
                    likely = np.ones(len(d), bool)
                    likely[open_] = answer >= told[near_j[open_]]
                    d, q, near_j, cosines, from_, to = (x[likely] for x in (d, q, near_j, cosines, from_, to))
                    # no common subsequence is longer than that of the words' features
                    bound = _common(held.features, begin[d] + from_, to - from_, number, near_j, where[some], size[q])
                    likely = np.flatnonzero(bound >= least[near_j])
                    columns_ = (d, q, cosines, from_, to)
                    for d, q, cosine, begin_, end in zip(*[c[likely].tolist() for c in columns_]):
                        query = wanted[q]
                        n, at = len(query.words), int(begin[d])
                        passage = held.words(at + begin_, at + end)
                        lcs = common_subsequence(masks[q], n, passage)
                        share, a = lcs / n, query.answer
                        answered = common_subsequence(said[q], len(a), passage) >= answer_share * len(a)
                        if share >= min_share or share >= paraphrase_share and answered:
                            note((d, query.item), (-share, begin_, end, cosine, lcs, bool(answered)))
            out = [(held.keys[d], item, b, e_, c, lcs, -s, a) for (d, item), (s, b, e_, c, lcs, a) in sorted(best.items())]
            if out:
                yield batch(schema, list(zip(*out)))

    return docs.select(F.col("`doc_id`").alias("doc_id"), F.col("`text`").alias("text")).mapInArrow(run, OUT)


def drop_leaking(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id leaks no item; rows without doc_id stay."""
    gone = found.select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")
