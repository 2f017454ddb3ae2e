"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are words and the beginnings of words.  Which of them tell toxic examples from clean ones is learned from the
labelled sample (a term must stand out in log odds and be several times as common in toxic texts); all other words count
as one common term, so that a long clean text with a chance hit stays near the clean examples.  Weights are (1 + ln tf) * idf,
idf over all documents, vectors have unit length.

The index holds the examples in blocks; each block has its own posting lists, and each term its greatest weight in every
block.  A query adds these maxima to a bound per block, reads blocks from the highest bound down and stops when the k-th
best similarity lies above every bound that is left, so no example is missed.  All examples that tie with the k-th are
counted too.  Each votes with weight 1 / (distance + ``SOFT``); votes become scores through an isotonic curve fitted on
the examples themselves, each left out of its own vote.  The nearest examples and the terms that were found are the evidence.

Bounded, whatever the corpus: ``examples`` labelled rows, ``terms`` terms.  They are broadcast (some MB).  Everything else is
one pass over all documents that keeps a few numbers of each, and one pass over those.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.llm.common import arrow_schema, batch, own, rows_of, shingles
from attesta.session import scratch

EXAMPLES, TERMS, NEIGHBOURS = 8_000, 4_096, 25
STEMS = range(2, 8)  # lengths of the beginnings of words
LONGEST = 40  # letters of a word that is a term as a whole; longer ones have beginnings only
ODDS, TIMES = 3.5, 4.0  # least z of the log odds, least ratio of the shares
SOFT = 0.05
BLOCK = 64
THRESHOLD = 0.7
_WORD = re.compile(r"[^\W\d_]+")
_MEMORY = 400_000


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def terms_of(word: str) -> list[str]:
    """The word itself, if it is not too long, and its beginnings (marked by a dash)."""
    return ([word] if len(word) <= LONGEST else []) + [word[:n] + "-" for n in STEMS if n < len(word)]


def held_out(key: Column) -> Column:
    """Rows whose labels are never learned; a null key is not one of them."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def labelled_sample(docs: DataFrame, labels: DataFrame, examples: int) -> DataFrame:
    """doc_id, text, toxic: about ``examples`` labelled documents that are not held out, by a hash of doc_id.

    A document with several labels is toxic if one of them says so; null labels and unlabelled documents are left out.
    """
    known = own(labels, doc_id="doc_id", toxic="toxic").filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    total = known.count()
    share = min(1.0, examples / max(1, total))
    lot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))
    return own(docs, doc_id="doc_id", text="text").join(F.broadcast(known.filter(lot)), "doc_id")  # bounded by ``examples``


def _sketch(words: Sequence[str]) -> int:
    """Least hash of the runs of three words: near copies mostly agree in it."""
    found = shingles([w.encode("utf-8", "replace") for w in words], 3)
    return int(found.min().astype(np.int64)) if len(found) else 0


def example_words(sample: DataFrame) -> DataFrame:
    """doc_id, toxic, words, counts: of examples that agree in label and sketch (near copies) one is kept."""
    out = "doc_id long, toxic int, sketch long, words array<string>, counts array<int>"
    schema = arrow_schema(out)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for key, text, toxic in rows_of([b]):
                words = words_of(text)
                if words:
                    counts = Counter(words)
                    rows.append((key, toxic, _sketch(words), list(counts), list(counts.values())))
            if rows:
                yield batch(schema, list(zip(*rows)))

    found = sample.select("doc_id", "text", "toxic").mapInArrow(run, out)
    row = F.struct("doc_id", "words", "counts")
    return found.groupBy("toxic", "sketch").agg(F.min_by(row, F.struct(F.xxhash64("doc_id"), "doc_id")).alias("r")).select("r.*", "toxic")


def telling_terms(examples: DataFrame, terms: int) -> list[str]:
    """The terms that stand out most in toxic examples, at most ``terms``, in the order of their names."""
    out = "term string, clean long, toxic long"
    schema = arrow_schema(out)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clean, toxic = Counter(), Counter()

        def flush() -> Iterator[pa.RecordBatch]:
            names = list(clean.keys() | toxic.keys())
            if names:
                yield batch(schema, (names, [clean[n] for n in names], [toxic[n] for n in names]))
            clean.clear()
            toxic.clear()

        for b in batches:
            for words, label in rows_of([b]):
                (toxic if label else clean).update({t for w in words for t in terms_of(w)})
                if len(clean) + len(toxic) > 1_000_000:
                    yield from flush()
        yield from flush()

    totals = {r.toxic: r.n for r in examples.groupBy(F.coalesce((F.col("toxic") != 0).cast("int"), F.lit(0)).alias("toxic")).agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = totals.get(0, 0), totals.get(1, 0)
    counts = examples.select("words", "toxic").mapInArrow(run, out).groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    a, b = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(a / (n1 - F.col("toxic") + 0.5)) - F.log(b / (n0 - F.col("clean") + 0.5))
    z = odds / F.sqrt(1 / a + 1 / b)
    telling = counts.filter((z >= ODDS) & (a * (n0 + 1) >= TIMES * b * (n1 + 1)))
    return sorted(r.term for r in telling.orderBy(z.desc(), "term").limit(terms).select("term").collect())


@dataclass(frozen=True)
class Space:
    """The telling terms and their idf; the number after the last term stands for all other words."""

    terms: dict[str, int]
    idf: np.ndarray

    def numbers(self, word: str) -> list[int]:
        return [self.terms[t] for t in terms_of(word) if t in self.terms]

    def vector(self, ids: Sequence[int], counts: Sequence[int], rest: int) -> tuple[np.ndarray, np.ndarray]:
        """Unit vector: term numbers, ascending, and weights."""
        at = np.array([*ids, *([len(self.terms)] if rest else [])], np.int64)
        tf = np.array([*counts, *([rest] if rest else [])], float)
        w = (1 + np.log(tf)) * np.append(self.idf, 1.0)[at]
        return at, w / np.sqrt((w * w).sum()) if len(w) else w


def count_terms(words: Iterable[tuple[str, int]], known: dict[str, list[int]], find) -> tuple[list[int], list[int], int]:
    """Numbers and counts of the telling terms of a text and the number of its other words."""
    found: Counter = Counter()
    rest = 0
    for word, n in words:
        numbers = known.get(word)
        if numbers is None:
            if len(known) > _MEMORY:
                known.clear()
            numbers = known[word] = find(word)
        if numbers:
            for i in numbers:
                found[i] += n
        else:
            rest += n
    ids = sorted(found)
    return ids, [found[i] for i in ids], rest


class BlockMaxIndex:
    """Unit vectors of examples in blocks with posting lists, and the greatest weight of each term in each block."""

    def __init__(self, vectors: Sequence[tuple[np.ndarray, np.ndarray]], votes: Sequence[tuple[int, int, int]], terms: int):
        """``votes``: number of examples with the vector, how many of them are toxic, the least doc_id among them."""
        def place(i: int) -> tuple:  # like vectors into one block: by the heaviest terms
            at, w = vectors[i]
            return tuple(at[np.argsort(-w, kind="stable")[:3]]), i

        order = sorted(range(len(vectors)), key=place)
        self.votes = np.array([votes[i] for i in order], np.int64).reshape(-1, 3)
        self.blocks = []
        self.most = np.zeros((terms + 1, -(-len(order) // BLOCK)))
        for b, first in enumerate(range(0, len(order), BLOCK)):
            part = [vectors[i] for i in order[first : first + BLOCK]]
            term = np.concatenate([at for at, _ in part])
            weight = np.concatenate([w for _, w in part])
            row = np.repeat(np.arange(len(part)), [len(at) for at, _ in part])
            by = np.argsort(term, kind="stable")
            names, starts = np.unique(term[by], return_index=True)
            self.blocks.append((first, len(part), names, np.append(starts, len(by)), row[by], weight[by]))
            np.maximum.at(self.most[:, b], term, weight)
        self.most *= 1 + 1e-9  # rounding must not lower a bound

    def similar(self, at: np.ndarray, w: np.ndarray, k: int, without: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Places and similarities of the k nearest examples and of all that tie with the k-th, nearest first.

        Places count as many examples as share them; ``without`` leaves out one example at a place.
        """
        bounds = w @ self.most[at]
        places, sims = np.zeros(0, np.int64), np.zeros(0)
        count = self.votes[:, 0]
        kth = -1.0
        for b in np.argsort(-bounds, kind="stable"):
            if bounds[b] < kth or bounds[b] <= 0:
                break
            first, n, names, starts, row, weight = self.blocks[b]
            here = np.searchsorted(names, at)
            hit = here < len(names)
            hit[hit] = names[here[hit]] == at[hit]
            score = np.zeros(n)
            for i, j in zip(here[hit], np.flatnonzero(hit)):
                lo, hi = starts[i], starts[i + 1]
                score[row[lo:hi]] += weight[lo:hi] * w[j]
            near = np.flatnonzero((score > 0) & (score >= kth))
            places, sims = np.concatenate([places, near + first]), np.concatenate([sims, score[near]])
            order = np.lexsort((places, -sims))
            places, sims = places[order], sims[order]
            total = np.cumsum(count[places] - (places == without))
            if len(total) and total[-1] >= k:
                kth = sims[np.searchsorted(total, k)]
                keep = sims >= kth
                places, sims = places[keep], sims[keep]
        return places, sims

    def vote(self, at: np.ndarray, w: np.ndarray, k: int, without: tuple[int, int] | None = None) -> tuple[float | None, list[int]]:
        """Weighted share of toxic examples among the nearest, and the doc_ids of the nearest; None without any.

        ``without`` (place, label) leaves one example out of the vote.
        """
        if not len(at) or not self.blocks:
            return None, []
        places, sims = self.similar(at, w, k, without and without[0])
        n, toxic = (self.votes[places, i].astype(float) for i in (0, 1))
        if without:
            n[places == without[0]] -= 1
            toxic[places == without[0]] -= without[1]
        weight = 1 / (np.sqrt(np.maximum(0.0, 2 - 2 * sims)) + SOFT)
        total = (weight * n).sum()
        return (float((weight * toxic).sum() / total) if total > 0 else None), [int(x) for x in self.votes[places[:3], 2]]


def isotonic(votes: Sequence[float], labels: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """Knots of a rising curve from votes to the share of label 1 (pooled neighbours; each pool has half a case of either label more)."""
    pools: list[list[float]] = []
    order = np.argsort(votes, kind="stable")
    values = np.asarray(votes, float)[order]
    for v, y in zip(values, np.asarray(labels, float)[order]):
        if pools and pools[-1][4] == v:
            pools[-1][0] += 1
            pools[-1][1] += y
            pools[-1][2] += v
        else:
            pools.append([1, y, v, v, v])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            n, s, x, _, hi = pools.pop()
            pools[-1] = [pools[-1][0] + n, pools[-1][1] + s, pools[-1][2] + x, pools[-1][3], hi]
    xs = np.array([p[2] / p[0] for p in pools] or [0.0])
    ys = np.array([(p[1] + 0.5) / (p[0] + 1) for p in pools] or [0.5])
    return xs, np.maximum.accumulate(ys)


OUT = "doc_id long, held_out boolean, score double, predicted int, nearest array<long>, found array<string>"


def score(
    docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, terms: int = TERMS, k: int = NEIGHBOURS, threshold: float = THRESHOLD
) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, nearest (doc_ids of the nearest examples), found (telling terms).

    Null, empty and wordless texts have no vector and get the share of toxic examples as their score, like all texts if there
    are no examples (0.5 without any label).  A null doc_id is scored like any other and is never an example.  Repeated rows
    are scored row by row and alike.  An empty table gives no rows.  Further columns are ignored.
    """
    spark = docs.sparkSession

    def stored(rows: DataFrame, name: str) -> DataFrame:
        path = scratch(spark, f"nearest-{name}")
        rows.write.parquet(path)
        return spark.read.parquet(path)

    sample = stored(example_words(labelled_sample(docs, labels, examples)), "examples")
    names = telling_terms(sample, terms)
    numbers = {t: i for i, t in enumerate(names)}
    space = Space(numbers, np.ones(len(names)))

    counted = "doc_id long, held_out boolean, ids array<int>, counts array<int>, rest long"
    schema = arrow_schema(counted)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[int]] = {}
        for b in batches:
            rows = []
            for key, out, text in rows_of([b]):
                rows.append((key, out, *count_terms(Counter(words_of(text)).items(), known, space.numbers)))
            if rows:
                yield batch(schema, list(zip(*rows)))

    every = stored(own(docs, doc_id=F.col("doc_id").cast("long"), held_out=held_out(F.col("doc_id")), text="text").mapInArrow(count, counted), "counts")
    total = every.count()
    df = {r.i: r.n for r in every.select(F.explode("ids").alias("i")).groupBy("i").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``terms`` rows
    space = Space(numbers, np.array([math.log((1 + total) / (1 + df.get(i, 0))) + 1 for i in range(len(names))]))

    # examples of one and the same vector are one entry of the index; the sample is bounded
    entries: dict[bytes, list] = {}
    known: dict[str, list[int]] = {}
    for r in sample.orderBy("doc_id").toLocalIterator():
        at, w = space.vector(*count_terms(zip(r.words, r.counts), known, space.numbers))
        entry = entries.setdefault(at.tobytes() + w.round(12).tobytes(), [at, w, 0, 0, r.doc_id])
        entry[2] += 1
        entry[3] += bool(r.toxic)
    index = BlockMaxIndex([(e[0], e[1]) for e in entries.values()], [tuple(e[2:]) for e in entries.values()], len(names))
    sent = spark.sparkContext.broadcast((index, space, names))

    # each kind of example, left out of its own vote: (place, label) and how often
    of = {int(first): i for i, first in enumerate(index.votes[:, 2])}
    kinds = []
    for at, w, n, toxic, first in entries.values():
        kinds += [(at.tolist(), w.tolist(), of[first], label, m) for label, m in ((1, toxic), (0, n - toxic)) if m]
    left = "vote double, label int, times int"
    left_schema = arrow_schema(left)

    def leave_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, _, _ = sent.value
        for b in batches:
            rows = [(index.vote(np.array(at, np.int64), np.array(w), k, (place, label))[0], label, times) for at, w, place, label, times in rows_of([b])]
            if rows:
                yield batch(left_schema, list(zip(*rows)))

    kind = "at array<long>, w array<double>, place long, label int, times int"
    votes = spark.createDataFrame(kinds, kind).repartition(spark.sparkContext.defaultParallelism).mapInArrow(leave_out, left).collect() if kinds else []
    pairs = sorted((r.vote, r.label) for r in votes for _ in range(r.times) if r.vote is not None)
    xs, ys = isotonic([v for v, _ in pairs], [y for _, y in pairs])
    n, toxic = int(index.votes[:, 0].sum()), int(index.votes[:, 1].sum())
    prior = toxic / n if n else 0.5
    result = arrow_schema(OUT)

    def rate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, space, names = sent.value
        seen: dict[bytes, tuple] = {}

        def look(ids, counts, rest) -> tuple[float, list[int]]:
            if not ids:
                rest = min(rest, 1)  # one direction, whatever the length
            key = repr((ids, counts, rest))
            if key not in seen:
                if len(seen) > 20_000:
                    seen.clear()
                vote, nearest = index.vote(*space.vector(ids, counts, rest), k)
                seen[key] = (prior if vote is None else float(np.interp(vote, xs, ys)), nearest)
            return seen[key]

        for b in batches:
            rows = []
            for key, out, ids, counts, rest in rows_of([b]):
                value, nearest = look(ids, counts, rest)
                rows.append((key, out, value, int(value >= threshold), nearest, [names[i] for i in ids]))
            if rows:
                yield batch(result, list(zip(*rows)))

    return every.mapInArrow(rate, OUT)
