"""Where the phrases of a list stand in texts of any length.

A list of at most ``AUTOMATON_CHARS`` characters is broadcast, and every text is read once by one automaton, without a
shuffle.  A longer list meets the texts on hashes of grams (``anchors``); each text is then read by an automaton of its own
candidates only, so neither the list nor the texts pass through the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from attesta.functions import text as tx
from attesta.functions.automaton import Automaton, apart, kept

AUTOMATON_CHARS = 300_000  # an automaton of so many states takes some 100 MB

# phrases of at least LONG characters meet documents on minimisers (one gram out of every WINDOW neighbours); shorter
# ones, down to GRAM characters, on every gram of that length; those below on every gram of their own length
GRAM, LONG_GRAM, WINDOW = 8, 16, 9
LONG = LONG_GRAM + WINDOW - 1

_BUILT: dict[str, Automaton] = {}


def _gram_hashes(s: str, size: int) -> np.ndarray:
    codes = np.frombuffer(s.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    if len(codes) < size:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(len(codes) - size + 1, dtype=np.uint64)
    for i in range(size):
        out = out * np.uint64(1_000_003) + codes[i : i + len(out)]
    out ^= out >> np.uint64(29)
    return out * np.uint64(0x9E3779B97F4A7C15)


def _minimisers(s: str) -> list[int]:
    h = _gram_hashes(s, LONG_GRAM)
    if len(h) < WINDOW:
        return []
    low = h[: len(h) - WINDOW + 1].copy()
    for i in range(1, WINDOW):
        np.minimum(low, h[i : i + len(low)], out=low)
    return np.unique(low.view(np.int64)).tolist()


@F.pandas_udf(T.ArrayType(T.LongType()))
def minimisers(s: pd.Series) -> pd.Series:
    """Hashes of the grams that are smallest among their neighbours; equal stretches of text share them."""
    return s.map(lambda v: _minimisers(v or ""))


@F.pandas_udf(T.ArrayType(T.LongType()))
def all_grams(s: pd.Series) -> pd.Series:
    """Hashes of every gram of ``GRAM`` characters."""
    return s.map(lambda v: np.unique(_gram_hashes(v or "", GRAM).view(np.int64)).tolist())


def short_grams(sizes: list[int]):
    """Every distinct gram of the given lengths."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def grams(s: pd.Series) -> pd.Series:
        return s.map(lambda v: list({v[i : i + n] for n in sizes for i in range(len(v) - n + 1)}) if v else [])

    return grams


def _candidates(body: DataFrame, phrases: DataFrame) -> DataFrame:
    """(id, phrase) for which the text may contain the phrase; none that does is missing.

    Each phrase is looked up by its rarest anchor, so boilerplate shared by many phrases does not multiply candidates.
    """
    size = F.length("phrase")
    lengths = phrases.agg(F.sort_array(F.collect_set(F.when(size < GRAM, size))), F.count_if((size >= GRAM) & (size < LONG)), F.count_if(size >= LONG))
    short, middle, long = lengths.first()  # GRAM - 1 lengths at most
    parts = []
    for n, part, anchors in ((long, size >= LONG, minimisers), (middle, (size >= GRAM) & (size < LONG), all_grams)):
        if n:
            keyed = phrases.filter(part).select("phrase", F.explode(anchors("phrase")).alias("a"))
            shared = keyed.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
            rarest = keyed.join(shared, "a").groupBy("phrase").agg(F.min(F.struct("n", "a"))["a"].alias("a"))
            parts.append(body.select("id", F.explode(anchors("text")).alias("a")).join(rarest, "a").select("id", "phrase"))
    if short:
        grams = body.select("id", F.explode(short_grams(short)("text")).alias("phrase"))
        parts.append(grams.join(phrases.filter(size < GRAM), "phrase").select("id", "phrase"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def occurrences(
    docs: DataFrame, doc_id: str, text: str, phrases: Column | str, of: DataFrame, squashed: bool = False, overlapping: bool = True, context: int = 0
) -> DataFrame:
    """(doc_id, phrase, lo, hi, at, upto, around): every place where a phrase of the list stands in a text.

    ``lo`` and ``hi`` are the first and last character in the text (from 0), ``at`` and ``upto`` start and end (exclusive) among
    the characters that count, ``around`` the place with ``context`` characters on both sides.  With ``squashed`` white space and
    marks do not count, in phrases and texts alike.  Without ``overlapping`` a phrase is found again only behind its last place.
    Repeated phrases count once, empty and null ones never; a null text holds nothing.
    """
    phrase = F.col(phrases) if isinstance(phrases, str) else phrases
    wanted = of.select((tx.squash(phrase) if squashed else phrase).alias("phrase")).filter(F.length("phrase") > 0).distinct()
    total = wanted.agg(F.sum(F.length("phrase"))).first()[0] or 0
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).filter(F.col("text").isNotNull())
    kind = docs.schema[doc_id].dataType
    out = T.StructType([T.StructField(doc_id, kind)]).add("phrase", "string").add("lo", "long").add("hi", "long").add("at", "long").add("upto", "long").add("around", "string")
    schema = to_arrow_schema(out)

    def places(auto: Automaton, key, body: str) -> Iterator[tuple]:
        hay, where = kept(body) if squashed else (body, None)
        found = auto.find(hay)
        for at, number in found if overlapping else apart(found, auto.phrases):
            upto = at + len(auto.phrases[number])
            lo, hi = (at, upto - 1) if where is None else (int(where[at]), int(where[upto - 1]))
            yield key, auto.phrases[number], lo, hi, at, upto, body[max(0, lo - context) : hi + 1 + context] if context else None

    def written(hits: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
        waiting = []
        for hit in hits:
            waiting.append(hit)
            if len(waiting) == 20_000:
                yield _record(waiting, schema)
                waiting = []
        if waiting:
            yield _record(waiting, schema)

    if total <= AUTOMATON_CHARS:
        listed = [r.phrase for r in wanted.collect()]  # at most AUTOMATON_CHARS characters
        sent, name = docs.sparkSession.sparkContext.broadcast(listed), uuid.uuid4().hex

        def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if name not in _BUILT:  # a worker keeps the last one
                _BUILT.clear()
                _BUILT[name] = Automaton(sent.value)
            auto = _BUILT[name]
            yield from written(p for b in batches for i in range(b.num_rows) for p in places(auto, b.column(0)[i].as_py(), b.column(1)[i].as_py()))

        return rows.mapInArrow(read, out)

    body = rows.select("id", (tx.squash(F.col("text")) if squashed else F.col("text")).alias("text"))
    chosen = _candidates(body, wanted).groupBy("id").agg(F.collect_set("phrase").alias("phrases"))

    def read_each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def hits() -> Iterator[tuple]:
            for b in batches:
                for i in range(b.num_rows):
                    yield from places(Automaton(b.column(2)[i].as_py()), b.column(0)[i].as_py(), b.column(1)[i].as_py())

        yield from written(hits())

    return rows.join(chosen, "id").select("id", "text", "phrases").mapInArrow(read_each, out)


def _record(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
