"""Small helpers of the operators: word patterns, Arrow columns and record batches."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# fixed values: the bytes at which words end (the class [\x20\x09-\x0D])
BLANKS = " \t\n\x0b\x0c\r"
#: lower-case ASCII letters stay, ASCII punctuation becomes a blank: the folding that shingles and passages share
_FOLD = bytes(
    32 if b < 48 or 57 < b < 65 or 90 < b < 97 or 122 < b < 128 else b for b in range(256)
)


def folded(text: str) -> bytes:
    """Lower-case words without ASCII punctuation, with blanks (byte 32 and no other) around them."""
    return text.lower().encode("utf-8", "replace").translate(_FOLD)


def folded_words(text: str | None) -> list[bytes]:
    """Lower-case words without ASCII punctuation; a null text has none."""
    return [] if not text else folded(text).split()


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def batch(schema: pa.Schema, columns: Sequence) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of all elements of the runs start, start + 1, ..., one run after the other."""
    lengths = np.asarray(lengths, np.int64)
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return np.zeros(0, np.int64)
    return np.repeat(np.asarray(starts, np.int64) - (ends - lengths), lengths) + np.arange(ends[-1])


def text_bytes(df: DataFrame, column: str) -> int:
    """Bytes of a text column, for the number of buckets only."""
    return df.agg(F.sum(F.octet_length(column))).first()[0] or 0


def own(df: DataFrame, **columns: Column | str) -> DataFrame:
    """Only the named columns under the operator's own names, so that extra columns cannot clash."""
    return df.select(*[(F.col(f"`{c}`") if isinstance(c, str) else c).alias(n) for n, c in columns.items()])


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterable[tuple]:
    """Python rows, one at a time, so that a batch of long texts is not copied whole."""
    for b in batches:
        for i in range(b.num_rows):
            yield tuple(b.column(k)[i].as_py() for k in range(b.num_columns))


WORD_MEMORY = 1_000_000
_KNOWN: dict[bytes, int] = {}


def word_hashes(words: Sequence[bytes]) -> np.ndarray:
    """A 64-bit hash of each word; a worker remembers up to ``WORD_MEMORY`` words."""
    try:
        return np.fromiter(map(_KNOWN.__getitem__, words), np.uint64, len(words))
    except KeyError:
        if len(_KNOWN) > WORD_MEMORY:
            _KNOWN.clear()
        digest = xxhash.xxh64_intdigest
        for w in set(words):
            if w not in _KNOWN:
                _KNOWN[w] = digest(w)
        return np.fromiter(map(_KNOWN.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit numbers one to one."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingles(words: Sequence[bytes], n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` words, in order, repeats included; a shorter text is one run, one without words none."""
    h = word_hashes(words)
    size = len(h)
    if not size:
        return np.zeros(0, np.uint64)
    n = min(n, size)
    weights = mix(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(n * 1000)) | np.uint64(1)
    total = np.zeros(size - n + 1, np.uint64)
    for k in range(n):
        total += h[k : size - n + 1 + k] * weights[k]
    return mix(total)
