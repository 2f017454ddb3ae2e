"""Quality rules: a linear-chain conditional random field labels lines, and the share of content decides.

Each line with a word is a position of the chain; its state is content or boilerplate.  The field is trained on a bounded
sample of labelled documents (``max_docs``, a parameter) by gradient ascent on the exact log-likelihood (forward-backward),
and Viterbi decoding labels the lines of every document.  A document is kept if it passes the base rules and at least
``min_share`` of its words stand in content lines.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from attesta.llm.common import BLANKS, arrow_schema, batch, own, rows_of

SYMBOLS = "#*$%&|<>"  # fixed value
BOILERPLATE, CONTENT = 0, 1
_ENDS = (".", "!", "?", '"', ":", ";")
_BREAK = re.compile(f"[{BLANKS}]+")
OUT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_lines long, n_content_lines long, content_share double"
)


@dataclass(frozen=True)
class Field:
    """Emission weights (features × 2) and transition scores (2 × 2) of the chain; start scores (2)."""

    emit: np.ndarray
    move: np.ndarray
    start: np.ndarray


def lines_of(text: str) -> list[str]:
    """The \\n-split lines that hold a word."""
    return [x for x in text.split("\n") if x.strip(BLANKS)]


def repeat_words(words: list[bytes]) -> int:
    """Words covered by 5-word windows that occur twice or more, the first occurrence included."""
    if len(words) < 6:
        return 0
    windows = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
    if len(set(windows)) == len(windows):
        return 0
    seen, covered, upto = Counter(windows), 0, 0
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered += i + 5 - max(i, upto)
            upto = i + 5
    return covered


def features(lines: list[str]) -> np.ndarray:
    """One row per line: what a line looks like, alone and against the lines before it."""
    out, seen = np.zeros((len(lines), 11), np.float32), set()
    for i, line in enumerate(lines):
        words = _BREAK.split(line.strip(BLANKS))
        n, chars = len(words), len(line)
        upper, lower = sum(w.isupper() and len(w) > 1 for w in words), line.lower()
        symbols = sum(map(line.count, SYMBOLS))
        out[i] = (
            1.0,
            min(math.log1p(n), 5) / 5,
            min(sum(map(len, words)) / n, 20) / 10,
            symbols / chars,
            symbols > n * 0.3,
            upper / n,
            1 - len(set(words)) / n,
            line in seen,
            lower.rstrip(BLANKS).endswith(_ENDS),
            (line.count("!") + line.count("?")) / n,
            "http" in lower or "@" in lower,
        )
        seen.add(line)
    return out


def viterbi(x: np.ndarray, field: Field) -> np.ndarray:
    """Most likely states of one document's lines; equal scores prefer content."""
    if not len(x):
        return np.zeros(0, np.int8)
    score = x.astype(np.float64) @ field.emit
    (m00, m01), (m10, m11) = field.move.tolist()
    rows = score.tolist()
    a, b, back = rows[0][0] + field.start[0], rows[0][1] + field.start[1], []
    for e0, e1 in rows[1:]:
        s0, s1 = (1, b + m10) if b + m10 >= a + m00 else (0, a + m00), (1, b + m11) if b + m11 >= a + m01 else (0, a + m01)
        back.append((s0[0], s1[0]))
        a, b = s0[1] + e0, s1[1] + e1
    state, path = int(b >= a), []
    for s in reversed(back):
        path.append(state)
        state = s[state]
    path.append(state)
    return np.array(path[::-1], np.int8)


def _logsum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def gradient(x: np.ndarray, y: np.ndarray, mask: np.ndarray, field: Field) -> tuple[float, Field]:
    """Log-likelihood of padded sequences (docs × lines × features) and its gradient, by forward-backward."""
    score, n, t = x @ field.emit, *y.shape
    ahead, behind = np.zeros((n, t, 2)), np.zeros((n, t, 2))
    ahead[:, 0] = score[:, 0] + field.start
    for i in range(1, t):
        step = _logsum(ahead[:, i - 1, :, None] + field.move, 1) + score[:, i]
        ahead[:, i] = np.where(mask[:, i, None], step, ahead[:, i - 1])
    for i in range(t - 2, -1, -1):
        step = _logsum(field.move + (score[:, i + 1] + behind[:, i + 1])[:, None, :], 2)
        behind[:, i] = np.where(mask[:, i + 1, None], step, 0)
    total = _logsum(ahead[:, -1], 1)
    one = np.exp(ahead + behind - total[:, None, None]) * mask[:, :, None]
    gold = np.eye(2)[y] * mask[:, :, None]
    pair = np.exp(
        ahead[:, :-1, :, None] + field.move + (score + behind)[:, 1:, None, :] - total[:, None, None, None]
    ) * mask[:, 1:, None, None]
    gold_pair = gold[:, :-1, :, None] * gold[:, 1:, None, :]
    like = (gold * score).sum() + (gold_pair * field.move).sum() + (gold[:, 0] * field.start).sum() - total.sum()
    return float(like), Field(
        np.einsum("ntf,nts->fs", x, gold - one), (gold_pair - pair).sum((0, 1)), (gold[:, 0] - one[:, 0]).sum(0)
    )


def train(docs: list[tuple[np.ndarray, np.ndarray]], rounds: int = 40, rate: float = 0.1, l2: float = 1e-3) -> Field:
    """Adam on the log-likelihood; documents of like length share a padded batch.  No documents give a field that keeps all."""
    docs = sorted((d for d in docs if len(d[0])), key=lambda d: len(d[0]))
    if not docs:
        return Field(np.zeros((11, 2)), np.zeros((2, 2)), np.zeros(2))
    batches = []
    for i in range(0, len(docs), 64):
        part = docs[i : i + 64]
        t = max(len(d[0]) for d in part)
        x, y, mask = np.zeros((len(part), t, 11)), np.zeros((len(part), t), int), np.zeros((len(part), t), bool)
        for k, (a, b) in enumerate(part):
            x[k, : len(a)], y[k, : len(b)], mask[k, : len(a)] = a, b, True
        batches.append((x, y, mask))
    parts = [np.zeros((11, 2)), np.zeros((2, 2)), np.zeros(2)]
    first, second, step = [p.copy() for p in parts], [p.copy() for p in parts], 0
    for _ in range(rounds):
        for x, y, mask in batches:
            step += 1
            _, g = gradient(x, y, mask, Field(*parts))
            for k, d in enumerate((g.emit, g.move, g.start)):
                d = d / len(x) - l2 * parts[k]
                first[k] = 0.9 * first[k] + 0.1 * d
                second[k] = 0.999 * second[k] + 0.001 * d * d
                parts[k] = parts[k] + rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Field(*parts)


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = 2_000, max_lines: int = 200) -> Field:
    """Train on at most ``max_docs`` labelled documents, chosen by a hash of doc_id, so that they keep the labels' shares.

    At first a line of a document of quality 1 is content, one of quality 0 boilerplate.  Documents of quality 0 hold ordinary
    lines too, so a second round takes the lines that the first field calls content in them as content, where most of their
    lines stay boilerplate.
    Of a longer document the first ``max_lines`` lines train the field (decoding always reads whole texts).  Only the
    features of the sample reach the driver.
    """
    known = own(labels, key="doc_id", quality="quality").filter("key is not null and quality in (0, 1)").groupBy("key").agg(
        F.max("quality").alias("quality")
    )
    texts = own(docs, key="doc_id", text="text").filter("text is not null")
    chosen = texts.select("key").distinct().join(known, "key").orderBy(F.xxhash64("key"), "key").limit(max_docs)
    chosen = F.broadcast(chosen)  # at most max_docs rows
    ddl = "key long, quality int, x binary"
    schema = arrow_schema(ddl)

    def lines_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, text, quality in rows_of(batches):
            lines = lines_of(text)[:max_lines]
            yield batch(schema, [[key], [quality], [features(lines).tobytes()]])

    got = texts.join(chosen, "key").select("key", "text", "quality").mapInArrow(lines_out, ddl)
    rows = sorted(got.collect(), key=lambda r: r["key"])
    sample = []
    for r in rows:
        x = np.frombuffer(r["x"], np.float32).reshape(-1, 11).astype(float)
        sample.append((x, np.full(len(x), r["quality"], int)))
    first = train(sample)
    for k, (r, (x, y)) in enumerate(zip(rows, sample)):
        if r["quality"] == 0 and len(y):
            told = viterbi(x, first).astype(int)
            if 2 * told.sum() < len(told):
                sample[k] = (x, told)
    return train(sample)


def judge(text: str | None, field: Field, min_share: float = 0.5) -> tuple:
    """The columns after doc_id for one text."""
    text = text or ""
    words = text.encode("utf-8", "replace").split()
    n = len(words)
    lines = lines_of(text)
    repeated = repeat_words(words)
    failed = n < 10 or 100 * repeated > 20 * n
    states = viterbi(features(lines), field)
    sizes = np.array([len(x.encode("utf-8", "replace").split()) for x in lines], np.int64)
    share = float(sizes[states == CONTENT].sum() / n) if n else 0.0
    return (
        n,
        len(text) - sum(map(text.count, BLANKS)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated,
        failed,
        bool(not failed and share >= min_share),
        len(lines),
        int((states == CONTENT).sum()),
        share,
    )


def label_documents(docs: DataFrame, field: Field, min_share: float = 0.5) -> DataFrame:
    """One row per input row: counts over the whole text, the base rule, the decoded share and the verdict.

    A null or empty text has no words and fails the base rule.  A null doc_id is passed through; repeated rows are judged
    one by one, alike.  An empty table gives no rows.  Further columns of ``docs`` are ignored.
    """
    schema = arrow_schema(OUT)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [(i, *judge(t, field, min_share)) for i, t in rows_of([b])]
            if out:
                yield batch(schema, list(zip(*out)))

    return own(docs, doc_id="doc_id", text="text").mapInArrow(run, OUT)


def keep_documents(docs: DataFrame, field: Field, min_share: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that pass, all columns kept; judged where they are, without a shuffle."""
    schema = to_arrow_schema(docs.schema)
    at_text = docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [judge(b.column(at_text)[i].as_py(), field, min_share)[6] for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays(b.columns, schema=schema).filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
