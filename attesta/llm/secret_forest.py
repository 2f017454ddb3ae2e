"""Secret scans: a random forest takes false positives out of the candidates.

A candidate is a run of token characters with a digit in it, a value assigned to a name like ``password`` (``dbPassword`` too),
a token with a well-known prefix, dots included, what follows ``Bearer``, the password of a URL, or the header of a private key.
Its features are its length, the character transitions in it (log-probabilities under a model counted over all documents), how much of it a
dictionary covers, its path, and its neighbouring words.  Spark's random forest is trained on labelled findings, a bounded
sample (``max_findings``, a parameter), and scores every candidate.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.llm.common import arrow_schema, batch, rows_of
from attesta.session import scratch

# fixed values: names that hold secrets, well-known token prefixes, marks of placeholders and of sample paths
NAMES = r"passw(?:or)?d|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential|private[_-]?key"
PREFIX = r"AKIA|ASIA|ghp_|gho_|ghs_|github_pat_|xox[abprs]-|sk-|sk_live_|rk_live_|glpat-|AIza|eyJ|SG\."
KEY_HEADER = r"-----BEGIN (?:[A-Z0-9]{1,12} ){0,3}PRIVATE KEY-----"
PREFIXES = re.compile(rf"^(?:{PREFIX}|{KEY_HEADER})")
PLACEHOLDER = re.compile(r"example|sample|dummy|change.?me|your.?|placeholder|x{4,}|test|0{6,}|1234", re.I)
SAMPLE_PATH = re.compile(r"test|example|sample|doc|fixture|mock", re.I)
_CANDIDATE = re.compile(
    rf"(?P<name>(?:(?<![A-Za-z])|(?-i:(?<=[a-z])(?=[A-Z])))(?:{NAMES})\"?\s{{0,3}}[=:]\s{{0,3}}[\"']?(?:(?:bearer|basic)\s{{1,3}})?)(?P<value>[^\s\"'<>,;]{{6,}})"
    r"|(?<![A-Za-z])bearer\s{1,3}(?P<bearer>[A-Za-z0-9._~+/\-]{12,}={0,2})"
    r"|(?<![A-Za-z])[a-z][a-z0-9+.\-]{1,20}://[^\s:/@\"'<>]{1,64}:(?P<url>[^\s/@\"'<>]{3,200})@"
    rf"|(?-i:{KEY_HEADER})"
    rf"|(?<![A-Za-z0-9+/_\-])(?-i:{PREFIX})[A-Za-z0-9_\-]{{6,}}(?:\.[A-Za-z0-9_\-]{{4,}})*"
    r"|(?<![A-Za-z0-9+/_\-])(?=[A-Za-z+/_\-]*[0-9])[A-Za-z0-9+/_\-]{12,}={0,2}",
    re.I,
)
_ASSIGNED = re.compile(rf"(?:(?:{NAMES})\"?\s*[=:]\s*[\"']?(?:(?:bearer|basic)\s+)?|bearer\s+|://[^\s:/@\"'<>]{{1,64}}:)$", re.I)
_HEX = re.compile(r"[0-9a-f]+$|[0-9A-F]+$")
LONGEST = 24  # letters of a dictionary word
AROUND = 48  # characters of each neighbourhood
CLASSES = 63
FEATURES = (
    "length", "transitions", "worst_transition", "dictionary", "entropy", "digits", "upper", "switches", "hex", "prefix",
    "placeholder", "repeats", "assigned", "quoted", "before_words", "after_words", "path_sample", "path_depth", "joined",
)


def char_classes() -> np.ndarray:
    """Letters and digits have a class each, all other bytes one."""
    out = np.full(256, CLASSES - 1, np.uint8)
    for k, c in enumerate("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"):
        out[ord(c)] = k
    return out


def transitions(docs: DataFrame) -> np.ndarray:
    """Log-probabilities (CLASSES × CLASSES) of the next character, counted over all texts; null texts add nothing."""
    ddl = "cell int, n long"
    schema = arrow_schema(ddl)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, classes = np.zeros(CLASSES * CLASSES, np.int64), char_classes()
        for (text,) in rows_of(batches):
            data = classes[np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)].astype(np.int32)
            if len(data) > 1:
                total += np.bincount(data[:-1] * CLASSES + data[1:], minlength=CLASSES * CLASSES)
        cells = np.flatnonzero(total)
        yield batch(schema, [cells, total[cells]])

    counted = docs.select("text").mapInArrow(run, ddl).groupBy("cell").agg(F.sum("n").alias("n"))
    counts = np.ones((CLASSES, CLASSES))
    for r in counted.collect():  # at most CLASSES² rows
        counts[divmod(r["cell"], CLASSES)] += r["n"]
    return np.log(counts / counts.sum(1, keepdims=True))


def dictionary(path: str) -> frozenset[str]:
    """Whole words of four letters or more of a public tokenizer's vocabulary (word ends marked ``</w>``)."""
    with open(path, encoding="utf-8") as f:
        pieces = json.load(f)["model"]["vocab"]
    words = (p.removesuffix("</w>") for p in pieces if p.endswith("</w>"))
    return frozenset(w for w in words if 4 <= len(w) <= LONGEST and w.isalpha())


def coverage(value: str, words: frozenset[str]) -> float:
    """Share of the characters that dictionary words cover, longest first from the left."""
    low, i, covered = value.lower(), 0, 0
    while i < len(low):
        for n in range(min(LONGEST, len(low) - i), 3, -1):
            if low[i : i + n] in words:
                covered += n
                i += n
                break
        else:
            i += 1
    return covered / max(1, len(low))


def describe(value: str, before: str, after: str, path: str | None, logp: np.ndarray, words: frozenset[str], classes: np.ndarray) -> list[float]:
    data = classes[np.frombuffer(value.encode("utf-8", "replace"), np.uint8)].astype(int)
    steps = logp[data[:-1], data[1:]] if len(data) > 1 else np.zeros(1)
    counts, n = np.array(list(Counter(value).values())), len(value)
    share = counts / n
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.isalpha() else "s" for c in value]
    near = lambda x: [w for w in re.findall(r"[^\W\d_]+", x.lower()) if len(w) > 3]
    known = lambda ws: sum(w in words for w in ws) / len(ws) if ws else 0.0
    return [
        math.log(n), float(steps.mean()), float(steps.min()), coverage(value, words),
        float(-(share * np.log2(share)).sum()), kinds.count("d") / n, kinds.count("u") / n,
        sum(a != b for a, b in zip(kinds, kinds[1:])) / n, float(bool(_HEX.match(value))), float(bool(PREFIXES.match(value))),
        float(bool(PLACEHOLDER.search(value))), float(counts.max() / n),
        float(bool(_ASSIGNED.search(before))), float(before[-1:] in "\"'" and after[:1] in "\"'" and before != ""),
        known(near(before)), known(near(after)),
        float(bool(SAMPLE_PATH.search(path or ""))), float((path or "").count("/")), float(before[-1:].isalnum() or after[:1].isalnum()),
    ]


def find(text: str | None) -> Iterator[tuple[int, str, str, str]]:
    """(start, value, before, after) of each candidate; positions count characters."""
    for m in _CANDIDATE.finditer(text or ""):
        a, b = m.span(m.lastgroup or 0)
        yield a, text[a:b], text[max(0, a - AROUND) : a], text[b : b + AROUND]


CANDIDATES = "doc_id long, start long, value string, before string, after string, path string, features array<double>"


def candidates(docs: DataFrame, logp: np.ndarray, vocabulary: str, path_column: str = "source") -> DataFrame:
    schema = arrow_schema(CANDIDATES)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, classes = dictionary(vocabulary), char_classes()
        for b in batches:
            out = [
                (key, at, value, before, after, path, describe(value, before, after, path, logp, words, classes))
                for key, text, path in rows_of([b])
                for at, value, before, after in find(text)
            ]
            if out:
                yield batch(schema, list(zip(*out)))

    path = F.col(f"`{path_column}`").cast("string") if path_column in docs.columns else F.lit(None).cast("string")
    return docs.select(F.col("`doc_id`").alias("doc_id"), F.col("`text`").alias("text"), path.alias("path")).mapInArrow(run, CANDIDATES)


def rule_label() -> Column:
    """Labels of findings where none are given: 1 for a known prefix or an assigned value of some randomness that is no
    placeholder, else 0."""
    f = {name: F.col("features")[i] for i, name in enumerate(FEATURES)}
    random = (f["entropy"] >= 2.5) & (f["dictionary"] < 0.5) & (f["placeholder"] == 0)
    return (random & ((f["prefix"] == 1) | ((f["assigned"] == 1) & ((f["digits"] > 0.1) | (f["switches"] > 0.2))))).cast("double")


def findings(found: DataFrame, logp: np.ndarray, vocabulary: str, max_findings: int = 6_000) -> DataFrame:
    """label, features: at most ``max_findings`` candidates, half of either label, chosen by a hash, and for each true one a
    false twin: the same neighbours around a placeholder."""
    labelled = found.withColumn("label", rule_label())
    chosen = [
        labelled.filter(F.col("label") == k).orderBy(F.xxhash64("doc_id", "start", "value"), "doc_id", "start").limit(max_findings // 2)
        for k in (0.0, 1.0)
    ]
    both = chosen[0].unionByName(chosen[1])
    schema = arrow_schema("label double, features array<double>")

    def twins(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, classes = dictionary(vocabulary), char_classes()
        fakes = ("your_password_here1", "changeme12345", "example-token-0000", "xxxxxxxxxxxxxxxx1", "placeholder1")
        for label, start, value, before, after, path, features in rows_of(batches):
            out = [(label, features)]
            if label:
                fake = fakes[(start or 0) % len(fakes)]
                out.append((0.0, describe(fake, before, after, path, logp, words, classes)))
            yield batch(schema, list(zip(*out)))

    return both.select("label", "start", "value", "before", "after", "path", "features").mapInArrow(twins, "label double, features array<double>")


def train(labelled: DataFrame, trees: int = 30, depth: int = 8) -> RandomForestClassificationModel | None:
    """A forest over labelled findings (label, features); null if they are not of both labels."""
    if labelled.select("label").distinct().limit(2).count() < 2:
        return None
    forest = RandomForestClassifier(labelCol="label", featuresCol="x", numTrees=trees, maxDepth=depth, seed=7, cacheNodeIds=False)
    return forest.fit(labelled.select("label", array_to_vector("features").alias("x")))


def scan(docs: DataFrame, vocabulary: str, labelled: DataFrame | None = None, max_findings: int = 6_000, threshold: float = 0.5) -> DataFrame:
    """One row per candidate: doc_id, start, length, value_sha256, score, is_secret.

    ``labelled`` (label, features) are findings of one's own; else rules label a bounded sample.  The value itself is not
    returned.  Null and empty texts have no candidates; a null doc_id or path is passed through; repeated rows give
    repeated findings; an empty table gives no rows.  If the labelled findings are all of one label there is nothing to
    learn from, and the rule itself decides (score 0 or 1).  ``path`` is the source column.  Further columns are ignored.
    """
    spark = docs.sparkSession
    logp = transitions(docs)
    path = scratch(spark, "candidates")
    candidates(docs, logp, vocabulary).write.parquet(path)
    found = spark.read.parquet(path)
    sample = scratch(spark, "findings")
    (findings(found, logp, vocabulary, max_findings) if labelled is None else labelled).write.parquet(sample)
    model = train(spark.read.parquet(sample))
    if model is None:
        scored = found.withColumn("score", rule_label())
    else:
        scored = model.transform(found.withColumn("x", array_to_vector("features")))
        scored = scored.withColumn("score", F.round(vector_to_array("probability")[1], 6))
    return scored.select(
        "doc_id", "start", F.length("value").cast("long").alias("length"), F.sha2("value", 256).alias("value_sha256"),
        "score", (F.col("score") >= threshold).alias("is_secret"),
    )
