"""N-gram Jaccard self-join by MinHash banding, with exact verification.

1. Every text gets the set of its 5-word n-grams, a digest of that set and one hash per band of MinHash values; rows and
   bands are chosen for a target recall at the threshold.  Texts with equal sets are one node from here on.
2. Nodes are shuffled on band hashes.  A bucket gives each member one edge to its least member, never all pairs; connected
   components of these edges hold every pair that shares a band.
3. Within a component all pairs are verified on full n-gram sets, in blocks: a component of up to ``block`` nodes is one
   task's work, a larger one is split into pairs of blocks, so that no task holds more than two blocks.  A block pair returns
   a row per node (its links there and the least node it hangs on), not the pairs.
4. Links add up per node, and verified components are the classes.

The verified set holds every pair that any band proposes, so nothing that banding finds is lost; pairs that no band proposes
are missed with a probability of at most 1 - recall each, at the threshold itself (less above it).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.llm.common import arrow_schema, batch, folded_words, mix, rows_of, shingles
from attesta.llm.components import components
from attesta.session import scratch

WORDS, THRESHOLD = 5, 0.8


def choose_bands(threshold: float, recall: float, rows: int = 5) -> int:
    """Bands of ``rows`` values with which a pair at the threshold shares one with probability ``recall`` or more."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)))


def ngram_set(text: str | None, n: int = WORDS) -> np.ndarray:
    return np.unique(shingles(folded_words(text), n))


def band_hashes(grams: np.ndarray, bands: int, rows: int) -> np.ndarray:
    k = bands * rows
    a = mix(np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)
    b = mix(np.arange(k + 1, 2 * k + 1, dtype=np.uint64))
    least = np.full(k, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(grams), 2048):
        part = grams[None, i : i + 2048] * a[:, None]
        part += b[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    value, table = np.arange(bands, dtype=np.uint64), least.reshape(bands, rows)
    for r in range(rows):
        value = mix(value + table[:, r])
    return value.view(np.int64)


def row_key() -> Column:
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.md5(F.coalesce("text", F.lit(""))))


SIGNED = "doc_id long, key string, node struct<a: long, b: long>, bands array<long>"


def signatures(docs: DataFrame, bands: int, rows: int, n: int = WORDS) -> DataFrame:
    """doc_id, key, node (digest of the n-gram set; null without words), bands."""
    schema = arrow_schema(SIGNED)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for key, row, text in rows_of([b]):
                grams = ngram_set(text, n)
                if not len(grams):
                    out.append((key, row, None, None))
                    continue
                x, y = np.frombuffer(hashlib.blake2b(grams.tobytes(), digest_size=16).digest(), np.int64).tolist()
                out.append((key, row, {"a": x, "b": y}, band_hashes(grams, bands, rows)))
            if out:
                yield batch(schema, list(zip(*out)))

    return docs.select("doc_id", row_key().alias("key"), "text").mapInArrow(run, SIGNED)


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections: products of slices of the membership matrix."""
    m = len(sets)
    if m <= 6:
        out = np.zeros((m, m), np.int64)
        for i in range(m):
            for j in range(i):
                out[i, j] = out[j, i] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        return out
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(m), sizes)
    grams = np.concatenate(sets)
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], owner[order]
    at = np.cumsum(np.append(0, grams[1:] != grams[:-1]))
    out = np.zeros((m, m), np.float64)
    if len(at):
        width = max(256, (1 << 22) // m)
        for lo in range(0, int(at[-1]) + 1, width):
            i, j = np.searchsorted(at, [lo, lo + width])
            part = np.zeros((m, width), np.float32)
            part[owner[i:j], at[i:j] - lo] = 1
            out += part @ part.T
    return out.astype(np.int64)


def verify(nodes: list[tuple], sets: list[np.ndarray], copies: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float):
    """Rows (node, links, root) of the nodes that have a link between a left and a right member."""
    inter, sizes = overlaps(sets), np.array([len(s) for s in sets])
    union = sizes[:, None] + sizes[None, :] - inter
    linked = (inter >= threshold * union - 1e-9) & (left[:, None] & right[None, :] | right[:, None] & left[None, :])
    np.fill_diagonal(linked, False)
    order = sorted(range(len(nodes)), key=nodes.__getitem__)
    root = list(range(len(nodes)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    rank = {i: r for r, i in enumerate(order)}
    for i in order:
        for j in np.flatnonzero(linked[i]):
            a, b = find(i), find(int(j))
            if a != b:
                a, b = (a, b) if rank[a] < rank[b] else (b, a)
                root[b] = a
    links = linked @ copies
    return [(nodes[i], int(links[i]), nodes[find(i)]) for i in range(len(nodes)) if linked[i].any()]


VERIFIED = "node struct<a: long, b: long>, split boolean, links long, root struct<a: long, b: long>"


def ngram_join(
    docs: DataFrame, threshold: float = THRESHOLD, n: int = WORDS, recall: float = 0.9995, rows: int = 5, block: int = 192
) -> DataFrame:
    """One row per input row: doc_id, class_id, n_links.

    A link joins two rows whose sets of ``n``-word n-grams have a Jaccard similarity of ``threshold`` or more; n_links is
    the number of other rows a row is linked with, copies included, and class_id the smallest doc_id of its connected
    class.  A text of fewer than ``n`` words is one n-gram.  A null text or one without words has no links and is its own
    class.  A row without doc_id takes part, its class_id is that of its class, or null if no row of the class has one.
    Repeated rows are linked with each other.  An empty table gives no rows.  Further columns are ignored.
    """
    spark = docs.sparkSession
    bands = choose_bands(threshold, recall, rows)

    def stored(df: DataFrame, name: str) -> DataFrame:
        """The small side of a join on a key that may be hot: against a stored table the other side can be split."""
        path = scratch(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    base = docs.select(F.col("`doc_id`").alias("doc_id"), F.col("`text`").alias("text"))
    signed = stored(signatures(base, bands, rows, n), "signatures")

    nodes = signed.filter("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies"), F.min("key").alias("key"), F.min("bands").alias("bands")
    )
    bucket = nodes.select("node", F.posexplode("bands").alias("band", "hash"))
    least = bucket.groupBy("band", "hash").agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    least = stored(least.drop("n"), "buckets")
    stars = bucket.join(least, ["band", "hash"]).select(F.col("node").alias("u"), F.col("least").alias("v"))
    found = components(stars)

    # members of components, dealt to block pairs
    sizes = found.groupBy("label").agg(F.count(F.lit(1)).alias("n")).select("label", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    sizes = stored(sizes, "sizes")
    members = (
        nodes.select("node", "key", "copies").join(found, "node").join(sizes, "label")
        .withColumn("part", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .select("node", "key", "copies", "label", "blocks", "part")
    )
    texts = base.select(row_key().alias("key"), "text").join(members, "key")
    low, high = F.least("part", "other"), F.greatest("part", "other")
    dealt = texts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.xxhash64("label", low, high).alias("work"), "label", low.alias("i"), high.alias("j"), "part", "node", "copies", "blocks", "text"
    )
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    dealt = dealt.repartition(int(parts), "work").sortWithinPartitions("work", "label", "i", "j", "node")
    checked = stored(dealt.mapInArrow(_verifier(threshold, n), VERIFIED), "verified")

    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    # a component that one task saw whole is settled; the others' pieces are joined up
    across = components(checked.filter("split").select(F.col("node").alias("u"), F.col("root").alias("v")))
    label = checked.filter("not split").select("node", F.col("root").alias("label")).unionByName(across)
    known = nodes.select("node", "first", "copies").join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    classes = stored(known.groupBy("label").agg(F.min("first").alias("class_id")), "classes")
    known = known.join(classes, "label").join(links, "node", "left").select(
        "node", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    return signed.select("doc_id", "node").join(known, "node", "left").select(
        "doc_id",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def _verifier(threshold: float, n: int):
    schema = arrow_schema(VERIFIED)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, held, out = None, {}, []

        def done() -> list[tuple]:
            i, j, split = work[2], work[3], work[4]
            if len(held) < 2:
                return []
            nodes = list(held)
            part = np.array([held[x][0] for x in nodes])
            copies = np.array([held[x][1] for x in nodes], np.int64)
            found = verify(nodes, [held[x][2] for x in nodes], copies, part == i, part == j, threshold)
            keys = lambda x: {"a": x[0], "b": x[1]}
            return [(keys(x), split, links, keys(root)) for x, links, root in found]

        for row in rows_of(batches):
            now = (row[0], (row[1]["a"], row[1]["b"]), row[2], row[3], row[7] > 1)
            if now != work:
                if work:
                    out += done()
                work, held = now, {}
            node = (row[5]["a"], row[5]["b"])
            if node not in held:  # a repeated row brings the same text again
                held[node] = (row[4], row[6], ngram_set(row[8], n))
            if len(out) > 10_000:
                yield batch(schema, list(zip(*out)))
                out = []
        if work:
            out += done()
        if out:
            yield batch(schema, list(zip(*out)))

    return run


def one_per_class(docs: DataFrame, joined: DataFrame) -> DataFrame:
    """The rows of ``docs`` without those whose class has a smaller doc_id; rows without doc_id stay."""
    gone = joined.filter("doc_id <> class_id").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")
