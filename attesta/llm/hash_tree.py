"""Shards by a hierarchical weighted hash tree.

A tree has regions, racks and shards.  At each node every child draws an exponential time ``-ln(u) / weight`` from a hash
of the row's key and the child's name; the least one takes the row.  A child's draw depends on its own name and weight
alone, so a changed weight moves rows only into or out of that child's subtree, and a new child takes rows from its
siblings but never lets one sibling pass rows to another.

All work is in column expressions.  Numbering within a shard never sorts a whole shard in one task: a shard's rows are dealt
into blocks by a hash, rows are numbered within blocks, and blocks add the sizes of the blocks before them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attesta.llm.common import own


@dataclass(frozen=True)
class Node:
    """A subtree; a leaf has a shard number.  A parent weighs what its leaves weigh."""

    name: str
    children: tuple[Node, ...] = field(default=())
    shard: int | None = None
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return self.own_weight if self.shard is not None else math.fsum(c.weight for c in self.children)

    def leaves(self) -> list[Node]:
        return [self] if self.shard is not None else [leaf for c in self.children for leaf in c.leaves()]


def tree(regions: int, racks: int, shards: int) -> Node:
    """Regions of ``racks`` racks of ``shards`` shards each, numbered from 0."""
    def rack(r: int, k: int) -> Node:
        first = (r * racks + k) * shards
        return Node(f"rack{r}.{k}", tuple(Node(f"shard{first + i}", shard=first + i) for i in range(shards)))

    return Node("root", tuple(Node(f"region{r}", tuple(rack(r, k) for k in range(racks))) for r in range(regions)))


def grow(root: Node, weight: float = 1.0) -> Node:
    """One more shard, in a region of its own: no other node's weight changes, so rows move into the new shard only."""
    n = max(leaf.shard for leaf in root.leaves()) + 1
    leaf = Node(f"shard{n}", shard=n, own_weight=weight)
    return replace(root, children=(*root.children, Node(f"region+{n}", (Node(f"rack+{n}", (leaf,)),))))


def reweigh(node: Node, weights: dict[int, float]) -> Node:
    """The same tree with other weights of some shards; weight 0 empties a shard."""
    if node.shard is not None:
        return replace(node, own_weight=weights.get(node.shard, node.own_weight))
    return replace(node, children=tuple(reweigh(c, weights) for c in node.children))


def shard_of(root: Node, key: Column) -> Column:
    """Shard of a key; a null key is a key like any other.  Equal draws go to the lesser name.

    The tree is a literal map from a node to its children, so that each level is one expression however wide it is.
    """
    if root.weight <= 0:
        raise ValueError("no shard has a weight")
    children, shards = [], []

    def walk(node: Node) -> int:
        kids = [c for c in node.children if c.weight > 0]
        listed = [(c.name, c.weight) for c in kids] or [(node.name, 1.0)]  # a leaf stays where it is
        children.extend([F.lit(node.name), F.array(*[F.struct(F.lit(n).alias("n"), F.lit(float(w)).alias("w")) for n, w in listed])])
        if node.shard is not None:
            shards.extend([F.lit(node.name), F.lit(node.shard)])
        return 1 + max(map(walk, kids)) if kids else 0

    def draw(child: Column) -> Column:
        high = F.shiftrightunsigned(F.xxhash64(child["n"], key), 11).cast("double")  # 53 bits
        return F.struct((-F.log((high + 0.5) / F.lit(2.0**53)) / child["w"]).alias("t"), child["n"].alias("n"))

    at = F.lit(root.name)
    for _ in range(walk(root)):
        at = F.array_min(F.transform(F.element_at(F.create_map(*children), at), draw))["n"]
    return F.element_at(F.create_map(*shards), at)


def assign(
    df: DataFrame, root: Node, grown: Node | None = None, key: str = "doc_id", text: str = "text", rows_per_block: int = 20_000
) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Size is the UTF-8 length of the text plus 8; a null text counts 0 bytes and its checksum is that of no bytes (0).
    Slots of a shard run from 0 without gaps, in the order of a hash block, then key, size and checksum; rows that agree
    in all of these get neighbouring slots.  A null key is hashed like any other key; repeated rows go to one shard and
    get a slot each; an empty table gives no rows.  Further columns of ``df`` are ignored.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = own(
        df,
        doc_id=key,
        size=(F.octet_length(body) + 8).cast("long"),
        text_crc32=F.crc32(body.cast("binary")).cast("long"),
        shard=shard_of(root, F.col(f"`{key}`")).cast("int"),
        grown_shard=(shard_of(grown, F.col(f"`{key}`")) if grown else F.lit(None)).cast("int"),
    )
    blocks = max(1, math.ceil(df.count() / (rows_per_block * len(root.leaves()))))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(blocks)))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("shard", "block").orderBy("doc_id", "size", "text_crc32")
    numbered = rows.withColumn("at", F.row_number().over(within).cast("long") - 1).join(sizes, ["shard", "block"])
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("first") + F.col("at")).alias("slot"), "grown_shard"
    )


def write_shards(df: DataFrame, root: Node, path: str, key: str = "doc_id", files_per_shard: int = 16) -> None:
    """Write all columns of ``df`` under ``path/shard=<n>``, each shard in several files so that no task holds one whole."""
    out = df.withColumn("shard", shard_of(root, F.col(f"`{key}`")).cast("int"))
    spread = F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(files_per_shard))
    out.repartition(F.col("shard"), spread).write.partitionBy("shard").parquet(path)
