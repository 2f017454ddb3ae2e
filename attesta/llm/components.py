"""Connected components by alternating large and small stars.

Each round hangs every node's larger neighbours, then its smaller ones, on the least node around it; a node's neighbours are
never gathered, they meet the minimum by a join.  Edges and minima of each round are written tables in the shared folder: a
join with a stored minimum is split by adaptive execution where a hub has many edges, one with an aggregate on its key is not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.session import scratch


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(u, v) → (node, label): the least node of its component, for every node with an edge to another.

    Edges with a null end and from a node to itself are ignored; repeated edges count once; no edges give no rows.
    """
    spark = edges.sparkSession

    def stored(df: DataFrame) -> DataFrame:
        path = scratch(spark, "edges")
        df.write.parquet(path)
        return spark.read.parquet(path)

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = stored(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    last = state(now)
    for _ in range(rounds):
        if not last[0]:
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")))
        large = stored(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")))
        hung = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v"))
        )).alias("e")).select("e.u", "e.v")
        now = stored(hung.filter("u <> v").distinct())
        last, before = state(now), last
        if last == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    # settled: every component is a star around its least node
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )
