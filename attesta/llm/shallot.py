"""Exact k-means on whole numbers, with the Shallot search for the nearest centroid.

Every vector remembers its nearest and its second-nearest centroid, an upper bound of the distance to the first and a
lower bound of the distance to all others.  When the centroids move, the bounds move with them; a vector whose upper bound
stays below its lower bound, or below half the gap around its centroid, keeps its centroid without a look at any other.
The rest start from the closer one of the two they remember and walk through its neighbours in order of distance: no
centroid farther from the start than (distance to the start + distance to the second nearest so far) can be among the
two nearest, and that ball shrinks whenever a nearer one is found.  Bounds are floating and are only trusted with a
margin; what survives them is compared by exact squared distances in whole numbers, equal ones by number.

Spark holds the vectors and their bounds as a written table per round, so a lost executor repeats its own files only.  A
round hands the driver one row of sums per centroid; nothing else leaves the executors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.llm.common import arrow_schema, own
from attesta.session import scratch

MARGIN = 1e-9  # relative; far above the rounding of a few additions and roots
LIMIT = 2**26  # 64 squared differences of components up to this still fit 63 bits
STATE = "vec_id long, v array<int>, near int, second int, upper double, lower double, distance long"


@dataclass(frozen=True)
class Centroids:
    """Centroids, their distances from one another and how far each moved since the last round."""

    at: np.ndarray  # (k, d) whole numbers
    moved: np.ndarray  # (k,)

    @classmethod
    def of(cls, at: Sequence[Sequence[int]], before: Centroids | None = None) -> Centroids:
        at = np.array(at, np.int64)
        moved = np.zeros(len(at)) if before is None else np.sqrt(((at - before.at) ** 2).sum(1)) * (1 + MARGIN)
        return cls(at, moved)

    @property
    def gaps(self) -> np.ndarray:
        return np.sqrt(((self.at[:, None, :] - self.at[None, :, :]) ** 2).sum(2))


def _least(d1, c1, d2, c2):
    """Does (d1, c1) come before (d2, c2)?"""
    return (d1 < d2) | ((d1 == d2) & (c1 < c2))


def nearest(v: np.ndarray, centroids: Centroids, near, second, upper, lower):
    """New (near, second, upper, lower, squared distance) of each vector, and the number of distances worked out."""
    c, k, n = centroids.at, len(centroids.at), len(v)

    def squared(rows, which):
        return ((v[rows] - c[which]) ** 2).sum(1)

    everyone = np.arange(n)
    if k == 1:
        return near * 0, near * 0, upper, lower, squared(everyone, near * 0), n
    gaps = centroids.gaps
    order = np.argsort(gaps, axis=1, kind="stable")
    order = np.array([[j for j in order[i] if j != i] for i in range(k)])  # a centroid's neighbours, nearest first
    clear = np.array([gaps[i, order[i, 0]] for i in range(k)]) / 2 * (1 - MARGIN)
    most = np.array([np.delete(centroids.moved, i).max() for i in range(k)])

    lower = np.maximum(lower - most[near], 0.0) * (1 - MARGIN)
    upper = (upper + centroids.moved[near]) * (1 + MARGIN)
    exact = np.full(n, -1, np.int64)
    todo = np.flatnonzero(upper >= np.maximum(lower, clear[near]))
    exact[todo] = squared(todo, near[todo])
    work = len(todo)
    upper[todo] = np.sqrt(exact[todo]) * (1 + MARGIN)
    todo = todo[upper[todo] >= np.maximum(lower[todo], clear[near[todo]])]

    # start from the closer of the two that are remembered
    first, other = near[todo], second[todo]
    d1, d2 = exact[todo], squared(todo, other)
    work += len(todo)
    swap = _least(d2, other, d1, first)
    first, other = np.where(swap, other, first), np.where(swap, first, other)
    d1, d2 = np.where(swap, d2, d1), np.where(swap, d1, d2)
    start, reach = first.copy(), np.sqrt(d1)
    walking = np.arange(len(todo))
    for rank in range(k - 1):
        candidate = order[start[walking], rank]
        ball = (reach[walking] + np.sqrt(d2[walking])) * (1 + MARGIN)
        inside = gaps[start[walking], candidate] <= ball
        walking, candidate = walking[inside], candidate[inside]  # neighbours are sorted and the ball only shrinks
        if not len(walking):
            break
        fresh = candidate != other[walking]
        at, candidate = walking[fresh], candidate[fresh]
        d = squared(todo[at], candidate)
        work += len(at)
        better, runner_up = _least(d, candidate, d1[at], first[at]), _least(d, candidate, d2[at], other[at])
        d2[at] = np.where(better, d1[at], np.where(runner_up, d, d2[at]))
        other[at] = np.where(better, first[at], np.where(runner_up, candidate, other[at]))
        d1[at], first[at] = np.where(better, d, d1[at]), np.where(better, candidate, first[at])
    near, second = near.copy(), second.copy()
    near[todo], second[todo], exact[todo] = first, other, d1
    upper[todo], lower[todo] = np.sqrt(d1) * (1 + MARGIN), np.sqrt(d2) * (1 - MARGIN)
    return near, second, upper, lower, exact, work


def whole_vectors(df: DataFrame, dims: int, scale: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and v, the components as whole numbers floor(scale * x); other lengths, nulls and non-finite values are left out."""
    rows = own(df, vec_id=key, e=F.col(f"`{vector}`").cast("array<double>"))
    bad = F.exists("e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))

    def whole(x: Column) -> Column:
        y = F.floor(x * F.lit(float(scale)))
        return F.when(F.abs(x) * scale <= LIMIT, y).otherwise(F.raise_error(F.lit(f"a component is beyond {LIMIT} / {scale}"))).cast("int")

    return rows.filter((F.size("e") == dims) & ~bad).select(F.col("vec_id").cast("long"), F.transform("e", whole).alias("v"))


def _assign(rows: DataFrame, centroids: Centroids) -> DataFrame:
    schema = arrow_schema(STATE)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            v = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(n, -1).astype(np.int64)
            if b.num_columns > 2:
                bounds = [np.array(b.column(i)) for i in range(2, 6)]
            else:  # nothing is known yet
                k = len(centroids.at)
                bounds = [np.zeros(n, np.int32), np.full(n, min(1, k - 1), np.int32), np.full(n, np.inf), np.zeros(n)]
            near, second, upper, lower, exact, _ = nearest(v, centroids, *bounds)
            arrays = [b.column(0), b.column(1), near.astype(np.int32), second.astype(np.int32), upper, lower, exact]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) if isinstance(x, np.ndarray) else x.cast(t) for x, t in zip(arrays, schema.types)], schema=schema)

    return rows.mapInArrow(run, STATE)


def _moved(state: DataFrame, centroids: Centroids) -> Centroids:
    """Exact whole means of the clusters; an empty cluster's centroid stays."""
    dims = centroids.at.shape[1]
    sums = state.groupBy("near").agg(F.count(F.lit(1)), *[F.sum(F.col("v")[i].cast("long")) for i in range(dims)]).collect()
    at = [list(map(int, row)) for row in centroids.at]
    for row in sums:  # at most one row per centroid
        at[row[0]] = [s // row[1] for s in row[2:]]
    return Centroids.of(at, centroids)


def cluster(
    df: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: str = "1", key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Vectors with another number of components than ``dims``, a null or a non-finite one are left out.  The first centroids
    are the vectors with the least sha256 of ``seed:vec_id``; with fewer than ``k`` vectors there are fewer centroids.  A
    null vec_id is kept and clustered but its vector is chosen as a first centroid only after all others; repeated rows are
    clustered row by row, and of rows with one vec_id the lesser vector starts first.  An empty table gives no rows.
    Further columns are ignored.  A component beyond ``LIMIT / scale`` stops the job: its distance would not fit a long.
    """
    spark = df.sparkSession

    def stored(rows: DataFrame, name: str) -> DataFrame:
        path = scratch(spark, f"shallot-{name}")
        rows.write.parquet(path)
        return spark.read.parquet(path)

    rows = stored(whole_vectors(df, dims, scale, key, vector), "vectors")
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.select("v", drawn.alias("h")).orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()
    out = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not first:
        return spark.createDataFrame([], out)
    centroids, state = Centroids.of([r.v for r in first]), rows
    for i in range(rounds):
        state = stored(_assign(state, centroids), f"round{i}")
        centroids = _moved(state, centroids)
    last = stored(_assign(state, centroids).withColumn("distance", _distance(centroids)).select("vec_id", "near", "distance"), "last")
    sums = {r.near: r.inertia for r in last.groupBy("near").agg(F.sum("distance").alias("inertia")).collect()}
    facts = F.create_map(*[x for i, at in enumerate(centroids.at.tolist()) for x in (F.lit(i), F.struct(
        F.lit(sums.get(i, 0)).cast("long").alias("inertia"), F.lit(hashlib.sha256(",".join(map(str, at)).encode()).hexdigest()).alias("sha")))])
    of = F.element_at(facts, F.col("near"))
    return last.select(
        "vec_id", F.col("near").alias("cluster"), "distance", of["inertia"].alias("cluster_inertia"),
        F.lit(sum(sums.values())).cast("long").alias("inertia"), of["sha"].alias("centroid_sha256"),
    )


def _distance(centroids: Centroids) -> Column:
    """Squared distance to the vector's own centroid; the search knows it only where bounds did not settle the matter."""
    table = F.lit(centroids.at.tolist()).cast("array<array<long>>")
    diffs = F.zip_with(F.col("v"), F.element_at(table, F.col("near") + 1), lambda x, y: (x - y) * (x - y))
    return F.when(F.col("distance") >= 0, F.col("distance")).otherwise(F.aggregate(diffs, F.lit(0).cast("long"), lambda s, x: s + x))
