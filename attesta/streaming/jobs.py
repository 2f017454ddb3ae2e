"""Incremental forms of the merge, dedupe, session and attribution operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from attesta.operators import lifecycle as life
from attesta.operators import sequence as seq


def read_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files as a stream, with the schema of the files present; ``path`` may be a folder or one file."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    folder, _, name = path.rpartition("/")
    return reader.parquet(f"{folder}/{{{name}}}")  # a pattern, as a plain path would have to be a folder


def run_available(query: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None] | None = None, path: str | None = None) -> None:
    """Process what is there and stop; a restart continues from the checkpoint."""
    writer = query.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    writer = writer.foreachBatch(sink) if sink else writer.format("parquet").option("path", path).outputMode("append")
    writer.start().awaitTermination()


def merge_facts(path: str, key: list[str], buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """Sink: change-aware upsert into Parquet files partitioned by ``bucket``, a hash of the key.

    Only the buckets that a micro-batch touches are read and overwritten (dynamic partition overwrite), so the work follows
    the batch, not the table.  The merged buckets are first written beside the table; a batch that is replayed after a failure
    finds them complete and only repeats the overwrite.  Null and odd values are keys like any other.
    """
    pending = f"{path}.pending"

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = _batches(spark, pending)
        if any(i > batch_id for i in done):
            return  # a later batch has been merged on top
        side = f"{pending}/batch={batch_id}"
        if batch_id not in done:
            rows = life.one_per_key(batch, key).withColumn("bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))
            touched = [r.bucket for r in rows.select("bucket").distinct().collect()]  # at most ``buckets``
            if not touched:
                return
            if _exists(spark, path):
                stored = spark.read.parquet(path).filter(F.col("bucket").isin(touched))
                rows = life.upsert(_keyed(stored, key), _keyed(rows, key), ["bucket", "__key"]).select("__key.*", "*").drop("__key")
            rows.repartition("bucket").write.mode("overwrite").parquet(side)
        merged = spark.read.parquet(side)
        merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
        for old in done:
            if old < batch_id:
                _path(spark, pending)[1].delete(_path(spark, f"{pending}/batch={old}")[0], True)

    return sink


def _keyed(rows: DataFrame, key: list[str]) -> DataFrame:
    """The key as one struct: nulls in it are equal."""
    return rows.withColumn("__key", F.struct(*key)).drop(*key)


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def _batches(spark: SparkSession, pending: str) -> list[int]:
    """Batches whose merged buckets were written completely."""
    p, fs = _path(spark, pending)
    names = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
    return [int(n.partition("=")[2]) for n in names if n.startswith("batch=") and _exists(spark, f"{pending}/{n}/_SUCCESS")]


def first_seen(stream: DataFrame, key: list[str], time: str, lateness: str) -> DataFrame:
    """The first row per key; repeats within the lateness are dropped and state older than it is released."""
    return stream.withWatermark(time, lateness).dropDuplicatesWithinWatermark(key)


def gap_sessions(stream: DataFrame, key: str, time: str, gap: str, lateness: str) -> DataFrame:
    """Sessions that the watermark has closed; counts are kept per session, not rows."""
    w = F.session_window(time, gap)
    s = stream.withWatermark(time, lateness).groupBy(key, w.alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return s.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def tumbling_counts(stream: DataFrame, key: list[str], time: str, width: str, lateness: str) -> DataFrame:
    """Counts per key and window, once the watermark has closed the window."""
    g = stream.withWatermark(time, lateness).groupBy(*key, F.window(time, width).alias("w"))
    return g.agg(F.count(F.lit(1)).alias("n")).select(*key, F.col("w.start").alias("start"), "n")


class _Attribution(StatefulProcessor):
    """Keeps the labels of one conversation by turn and states which turns a batch has attributed or changed."""

    def __init__(self, out: StructType, pos: str, idle_ms: int):
        self.out, self.pos, self.idle = out, pos, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.labels = handle.getMapState("labels", "pos long", "owner string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802 - the interface's names
        known = {k[0]: v[0] for k, v in self.labels.iterator()}
        before = attributed(known)
        for part in rows:
            for pos, owner in zip(part[self.pos].tolist(), part["owner"].tolist()):
                owner = owner if isinstance(owner, str) else None
                known[pos] = owner
                self.labels.updateValue((pos,), (owner,))
                before.pop(pos, None)
        now = timerValues.getCurrentProcessingTimeInMs()
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(now + self.idle)
        said = [(*key, pos, known[pos], member, now) for pos, member in attributed(known).items() if pos not in before or before[pos] != member]
        if said:
            yield pd.DataFrame(said, columns=self.out.names)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        self.labels.clear()
        return iter(())

    def close(self) -> None:
        pass


def attributed(labels: dict[int, str | None]) -> dict[int, str | None]:
    """Turn → member, by the rules of ``sequence.attribute``."""
    out, state = {}, None
    for pos in sorted(labels):
        owner = labels[pos]
        if owner is not None and owner != seq.CHAIR:
            state = None if owner == seq.OUTSIDER else owner
        out[pos] = None if owner == seq.CHAIR else state
    return out


def running_attribution(turns: DataFrame, key: list[str], pos: str, owner: Column, idle: str = "1 day") -> DataFrame:
    """Stream of (key, pos, owner, attributed, version): what each batch attributes, and what it changes in earlier turns.

    The state of a conversation is its labels by turn, in the state store; a batch reads and writes the conversations it
    touches.  A turn that comes late is put in its place and the turns behind it are stated anew under a higher
    version; ``latest`` keeps the last statement.  A timer releases a conversation that has been idle for ``idle``.
    Needs the RocksDB state store (``stateful``).
    """
    rows = turns.select(*key, F.col(pos).cast("long").alias(pos), owner.alias("owner"))
    out = StructType([rows.schema[k] for k in key]).add(pos, "long").add("owner", "string").add("attributed", "string").add("version", "long")
    idle_ms = int(pd.Timedelta(idle).total_seconds() * 1000)
    return rows.groupBy(*key).transformWithStateInPandas(_Attribution(out, pos, idle_ms), out, "Append", "ProcessingTime")


def latest(stated: DataFrame, key: list[str], pos: str) -> DataFrame:
    """The last statement about each turn."""
    last = stated.groupBy(*key, pos).agg(F.max_by(F.struct("owner", "attributed"), "version").alias("s"))
    return last.select(*key, pos, "s.owner", "s.attributed")


@contextmanager
def stateful(spark: SparkSession) -> Iterator[None]:
    """Settings for keyed state in a run that ends: RocksDB, checkpoints that hold what changed, and no batches without data,
    which a run with timers would go on making for ever."""
    store = "spark.sql.streaming.stateStore"
    wanted = {
        f"{store}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        f"{store}.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


__all__ = ["first_seen", "gap_sessions", "latest", "merge_facts", "read_stream", "run_available", "running_attribution", "stateful", "tumbling_counts"]
