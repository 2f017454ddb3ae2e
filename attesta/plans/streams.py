"""ST: streaming forms, run to the end of the available files."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta.operators import sequence as seq
from attesta.plans.registry import plan
from attesta.scale import micros
from attesta.session import scratch
from attesta.streaming import jobs


def _events(t):
    e = jobs.read_stream(t.spark, f"{t.sf_dir}/events.parquet")
    return e.withColumn("ts", F.col("ts").cast("timestamp"))


@plan("st1_fact_merge", """WITH e AS (SELECT user_id, CAST(props->>'$.k' AS BIGINT) AS k, event_type, event_id FROM events)
  SELECT event_type, user_id, k, max(event_id) AS fetched_at FROM e GROUP BY ALL""")
def st1(t):
    base = scratch(t.spark, "stream-merge")
    stream = _events(t).select(
        "event_type", "user_id", F.get_json_object("props", "$.k").cast("long").alias("k"), F.col("event_id").alias("fetched_at")
    )
    jobs.run_available(stream, f"{base}/checkpoint", sink=jobs.merge_facts(f"{base}/facts", ["event_type", "user_id", "k"]))
    return t.spark.read.parquet(f"{base}/facts").select("event_type", "user_id", "k", "fetched_at")


@plan("st2_first_seen", """SELECT event_id, user_id FROM events""")
def st2(t):
    base = scratch(t.spark, "stream-dedupe")
    twice = _events(t).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    first = jobs.first_seen(twice, ["event_id"], "ts", "60 days").select("event_id", "user_id")
    jobs.run_available(first, f"{base}/checkpoint", path=f"{base}/out")
    return t.spark.read.parquet(f"{base}/out")


@plan("st3_gap_sessions", """WITH p AS (SELECT user_id, ts, ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS gap FROM events),
  s AS (SELECT user_id, ts, sum((gap IS NULL OR gap >= INTERVAL 30 MINUTE)::INT) OVER (PARTITION BY user_id ORDER BY ts) AS c FROM p),
  g AS (SELECT user_id, min(ts) AS a, max(ts) + INTERVAL 30 MINUTE AS b, count(*) AS n FROM s GROUP BY user_id, c)
  SELECT user_id, epoch_us(a) AS start, epoch_us(b) AS "end", n FROM g WHERE b <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""")
def st3(t):
    base = scratch(t.spark, "stream-sessions")
    sessions = jobs.gap_sessions(_events(t), "user_id", "ts", "30 minutes", "10 minutes")
    jobs.run_available(sessions, f"{base}/checkpoint", path=f"{base}/out")
    out = t.spark.read.parquet(f"{base}/out")
    return out.select("user_id", micros("start").alias("start"), micros("end").alias("end"), "n")


@plan("st4_tumbling_counts", """SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events
  WHERE CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events) GROUP BY ALL""")
def st4(t):
    base = scratch(t.spark, "stream-days")
    counts = jobs.tumbling_counts(_events(t), ["user_id"], "ts", "1 day", "10 minutes")
    jobs.run_available(counts, f"{base}/checkpoint", path=f"{base}/out")
    return t.spark.read.parquet(f"{base}/out").select("user_id", F.date_format("start", "yyyy-MM-dd").alias("day"), "n")


@plan("st5_running_attribution", """WITH o AS (SELECT conv_id, turn, CASE WHEN role = 'system' THEN 'CHAIR' WHEN role = 'user' AND length(text) % 5 = 0 THEN 'OTHER'
    WHEN role = 'user' THEN 'm' || (length(text) % 3) END AS owner FROM conversations),
  s AS (SELECT *, last_value(CASE WHEN owner <> 'CHAIR' THEN owner END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS state FROM o)
  SELECT conv_id, turn, owner, CASE WHEN owner IS NOT DISTINCT FROM 'CHAIR' OR state = 'OTHER' THEN NULL ELSE state END AS attributed FROM s""")
def st5(t):
    base = scratch(t.spark, "stream-turns")
    role, n = F.col("role"), F.length("text")
    owner = F.when(role == "system", seq.CHAIR).when((role == "user") & (n % 5 == 0), seq.OUTSIDER).when(
        role == "user", F.concat(F.lit("m"), (n % 3).cast("string"))
    )
    turns = jobs.read_stream(t.spark, f"{t.sf_dir}/conversations.parquet")
    with jobs.stateful(t.spark):
        jobs.run_available(jobs.running_attribution(turns, ["conv_id"], "turn", owner), f"{base}/checkpoint", path=f"{base}/out")
    return jobs.latest(t.spark.read.parquet(f"{base}/out"), ["conv_id"], "turn")
