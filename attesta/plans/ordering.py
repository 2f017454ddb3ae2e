"""O: order and top-k.  U: set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta.operators import sequence as seq
from attesta.operators import sets
from attesta.plans.registry import plan
from attesta.scale import OrderedGroups, days, digits_pos, rows_per_block
from attesta.sources.scans import tagged_union
from attesta.tables import FACT, PERSON, ROSTER


@plan("o1_newest_nulls_last", f"""WITH {FACT} SELECT fact_key, row_number() OVER (PARTITION BY kind ORDER BY CASE WHEN fact_key NOT LIKE '%7' THEN date END DESC NULLS LAST, fact_key) AS place FROM fact""")
def o1(t):
    facts = t.facts().withColumn("date", F.when(~F.col("fact_key").endswith("7"), F.col("date")))
    newest = F.coalesce(-days("date"), F.lit(seq.UNNUMBERED))
    f = facts.select("fact_key", "kind", newest.alias("newest"))
    g = OrderedGroups(f, ["kind"], ["newest", "fact_key"], "newest", digits_pos("fact_key", len("event:")))
    return g.number("place").rows().select("fact_key", "place")


@plan("o2_newest_n_hidden", """WITH r AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC, event_id DESC) AS place,
    count(*) OVER (PARTITION BY user_id) AS n FROM events)
  SELECT user_id, event_id, CAST(place AS INTEGER) AS place, greatest(n - 20, 0) AS hidden FROM r WHERE place <= 20""")
def o2(t):
    e = t.events.select("user_id", "event_id", F.to_date("ts").alias("date"))
    return seq.newest_n(e, ["user_id"], [F.desc_nulls_last("date"), F.desc("event_id")], 20).drop("date")


@plan("o3_fallback_order", """SELECT c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY coalesce(CASE WHEN c_mktsegment = 'BUILDING' THEN c_custkey % 100 END,
    CASE WHEN c_acctbal > 0 THEN c_custkey // 3 END, 1099511627776), c_custkey) AS place FROM customer""")
def o3(t):
    reg = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_custkey") % 100)
    listed = F.when(F.col("c_acctbal") > 0, F.floor(F.col("c_custkey") / 3))
    c = t.customer.select("c_custkey", "c_nationkey", F.coalesce(reg, listed, F.lit(seq.UNNUMBERED)).alias("no"))
    return OrderedGroups(c, ["c_nationkey"], ["no", "c_custkey"], "no", "c_custkey").number("place").rows().select("c_custkey", "place")


@plan("o4_category_rank", """SELECT p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY CASE p_type WHEN 'PROMO' THEN 0 WHEN 'LARGE' THEN 1 ELSE 2 END, p_partkey) AS place FROM part""")
def o4(t):
    rank = F.when(F.col("p_type") == "PROMO", 0).when(F.col("p_type") == "LARGE", 1).otherwise(2)
    p = t.part.select("p_partkey", "p_brand", rank.alias("rank"))
    return OrderedGroups(p, ["p_brand"], ["rank", "p_partkey"], "rank", "p_partkey").number("place").rows().select("p_partkey", "place")


@plan("o5_latest_nonempty", """SELECT user_id, max(event_id) AS event_id FROM events WHERE CAST(props->>'$.k' AS INT) > 80 AND event_type = 'view' GROUP BY user_id""")
def o5(t):
    full = t.events.filter((F.get_json_object("props", "$.k").cast("int") > 80) & (F.col("event_type") == "view"))
    return full.groupBy("user_id").agg(F.max(F.struct("event_id"))["event_id"].alias("event_id"))


@plan("o6_ordered_distinct", """WITH w AS (SELECT doc_id, string_split(text, ' ') AS w FROM documents),
  u AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS n, unnest(w) AS x FROM w), f AS (SELECT doc_id, x, min(n) AS n FROM u GROUP BY ALL)
  SELECT doc_id, count(*) AS n, md5(string_agg(x, ' ' ORDER BY f.n)) AS words FROM f GROUP BY doc_id""")
def o6(t):
    w = F.array_distinct(F.split("text", " "))
    return t.documents.select("doc_id", F.size(w).cast("long").alias("n"), F.md5(F.array_join(w, " ")).alias("words"))


@plan("u1_basis_union", f"""WITH {ROSTER}, {PERSON} SELECT record_id AS id, area, office, 'roster' AS basis FROM roster
  UNION ALL SELECT person_id, area, NULL, 'election' FROM person""")
def u1(t):
    people = t.persons().select(F.col("person_id").alias("id"), "area")
    return tagged_union([("roster", t.roster().select(F.col("record_id").alias("id"), "area", "office")), ("election", people)], tag="basis")


@plan("u2_distinct_union", """SELECT DISTINCT l_suppkey AS id FROM lineitem UNION SELECT s_suppkey FROM supplier""")
def u2(t):
    both = t.lineitem.select(F.col("l_suppkey").alias("id")).unionByName(t.supplier.select(F.col("s_suppkey").alias("id")))
    return both.dropDuplicates(["id"])


@plan("u3_symmetric_difference", """WITH n AS (SELECT k, sum(d) AS d FROM (SELECT l_orderkey * 8 + l_linenumber AS k, 1 AS d FROM lineitem
    UNION ALL SELECT o_orderkey * 8 + 1 + o_custkey % 5, -1 FROM orders) GROUP BY k)
  SELECT k, CASE WHEN d > 0 THEN 'a' ELSE 'b' END AS side, CAST(abs(d) AS BIGINT) AS n FROM n WHERE d <> 0""")
def u3(t):
    a = t.lineitem.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("k"))
    b = t.orders.select((F.col("o_orderkey") * 8 + 1 + F.col("o_custkey") % 5).alias("k"))
    return sets.symmetric_difference(a, b)


@plan("u4_in_both_lists", """WITH e AS (SELECT CAST(ts AS DATE) AS d, user_id, bool_or(event_type = 'view') AS p, bool_or(event_type = 'signup') AS l FROM events WHERE event_type IN ('view', 'signup') GROUP BY ALL)
  SELECT strftime(d, '%Y-%m-%d') AS day, bool_or(p AND l) AS reject FROM e GROUP BY d""")
def u4(t):
    e = t.events.select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "user_id", "event_type")
    return sets.in_both(e.filter("event_type = 'view'"), e.filter("event_type = 'signup'"), ["day"], "user_id")


@plan("u5_cached_merge", """WITH f AS (SELECT CASE WHEN l_quantity > 40 THEN l_orderkey ELSE -l_orderkey - 1 END AS k, count(*) AS v FROM lineitem GROUP BY ALL)
  SELECT k, v, 'fresh' AS src FROM f UNION ALL SELECT o_orderkey, o_custkey, 'cached' FROM orders WHERE o_orderkey NOT IN (SELECT k FROM f)""")
def u5(t):
    cached = t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("v"), F.lit("cached").alias("src"))
    # lines of a small quantity refresh keys that are not cached
    key = F.when(F.col("l_quantity") > 40, F.col("l_orderkey")).otherwise(-F.col("l_orderkey") - 1)
    lines = t.lineitem.select(key.alias("k"))
    # an order has few lines, so combining before the shuffle saves little; dealt out by their number, no task's groups grow with the table
    parts = max(-(-lines.count() // rows_per_block(t.spark)), t.spark.sparkContext.defaultParallelism)
    fresh = lines.repartition(parts, "k").groupBy("k").agg(F.count(F.lit(1)).alias("v")).withColumn("src", F.lit("fresh"))
    return sets.cached_merge(cached, fresh, ["k"])


@plan("u6_coverage", """WITH n AS (SELECT l_orderkey - l_orderkey % 2 * (l_linenumber % 2) AS unit, count(*) AS n FROM lineitem GROUP BY ALL)
  SELECT o_orderkey AS unit, coalesce(n, 0) AS n, CASE WHEN n IS NULL THEN 'unassigned' ELSE 'assigned twice' END AS problem
  FROM orders LEFT JOIN n ON o_orderkey = unit WHERE coalesce(n, 0) <> 1""")
def u6(t):
    assigned = t.lineitem.select((F.col("l_orderkey") - F.col("l_orderkey") % 2 * (F.col("l_linenumber") % 2)).alias("unit"))
    return sets.coverage(t.orders.select(F.col("o_orderkey").alias("unit")), assigned, "unit")
