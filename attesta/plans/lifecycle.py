"""M: stateful merge and lifecycle."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta.operators import lifecycle as life
from attesta.plans.registry import plan
from attesta.scale import micros
from attesta.session import scratch

# Two snapshots of one fact table: the stored one ends early and holds older content for some rows; the batch begins late.
_SNAP = """s AS (SELECT event_id AS k, user_id, event_type AS kind, CASE WHEN event_type = 'error' THEN value + 1 ELSE value END AS value, 1 AS fetched_at FROM events WHERE ts < TIMESTAMP '2024-01-28'),
  b AS (SELECT event_id AS k, user_id, event_type AS kind, CASE WHEN value < 10 THEN NULL ELSE value END AS value, 2 AS fetched_at FROM events WHERE ts >= TIMESTAMP '2024-01-04')"""
_MERGED = """j AS (SELECT coalesce(s.k, b.k) AS k, s.k AS sk, b.k AS bk, s.user_id AS su, b.user_id AS bu, s.kind AS sd, b.kind AS bd, s.value AS sv, b.value AS bv,
    bk IS NOT NULL AND (sk IS NULL OR s.user_id <> b.user_id OR s.kind <> b.kind OR s.value IS DISTINCT FROM b.value) AS take FROM s FULL JOIN b ON s.k = b.k),
  m AS (SELECT k, coalesce(bu, su) AS user_id, coalesce(bd, sd) AS kind, CASE WHEN take THEN bv ELSE sv END AS value, CASE WHEN take THEN 2 ELSE 1 END AS fetched_at, sk, bk FROM j)"""


def _snapshots(t):
    value = F.col("value")
    rows = lambda df, v, stamp: df.select(
        F.col("event_id").alias("k"), "user_id", F.col("event_type").alias("kind"), v.alias("value"), F.lit(stamp).alias("fetched_at")
    )
    stored = t.events.filter("ts < timestamp_ntz'2024-01-28 00:00:00'")
    batch = t.events.filter("ts >= timestamp_ntz'2024-01-04 00:00:00'")
    older = F.when(F.col("event_type") == "error", value + 1).otherwise(value)
    return rows(stored, older, 1), rows(batch, F.when(value >= 10, value), 2)


def _people(t, condition):
    return t.customer.filter(condition).select(F.col("c_custkey").alias("user_id"))


@plan("m1_change_aware_upsert", f"WITH {_SNAP}, {_MERGED} SELECT k, user_id, kind, value, fetched_at FROM m")
def m1(t):
    stored, batch = _snapshots(t)
    return life.upsert(stored, batch, ["k"])


@plan("m2_sparse_upsert", f"""WITH {_SNAP} SELECT coalesce(s.k, b.k) AS k, s.user_id, s.kind, coalesce(b.value, s.value) AS value, s.fetched_at FROM s FULL JOIN b ON s.k = b.k""")
def m2(t):
    stored, batch = _snapshots(t)
    return life.sparse_upsert(stored, batch.select("k", "value"), ["k"])


@plan("m3_canonical_payload", """SELECT event_id, '{"k":' || (props->>'$.k') || ',"type":"' || event_type || '","user":' || user_id || '}' AS payload FROM events""")
def m3(t):
    e = t.events.select("event_id", F.col("user_id").alias("user"), F.col("event_type").alias("type"), F.from_json("props", "k bigint")["k"].alias("k"))
    return e.select("event_id", life.canonical_json(["user", "type", "k"]).alias("payload"))


@plan("m4_scope_replace", f"WITH {_SNAP}, {_MERGED} SELECT k, user_id, kind, value, fetched_at FROM m WHERE bk IS NOT NULL OR kind <> 'view'")
def m4(t):
    stored, batch = _snapshots(t)
    return life.scope_replace(stored, batch, ["k"], F.col("kind") == "view")[0]


@plan("m4_scope_report", f"""WITH {_SNAP} SELECT 'written' AS what, count(*) AS n FROM b
  UNION ALL SELECT 'deleted', count(*) FROM s WHERE kind = 'view' AND k NOT IN (SELECT k FROM b)""")
def m4_report(t):
    stored, batch = _snapshots(t)
    return life.scope_replace(stored, batch, ["k"], F.col("kind") == "view")[1]


@plan("m5_entity_replace", f"""WITH {_SNAP}, f AS (SELECT * FROM b WHERE kind IN ('view', 'click') AND user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')),
  o AS (SELECT * FROM s WHERE kind IN ('view', 'click')),
  j AS (SELECT f.k, f.user_id, f.kind, f.value AS fv, o.value AS ov, o.k AS ok FROM f LEFT JOIN o ON f.k = o.k)
  SELECT * FROM s WHERE kind NOT IN ('view', 'click')
  UNION ALL SELECT o.* FROM o WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) AND user_id NOT IN (SELECT user_id FROM f)
  UNION ALL SELECT k, user_id, kind, fv, CASE WHEN ok IS NOT NULL AND fv IS NOT DISTINCT FROM ov THEN 1 ELSE 2 END FROM j""")
def m5(t):
    stored, batch = _snapshots(t)
    fetched = batch.filter("kind IN ('view', 'click')").join(_people(t, "c_mktsegment = 'BUILDING'"), "user_id", "left_semi")
    linked = _people(t, "c_acctbal > 0")
    return life.entity_replace(stored, fetched, ["k"], "user_id", "kind", ["view", "click"], linked)


@plan("m6_departed_only", f"""WITH {_SNAP}, {_MERGED} SELECT k, user_id, kind, value, fetched_at FROM m WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
  UNION ALL SELECT * FROM s WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) AND kind <> 'view'""")
def m6(t):
    stored, batch = _snapshots(t)
    targets = _people(t, "c_acctbal > 0")
    return life.purge_departed(stored, batch.join(targets, "user_id", "left_semi"), ["k"], "user_id", F.col("kind") == "view", targets)


@plan("m7_write_once", f"WITH {_SNAP} SELECT * FROM s UNION ALL SELECT * FROM b WHERE k NOT IN (SELECT k FROM s)")
def m7(t):
    stored, batch = _snapshots(t)
    return life.write_once(stored, batch, ["k"])


@plan("m8_coverage_state", """WITH w AS (SELECT DISTINCT event_type, user_id FROM events), c AS (SELECT DISTINCT event_type, user_id FROM events WHERE event_type <> 'error' OR value > 150)
  SELECT w.event_type, count(*) FILTER (WHERE c.user_id IS NULL) AS new_members, CASE WHEN bool_or(c.user_id IS NULL) THEN 'full' ELSE 'incremental' END AS scan
  FROM w LEFT JOIN c ON w.event_type = c.event_type AND w.user_id = c.user_id GROUP BY w.event_type""")
def m8(t):
    wanted = t.events.select("event_type", "user_id")
    covered = t.events.filter("event_type <> 'error' OR value > 150").select("event_type", "user_id")
    return life.scan_plan(covered, wanted, "event_type", "user_id")


@plan("m9_reread_window", """WITH s AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS d, o_totalprice AS v, 'stored' AS src FROM orders WHERE o_orderdate < DATE '1998-06-01' AND o_orderstatus <> 'P'),
  f AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS d, o_totalprice AS v, 'fresh' AS src FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1998-06-01' - 60)
  SELECT k, v, src FROM f UNION ALL SELECT k, v, src FROM s WHERE k NOT IN (SELECT k FROM f)""")
def m9(t):
    o = t.orders.select(F.col("o_orderkey").alias("k"), F.to_date("o_orderdate").alias("d"), F.col("o_totalprice").alias("v"), "o_orderstatus")
    last = F.lit("1998-06-01").cast("date")
    stored = o.filter((F.col("d") < last) & (F.col("o_orderstatus") != "P")).drop("o_orderstatus").withColumn("src", F.lit("stored"))
    return life.reread_window(stored, o.withColumn("src", F.lit("fresh")), ["k"], "d", last).drop("d")


@plan("m10_review_transition", """SELECT o_orderkey AS k, CASE o_orderstatus WHEN 'O' THEN 'qualified' ELSE 'registered' END AS status,
  CASE o_orderstatus WHEN 'O' THEN 'https://review.example.org' END AS review_url, epoch_us(o_orderdate) AS fetched_at FROM orders WHERE o_orderstatus <> 'F'""")
def m10(t):
    rows = t.orders.select(
        F.col("o_orderkey").alias("k"), F.lit("registered").alias("status"), F.lit(None).cast("string").alias("review_url"), micros("o_orderdate").alias("fetched_at")
    )
    review = t.orders.filter("o_orderstatus <> 'P'").select(
        F.col("o_orderkey").alias("k"), F.when(F.col("o_orderstatus") == "F", "disqualified").otherwise("qualified").alias("result"),
        F.lit("https://review.example.org").alias("review_url"),
    )
    return life.review_transition(rows, review, ["k"], "status", "review_url")


@plan("m11_approval_gate", """SELECT doc_id, lang FROM documents SEMI JOIN (SELECT doc_id FROM labels WHERE quality = 1) USING (doc_id)""")
def m11(t):
    reviews = t.labels.select("doc_id", F.when(F.col("quality") == 1, "approved").otherwise("rejected").alias("status"))
    return life.approved_only(t.documents.select("doc_id", "lang"), reviews, ["doc_id"])


@plan("m12_no_overwrite", """SELECT doc_id, CASE WHEN EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND quality = 1) THEN 'pending' ELSE 'publish' END AS route FROM documents d""")
def m12(t):
    return life.route_output(t.documents.select("doc_id"), t.labels.filter("quality = 1"), ["doc_id"])


@plan("m13_curated_edits", r"""WITH c AS (SELECT conv_id, turn // 4 AS page, turn, role, text, string_split(text, chr(10)) AS ls, string_split(text, '. ') AS ss FROM conversations),
  e AS (SELECT *, role = 'system' AS gone, role = 'assistant' AND len(ss) > 1 AND length(ss[1]) > 0 AS say, role = 'user' AND len(ls) > 1 AS cut FROM c)
  SELECT conv_id, page, count(*) FILTER (WHERE NOT gone) AS issues,
    CAST(coalesce(sum(len(ls) - CASE WHEN cut AND trim(ls[1]) = '' THEN 1 ELSE 0 END) FILTER (WHERE NOT gone), 0) AS BIGINT) AS points,
    CAST(coalesce(sum(len(ls) - cut::INT) FILTER (WHERE NOT gone), 0) AS BIGINT) AS citations,
    CAST(coalesce(sum(CASE WHEN say THEN length(trim(substr(text, length(ss[1]) + 1))) ELSE length(text) END) FILTER (WHERE NOT gone), 0) AS BIGINT) AS response_chars
  FROM e GROUP BY conv_id, page""")
def m13(t):
    c = t.conversations.withColumn("page", F.floor(F.col("turn") / 4))
    lines, sentences = F.split("text", "\n"), F.split("text", r"\. ")
    topic = F.concat(F.lit("turn "), "turn")
    issue = F.struct(
        topic.alias("topic"),
        F.transform(lines, lambda s, i: F.concat(F.lit("<"), i, F.lit(">"), s)).alias("points"),
        F.col("text").alias("response"),
        F.transform(lines, lambda s, i: F.struct(i.cast("long").alias("page"), s.alias("text"))).alias("citations"),
    )
    docs = c.groupBy("conv_id", "page").agg(F.array_sort(F.collect_list(F.struct("turn", issue.alias("i")))).alias("l")).select(
        "conv_id", "page", F.transform("l", lambda x: x["i"]).alias("issues")
    )
    edit = lambda cond, no, action, text, page: F.when(
        cond, F.struct((F.col("turn") * 4 + no).cast("int").alias("no"), topic.alias("topic"), F.lit(action).alias("action"), text.alias("text"), page.alias("page"))
    )
    nothing, nowhere = F.lit(None).cast("string"), F.lit(None).cast("long")
    user = (F.col("role") == "user") & (F.size(lines) > 1)
    edits = c.select(
        "conv_id", "page",
        F.inline(F.filter(F.array(
            edit(F.col("role") == "system", 0, "drop_issue", nothing, nowhere),
            edit(user, 1, "drop_citation", nothing, F.lit(0).cast("long")),
            edit(user, 2, "drop_point_text", F.lit("<0>"), nowhere),
            edit((F.col("role") == "assistant") & (F.size(sentences) > 1) & (F.length(sentences[0]) > 0), 3, "drop_response_sentence", sentences[0], nowhere),
        ), lambda x: x.isNotNull())),
    )
    edits = edits.toDF("conv_id", "doc_page", "no", "topic", "action", "text", "page")
    out = life.apply_edits(docs.withColumnRenamed("page", "doc_page"), edits, ["conv_id", "doc_page"])
    total = lambda f: F.aggregate(F.col("issues"), F.lit(0).cast("long"), lambda a, i: a + f(i))
    return out.select(
        "conv_id", F.col("doc_page").alias("page"), F.size("issues").cast("long").alias("issues"),
        total(lambda i: F.size(i["points"])).alias("points"), total(lambda i: F.size(i["citations"])).alias("citations"),
        total(lambda i: F.coalesce(F.length(i["response"]), F.lit(0))).alias("response_chars"),
    )


@plan("m14_scope_atomicity", """SELECT event_type AS scope, count(*) AS n,
    CASE event_type WHEN 'click' THEN 'published' WHEN 'view' THEN 'failed' ELSE 'unchanged' END AS status
  FROM events WHERE event_type IN ('view', 'purchase', 'signup') OR event_type = 'click' AND value > 10 GROUP BY event_type""")
def m14(t):
    store = life.ScopeStore(t.spark, scratch(t.spark, "scopes"))
    kinds = ["click", "view", "purchase", "signup"]
    life.publish(store, {k: (lambda k=k: t.events.filter(F.col("event_type") == k)) for k in kinds})
    # second run: one source breaks while it is written, the others publish
    broken = lambda: t.events.filter("event_type = 'view'").withColumn("value", F.raise_error(F.lit("bad page")).cast("double"))
    status = life.publish(store, {"click": lambda: t.events.filter("event_type = 'click' AND value > 10"), "view": broken})
    rows = store.read().groupBy(F.col("event_type").alias("scope")).agg(F.count(F.lit(1)).alias("n"))
    return rows.join(status, "scope", "left").select("scope", "n", F.coalesce("status", F.lit("unchanged")).alias("status"))


@plan("m15_noop_status", """SELECT c_custkey AS user_id, count(event_id) AS records, CASE WHEN count(event_id) > 0 THEN 'ok' ELSE 'no_speech' END AS status
  FROM customer LEFT JOIN events ON user_id = c_custkey AND event_type = 'purchase' GROUP BY c_custkey""")
def m15(t):
    roster = t.customer.select(F.col("c_custkey").alias("user_id"))
    return life.explicit_status(roster, t.events.filter("event_type = 'purchase'"), ["user_id"], "no_speech")


@plan("m16_exclusion_fact", """SELECT l_orderkey, l_linenumber, CASE WHEN l_tax > 0.07 THEN 'attendance_excluded' ELSE 'attendance' END AS kind,
  CASE WHEN l_tax > 0.07 THEN CASE WHEN l_discount > 0.05 THEN 'mismatch' ELSE 'unreadable' END END AS reason FROM lineitem""")
def m16(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_tax", "l_discount")
    reason = F.when(F.col("l_discount") > 0.05, "mismatch").otherwise("unreadable")
    bad = rows.filter("l_tax > 0.07").withColumn("reason", reason)
    return life.with_exclusions(rows.filter("NOT l_tax > 0.07"), bad, "attendance").select("l_orderkey", "l_linenumber", "kind", "reason")


def _named(t):
    k = F.col("o_custkey")
    events = t.orders.select("o_orderkey", F.array_distinct(F.array(k % 130, (k + 1) % 130, k % 17)).alias("names"))
    people = t.supplier.select(F.col("s_suppkey").alias("name"), F.concat(F.lit("p"), "s_suppkey").alias("person_id"))
    return life.fan_out(events, "names", people, "vid", "o_orderkey")


_NAMED = """n AS (SELECT o_orderkey, unnest(list_distinct([o_custkey % 130, (o_custkey + 1) % 130, o_custkey % 17])) AS name FROM orders)"""


@plan("m17_fan_out", f"""WITH {_NAMED} SELECT 'vid:' || o_orderkey || ':p' || s_suppkey AS fact_key, 'p' || s_suppkey AS person_id FROM n JOIN supplier ON name = s_suppkey""")
def m17(t):
    return _named(t)[0].select("fact_key", "person_id")


@plan("m17_unmapped_names", f"""WITH {_NAMED} SELECT name, count(*) AS skipped FROM n WHERE name NOT IN (SELECT s_suppkey FROM supplier) GROUP BY name""")
def m17_skipped(t):
    return _named(t)[1]


@plan("m18_incumbent_attach", """WITH o AS (SELECT o_custkey, o_orderstatus AS office, 'd' || o_orderkey % 3 AS d, o_orderpriority = '1-URGENT' AS suspended FROM orders),
  x AS (SELECT o_custkey, office, unnest(CASE WHEN d = 'd1' THEN ['e1', 'e2'] ELSE [d] END) AS d, suspended FROM o),
  g AS (SELECT o_custkey, office, d, bool_or(suspended) AS s FROM x GROUP BY ALL)
  SELECT c_custkey, string_agg(office || '/' || d || CASE WHEN s THEN '*' ELSE '' END, ',' ORDER BY office, d) AS offices FROM customer LEFT JOIN g ON c_custkey = o_custkey GROUP BY c_custkey""")
def m18(t):
    offices = t.orders.select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderstatus").alias("office"), F.concat(F.lit("d"), F.col("o_orderkey") % 3).alias("district_id"),
        (F.col("o_orderpriority") == "1-URGENT").alias("suspended"), F.lit("roster").alias("basis"),
    )
    remap = t.spark.createDataFrame([("d1", "e1"), ("d1", "e2")], "old string, new string")
    out = life.attach_incumbency(t.customer.select("c_custkey"), offices, remap, "c_custkey")
    shown = F.transform("incumbent", lambda o: F.concat(o["office"], F.lit("/"), o["district_id"], F.when(o["suspended"], "*").otherwise("")))
    return out.select("c_custkey", F.array_join(shown, ",").alias("offices"))


def _summaries(t):
    n = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("written"), F.count_if(F.col("o_orderstatus") == "O").alias("oral"),
        F.count_if(F.col("o_orderstatus") == "P").alias("clips"),
    )
    c = t.customer.join(n, "c_custkey", "left").fillna(0, ["written", "oral", "clips"])
    dims = F.filter(
        F.array(*[F.struct(F.lit(d).alias("id"), F.col(d).alias("n")) for d in ("written", "oral", "clips")]), lambda d: d["n"] > 0
    )
    records = F.col("written") + F.col("oral") + F.col("clips")
    kind = life.summary_kind(F.col("c_acctbal") > 0, F.col("c_nationkey") < 20, records)
    return c.select("c_custkey", kind.alias("kind"), F.when(kind == "records", dims).alias("dims"))


_SUMMARY = """n AS (SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS w, count(*) FILTER (WHERE o_orderstatus = 'O') AS o, count(*) FILTER (WHERE o_orderstatus = 'P') AS p FROM orders GROUP BY ALL),
  s AS (SELECT c_custkey, coalesce(w, 0) AS w, coalesce(o, 0) AS o, coalesce(p, 0) AS p, CASE WHEN c_acctbal <= 0 THEN 'new' WHEN c_nationkey >= 20 THEN 'unrecorded'
    WHEN coalesce(w + o + p, 0) = 0 THEN 'none' ELSE 'records' END AS kind FROM customer LEFT JOIN n ON o_custkey = c_custkey)"""


@plan("m19_summary_record", f"""WITH {_SUMMARY} SELECT c_custkey, kind, CASE WHEN kind = 'records' THEN array_to_string(list_filter([CASE WHEN w > 0 THEN 'written=' || w END, CASE WHEN o > 0 THEN 'oral=' || o END,
  CASE WHEN p > 0 THEN 'clips=' || p END], lambda x: x IS NOT NULL), ',') END AS dims FROM s""")
def m19(t):
    shown = F.array_join(F.transform("dims", lambda d: F.concat(d["id"], F.lit("="), d["n"].cast("string"))), ",")
    return _summaries(t).select("c_custkey", "kind", shown.alias("dims"))


@plan("m20_dimension_selection", f"""WITH {_SUMMARY} SELECT c_custkey, array_to_string(list_filter([CASE WHEN w > 0 THEN 'written' END, CASE WHEN p > 0 THEN 'clips' END], lambda x: x IS NOT NULL), ',') AS shown,
  CASE WHEN o > 0 THEN 'oral' ELSE '' END AS omitted FROM s WHERE kind = 'records'""")
def m20(t):
    s = _summaries(t).filter("kind = 'records'")
    shown, omitted = life.select_dimensions(F.col("dims"), ["clips", "written"])
    return s.select("c_custkey", F.array_join(F.transform(shown, lambda d: d["id"]), ",").alias("shown"), F.array_join(omitted, ",").alias("omitted"))
