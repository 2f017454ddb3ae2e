"""Q: quality gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta.operators import gates
from attesta.operators.sets import coverage
from attesta.plans.registry import plan
from attesta.sources.sinks import SENSITIVE
from attesta.tables import FACT


@plan("q1_row_constraints", f"""WITH {FACT}, f AS (SELECT fact_key, person_id, CASE WHEN kind = 'error' THEN 'ftp://x' ELSE source_url END AS source_url,
    CASE WHEN fact_key LIKE '%3' THEN left(data, 4) ELSE data END AS data, CASE WHEN kind <> 'signup' THEN date END AS date FROM fact)
  SELECT fact_key, 'date is null' AS violation FROM f WHERE date IS NULL
  UNION ALL SELECT fact_key, 'source_url is no link' FROM f WHERE source_url NOT LIKE 'http%'
  UNION ALL SELECT fact_key, 'data is no JSON' FROM f WHERE NOT json_valid(data)
  UNION ALL SELECT fact_key, 'person_id unknown' FROM f WHERE person_id NOT IN (SELECT 'p' || s_suppkey FROM supplier)""")
def q1(t):
    f = t.facts()
    f = f.withColumns({
        "source_url": F.when(F.col("kind") == "error", "ftp://x").otherwise(F.col("source_url")),
        "data": F.when(F.col("fact_key").endswith("3"), F.substring("data", 1, 4)).otherwise(F.col("data")),
        "date": F.when(F.col("kind") != "signup", F.col("date")),
    })
    persons = t.supplier.select(F.concat(F.lit("p"), "s_suppkey").alias("person_id"))
    return gates.row_constraints(f, "fact_key", ["fact_key", "kind", "date"], "source_url", "data", [("person_id", persons, "person_id")])


@plan("q2_declared_count", """WITH n AS (SELECT l_orderkey, count(*) AS listed, count(DISTINCT l_suppkey) AS d FROM lineitem GROUP BY ALL)
  SELECT o_orderkey, coalesce(listed, 0) AS listed, o_custkey % 5 + 1 AS declared, CASE WHEN listed IS NULL THEN 'no list' WHEN d < listed THEN 'repeated name'
    WHEN listed <> o_custkey % 5 + 1 THEN 'count differs' END AS reason FROM orders LEFT JOIN n ON l_orderkey = o_orderkey""")
def q2(t):
    members = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey")
    headers = t.orders.select("o_orderkey", (F.col("o_custkey") % 5 + 1).alias("declared"))
    return gates.declared_count(members, headers, "o_orderkey", "l_suppkey", "declared")


@plan("q3_detail_vs_total", """WITH d AS (SELECT CASE WHEN l_quantity > 3 THEN l_orderkey ELSE -l_orderkey - 1 END AS l_orderkey, count(*) AS marks, sum((l_returnflag <> 'R')::INT) AS p,
    sum((l_returnflag = 'R')::INT) AS a FROM lineitem GROUP BY ALL),
  t AS (SELECT o_orderkey, 1 AS c FROM orders UNION ALL SELECT o_orderkey, 1 FROM orders WHERE o_totalprice > 490000),
  g AS (SELECT o_orderkey, count(*) AS copies FROM t GROUP BY ALL)
  SELECT g.o_orderkey, CASE WHEN copies > 1 THEN 'duplicate' WHEN marks IS NULL THEN 'blank' WHEN o_orderstatus <> 'F' AND a > 0 THEN 'absent_without_column'
    WHEN p + a <> o_custkey % 3 + 3 THEN 'mismatch' END AS reason FROM g JOIN orders o ON g.o_orderkey = o.o_orderkey LEFT JOIN d ON l_orderkey = g.o_orderkey""")
def q3(t):
    absent = F.col("l_returnflag") == "R"
    key = F.when(F.col("l_quantity") > 3, F.col("l_orderkey")).otherwise(-F.col("l_orderkey") - 1)  # such marks belong to no printed table
    details = t.lineitem.select(key.alias("o_orderkey"), (~absent).cast("int").alias("present"), absent.cast("int").alias("absent"))
    twice = t.orders.unionByName(t.orders.filter("o_totalprice > 490000"))  # some tables are printed twice
    totals = twice.select("o_orderkey", (F.col("o_custkey") % 3 + 3).alias("total"), (F.col("o_orderstatus") == "F").alias("has_absent"))
    return gates.detail_against_total(details, totals, ["o_orderkey"], "has_absent")


@plan("q4_equal_column_sums", """SELECT l_orderkey, CASE WHEN min(l_suppkey % 3) <> max(l_suppkey % 3) THEN 'column sums differ' END AS reason FROM lineitem GROUP BY l_orderkey""")
def q4(t):
    return gates.equal_sums(t.lineitem, "l_orderkey", F.col("l_suppkey") % 3)


@plan("q5_batch_reject", """SELECT l_orderkey, count(*) AS rows, count(*) FILTER (WHERE l_tax = 0) AS unknown, CASE WHEN bool_or(l_tax = 0) THEN 'unknown name' END AS reason FROM lineitem GROUP BY l_orderkey""")
def q5(t):
    return gates.all_known(t.lineitem, "l_orderkey", F.col("l_tax") > 0)


@plan("q6_reject_rate", """WITH r AS (SELECT source || lang AS file, coalesce(quality = 0, false) AS bad, n_chars < 400 AS short FROM documents LEFT JOIN labels USING (doc_id)),
  g AS (SELECT file, count(*) AS rows, count(*) FILTER (WHERE bad) AS bad, count(*) FILTER (WHERE short) AS name_only FROM r GROUP BY file)
  SELECT *, CASE WHEN bad >= 2 AND bad / rows > 0.2 THEN 'too many rejects' WHEN name_only * 2 > rows THEN 'names only' END AS reason FROM g""")
def q6(t):
    rows = t.documents.join(t.labels, "doc_id", "left").withColumn("file", F.concat("source", "lang"))
    return gates.reject_rate(rows, "file", F.coalesce(F.col("quality") == 0, F.lit(False)), F.col("n_chars") < 400)


@plan("q7_exact_coverage", """WITH a AS (SELECT p_partkey % 10 AS office, p_partkey // 10 AS unit FROM part WHERE p_size > 5 UNION ALL SELECT p_partkey % 10, p_partkey // 10 FROM part WHERE p_size > 47),
  u AS (SELECT DISTINCT p_partkey % 10 AS office, p_partkey // 10 AS unit FROM part), n AS (SELECT office, unit, count(*) AS n FROM a GROUP BY ALL)
  SELECT u.unit, u.office, coalesce(n, 0) AS n, CASE WHEN n IS NULL THEN 'unassigned' ELSE 'assigned twice' END AS problem FROM u LEFT JOIN n ON u.office = n.office AND u.unit = n.unit WHERE coalesce(n, 0) <> 1""")
def q7(t):
    p = t.part.select(F.floor(F.col("p_partkey") / 10).alias("unit"), (F.col("p_partkey") % 10).alias("office"), "p_size")
    assigned = p.filter("p_size > 5").unionByName(p.filter("p_size > 47"))
    return coverage(p, assigned, "unit", "office")


@plan("q8_cardinality", """SELECT o_custkey, count(*) AS n, CASE WHEN count(*) NOT BETWEEN 5 AND 14 THEN 'implausible count' END AS reason FROM orders GROUP BY o_custkey""")
def q8(t):
    return gates.cardinality(t.orders, "o_custkey", 5, 14)


@plan("q9_shrink_guard", """WITH l AS (SELECT user_id, count(*) AS n FROM events WHERE event_type <> 'click' GROUP BY ALL), s AS (SELECT user_id, count(*) AS n FROM events WHERE value > 20 GROUP BY ALL)
  SELECT coalesce(l.user_id, s.user_id) AS user_id, coalesce(l.n, 0) AS listed, coalesce(s.n, 0) AS stored, CASE WHEN coalesce(l.n, 0) < 40 THEN 'below floor' WHEN coalesce(l.n, 0) < coalesce(s.n, 0) THEN 'shrank' END AS reason
  FROM l FULL JOIN s ON l.user_id = s.user_id""")
def q9(t):
    return gates.shrink_guard(t.events.filter("event_type <> 'click'"), t.events.filter("value > 20"), "user_id", 40)


@plan("q10_identity_agreement", """SELECT o_orderkey AS k, CASE WHEN l.k IS NULL THEN 'no reference' WHEN l.number <> o_custkey % 3 THEN 'number differs' WHEN l.birth_year <> year(o_orderdate) THEN 'birth_year differs'
    WHEN l.party <> o_orderstatus THEN 'party differs' END AS reason FROM orders LEFT JOIN
    (SELECT l_orderkey AS k, min(l_partkey) % 3 AS number, min(year(l_shipdate)) AS birth_year, min(CASE WHEN l_linestatus = 'O' THEN 'O' ELSE 'F' END) AS party FROM lineitem GROUP BY l_orderkey) l ON l.k = o_orderkey""")
def q10(t):
    rows = t.orders.select(
        F.col("o_orderkey").alias("k"), (F.col("o_custkey") % 3).alias("number"), F.year("o_orderdate").alias("birth_year"), F.col("o_orderstatus").alias("party")
    )
    ref = t.lineitem.groupBy(F.col("l_orderkey").alias("k")).agg(
        (F.min("l_partkey") % 3).alias("number"), F.min(F.year("l_shipdate")).alias("birth_year"),
        F.min(F.when(F.col("l_linestatus") == "O", "O").otherwise("F")).alias("party"),
    )
    return gates.identity_agreement(rows, ref, "k", ["number", "birth_year", "party"]).select("k", "reason")


@plan("q11_field_chain", r"""WITH e AS (SELECT doc_id, text, CASE WHEN trim(text) = '' THEN 'blank' WHEN regexp_matches(text, '<[a-z]+') THEN 'image' WHEN text LIKE '%Licensed%' OR text LIKE '%licensed%' THEN 'cross-cell'
    WHEN (length(text) - length(regexp_replace(text, '[%#$*&]', '', 'g'))) / greatest(length(text), 1) > 0.02 THEN 'garble' WHEN length(text) < 20 THEN 'gap' END AS reason FROM documents)
  SELECT doc_id, reason, CASE WHEN reason IS NULL THEN md5(text) END AS value FROM e""")
def q11(t):
    text = F.col("text")
    broken = F.length(text) - F.length(F.regexp_replace(text, r"[%#$*&]", ""))
    evidence = [
        ("blank", F.trim(text) == ""), ("image", text.rlike("<[a-z]+")), ("cross-cell", text.contains("Licensed") | text.contains("licensed")),
        ("garble", broken / F.greatest(F.length(text), F.lit(1)) > 0.02), ("gap", F.length(text) < 20),
    ]
    return gates.field_chain(t.documents, "text", *evidence).select("doc_id", "reason", F.md5("text").alias("value"))


@plan("q12_label_consistency", r"""SELECT page_id, CASE WHEN regexp_extract(html, 'lang="([a-z]+)"', 1) <> split_part(url, '/', 4) THEN 'language differs'
  WHEN position(regexp_extract(url, '^https?://([^/?#]+)', 1) IN html) = 0 THEN 'host not on page' END AS reason FROM pages""")
def q12(t):
    reason = gates.first_reason(
        ("language differs", F.regexp_extract("html", 'lang="([a-z]+)"', 1) != F.split_part("url", F.lit("/"), F.lit(4))),
        ("host not on page", ~F.col("html").contains(F.try_parse_url("url", F.lit("HOST")))),
    )
    return t.pages.select("page_id", reason.alias("reason"))


@plan("q13_both_present", """WITH p AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events WHERE event_type = 'view'),
  l AS (SELECT user_id, CAST(ts AS DATE) AS d, max(CASE WHEN value > 20 THEN 'from ' || hour(ts) END) AS note FROM events WHERE event_type = 'click' GROUP BY ALL)
  SELECT coalesce(p.user_id, l.user_id) AS user_id, strftime(coalesce(p.d, l.d), '%Y-%m-%d') AS day, CASE WHEN p.d IS NOT NULL AND l.d IS NOT NULL AND note IS NULL THEN 'error' WHEN p.d IS NOT NULL THEN 'present' ELSE 'leave' END AS status,
    p.d IS NOT NULL AND l.d IS NOT NULL AND note IS NOT NULL AS partial FROM p FULL JOIN l ON p.user_id = l.user_id AND p.d = l.d""")
def q13(t):
    e = t.events.select("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type", F.when(F.col("value") > 20, F.concat(F.lit("from "), F.hour("ts"))).alias("note"))
    return gates.both_lists(e.filter("event_type = 'view'"), e.filter("event_type = 'click'"), ["user_id", "day"], "note")


@plan("q14_publish_invariants", f"""WITH {FACT} SELECT 'sensitive fields' AS "check", 0::BIGINT AS violations
  UNION ALL SELECT 'sensitive payload fields', coalesce(sum(CASE WHEN CAST(data->>'$.k' AS BIGINT) % 10 = 0 THEN 2 ELSE 0 END), 0)::BIGINT FROM fact
  UNION ALL SELECT 'provenance', count(*) FILTER (WHERE source_url NOT LIKE 'http%' OR fetched_at IS NULL) FROM fact
  UNION ALL SELECT 'exported set', (SELECT count(DISTINCT person_id) FROM fact WHERE person_id NOT IN (SELECT person_id FROM fact WHERE kind = 'signup'))
  UNION ALL SELECT 'references', count(*) FILTER (WHERE person_id NOT IN (SELECT CASE WHEN c_custkey > 20 THEN 'p' ELSE 'q' END || c_custkey FROM customer)) FROM fact""")
def q14(t):
    facts = t.facts()
    exported = facts.groupBy("person_id").agg(F.max("date").alias("latest"))
    candidates = facts.filter("kind = 'signup'").select("person_id").distinct()
    persons = t.customer.select(F.concat(F.when(F.col("c_custkey") > 20, "p").otherwise("q"), "c_custkey").alias("person_id"))
    # some payloads hold a list of relatives, two of them with a date of birth
    hidden = F.concat(F.lit('{"a":'), "data", F.lit(',"kin":[{"birth_date":1},{"deep":{"birth_year":[2]}},"birth_date"]}'))
    some = F.get_json_object("data", "$.k").cast("long") % 10 == 0
    facts = facts.withColumn("data", F.when(some, hidden).otherwise(F.col("data")))
    return gates.publish_invariants(facts, exported, candidates, persons, SENSITIVE, payload="data")


@plan("q15_suspects", """SELECT o_orderstatus, o_custkey, count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT s_suppkey FROM supplier) GROUP BY ALL HAVING count(*) >= 6""")
def q15(t):
    roster = t.supplier.select(F.col("s_suppkey").alias("o_custkey"))
    return gates.suspects(t.orders, roster, "o_orderstatus", "o_custkey", 6)


@plan("q16_stray_edits", """SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""")
def q16(t):
    edits = t.lineitem.select("l_orderkey", "l_linenumber")
    run = t.orders.filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    return gates.stray(edits, run, ["l_orderkey"])


@plan("q17_one_summary_row", """WITH r AS (SELECT l_orderkey, l_linenumber % 2 AS page, l_quantity >= 30 AS s, CAST(l_tax * 100 AS INT) // 5 AS m FROM lineitem),
  p AS (SELECT l_orderkey, page, count(*) FILTER (WHERE s) AS s, max(m) FILTER (WHERE s) AS m FROM r GROUP BY ALL)
  SELECT l_orderkey, CASE WHEN NOT bool_and(s = 1) THEN 'not one summary row' WHEN min(m) <> max(m) THEN 'meeting counts differ' END AS reason FROM p GROUP BY l_orderkey""")
def q17(t):
    rows = t.lineitem.select(
        "l_orderkey", (F.col("l_linenumber") % 2).alias("page"), (F.col("l_quantity") >= 30).alias("s"), F.floor(F.round(F.col("l_tax") * 100) / 5).alias("m")
    )
    return gates.one_summary_row(rows, "l_orderkey", "page", F.col("s"), "m")


@plan("q18_listing_agreement", """SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders""")
def q18(t):
    # the detail pages are a written copy of the orders, read back
    from attesta.session import scratch

    path = scratch(t.spark, "detail")
    fields = ["o_orderstatus", "o_orderpriority"]
    t.orders.select("o_orderkey", *fields).write.parquet(path)
    return gates.listing_agrees(t.orders.select("o_orderkey", *fields), t.spark.read.parquet(path), "o_orderkey", fields)
