"""S: scans, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta.plans.registry import plan
from attesta.session import scratch
from attesta.sources import scans, sinks
from attesta.tables import FACT


@plan("s1_keyed_group_scan", """SELECT 'NATION_' || c_nationkey AS "group", c_custkey, c_name FROM customer""")
def s1(t):
    # landed files of 100 customers each: {nation: [customers]}
    files = t.customer.withColumn("file", F.floor(F.col("c_custkey") / 100))
    group = F.concat(F.lit("NATION_"), "c_nationkey").alias("g")
    per_group = files.groupBy("file", group).agg(F.collect_list(F.struct("c_custkey", "c_name")).alias("rows"))
    docs = per_group.groupBy("file").agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("g", "rows")))).alias("body")
    )
    return scans.keyed_groups(docs, "body", "struct<c_custkey:bigint,c_name:string>")


@plan("s2_tagged_union", """SELECT o_orderkey, 'status_' || lower(o_orderstatus) AS kind FROM orders""")
def s2(t):
    parts = [(f"status_{s.lower()}", t.orders.filter(F.col("o_orderstatus") == s).select("o_orderkey")) for s in "OFP"]
    return scans.tagged_union(parts)


def _event_pages(t):
    e = t.events.select("event_id", "user_id", F.to_date("ts").cast("string").alias("listing"),
                        F.floor(F.col("event_id") / 100).alias("page"))
    totals = e.groupBy("listing").agg(F.count(F.lit(1)).alias("total"))
    pages = e.groupBy("listing", "page").agg(F.array_sort(F.collect_list(F.struct("event_id", "user_id"))).alias("rows"))
    return pages.join(totals, "listing")


@plan("s3_paged_api", """WITH e AS (SELECT event_id, strftime(ts, '%Y-%m-%d') AS listing, event_id // 100 AS page FROM events)
  SELECT listing, count(DISTINCT page) AS pages, count(*) AS rows, count(*) AS total, true AS complete FROM e GROUP BY listing""")
def s3(t):
    return scans.page_completeness(_event_pages(t))


@plan("s3_paged_rows", """SELECT strftime(ts, '%Y-%m-%d') AS listing, event_id // 100 AS page, event_id, user_id FROM events""")
def s3_rows(t):
    return scans.require_complete(_event_pages(t)).drop("pos")


@plan("s4_repeated_rows", r"""WITH p AS (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS h,
    regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS l, len(regexp_extract_all(html, '<a ')) AS anchors FROM pages)
  SELECT page_id, anchors = len(h) AS ok, CAST(unnest(range(1, len(h) + 1)) - 1 AS INTEGER) AS pos, unnest(h) AS href, unnest(l) AS label FROM p""")
def s4(t):
    return scans.repeated_rows(t.pages, "html", r'<a href="([^"]*)">([^<]*)</a>', ["href", "label"], "<a ", ["page_id"])


@plan("s5_sectioned_rows", r"""WITH p AS (SELECT page_id, regexp_extract_all(html, '<(nav|article|footer)>', 1) AS ids,
    string_split_regex(html, '<(?:nav|article|footer)>')[2:] AS parts FROM pages),
  s AS (SELECT page_id, unnest(range(1, len(ids) + 1)) - 1 AS section_no, unnest(ids) AS section, unnest(parts) AS part FROM p),
  h AS (SELECT page_id, section_no, section, regexp_extract_all(part, '<(a|p|h1|b|br)[ >]', 1) AS hits FROM s)
  SELECT page_id, CAST(section_no AS INTEGER) AS section_no, section, CAST(unnest(range(1, len(hits) + 1)) - 1 AS INTEGER) AS hit_no,
    unnest(hits) AS hit FROM h""")
def s5(t):
    return scans.sectioned_rows(t.pages, "html", "<(nav|article|footer)>", "<(a|p|h1|b|br)[ >]", ["page_id"])


@plan("s6_declared_list", r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS s FROM documents),
  n AS (SELECT doc_id, len(list_filter(string_split(s, ', '), lambda x: trim(x) <> '')) AS items,
    len(string_split(s, ' ')) // 10 AS declared FROM l WHERE s <> '')
  SELECT doc_id, count(*) AS lists, CAST(sum(items) AS BIGINT) AS items, count(*) FILTER (WHERE items = declared) AS ok FROM n GROUP BY doc_id""")
def s6(t):
    lines = t.documents.select("doc_id", F.explode(F.split("text", "\n")).alias("s")).filter("s <> ''")
    stated = F.floor(F.size(F.split("s", " ")) / 10).cast("string")
    written = F.concat(F.lit("Listed: "), "s", F.lit(" in total "), stated)
    parsed = lines.select("doc_id", scans.declared_list(written, "Listed:", "in total", ", ").alias("m"))
    return parsed.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("lists"),
        F.sum(F.size("m.items")).alias("items"),
        F.count_if(F.size("m.items") == F.col("m.declared")).alias("ok"),
    )


@plan("s7_curated_csv", """SELECT doc_id, quality, toxic FROM labels""")
def s7(t):
    path = scratch(t.spark, "curated")
    t.labels.write.csv(path, header=True)
    return scans.curated_csv(
        t.spark, path, "doc_id bigint, quality int, toxic int", ["doc_id"], ["quality"], {"quality": [0, 1], "toxic": [0, 1]}
    )


@plan("s8_snapshot_reload", """SELECT c_custkey, c_name, NULL::VARCHAR AS note FROM customer WHERE c_acctbal > 0""")
def s8(t):
    base = scratch(t.spark, "snapshots")
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal")
    sinks.write_snapshot(rows.drop("c_acctbal"), base, "2024-01-01")
    sinks.write_snapshot(rows.filter("c_acctbal > 0").drop("c_acctbal"), base, "2024-01-02")
    expected = rows.drop("c_acctbal").withColumn("note", F.lit(None).cast("string")).schema
    return scans.latest_snapshot(t.spark, base, expected)


@plan("s9_redacting_sink", """SELECT c_custkey, c_name, NULL::DOUBLE AS c_acctbal,
  CASE WHEN c_custkey % 3 = 0 THEN '{"seen":' || c_custkey || '}' ELSE '{"kin":[{"name":"' || c_name || '"},' || c_custkey || ']}' END AS data FROM customer""")
def s9(t):
    base = scratch(t.spark, "redacted")
    key = F.col("c_custkey").cast("string")
    data = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit('{"seen":'), key, F.lit("}"))).otherwise(
        F.concat(F.lit('{"kin":[{"name":"'), "c_name", F.lit('","c_acctbal":{"birth_date":1}},'), key, F.lit('],"c_acctbal":2}'))
    )
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal", data.alias("data"))
    sinks.write_snapshot(rows, base, "2024-01-01", ["c_acctbal"], ["data"])
    return t.spark.read.parquet(base).drop("ds")


PER_PART = 20  # small, so that persons have several parts here


@plan("s10_entity_docs", f"""WITH {FACT},
  r AS (SELECT *, row_number() OVER (PARTITION BY person_id, kind ORDER BY date DESC NULLS LAST, fact_key) AS rank FROM fact)
  SELECT person_id, kind, (rank - 1) // {PER_PART} AS part, count(*) AS n, string_agg(fact_key, ',' ORDER BY rank) AS keys FROM r GROUP BY ALL""")
def s10(t):
    docs = sinks.entity_docs(t.facts(), PER_PART, key_prefix=len("event:"))
    keys = F.array_join(F.transform("facts", lambda f: f["fact_key"]), ",")
    return docs.select("person_id", "kind", "part", F.size("facts").cast("long").alias("n"), keys.alias("keys"))


@plan("s11_district_docs", """SELECT n_name, count(c_custkey) AS n, min(c_custkey) AS first, max(c_custkey) AS last
  FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_name""")
def s11(t):
    members = t.customer.select(F.col("c_nationkey").alias("n_nationkey"), "c_custkey", "c_mktsegment")
    docs = sinks.district_docs(t.nation, members, "n_nationkey", "c_custkey")
    parts = docs.select(
        "n_name", F.size(F.coalesce("people", F.array())).cast("long").alias("k"),
        F.try_element_at("people", F.lit(1))["c_custkey"].alias("lo"),
        F.try_element_at("people", F.lit(-1))["c_custkey"].alias("hi"),
    )
    return parts.groupBy("n_name").agg(F.sum("k").alias("n"), F.min("lo").alias("first"), F.max("hi").alias("last"))


@plan("s12_map_pivot", """WITH m AS (SELECT c_nationkey, c_mktsegment, max(c_custkey) AS v FROM customer GROUP BY ALL)
  SELECT c_nationkey, string_agg(c_mktsegment || '=' || v, ';' ORDER BY c_mktsegment) AS "values",
    string_agg(DISTINCT 'seg:' || left(c_mktsegment, 1), ',' ORDER BY 'seg:' || left(c_mktsegment, 1)) AS sources FROM m GROUP BY c_nationkey""")
def s12(t):
    rows = t.customer.withColumn("src", F.concat(F.lit("seg:"), F.substring("c_mktsegment", 1, 1)))
    out = sinks.pivot_map(rows, "c_nationkey", "c_mktsegment", "c_custkey", "src")
    entries = F.transform(F.map_entries("values"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return out.select("c_nationkey", F.array_join(entries, ";").alias("values"), F.array_join("sources", ",").alias("sources"))


@plan("s13_catalogue", """WITH f AS (SELECT n_regionkey, bool_or(c_acctbal > 9990) AS rich,
    bool_or(c_mktsegment = 'BUILDING') AS building FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_regionkey)
  SELECT r_name, string_agg(n_name, ',' ORDER BY n_nationkey) AS districts, coalesce(bool_or(rich), false) AS rich,
    coalesce(bool_or(building), false) AS building
  FROM region LEFT JOIN nation ON r_regionkey = nation.n_regionkey LEFT JOIN f ON r_regionkey = f.n_regionkey GROUP BY r_name""")
def s13(t):
    flags = (
        t.customer.join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))  # nation: fixed 25 rows
        .groupBy(F.col("n_regionkey").alias("r_regionkey"))
        .agg(F.bool_or(F.col("c_acctbal") > 9990).alias("rich"),
             F.bool_or(F.col("c_mktsegment") == "BUILDING").alias("building"))
    )
    districts = t.nation.select(F.col("n_regionkey").alias("r_regionkey"), "n_nationkey", "n_name")
    out = sinks.catalogue(t.region, districts, flags, "r_regionkey", "n_nationkey")
    listed = F.array_join(F.transform("districts", lambda d: d["n_name"]), ",")
    return out.select("r_name", listed.alias("districts"), "rich", "building")


def _with_k(t):
    return t.events.withColumn("k", F.get_json_object("props", "$.k").cast("long"))


@plan("s14_unseen_scan", """WITH e AS (SELECT *, CAST(props->>'$.k' AS BIGINT) AS k FROM events)
  SELECT event_id, user_id, k FROM e WHERE ts >= TIMESTAMP '2024-01-15' AND NOT EXISTS
    (SELECT 1 FROM e o WHERE o.ts < TIMESTAMP '2024-01-15' AND o.user_id = e.user_id AND o.k = e.k)""")
def s14(t):
    e = _with_k(t)
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    return scans.unseen(e.filter(F.col("ts") >= cut), e.filter(F.col("ts") < cut), ["user_id", "k"]).select(
        "event_id", "user_id", "k"
    )


def _newest(t, grown):
    e = t.events.select("event_id", "user_id", "event_type", "value", "ts")
    # stored so far: per source, the older half, with gaps
    known = e.filter("ts < timestamp_ntz'2024-01-16 00:00:00' AND value > 5")
    wanted = e.select("event_type", "user_id").distinct()
    covered = e.filter("event_type <> 'error' OR value > 150").select("event_type", "user_id").distinct() if grown else wanted
    return scans.newest_until_known(e.drop("value", "ts"), known, "event_type", "event_id", "event_id", covered, wanted, "user_id")


_NEWEST_SQL = """WITH k AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-16' AND value > 5),
  m AS (SELECT event_type, max(event_id) AS mark FROM k GROUP BY event_type)
  SELECT e.event_id, e.user_id, e.event_type FROM events e JOIN m USING (event_type)
  WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.event_id = e.event_id) AND (e.event_id > mark OR {grew})"""


@plan("s15_stop_at_known", _NEWEST_SQL.format(grew="false"))
def s15(t):
    return _newest(t, False)


@plan("s15_coverage_grew", _NEWEST_SQL.format(grew="event_type = 'error'"))
def s15_grown(t):
    return _newest(t, True)
