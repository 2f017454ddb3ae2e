"""P: projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta.functions.ids import safe_url
from attesta.operators import filters
from attesta.plans.registry import plan
from attesta.tables import FACT


@plan("p1_json_path", """SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k FROM events WHERE CAST(props->>'$.k' AS BIGINT) >= 50""")
def p1(t):
    k = F.from_json("props", "k bigint")["k"]
    return t.events.select("event_id", k.alias("k")).filter("k >= 50")


@plan("p2_scope_prefix", f"""WITH {FACT} SELECT kind || ':' || fact_key AS fact_key, kind FROM fact WHERE kind = 'view'""")
def p2(t):
    scoped = t.facts().select(F.concat_ws(":", "kind", "fact_key").alias("fact_key"), "kind")
    return scoped.filter(F.col("fact_key").startswith("view:"))


@plan("p3_currency", """SELECT o_orderkey FROM orders WHERE year(o_orderdate) = 1997 AND o_orderstatus <> 'F'
  AND o_orderpriority NOT IN ('1-URGENT', '2-HIGH') AND o_totalprice <= 400000""")
def p3(t):
    p = F.col("o_orderpriority")
    current = filters.is_current(
        F.year("o_orderdate") == 1997,
        F.when(F.col("o_orderstatus") == "F", F.lit("left")),
        F.when(p.isin("1-URGENT", "2-HIGH"), p),
        F.when(F.col("o_totalprice") > 400000, F.col("o_totalprice")),
    )
    return t.orders.filter(current).select("o_orderkey")


_SHAPES = {
    "query": r"example\.(com|org|net)/[a-z]{2}/\d+\?",
    "anchor": r"example\.(com|org|net)/[a-z]{2}/\d+#",
    "file": r"example\.(com|org|net)/[a-z]{2}/\d+\.html$",
    "plain": r"example\.(com|org|net)/[a-z]{2}/\d+/?$",
}
_SHAPE_SQL = r"""SELECT page_id, CASE WHEN NOT regexp_matches(url, '/(en|de)/') THEN 'ignore'
  WHEN regexp_matches(url, '/\d+\?') THEN 'query' WHEN regexp_matches(url, '/\d+#') THEN 'anchor'
  WHEN regexp_matches(url, '/\d+\.html$') THEN 'file' WHEN regexp_matches(url, '/\d+/?$') THEN 'plain' ELSE 'unknown' END AS shape FROM pages"""


@plan("p4_parse_or_classify", _SHAPE_SQL)
def p4(t):
    return t.pages.select("page_id", filters.classify(F.col("url"), "/(en|de)/", _SHAPES).alias("shape"))


@plan("p4_known_shapes", f"SELECT * FROM ({_SHAPE_SQL}) WHERE shape <> 'ignore'")
def p4_known(t):
    return filters.known_shapes(t.pages, "url", "/(en|de)/", _SHAPES).select("page_id", "shape")


@plan("p5_membership", """SELECT doc_id FROM documents WHERE list_contains(list_transform(string_split(text, ','), lambda s: trim(s)), 'the of')
  OR list_contains(list_transform(string_split(text, ','), lambda s: trim(s)), lang)""")
def p5(t):
    listed = filters.names_list(F.col("text"), ",")
    d = t.documents.select("doc_id", "lang", listed.alias("listed"))
    return d.filter(F.array_contains("listed", "the of") | F.expr("array_contains(listed, lang)")).select("doc_id")


@plan("p6_public_projection", """SELECT conv_id, turn // 4 AS page, string_agg(role, ',' ORDER BY turn) AS roles
  FROM conversations GROUP BY ALL""")
def p6(t):
    # summary documents of at most four turns, then only the whitelisted fields
    turns = t.conversations.groupBy("conv_id", F.floor(F.col("turn") / 4).alias("page")).agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    )
    public = turns.withColumn("turns", F.transform("turns", lambda x: F.struct(x["turn"], x["role"])))
    return public.select("conv_id", "page", F.array_join(F.transform("turns", lambda x: x["role"]), ",").alias("roles"))


@plan("p7_term_start", """WITH s AS (SELECT user_id, min(ts) AS since FROM events WHERE event_type = 'signup' GROUP BY user_id)
  SELECT event_id, e.user_id FROM events e JOIN s USING (user_id) WHERE ts >= since""")
def p7(t):
    starts = t.events.filter("event_type = 'signup'").select("user_id", F.col("ts").alias("start"))
    return filters.since(t.events, starts, "user_id", "ts", "start").select("event_id", "user_id")


@plan("p8_url_safety", """SELECT page_id, CASE WHEN page_id % 10 <> 7 THEN replace(url, 'http://', 'https://') END AS url FROM pages""")
def p8(t):
    url = F.when(F.col("page_id") % 10 == 7, F.concat(F.lit("javascript:"), "url")).otherwise(F.col("url"))
    return t.pages.select("page_id", safe_url(url).alias("url"))


@plan("p9_noise_exclusion", """SELECT doc_id FROM documents WHERE NOT regexp_matches(text, 'Licensed under|All rights reserved|token = ')""")
def p9(t):
    return t.documents.filter(~F.col("text").rlike("Licensed under|All rights reserved|token = ")).select("doc_id")


@plan("p10_readability", r"""WITH r AS (SELECT doc_id, length(text) AS n, length(regexp_replace(text, '[A-Za-z ]', '', 'g')) AS other,
    length(text) - length(regexp_replace(text, '[%#$*&]', '', 'g')) AS broken FROM documents)
  SELECT doc_id, coalesce(n > 0 AND (n - other) / n > 0.9 AND broken / n <= 0.02, false) AS ok FROM r""")
def p10(t):
    return t.documents.select("doc_id", filters.readable(F.col("text"), "A-Za-z ", 0.9, "%#$*&").alias("ok"))


@plan("p11_verified_final", """SELECT d.doc_id, row_number() OVER (PARTITION BY lang ORDER BY d.doc_id DESC) AS place FROM documents d LEFT JOIN labels l
  ON d.doc_id = l.doc_id WHERE l.quality IS NOT DISTINCT FROM 1""")
def p11(t):
    from attesta.scale import OrderedGroups

    j = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left").filter(F.col("quality").eqNullSafe(1))
    newest = j.select("doc_id", "lang", (-F.col("doc_id")).alias("newest"))
    return OrderedGroups(newest, ["lang"], ["newest"], "newest").number("place").rows().select("doc_id", "place")
