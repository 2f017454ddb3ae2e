"""J: joins and linking."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta.functions import text
from attesta.operators import evidence, joins, linking
from attesta.plans.registry import plan
from attesta.scale import micros
from attesta.tables import FACT, PERSON, ROSTER

_REMAP = [("n7", 1, 1), ("n7", 1, 2), ("n7", 2, 3), ("n7", 3, 4)]  # fixed values: area, old district, new district


def _records(t):
    remap = t.spark.createDataFrame(_REMAP, "area string, district_n bigint, new_n bigint")
    return linking.new_districts(t.roster(), remap)


@plan("j1_inner", f"""WITH {FACT} SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey""")
def j1(t):
    return t.orders.select("o_orderkey", "o_custkey").join(
        t.customer.select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey")
    ).select("o_orderkey", "c_name")


@plan("j2_exists", """SELECT c_custkey FROM customer WHERE EXISTS
  (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'O')""")
def j2(t):
    open_ = t.orders.filter("o_orderstatus = 'O'")
    return t.customer.join(open_, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@plan("j3_stale", """SELECT p_partkey FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey - l_partkey % 3 = p_partkey)""")
def j3(t):
    run = t.lineitem.select((F.col("l_partkey") - F.col("l_partkey") % 3).alias("l_partkey"))  # a run that lists every third part
    return t.part.join(run, F.col("p_partkey") == F.col("l_partkey"), "left_anti").select("p_partkey")


@plan("j4_suppression", """SELECT doc_id, CASE WHEN EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND toxic = 1)
  THEN 'withheld' ELSE 'published' END AS state FROM documents d""")
def j4(t):
    published, withheld = joins.suppress(t.documents.select("doc_id"), t.labels.filter("toxic = 1"), ["doc_id"])
    return published.withColumn("state", F.lit("published")).unionByName(withheld.withColumn("state", F.lit("withheld")))


_LINK_WITH = f"""WITH {ROSTER}, {PERSON},
  j AS (SELECT r.record_id, r.office, r.area, r.district_n,
    (SELECT count(*) FROM person p WHERE p.area = r.area AND p.weak = r.weak AND p.words = r.words) AS n_exact,
    (SELECT count(*) FROM person p WHERE p.area = r.area AND p.weak = r.weak) AS n_weak,
    (SELECT count(*) FROM person p WHERE p.area = r.area AND p.folded = r.folded) AS n_folded,
    (SELECT count(*) FROM roster o WHERE o.area = r.area AND o.weak = r.weak) AS n_own,
    (SELECT min(person_id) FROM person p WHERE p.area = r.area AND p.weak = r.weak AND p.words = r.words) AS pid FROM roster r),
  k AS (SELECT j.*, p.district_id, CASE WHEN office = 'mayor' THEN p.district_id LIKE j.area || '-%'
      WHEN p.district_id = j.area || '-mayor' THEN true
      WHEN j.area = 'n7' AND district_n = 1 THEN p.district_id IN ('n7-council-1', 'n7-council-2')
      WHEN j.area = 'n7' THEN p.district_id = 'n7-council-' || (district_n + 1)
      ELSE p.district_id = j.area || '-council-' || district_n END AS overlap
    FROM j LEFT JOIN person p ON p.person_id = j.pid),
  w AS (SELECT *, CASE WHEN n_exact = 0 AND n_weak > 0 THEN 'romanization' WHEN n_exact = 0 AND n_folded > 0 THEN 'variant'
    WHEN n_exact = 0 THEN 'unregistered' WHEN n_weak > 1 OR n_own > 1 THEN 'duplicate_name'
    WHEN NOT overlap THEN 'no_overlap' END AS reason FROM k)"""
_LINK_SQL = _LINK_WITH + """
  SELECT record_id, CASE WHEN reason IS NULL THEN 'link' WHEN reason = 'unregistered' THEN reason ELSE 'review' END AS outcome,
    reason, CASE WHEN reason IS NULL THEN pid END AS person_id,
    CASE WHEN n_exact > 0 THEN n_exact WHEN n_weak > 0 THEN n_weak ELSE n_folded END AS hits FROM w"""


@plan("j5_certain_link", _LINK_SQL)
def j5(t):
    return linking.certain_links(_records(t), t.persons())


@plan("j5_review_rows", _LINK_WITH + """
  SELECT w.record_id, w.reason, p.person_id FROM w JOIN roster r USING (record_id) JOIN person p ON p.area = r.area AND CASE w.reason
    WHEN 'romanization' THEN p.weak = r.weak WHEN 'variant' THEN p.folded = r.folded ELSE p.weak = r.weak AND p.words = r.words END
  WHERE w.reason IS NOT NULL AND w.reason <> 'unregistered'""")
def j5_review(t):
    return linking.review_rows(_records(t), t.persons())


@plan("j6_cascade", f"""WITH {ROSTER}, {PERSON}, h AS (
    SELECT record_id, 1 AS tier, person_id FROM roster r JOIN person p ON r.area = p.area AND r.weak = p.weak AND r.words = p.words
    UNION ALL SELECT record_id, 2, person_id FROM roster r JOIN person p ON r.area = p.area AND r.weak = p.weak
    UNION ALL SELECT record_id, 3, person_id FROM roster r JOIN person p ON r.area = p.area AND r.folded = p.folded),
  g AS (SELECT record_id, tier, count(*) AS n, min(person_id) AS one, min(tier) OVER (PARTITION BY record_id) AS best FROM h GROUP BY record_id, tier)
  SELECT r.record_id, tier, CASE WHEN n = 1 THEN one END AS person_id,
    CASE WHEN n IS NULL THEN 'not_found' WHEN n > 1 THEN 'ambiguous' END AS reason
  FROM roster r LEFT JOIN g ON r.record_id = g.record_id AND g.tier = g.best""")
def j6(t):
    return linking.cascade_match(t.roster(), t.persons())


_NATIONWIDE_SQL = f"""WITH {ROSTER}, {PERSON}, c AS (SELECT * REPLACE (CASE WHEN c_acctbal > 9000 THEN '' ELSE '5000' END || weak AS weak,
    CASE WHEN c_acctbal > 9000 THEN '' ELSE '5000' END || folded AS folded) FROM person),
  j AS (SELECT r.record_id, CASE WHEN s_suppkey % 9 <> 8 THEN r.area END AS area,
    (SELECT count(*) FROM c WHERE c.folded = r.folded) AS n_cand, (SELECT count(*) FROM roster o WHERE o.folded = r.folded) AS n_own,
    (SELECT min(person_id) FROM c WHERE c.weak = r.weak AND c.words = r.words) AS pid FROM roster r),
  w AS (SELECT j.*, CASE WHEN n_cand = 0 THEN 'new' WHEN n_cand > 1 OR n_own > 1 THEN 'duplicate_name'
    WHEN pid IS NULL THEN 'romanization_or_variant' WHEN j.area IS NULL THEN 'at_large' WHEN c.area <> j.area THEN 'other_county' END AS reason
    FROM j LEFT JOIN c ON c.person_id = j.pid)"""


def _nationwide(t):
    # most candidates bear names that the roster does not know, so that all reasons occur
    candidates = t.persons().withColumn("name", F.concat(F.when(F.col("c_acctbal") > 9000, "").otherwise("5000"), "name"))
    records = t.roster().withColumn("area", F.when(F.col("s_suppkey") % 9 != 8, F.col("area")))
    return records, candidates


@plan("j7_nationwide", _NATIONWIDE_SQL + " SELECT record_id, reason, CASE WHEN reason IS NULL THEN pid END AS person_id FROM w")
def j7(t):
    return linking.nationwide_links(*_nationwide(t))


@plan("j7_review_rows", _NATIONWIDE_SQL + """ SELECT w.record_id, w.reason, c.person_id FROM w JOIN roster r USING (record_id) JOIN c ON c.folded = r.folded
  WHERE w.reason IS NOT NULL AND w.reason <> 'new'""")
def j7_review(t):
    return linking.nationwide_review(*_nationwide(t))


@plan("j8_override", """SELECT 'd' || d.doc_id AS record_id, CASE WHEN l.quality = 1 THEN 'm' || d.doc_id WHEN d.lang = 'en' THEN 'a' || d.doc_id
    ELSE 'p' || left(sha1('docs:d' || d.doc_id), 10) END AS person_id,
  CASE WHEN l.quality = 1 THEN 'curated' WHEN d.lang = 'en' THEN 'automatic' ELSE 'minted' END AS verified_by
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def j8(t):
    rec = F.concat(F.lit("d"), "doc_id").alias("record_id")
    manual = t.labels.filter("quality = 1").select(rec, F.concat(F.lit("m"), "doc_id").alias("person_id"))
    auto = t.documents.filter("lang = 'en'").select(rec, F.concat(F.lit("a"), "doc_id").alias("person_id"))
    return linking.resolve_identity(t.documents.select(rec), manual, auto, "docs")


@plan("j9_roster_lookup", """WITH i AS (SELECT s_suppkey % 83 AS k, count(*) AS n, min(s_suppkey) AS id FROM supplier GROUP BY ALL)
  SELECT c_custkey, c_custkey % 101 AS k, CASE WHEN n = 1 THEN id END AS s_suppkey,
    CASE WHEN n IS NULL THEN 'no such person' WHEN n > 1 THEN 'duplicate' END AS reason
  FROM customer LEFT JOIN i ON c_custkey % 101 = i.k""")
def j9(t):
    roster = t.supplier.select((F.col("s_suppkey") % 83).alias("k"), "s_suppkey")
    return linking.roster_lookup(t.customer.select("c_custkey", (F.col("c_custkey") % 101).alias("k")), roster, "k", "s_suppkey")


@plan("j10_two_key_lookup", """SELECT o_orderkey, c_nationkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey""")
def j10(t):
    members = t.customer.select(F.col("c_custkey").alias("member"), "c_nationkey", "c_name")
    targets = t.orders.select("o_orderkey", F.col("o_custkey").alias("member")).join(
        t.customer.select(F.col("c_custkey").alias("member"), "c_nationkey"), "member"
    )
    return linking.required_lookup(targets, members, ["member", "c_nationkey"], "c_name").select(
        "o_orderkey", "c_nationkey", "c_name"
    )


@plan("j11_self_check", f"""WITH {PERSON} SELECT person_id, count(*) OVER (PARTITION BY area, weak, words) = 1 AS ok FROM person""")
def j11(t):
    p = linking.with_name_keys(t.persons()).withColumn("key", F.concat_ws("|", "area", "weak", "words"))
    own = p.select("key", F.col("person_id").alias("target"))
    found = linking.roster_lookup(own, p, "key", "person_id")
    return found.select(F.col("target").alias("person_id"), F.col("person_id").eqNullSafe(F.col("target")).alias("ok"))


@plan("j12_parent_fallback", """WITH o AS (SELECT o_custkey - o_custkey % 2 AS o_custkey, c_nationkey, CASE WHEN c_nationkey < 8 THEN '2-HIGH' ELSE o_orderpriority END AS v
    FROM orders JOIN customer ON o_custkey = c_custkey),
  e AS (SELECT o_custkey, min(v) AS v FROM o GROUP BY ALL),
  p AS (SELECT c_nationkey, min(v) AS v FROM o GROUP BY ALL HAVING count(DISTINCT v) = 1)
  SELECT c.c_custkey, coalesce(e.v, p.v) AS value, CASE WHEN e.v IS NOT NULL THEN 'exact' WHEN p.v IS NOT NULL THEN 'inherited' ELSE 'unmatched' END AS how
  FROM customer c LEFT JOIN e ON c_custkey = o_custkey LEFT JOIN p ON c.c_nationkey = p.c_nationkey""")
def j12(t):
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    value = F.when(F.col("c_nationkey") < 8, F.lit("2-HIGH")).otherwise(F.col("o_orderpriority"))  # one value in these nations
    even = F.col("c_custkey") - F.col("c_custkey") % 2  # odd customers have no code of their own
    exact = o.select(even.alias("c_custkey"), "c_nationkey", value.alias("value"))
    rows = t.customer.select("c_custkey", "c_nationkey")
    return linking.unique_parent_fallback(rows, exact, "c_custkey", "c_nationkey", "value").drop("c_nationkey")


@plan("j13_range_expansion", """WITH x AS (SELECT p_partkey AS text_id, p_size % 5 AS r, p_size % 25 AS a, (p_size + 7) % 25 AS b FROM part),
  k AS (SELECT text_id, 0 AS pos, 'REGION_' || r || '+NATION_' || a AS token, 'REGION_' || r AS town_name, 'NATION_' || a AS village_name, r, a AS v FROM x
    UNION ALL SELECT text_id, 1, 'NATION_' || b, 'REGION_' || r, 'NATION_' || b, r, b FROM x
    UNION ALL SELECT text_id, 2, 'REGION_' || (r + 1) % 5, 'REGION_' || (r + 1) % 5, NULL, NULL, NULL FROM x)
  SELECT text_id, token, town_name, village_name, CASE WHEN village_name IS NULL THEN 1 ELSE coalesce(n, 0) END AS hits,
    CASE WHEN village_name IS NULL THEN true ELSE coalesce(n, 0) = 1 END AS ok
  FROM k LEFT JOIN (SELECT n_regionkey, n_nationkey, count(*) AS n FROM nation GROUP BY ALL) u ON u.n_regionkey = k.r AND u.n_nationkey = k.v""")
def j13(t):
    size = F.col("p_size")
    written = F.concat(
        F.lit("REGION_"), size % 5, F.lit("+NATION_"), size % 25, F.lit("、NATION_"), (size + 7) % 25,
        F.lit("、REGION_"), (size % 5 + 1) % 5,
    )
    texts = t.part.select(F.col("p_partkey").alias("text_id"), written.alias("range"))
    universe = t.nation.select(F.concat(F.lit("REGION_"), "n_regionkey").alias("town"), F.col("n_name").alias("village"))
    return linking.expand_ranges(texts, universe).drop("at")


@plan("j14_remap", f"""WITH {ROSTER} SELECT record_id, CASE WHEN area = 'n7' AND district_n = 1 THEN 'n7-council-1,n7-council-2'
  WHEN area = 'n7' THEN 'n7-council-' || (district_n + 1) ELSE area || '-council-' || district_n END AS districts FROM roster""")
def j14(t):
    return _records(t).select("record_id", F.array_join("district_ids", ",").alias("districts"))


@plan("j15_day_session", """WITH r AS (SELECT CAST(ts AS DATE) AS day, event_type, user_id, min(event_id) AS first FROM events
    GROUP BY ALL),
  n AS (SELECT day, event_type, user_id % 50 AS room, string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY first) AS names FROM r GROUP BY ALL)
  SELECT event_id, names FROM events e JOIN n ON CAST(e.ts AS DATE) = n.day AND e.event_type = n.event_type AND n.room = e.event_id % 60""")
def j15(t):
    # a session is a day, a type and a room; media of ten rooms are without records
    e = t.events.withColumn("day", F.to_date("ts"))
    media = e.select("event_id", "day", "event_type", (F.col("event_id") % 60).alias("room"))
    records = e.select("day", "event_type", (F.col("user_id") % 50).alias("room"), "user_id", F.col("event_id").alias("seen"))
    out = joins.day_session_names(media, records, ["day", "event_type", "room"], "user_id", "seen")
    return out.select("event_id", F.array_join("names", ",").alias("names"))


@plan("j16_max_overlap", """WITH d AS (SELECT DISTINCT event_type, CAST(ts AS DATE) AS doc, user_id FROM events),
  g AS (SELECT DISTINCT event_type, CAST(ts AS DATE) + CAST(event_id % 4 AS INTEGER) AS grp, user_id FROM events),
  s AS (SELECT event_type, doc, grp, count(*) AS score FROM d JOIN g USING (event_type, user_id) GROUP BY ALL),
  m AS (SELECT *, max(score) OVER w AS best FROM s WINDOW w AS (PARTITION BY event_type, doc)),
  c AS (SELECT *, doc = grp AS same_date, bool_or(doc = grp) OVER (PARTITION BY event_type, doc) AS any_same FROM m WHERE score = best)
  SELECT event_type, strftime(doc, '%Y-%m-%d') AS doc, strftime(grp, '%Y-%m-%d') AS grp, score, same_date FROM c WHERE same_date OR NOT any_same""")
def j16(t):
    # a member is listed in the group of its day or of one of the three days after
    shown = lambda day: F.date_format(day, "yyyy-MM-dd")
    docs = t.events.select("event_type", shown("ts").alias("doc"), "user_id")
    groups = t.events.select("event_type", shown(F.date_add(F.to_date("ts"), (F.col("event_id") % 4).cast("int"))).alias("grp"), "user_id")
    return joins.best_overlap(docs, groups, "event_type", "doc", "grp", "user_id", F.col("doc"), F.col("grp"))


@plan("j17_containment", r"""SELECT doc_id, item_id FROM documents d JOIN benchmark b ON
  contains(regexp_replace(d.text, '\s+', '', 'g'), regexp_replace(b.text, '\s+', '', 'g'))""")
def j17(t):
    return evidence.contained_phrases(t.documents, "doc_id", "text", t.benchmark, "item_id", "text")


@plan("j18_span_interval", """WITH s AS (SELECT conv_id, turn, coalesce(sum(length(text) + 1) OVER (PARTITION BY conv_id ORDER BY turn
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lo, length(text) AS len FROM conversations)
  SELECT conv_id, CAST(lo + len // 2 AS BIGINT) AS pos, turn FROM s WHERE len > 0
  UNION ALL SELECT conv_id, CAST(lo AS BIGINT), turn FROM s WHERE len > 0""")
def j18(t):
    from attesta.scale import OrderedGroups

    turns = t.conversations.select("conv_id", "turn", F.length("text").cast("long").alias("len"))
    ends = OrderedGroups(turns, ["conv_id"], ["turn"], "turn").running_sum("upto", F.col("len") + 1).rows()
    spans = ends.select("conv_id", "turn", (F.col("upto") - F.col("len") - 1).alias("lo"), "len")
    points = spans.select("conv_id", F.explode(F.array(F.col("lo"), F.col("lo") + F.floor(F.col("len") / 2))).alias("pos"))
    spans = spans.withColumn("hi", F.col("lo") + F.col("len"))
    return joins.enclosing_spans(points, spans, "conv_id", "pos", "lo", "hi").select("conv_id", "pos", "turn")


@plan("j19_null_safe_first", """WITH s AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS dept FROM orders),
  m AS (SELECT l_orderkey * 10 + l_linenumber AS media, CAST(l_shipdate AS DATE) AS day, CASE WHEN l_linestatus = 'O' THEN 'O' END AS dept FROM lineitem)
  SELECT o_orderkey, (SELECT min(media) FROM m WHERE m.day = s.day AND m.dept IS NOT DISTINCT FROM s.dept) AS media FROM s""")
def j19(t):
    src = t.orders.select(
        "o_orderkey", F.to_date("o_orderdate").alias("day"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("dept"),
    )
    media = t.lineitem.select(
        F.to_date("l_shipdate").alias("day"), F.when(F.col("l_linestatus") == "O", F.lit("O")).alias("dept"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("media"),
    )
    return joins.first_match(src, media, ["day", "dept"], [], ["media"]).select("o_orderkey", "media")


@plan("j20_reconcile", """WITH l AS (SELECT CASE WHEN l_quantity > 20 THEN l_orderkey ELSE -l_orderkey - 1 END AS k, count(*) AS n FROM lineitem GROUP BY ALL),
  r AS (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey ELSE o_orderkey + 1000000000 END AS k, count(*) AS n FROM orders GROUP BY ALL)
  SELECT coalesce(l.k, r.k) AS k, coalesce(l.n, 0) AS n_left, coalesce(r.n, 0) AS n_right,
    CASE WHEN r.k IS NULL THEN 'only_left' WHEN l.k IS NULL THEN 'only_right' ELSE 'both' END AS side FROM l FULL JOIN r ON l.k = r.k""")
def j20(t):
    # keys that the other side cannot have make the one-sided rows
    line, order = F.col("l_orderkey"), F.col("o_orderkey")
    left = t.lineitem.select(F.when(F.col("l_quantity") > 20, line).otherwise(-line - 1).alias("k"))
    right = t.orders.select(F.when(F.col("o_orderstatus") != "P", order).otherwise(order + 1_000_000_000).alias("k"))
    return joins.reconcile(left, right, ["k"])


@plan("j21_contradiction", """WITH a AS (SELECT DISTINCT CAST(ts AS DATE) AS day, user_id FROM events WHERE event_type = 'error'),
  b AS (SELECT event_id, CAST(ts AS DATE) AS day, user_id, event_id // 4 AS sid FROM events WHERE event_type = 'purchase'),
  x AS (SELECT DISTINCT sid FROM b JOIN a USING (day, user_id))
  SELECT event_id, sid FROM b WHERE sid NOT IN (SELECT sid FROM x)""")
def j21(t):
    e = t.events.withColumn("day", F.to_date("ts")).withColumn("sid", F.floor(F.col("event_id") / 4))
    return joins.drop_contradicted(
        e.filter("event_type = 'error'"), e.filter("event_type = 'purchase'"), ["day", "user_id"], "sid"
    ).select("event_id", "sid")


@plan("j22_sole_owner", """WITH c AS (SELECT l_orderkey, l_suppkey % 4 AS owner FROM lineitem)
  SELECT l_orderkey, owner FROM c WHERE l_orderkey IN (SELECT l_orderkey FROM c GROUP BY 1 HAVING count(DISTINCT owner) = 1)""")
def j22(t):
    claims = t.lineitem.select("l_orderkey", (F.col("l_suppkey") % 4).alias("owner"))
    return joins.sole_owner(claims, "l_orderkey", "owner")


@plan("j23_all_or_nothing", """SELECT l_orderkey, count(*) AS members FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND p_size > 10
  GROUP BY l_orderkey HAVING bool_and(p_partkey IS NOT NULL)""")
def j23(t):
    known = t.part.filter("p_size > 10").select(F.col("p_partkey").alias("l_partkey"), F.lit(True).alias("known"))
    members = t.lineitem.select("l_orderkey", "l_partkey").join(known, "l_partkey", "left")
    return joins.all_or_nothing(members, "l_orderkey", F.col("known").isNotNull())


@plan("j24_two_evidence", """WITH c AS (SELECT user_id, epoch_us(ts) AS p FROM events WHERE event_type = 'view'),
  l AS (SELECT user_id, epoch_us(ts) AS p FROM events WHERE event_type = 'purchase')
  SELECT c.user_id, c.p AS call_pos, min(l.p) AS label_pos FROM c JOIN l ON c.user_id = l.user_id AND l.p > c.p GROUP BY ALL""")
def j24(t):
    e = t.events.select("user_id", "event_type", micros("ts").alias("p"))
    return joins.call_then_label(e.filter("event_type = 'view'"), e.filter("event_type = 'purchase'"), ["user_id"], "p")


@plan("j25_sole_donor", """WITH d AS (SELECT s_suppkey % 61 AS k, count(*) AS n, min(s_nationkey) AS donor FROM supplier GROUP BY ALL)
  SELECT c_custkey, coalesce(CASE WHEN c_custkey % 4 = 0 THEN c_nationkey END, CASE WHEN n = 1 THEN donor END, CASE WHEN c_custkey % 71 < 5 THEN 99 END) AS home,
    CASE WHEN c_custkey % 4 = 0 OR n = 1 OR c_custkey % 71 < 5 THEN NULL WHEN n IS NULL THEN 'no_home' ELSE 'ambiguous_home' END AS reason
  FROM customer LEFT JOIN d ON c_custkey % 71 = d.k""")
def j25(t):
    rows = t.customer.select(
        "c_custkey", (F.col("c_custkey") % 71).alias("k"), F.when(F.col("c_custkey") % 4 == 0, F.col("c_nationkey")).alias("home")
    )
    donors = t.supplier.select((F.col("s_suppkey") % 61).alias("k"), F.col("s_nationkey").alias("home"))
    curated = t.nation.filter("n_nationkey < 5").select(F.col("n_nationkey").cast("long").alias("k"), F.lit(99).alias("home"))
    return linking.fill_from_sole_donor(rows, donors, curated, "k", "home").drop("k")


_FILES = [  # fixed values: office, areas, number range, preference (lower first), path
    ("T1", ["ECONOMY", "SMALL"], 1, 20, 2, "a/one"), ("T1", ["ECONOMY"], 15, 30, 1, "b/one"),
    ("T1", ["LARGE", "MEDIUM"], 1, 50, 1, "b/two"), ("T2", ["PROMO", "STANDARD"], 10, 40, 1, "b/three"),
]


@plan("j26_file_coverage", """WITH f(office, area, lo, hi, pref, path) AS (VALUES ('T1','ECONOMY',1,20,2,'a/one'),('T1','SMALL',1,20,2,'a/one'),
    ('T1','ECONOMY',15,30,1,'b/one'),('T1','LARGE',1,50,1,'b/two'),('T1','MEDIUM',1,50,1,'b/two'),('T2','PROMO',10,40,1,'b/three'),('T2','STANDARD',10,40,1,'b/three'))
  SELECT p_partkey, (SELECT path FROM f WHERE f.office = CASE WHEN p_partkey % 2 = 0 THEN 'T1' ELSE 'T2' END AND f.area = p_type
    AND p_size BETWEEN lo AND hi ORDER BY pref, path LIMIT 1) AS path FROM part""")
def j26(t):
    files = t.spark.createDataFrame(_FILES, "office string, areas array<string>, lo int, hi int, preference int, path string")
    targets = t.part.select(
        "p_partkey", F.when(F.col("p_partkey") % 2 == 0, "T1").otherwise("T2").alias("office"), F.col("p_type").alias("area"),
        F.col("p_size").alias("number"),
    )
    return joins.covering_file(targets, files, "office", "area", "number").select("p_partkey", "path")


@plan("j27_link_status", """SELECT c_custkey, CASE WHEN EXISTS (SELECT 1 FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    WHERE o_custkey = c_custkey AND l_quantity = 50 AND o_orderstatus = 'F') THEN 'full'
  WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') THEN 'link-only' ELSE 'missing' END AS status FROM customer""")
def j27(t):
    listed = t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    # a line of another quantity names no order, so that few orders have a text
    key = F.when(F.col("l_quantity") == 50, F.col("l_orderkey")).otherwise(-F.col("l_orderkey") - 1)
    text = t.lineitem.select(key.alias("o_orderkey")).distinct().withColumn("text", F.lit(True))
    best = listed.join(text, "o_orderkey", "left").groupBy("c_custkey").agg(F.bool_or(F.col("text").isNotNull()).alias("full"))
    status = F.when(F.col("full"), "full").when(F.col("full").isNotNull(), "link-only").otherwise("missing")
    return t.customer.join(best, "c_custkey", "left").select("c_custkey", status.alias("status"))


@plan("j28_scoped_fix", """WITH w AS (SELECT doc_id, string_split(text, ' ')[1] AS raw FROM documents),
  f AS (SELECT l.doc_id, w.raw, upper(w.raw) AS fixed FROM labels l JOIN w USING (doc_id) WHERE quality = 1)
  SELECT w.doc_id, w.raw, coalesce(f.fixed, w.raw) AS name FROM w LEFT JOIN f ON w.doc_id = f.doc_id AND w.raw = f.raw""")
def j28(t):
    rows = t.documents.select("doc_id", F.split_part("text", F.lit(" "), F.lit(1)).alias("raw"))
    fixes = rows.join(t.labels.filter("quality = 1"), "doc_id", "left_semi").withColumn("fixed", text.upper(F.col("raw")))
    return joins.scoped_fixes(rows, fixes, "doc_id", "raw")
