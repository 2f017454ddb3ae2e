"""W: ordered sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta.operators import sequence as seq
from attesta.plans.registry import plan
from attesta.scale import OrderedGroups, micros


def _ymd(c):
    return F.date_format(c, "yyyy-MM-dd")


_LINES = """d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
  l AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) - 1 AS n, unnest(ls) AS line FROM d)"""


@plan("w1_list_order", """SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS list_order FROM orders""")
def w1(t):
    o = t.orders.select("o_orderkey", "o_orderstatus")
    return OrderedGroups(o, ["o_orderstatus"], ["o_orderkey"], "o_orderkey").number("list_order").rows().drop("o_orderstatus")


@plan("w2_latest_state", """SELECT user_id, arg_max(event_type, event_id) = 'error' AS suspended FROM events GROUP BY user_id""")
def w2(t):
    return seq.latest_state(t.events, ["user_id"], ["event_id"], "event_type").select("user_id", (F.col("state") == "error").alias("suspended"))


@plan("w3_earliest_row", """SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, min(event_id) AS event_id, count(DISTINCT event_type) > 1 AS conflict FROM events GROUP BY ALL""")
def w3(t):
    e = t.events.select("user_id", _ymd("ts").alias("day"), "event_id", "event_type")
    return seq.earliest(e, ["user_id", "day"], [F.col("event_id")], ["event_id"], same="event_type")


@plan("w3_earliest_or_fail", """SELECT l_orderkey, min(l_linenumber) AS l_linenumber FROM lineitem GROUP BY l_orderkey""")
def w3_strict(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_orderkey") % 7).alias("group"))
    return seq.earliest_or_fail(lines, ["l_orderkey"], [F.col("l_linenumber")], ["l_linenumber"], "group")


@plan("w4_preferred_source", """SELECT user_id, CAST(props->>'$.k' AS BIGINT) AS k, arg_min(event_id, [CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 ELSE 2 END, event_id]) AS event_id
  FROM events GROUP BY ALL""")
def w4(t):
    e = t.events.select("user_id", F.get_json_object("props", "$.k").cast("long").alias("k"), "event_id", "event_type")
    pref = F.when(F.col("event_type") == "view", 0).when(F.col("event_type") == "click", 1).otherwise(2)
    return seq.earliest(e, ["user_id", "k"], [pref, F.col("event_id")], ["event_id"])


def _owned(t):
    role, n = F.col("role"), F.length("text")
    owner = F.when(role == "system", seq.CHAIR).when((role == "user") & (n % 5 == 0), seq.OUTSIDER).when(
        role == "user", F.concat(F.lit("m"), (n % 3).cast("string"))
    )
    return t.conversations.withColumn("owner", owner)


_ATTRIBUTED = """o AS (SELECT conv_id, turn, text, role, CASE WHEN role = 'system' THEN 'CHAIR' WHEN role = 'user' AND length(text) % 5 = 0 THEN 'OTHER'
    WHEN role = 'user' THEN 'm' || (length(text) % 3) END AS owner FROM conversations),
  s AS (SELECT *, last_value(CASE WHEN owner <> 'CHAIR' THEN owner END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS state FROM o),
  w AS (SELECT *, CASE WHEN owner IS NOT DISTINCT FROM 'CHAIR' OR state = 'OTHER' THEN NULL ELSE state END AS attributed FROM s)"""


@plan("w5_attribution", f"WITH {_ATTRIBUTED} SELECT conv_id, turn, owner, attributed FROM w")
def w5(t):
    return seq.attribute(_owned(t), ["conv_id"], "turn", "owner").select("conv_id", "turn", "owner", "attributed")


def _runs(t):
    return seq.runs(t.events, ["user_id"], ["ts", "event_id"], micros("ts"), "event_type", "event_id")


_RUNS = """p AS (SELECT user_id, event_id, ts, event_type, lag(event_type) OVER w IS DISTINCT FROM event_type AS change FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
  g AS (SELECT *, CAST(sum(change::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS run FROM p),
  r AS (SELECT user_id, run, event_type, min(event_id) AS start, count(*) AS n FROM g GROUP BY ALL)"""


@plan("w6_runs", f"WITH {_RUNS} SELECT * FROM r")
def w6(t):
    return _runs(t)


@plan("w7_longest_block", f"""WITH {_RUNS}, b AS (SELECT *, event_type = 'view' AS own, event_type IN ('view', 'click') AS inside,
    sum((event_type NOT IN ('view', 'click'))::INT) OVER (PARTITION BY user_id ORDER BY run) AS block FROM r),
  top AS (SELECT user_id, arg_min(block, [-n, run]) AS block FROM b WHERE own GROUP BY user_id)
  SELECT b.user_id, arg_min(start, run) AS start, CAST(sum(n) AS BIGINT) AS n FROM b JOIN top ON b.user_id = top.user_id AND b.block = top.block WHERE own GROUP BY b.user_id""")
def w7(t):
    allowed = F.col("event_type").isin("view", "click")
    return seq.longest_own_run(_runs(t), ["user_id"], "event_type", F.lit("view"), allowed)


@plan("w8_interleave", """WITH p AS (SELECT conv_id, role, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS prev FROM conversations)
  SELECT conv_id, count(*) FILTER (WHERE prev IS NOT NULL AND prev <> role) - (count(DISTINCT role) - 1) AS interleave FROM p GROUP BY conv_id""")
def w8(t):
    return seq.interleave(t.conversations, ["conv_id"], ["turn"], "turn", "role")


@plan("w9_first_listed_start", """WITH m AS (SELECT DISTINCT user_id % 5 AS council, datediff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS day FROM events),
  l AS (SELECT DISTINCT user_id % 5 AS council, user_id, datediff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS day FROM events WHERE event_type = 'signup'),
  f AS (SELECT council, user_id, min(day) AS start, count(*) AS listed FROM l GROUP BY ALL)
  SELECT council, user_id, start, (SELECT count(*) FROM m WHERE m.council = f.council AND m.day >= f.start) AS meetings, listed FROM f""")
def w9(t):
    e = t.events.select((F.col("user_id") % 5).alias("council"), "user_id", F.unix_date(F.to_date("ts")).cast("long").alias("day"), "event_type")
    meetings = e.select("council", "day").distinct()
    lists = e.filter("event_type = 'signup'").select("council", "user_id", "day").distinct()
    return seq.meetings_since_first_listing(meetings, lists, "council", "day", "user_id")


@plan("w10_successor_cutoff", """WITH f AS (SELECT user_id, min(event_id) AS cut FROM events WHERE event_type = 'signup' GROUP BY user_id)
  SELECT event_id, e.user_id, cut IS NULL OR event_id < cut AS ok FROM events e LEFT JOIN f ON f.user_id = e.user_id + 1 WHERE event_type = 'signup'""")
def w10(t):
    lists = t.events.filter("event_type = 'signup'").select("event_id", "user_id")
    pairs = lists.select(F.col("user_id").alias("predecessor")).distinct().withColumn("successor", F.col("predecessor") + 1)
    return seq.before_successor(lists, pairs, "user_id", "event_id")


@plan("w11_first_verbatim", r"""WITH s AS (SELECT doc_id, regexp_replace(text, '\s+', '', 'g') AS s FROM documents)
  SELECT doc_id, length(s) < 10 OR row_number() OVER (PARTITION BY s ORDER BY doc_id) = 1 AS accepted FROM s""")
def w11(t):
    return seq.first_verbatim(t.documents, "doc_id", ["doc_id"], "text")


@plan("w12_carry_forward", """WITH c AS (SELECT page_id // 10 AS tab, page_id, CASE WHEN page_id % 3 = 1 THEN split_part(url, '/', 3) ELSE '' END AS cell FROM pages)
  SELECT page_id, last_value(nullif(cell, '') IGNORE NULLS) OVER (PARTITION BY tab ORDER BY page_id) AS filled FROM c""")
def w12(t):
    cell = F.when(F.col("page_id") % 3 == 1, F.split_part("url", F.lit("/"), F.lit(3))).otherwise(F.lit(" "))
    rows = t.pages.select("page_id", F.floor(F.col("page_id") / 10).alias("tab"), cell.alias("cell"))
    return seq.carry_blanks(rows, ["tab"], "page_id", "cell").select("page_id", "filled")


@plan("w13_continuation_merge", f"""WITH {_LINES}, k AS (SELECT doc_id, n, line, CASE WHEN n % 4 = 2 THEN '' ELSE split_part(line, ' ', 1) END AS name FROM l),
  p AS (SELECT *, lag(name) OVER w AS pn, lag(line) OVER w AS pt FROM k WINDOW w AS (PARTITION BY doc_id ORDER BY n)),
  j AS (SELECT *, pt IS NOT NULL AND (trim(name) = '' OR (pn = name AND NOT regexp_matches(pt, '[.!?。]\\s*$'))) AS cont FROM p),
  g AS (SELECT *, CAST(sum((NOT cont)::INT) OVER (PARTITION BY doc_id ORDER BY n) AS BIGINT) AS part FROM j)
  SELECT doc_id, part, count(*) AS lines, md5(string_agg(line, '' ORDER BY n)) AS text FROM g GROUP BY ALL""")
def w13(t):
    lines = F.split("text", "\n")
    names = F.transform(lines, lambda s, i: F.when(i % 4 == 2, "").otherwise(F.split_part(s, F.lit(" "), F.lit(1))))
    return seq.merge_continuations(t.documents, ["doc_id"], names, lines).withColumn("text", F.md5("text"))


@plan("w14_wrapped_bullets", rf"""WITH {_LINES}, g AS (SELECT *, CAST(sum(regexp_matches(line, '^[A-M]')::INT) OVER (PARTITION BY doc_id ORDER BY n) AS BIGINT) AS part FROM l)
  SELECT doc_id, part, count(*) AS lines, md5(string_agg(line, ' ' ORDER BY n)) AS text FROM g WHERE part > 0 GROUP BY ALL""")
def w14(t):
    return seq.merge_bullets(t.documents, ["doc_id"], F.split("text", "\n"), "^[A-M]").withColumn("text", F.md5("text"))


@plan("w15_marker_blocks", rf"""WITH {_LINES}, h AS (SELECT *, CASE WHEN length(line) < 80 THEN line END AS h FROM l),
  b AS (SELECT *, CAST(sum((h IS NOT NULL)::INT) OVER w AS BIGINT) AS block, last_value(h IGNORE NULLS) OVER w AS heading FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY n))
  SELECT doc_id, block, md5(max(heading)) AS heading, count(*) AS lines, CAST(sum(length(line)) AS BIGINT) AS chars FROM b WHERE block > 0 GROUP BY doc_id, block""")
def w15(t):
    b = seq.blocks(t.documents, ["doc_id"], F.split("text", "\n"), lambda s: F.length(s) < 80)
    chars = F.aggregate("body", F.lit(0).cast("long"), lambda n, s: n + F.length(s))
    return b.select("doc_id", "block", F.md5("heading").alias("heading"), F.size("body").cast("long").alias("lines"), chars.alias("chars"))


@plan("w16_gap_clusters", """WITH p AS (SELECT user_id, event_id, epoch_us(ts) AS x, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap FROM events),
  c AS (SELECT *, CAST(sum((gap IS NULL OR gap > 1800000000)::INT) OVER (PARTITION BY user_id ORDER BY x, event_id) AS BIGINT) AS cluster FROM p)
  SELECT user_id, cluster, count(*) AS n, min(x) AS first, max(x) AS last, CAST(sum(x) // count(*) AS BIGINT) AS mean FROM c GROUP BY ALL""")
def w16(t):
    return seq.gap_clusters(t.events, ["user_id"], ["event_id"], micros("ts"), 1_800_000_000)


@plan("w17_nearest_within", """WITH p AS (SELECT event_id, user_id, epoch_us(ts) AS x FROM events WHERE event_type = 'purchase'),
  m AS (SELECT DISTINCT user_id, epoch_us(ts) AS x FROM events WHERE event_type = 'view')
  SELECT event_id, p.user_id, p.x, CASE WHEN count(m.x) = 1 THEN min(m.x) END AS mark
  FROM p LEFT JOIN m ON p.user_id = m.user_id AND abs(p.x - m.x) <= 14400000000 GROUP BY ALL""")
def w17(t):
    e = t.events.select("event_id", "user_id", micros("ts").alias("x"), "event_type")
    points = e.filter("event_type = 'purchase'").drop("event_type")
    return seq.nearest_within(points, e.filter("event_type = 'view'"), ["user_id"], "x", 14_400_000_000)


@plan("w18_sequence_key", """SELECT event_id, ((month(ts) * 100 + day(ts)) * 2 + (hour(ts) >= 12)::INT) * 100 + hour(ts) % 12 AS seq FROM events""")
def w18(t):
    key = seq.sequence_key(F.month("ts").cast("long"), F.dayofmonth("ts"), F.hour("ts") >= 12, F.hour("ts") % 12)
    return t.events.select("event_id", key.alias("seq"))


@plan("w19_poison_flag", """SELECT event_id, bool_or(event_type = 'error' AND value > 100) OVER (PARTITION BY event_id // 5) AS poisoned FROM events""")
def w19(t):
    rows = t.events.withColumn("sid", F.floor(F.col("event_id") / 5))
    return seq.poisoned(rows, "sid", F.expr("event_type = 'error' AND value > 100")).select("event_id", "poisoned")


@plan("w20_citation_numbers", r"""WITH h AS (SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, page_id % 2 AS day, split_part(url, '/', 4) AS doc FROM pages),
  f AS (SELECT doc, host, day, min(page_id) AS first FROM h GROUP BY ALL), r AS (SELECT doc, host, day, row_number() OVER (PARTITION BY doc ORDER BY first) AS number FROM f)
  SELECT page_id, number FROM h JOIN r USING (doc, host, day)""")
def w20(t):
    refs = t.pages.select(F.split_part("url", F.lit("/"), F.lit(4)).alias("doc"), F.try_parse_url("url", F.lit("HOST")).alias("host"), (F.col("page_id") % 2).alias("day"), "page_id")
    return seq.number_citations(refs, ["doc"], ["host", "day"], "page_id").select("page_id", "number")


@plan("w21_first_listing", """SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS month, min(o_orderkey) AS o_orderkey FROM orders GROUP BY ALL""")
def w21(t):
    o = t.orders.select("o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderkey")
    return seq.earliest(o, ["o_custkey", "month"], [F.col("o_orderkey")], ["o_orderkey"])
