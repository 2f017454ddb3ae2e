"""A: aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta.operators import aggregates as agg
from attesta.plans.registry import plan
from attesta.scale import micros


def _k():
    return F.get_json_object("props", "$.k").cast("long")


def _ymd(c):
    return F.date_format(c, "yyyy-MM-dd")


@plan("a1_status_rates", """WITH n AS (SELECT user_id, count(*) AS total, count(*) FILTER (WHERE event_type = 'view') AS present,
    count(*) FILTER (WHERE event_type = 'click') AS leave FROM events GROUP BY user_id)
  SELECT c_custkey AS user_id, coalesce(total, 0) AS total, coalesce(present, 0) AS present, coalesce(leave, 0) AS leave,
    coalesce(present / total, 0) AS present_rate, coalesce(leave / total, 0) AS leave_rate FROM customer LEFT JOIN n ON c_custkey = user_id""")
def a1(t):
    people = t.customer.select(F.col("c_custkey").alias("user_id"))
    kind = F.col("event_type")
    return agg.status_rates(people, t.events, "user_id", kind == "view", kind == "click")


def _tables(t):
    """Per line: a table of q meetings with its counted marks; tables on status O have no absence column."""
    q, flag, no = F.col("l_quantity").cast("long"), F.col("l_returnflag"), F.col("l_linenumber")
    marked = lambda cond: F.when(cond, q).otherwise(F.lit(0).cast("long"))
    one_kind = lambda kinds, i, cond: F.when(cond, F.create_map(F.element_at(F.array(*[F.lit(k) for k in kinds]), i + 1), q))
    leave, duty = flag == "A", (flag == "N") & (no % 3 == 0)
    return t.lineitem.select(
        "l_orderkey", q.alias("meetings"), marked((flag == "N") & ~duty).alias("present"), marked(leave).alias("leave"), marked(duty).alias("duty"),
        F.when(F.col("l_linestatus") == "F", marked(flag == "R")).alias("absent"),
        one_kind(agg.LEAVE_TYPES, (no % 4).cast("int"), leave).alias("leave_types"), one_kind(agg.DUTY_TYPES, (no % 2).cast("int"), duty).alias("duty_types"),
    )


def _kinds_sql(kinds, column, mark):
    """Sums by kind as text, in the order of the list, without zeros."""
    each = ", ".join(f"CASE WHEN sum(q) FILTER (WHERE {mark} AND l_linenumber % {len(kinds)} = {i}) > 0 THEN '{k}=' || sum(q) FILTER (WHERE {mark} AND l_linenumber % {len(kinds)} = {i}) END"
                     for i, k in enumerate(kinds))
    return f"concat_ws(',', {each}) AS {column}"


_TABLES = f"""t AS (SELECT *, CAST(l_quantity AS BIGINT) AS q, l_returnflag = 'A' AS lv, l_returnflag = 'N' AND l_linenumber % 3 = 0 AS dt FROM lineitem),
  s AS (SELECT l_orderkey, CAST(sum(q) AS BIGINT) AS total, CAST(coalesce(sum(q) FILTER (WHERE l_linestatus = 'F'), 0) AS BIGINT) AS absent_total,
    CAST(coalesce(sum(q) FILTER (WHERE l_returnflag = 'N' AND NOT dt), 0) AS BIGINT) AS present, CAST(coalesce(sum(q) FILTER (WHERE lv), 0) AS BIGINT) AS leave,
    CAST(coalesce(sum(q) FILTER (WHERE dt), 0) AS BIGINT) AS duty, CAST(coalesce(sum(q) FILTER (WHERE l_linestatus = 'F' AND l_returnflag = 'R'), 0) AS BIGINT) AS absent,
    {_kinds_sql(agg.LEAVE_TYPES, "leave_types", "lv")}, {_kinds_sql(agg.DUTY_TYPES, "duty_types", "dt")} FROM t GROUP BY l_orderkey)"""


@plan("a2_metric_denominators", f"""WITH {_TABLES} SELECT *, present / total AS present_rate, leave / total AS leave_rate, duty / total AS duty_rate,
  CASE WHEN absent_total > 0 THEN absent / absent_total ELSE 0 END AS absent_rate FROM s""")
def a2(t):
    shown = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws("=", s["kind"], s["n"].cast("string"))), ",")
    return agg.attendance_totals(_tables(t), "l_orderkey").withColumns({c: shown(c) for c in ("leave_types", "duty_types")})


def _activity(t):
    e = t.events.withColumn("k", _k())
    is_ = lambda k: (F.col("event_type") == k).cast("long")
    return e.select(
        "user_id", "ts", F.lit(1).cast("long").alias("meetings"), is_("view").alias("present"), is_("click").alias("leave"),
        F.when((F.col("user_id") % 3 != 0) | (F.col("k") < 95), is_("error")).alias("absent"),
    )


@plan("a3_segments_residual", """WITH e AS (SELECT *, CASE WHEN user_id % 3 <> 0 OR CAST(props->>'$.k' AS BIGINT) < 95 THEN event_type = 'error' END AS ab FROM events),
  s AS (SELECT user_id, count(*) AS total, count(*) FILTER (WHERE event_type = 'view') AS p, count(*) FILTER (WHERE event_type = 'click') AS l,
    count(ab) AS abt, count(*) FILTER (WHERE ab) AS ab, strftime(max(ts), '%Y-%m-%d') AS latest FROM e GROUP BY user_id),
  r AS (SELECT *, total - p - l - CASE WHEN abt = total THEN ab ELSE 0 END AS rest FROM s)
  SELECT user_id, total, p / total AS rate, 'present=' || p || ',leave=' || l || CASE WHEN abt = total THEN ',absent=' || ab ELSE '' END ||
    CASE WHEN rest > 0 THEN ',unlisted=' || rest ELSE '' END AS segments, latest FROM r""")
def a3(t):
    facts = _activity(t)
    totals = agg.attendance_totals(facts, "user_id").join(facts.groupBy("user_id").agg(F.max("ts").alias("ts")), "user_id")
    out = agg.segments(totals, ["present", "leave"])
    text = F.array_join(F.transform("segments", lambda s: F.concat(s["label"], F.lit("="), s["n"].cast("string"))), ",")
    return (
        out.orderBy(F.desc_nulls_last("ts"), "user_id")
        .select("user_id", "total", F.col("present_rate").alias("rate"), text.alias("segments"), _ymd("ts").alias("latest"))
    )


_CATEGORIES = ["purchase", "view", "vote", "signup"]  # fixed order; "vote" does not occur


@plan("a4_zero_filled_counts", """SELECT user_id, count(*) FILTER (WHERE event_type = 'purchase') || ',' || count(*) FILTER (WHERE event_type = 'view') || ',0,' ||
  count(*) FILTER (WHERE event_type = 'signup') AS counts, count(*) FILTER (WHERE event_type IN ('click', 'error')) AS other FROM events GROUP BY user_id""")
def a4(t):
    out = agg.category_counts(t.events, ["user_id"], "event_type", _CATEGORIES)
    return out.select("user_id", F.array_join(F.transform("counts", lambda c: c.cast("string")), ",").alias("counts"), "other")


_SPEC = [  # id, predicate
    ("written", "event_type = 'view' AND value < 50"),
    ("oral", "event_type = 'view' AND value >= 50"),
    ("recent", "ts >= timestamp_ntz'2024-01-20 00:00:00'"),
    ("large", "value > 100"),
]


@plan("a5_counts_by_spec", """SELECT user_id, count(*) FILTER (WHERE event_type = 'view' AND value < 50) AS written,
  count(*) FILTER (WHERE event_type = 'view' AND value >= 50) AS oral, count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-20') AS recent,
  count(*) FILTER (WHERE value > 100) AS large FROM events GROUP BY user_id""")
def a5(t):
    return agg.counts_by_spec(t.events, ["user_id"], _SPEC)


@plan("a6_nonempty_counts", """WITH o(kind, place) AS (VALUES ('purchase', 1), ('view', 2), ('vote', 3), ('signup', 4), ('error', 5), ('click', 6))
  SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, kind, place, count(*) AS n FROM events JOIN o ON kind = event_type GROUP BY ALL""")
def a6(t):
    order = ["purchase", "view", "vote", "signup", "error", "click"]
    day = F.date_format("ts", "yyyy-MM-dd").alias("day")
    n = t.events.groupBy("user_id", day, F.col("event_type").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("place", F.array_position(F.array(*[F.lit(x) for x in order]), F.col("kind")).cast("int")).filter("place > 0")


def _council(t):
    e = t.events.select(
        (F.col("user_id") % 5).alias("council"), F.to_date("ts").alias("meeting"), F.weekofyear("ts").alias("session"),
        F.col("user_id").alias("person"), "event_type", "value",
    )
    persons = e.select("council", "person").distinct()
    meetings = e.groupBy("council", "meeting").agg(
        F.max("session").alias("session"), F.bool_or((F.col("event_type") == "click") & (F.col("value") > 330)).alias("leave_printed")
    )
    rank = F.when(F.col("event_type") == "view", 3).when(F.col("event_type") == "click", 2).when(F.col("event_type") == "signup", 1)
    # on several lists: present before leave before duty
    lists = e.filter(rank.isNotNull()).groupBy("council", "meeting", "person").agg(
        F.element_at(F.array(F.lit("duty"), F.lit("leave"), F.lit("present")), F.max(rank)).alias("status")
    )
    return persons, meetings, lists


_COUNCIL = """e AS (SELECT user_id % 5 AS council, CAST(ts AS DATE) AS meeting, weekofyear(ts) AS session, user_id AS person, event_type, value FROM events),
  p AS (SELECT DISTINCT council, person FROM e),
  m AS (SELECT council, meeting, session, bool_or(event_type = 'click' AND value > 330) AS printed FROM e GROUP BY ALL),
  s AS (SELECT council, session, count(*) AS meetings, bool_or(printed) AS printed FROM m GROUP BY ALL),
  l AS (SELECT council, meeting, session, person, max(CASE event_type WHEN 'view' THEN 3 WHEN 'click' THEN 2 WHEN 'signup' THEN 1 END) AS st FROM e
    WHERE event_type IN ('view', 'click', 'signup') GROUP BY ALL),
  c AS (SELECT council, session, person, count(*) FILTER (WHERE st = 3) AS present, count(*) FILTER (WHERE st = 2) AS leave, count(*) FILTER (WHERE st = 1) AS duty FROM l GROUP BY ALL)"""


@plan("a7_person_sessions", f"""WITH {_COUNCIL} SELECT p.council, CAST(s.session AS INTEGER) AS session, p.person, s.meetings, coalesce(present, 0) AS present,
  CASE WHEN printed THEN coalesce(leave, 0) END AS leave, CASE WHEN printed THEN coalesce(duty, 0) END AS duty
  FROM p JOIN s ON p.council = s.council LEFT JOIN c ON c.council = p.council AND c.session = s.session AND c.person = p.person""")
def a7(t):
    return agg.attendance_by_session(*_council(t))


@plan("a8_null_preserving_sum", """SELECT c_nationkey, CASE WHEN bool_or(c_acctbal > 9970) THEN count(*) FILTER (WHERE c_acctbal > 9970 AND c_mktsegment = 'BUILDING') END AS leave
  FROM customer GROUP BY c_nationkey""")
def a8(t):
    listed = F.col("c_acctbal") > 9970
    return agg.null_preserving_sum(t.customer, ["c_nationkey"], listed, (F.col("c_mktsegment") == "BUILDING").cast("long"), "leave")


@plan("a9_mark_histogram", """SELECT doc_id, length(text) - length(replace(text, '.', '')) AS present, length(text) - length(replace(text, ',', '')) AS leave,
  length(text) - length(replace(text, '%', '')) AS duty FROM documents""")
def a9(t):
    return agg.mark_histogram(t.documents, "doc_id", "text", {"present": ".", "leave": ",", "duty": "%"})


@plan("a10_count_vs_published", """WITH n AS (SELECT CASE WHEN l_quantity > 5 THEN l_orderkey ELSE -l_orderkey - 1 END AS l_orderkey, count(*) AS counted FROM lineitem GROUP BY ALL),
  h AS (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey ELSE o_orderkey + 1000000000 END AS o_orderkey, o_custkey % 7 + 1 AS printed FROM orders)
  SELECT coalesce(l_orderkey, o_orderkey) AS k, counted, printed, CASE WHEN printed IS NULL THEN 'not published' WHEN counted IS NULL THEN 'no rows'
    WHEN counted = printed THEN 'agrees' ELSE 'differs' END AS state FROM n FULL JOIN h ON l_orderkey = o_orderkey""")
def a10(t):
    # keys that the other side cannot have make the one-sided rows
    line, order = F.col("l_orderkey"), F.col("o_orderkey")
    rows = t.lineitem.select(F.when(F.col("l_quantity") > 5, line).otherwise(-line - 1).alias("k"))
    published = t.orders.select(F.when(F.col("o_orderstatus") != "P", order).otherwise(order + 1_000_000_000).alias("k"), (F.col("o_custkey") % 7 + 1).alias("printed"))
    return agg.count_against_published(rows, published, "k", "printed")


@plan("a11_drop_repeated", """SELECT l_orderkey, l_suppkey, min(l_linenumber) AS l_linenumber FROM lineitem GROUP BY l_orderkey, l_suppkey HAVING count(*) = 1""")
def a11(t):
    return agg.drop_repeated(t.lineitem.select("l_orderkey", "l_suppkey", "l_linenumber"), ["l_orderkey", "l_suppkey"])


@plan("a12_keep_first", """WITH e AS (SELECT user_id, CAST(props->>'$.k' AS BIGINT) AS k, event_id, event_type FROM events)
  SELECT user_id, k, min(event_id) AS event_id, arg_min(event_type, event_id) AS event_type, count(DISTINCT event_type) > 1 AS differs, count(*) AS copies
  FROM e GROUP BY user_id, k""")
def a12(t):
    e = t.events.select("user_id", _k().alias("k"), "event_id", "event_type")
    return agg.keep_first(e, ["user_id", "k"], "event_id", ["event_type"])


@plan("a13_first_date", """SELECT o_custkey, strftime(min(o_orderdate), '%Y-%m-%d') AS first, strftime(max(o_orderdate), '%Y-%m-%d') AS last FROM orders GROUP BY o_custkey""")
def a13(t):
    return t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b")).select(
        "o_custkey", _ymd("a").alias("first"), _ymd("b").alias("last")
    )


@plan("a14_mode_or_null", """WITH n AS (SELECT o_custkey, o_orderpriority AS v, count(*) AS n FROM orders GROUP BY ALL),
  r AS (SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY n DESC) AS r FROM n)
  SELECT o_custkey, CASE WHEN count(*) = 1 THEN min(v) END AS mode FROM r WHERE r = 1 GROUP BY o_custkey""")
def a14(t):
    return agg.mode_or_null(t.orders, ["o_custkey"], "o_orderpriority")


@plan("a15_modal_offset", """WITH d AS (SELECT c_custkey, c_nationkey, c_custkey % 4 + CASE WHEN c_mktsegment = 'BUILDING' THEN 0 ELSE c_custkey % 2 END AS d FROM customer),
  n AS (SELECT c_nationkey, d, row_number() OVER (PARTITION BY c_nationkey ORDER BY count(*) DESC, d) AS r FROM d GROUP BY c_nationkey, d)
  SELECT c_custkey, d."d" AS "offset", n."d" AS mode, d."d" = n."d" AS ok FROM d JOIN n ON d.c_nationkey = n.c_nationkey AND r = 1""")
def a15(t):
    k = F.col("c_custkey")
    offset = k % 4 + F.when(F.col("c_mktsegment") == "BUILDING", F.lit(0)).otherwise(k % 2)
    return agg.modal_offset(t.customer, ["c_nationkey"], offset).select("c_custkey", "offset", "mode", "ok")


@plan("a16_upper_median", """WITH m AS (SELECT o_custkey, list_sort(list(CAST(o_orderdate AS DATE)))[count(*) // 2 + 1] AS m FROM orders GROUP BY o_custkey)
  SELECT o_orderkey, strftime(m, '%Y-%m-%d') AS median, abs(CAST(o_orderdate AS DATE) - m) > 45 AS outlier FROM orders JOIN m USING (o_custkey)""")
def a16(t):
    o = t.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    return agg.median_outliers(o, ["o_custkey"], "day").select("o_orderkey", _ymd("median").alias("median"), "outlier")


@plan("a17_argmax", """SELECT l_orderkey, l_partkey, l_linenumber, l_quantity FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_linenumber, l_partkey DESC) = 1""")
def a17(t):
    return agg.argmax(
        t.lineitem, ["l_orderkey"], [F.col("l_quantity"), -F.col("l_linenumber"), F.col("l_partkey")], ["l_partkey", "l_linenumber", "l_quantity"]
    )


@plan("a18_set_equality", """WITH a AS (SELECT DISTINCT c_nationkey AS n, c_custkey % 40 AS m FROM customer WHERE c_acctbal > 0),
  b AS (SELECT DISTINCT c_nationkey AS n, c_custkey % 40 AS m FROM customer WHERE c_mktsegment <> 'BUILDING'),
  j AS (SELECT coalesce(a.n, b.n) AS n, a.m AS am, b.m AS bm FROM a FULL JOIN b ON a.n = b.n AND a.m = b.m)
  SELECT n, count(*) FILTER (WHERE bm IS NULL) AS only_a, count(*) FILTER (WHERE am IS NULL) AS only_b, bool_and(am IS NOT NULL AND bm IS NOT NULL) AS equal
  FROM j GROUP BY n""")
def a18(t):
    c = t.customer.select(F.col("c_nationkey").alias("n"), (F.col("c_custkey") % 40).alias("m"), "c_acctbal", "c_mktsegment")
    return agg.set_equality(c.filter("c_acctbal > 0"), c.filter("c_mktsegment <> 'BUILDING'"), ["n"], "m")


@plan("a19_reject_report", """WITH r AS (SELECT l_returnflag, unnest(list_filter([CASE WHEN l_quantity < 3 THEN 'too few' END, CASE WHEN l_discount > 0.09 THEN 'discount' END,
    CASE WHEN l_tax = 0 THEN 'no tax' END], lambda x: x IS NOT NULL)) AS reason FROM lineitem) SELECT l_returnflag, reason, count(*) AS n FROM r GROUP BY ALL""")
def a19(t):
    reasons = F.filter(
        F.array(F.when(F.col("l_quantity") < 3, "too few"), F.when(F.col("l_discount") > 0.09, "discount"), F.when(F.col("l_tax") == 0, "no tax")),
        lambda r: r.isNotNull(),
    )
    return agg.reject_report(t.lineitem.withColumn("reasons", reasons), "reasons", "l_returnflag")


@plan("a20_speaker_profile", """WITH t AS (SELECT conv_id, turn, text, CASE WHEN role <> 'system' THEN 'user' END AS speaker, CASE WHEN role = 'user' THEN 'user' END AS owner FROM conversations)
  SELECT conv_id, speaker, count(*) FILTER (WHERE owner IS NOT NULL) AS own_turns, count(*) FILTER (WHERE owner IS NULL) AS official_turns,
    CAST(coalesce(sum(length(text)) FILTER (WHERE owner IS NOT NULL), 0) AS BIGINT) AS own_chars, count(DISTINCT turn // 2) AS pages, min(turn // 2) AS first_page, max(turn // 2) AS last_page
  FROM t WHERE speaker IS NOT NULL GROUP BY conv_id, speaker""")
def a20(t):
    role = F.col("role")
    turns = t.conversations.select(
        "conv_id", "text", F.floor(F.col("turn") / 2).alias("page"), F.when(role != "system", "user").alias("speaker"), F.when(role == "user", "user").alias("owner")
    )
    return agg.speaker_profile(turns, ["conv_id"], "speaker", "owner", "text", "page")


@plan("a21_run_totals", """SELECT count(*) AS docs, CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS issues, CAST(sum(len(string_split(text, '. '))) AS BIGINT) AS sentences FROM documents""")
def a21(t):
    return t.documents.agg(
        F.count(F.lit(1)).alias("docs"),
        F.sum(F.size(F.split("text", "\n")).cast("long")).alias("issues"),
        F.sum(F.size(F.split("text", r"\. ")).cast("long")).alias("sentences"),
    )


@plan("a22_latest_of_many", """WITH o AS (SELECT o_custkey, epoch_us(max(o_orderdate)) AS a FROM orders GROUP BY ALL),
  l AS (SELECT o_custkey, epoch_us(max(l_shipdate)) AS b FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)
  SELECT o_custkey, greatest(a, b) AS as_of FROM o LEFT JOIN l USING (o_custkey)""")
def a22(t):
    # the nested dates of an order are first reduced to their latest
    lines = t.lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("ship"))
    j = t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return j.groupBy("o_custkey").agg(micros(F.greatest(F.max("o_orderdate"), F.max("ship"))).alias("as_of"))


@plan("a23_file_roll_up", """SELECT o_custkey, year(o_orderdate) AS session, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS files,
  strftime(min(o_orderdate), '%Y-%m-%d') AS date FROM orders GROUP BY ALL""")
def a23(t):
    o = t.orders.select("o_custkey", F.year("o_orderdate").cast("long").alias("session"), "o_orderpriority", "o_orderdate")
    out = agg.roll_up_files(o, ["o_custkey", "session"], "o_orderpriority", "o_orderdate")
    return out.select("o_custkey", "session", F.array_join("files", ",").alias("files"), _ymd("date").alias("date"))


@plan("a24_offset_lists", """WITH d AS (SELECT DISTINCT user_id, strftime(ts, '%Y-%m-%d') AS day, hour(ts) * 60 + minute(ts) AS s FROM events)
  SELECT user_id, day, (rank - 1) // 2 AS part, string_agg(CAST(s AS VARCHAR), ',' ORDER BY s) AS starts
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY s) AS rank FROM d) GROUP BY ALL""")
def a24(t):
    e = t.events.select("user_id", _ymd("ts").alias("day"), (F.hour("ts") * 60 + F.minute("ts")).alias("start"))
    out = agg.offset_lists(e, ["user_id", "day"], "start", per_row=2)
    return out.withColumn("starts", F.array_join(F.transform("starts", lambda s: s.cast("string")), ","))


@plan("a25_coverage_flags", """WITH t AS (SELECT DISTINCT CASE WHEN o_totalprice > 499500 THEN o_custkey ELSE -o_custkey - 1 END AS o_custkey FROM orders)
  SELECT c_nationkey, bool_or(c_mktsegment <> 'BUILDING' AND c_acctbal > 9900) AS roster, bool_or(c_mktsegment = 'BUILDING' AND c_acctbal > 9900) AS basis,
    bool_or(c_acctbal > 0 AND o_custkey IS NOT NULL) AS text FROM customer LEFT JOIN t ON c_custkey = o_custkey GROUP BY c_nationkey""")
def a25(t):
    # an order of a lower price names nobody, so that areas without texts exist
    whose = F.when(F.col("o_totalprice") > 499500, F.col("o_custkey")).otherwise(-F.col("o_custkey") - 1)
    texts = t.orders.select(whose.alias("c_custkey")).distinct().withColumn("has", F.lit(True))
    c = t.customer.join(texts, "c_custkey", "left")
    by_result, top = F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") > 9900
    return c.groupBy("c_nationkey").agg(
        F.bool_or(~by_result & top).alias("roster"), F.bool_or(by_result & top).alias("basis"),
        F.bool_or((F.col("c_acctbal") > 0) & F.col("has").isNotNull()).alias("text"),
    )
