"""F: scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta.functions import dates, ids, labels, names, text
from attesta.plans.registry import plan
from attesta.tables import PERSON, ROSTER


def _ymd(col):
    return F.date_format(col, "yyyy-MM-dd")


@plan("f1_name_normaliser", f"""WITH {ROSTER} SELECT record_id, weak || CASE s_suppkey % 4 WHEN 0 THEN ''
  WHEN 1 THEN 'LorAna' ELSE 'AnaLor' END AS norm FROM roster""")
def f1(t):
    return t.roster().select("record_id", names.normalise(F.col("name")).alias("norm"))


@plan("f2_script_split_key", f"""WITH {ROSTER}, {PERSON} SELECT record_id AS id, weak, words FROM roster
  UNION ALL SELECT person_id, weak, words FROM person""")
def f2(t):
    both = t.roster().select(F.col("record_id").alias("id"), "name").unionByName(
        t.persons().select(F.col("person_id").alias("id"), "name")
    )
    return both.select("id", names.weak_key(F.col("name")).alias("weak"), names.latin_words(F.col("name")).alias("words"))


@plan("f3_variant_folding", """SELECT doc_id, md5(translate(text, 'øäöüßéèêçñáíóú', '0aouseeecnaiou')) AS folded
  FROM documents""")
def f3(t):
    return t.documents.select("doc_id", F.md5(names.fold(F.col("text"))).alias("folded"))


# NFKC has no SQL form: rows only
# the text is its own NFKC form, and the three wide letters fold back to it
@plan("f4_nfkc", "SELECT doc_id, md5(text) AS nfkc, true AS same FROM documents")
def f4(t):
    wide = F.translate(F.col("text"), "abc", "ａｂｃ")
    return t.documents.select("doc_id", F.md5(names.nfkc(wide)).alias("nfkc"), (names.nfkc(wide) == F.col("text")).alias("same"))


@plan("f4_squash", r"""SELECT doc_id, md5(regexp_replace(regexp_replace(text, '〔p\d+〕|<[^<>\n]{0,40}>', '', 'g'), '[ \t\n\x0B\f\r]+', '', 'g'))
    AS squashed, length(text) AS blanked_length,
  length(regexp_replace(regexp_replace(text, '〔p\d+〕|<[^<>\n]{0,40}>', '', 'g'), '[ \t\n\x0B\f\r]+', '', 'g')) AS kept
  FROM documents""")
def f4_squash(t):
    marked = F.concat(F.lit("〔p12〕"), F.col("text"))
    return t.documents.select(
        "doc_id",
        F.md5(text.squash(marked)).alias("squashed"),
        (F.length(text.blank_marks(marked)) - 5).cast("long").alias("blanked_length"),
        F.size(text.kept_positions(marked)).cast("long").alias("kept"),
    )


@plan("f5_era_date", """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
  WHERE o_orderkey % 5 <> 4 UNION ALL SELECT o_orderkey, NULL FROM orders WHERE o_orderkey % 5 = 4""")
def f5(t):
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 5
    year, month, day = F.year(d) - 1911, F.month(d), F.dayofmonth(d)
    written = (
        F.when(k == 0, F.format_string("%d年%d月%d日", year, month, day))
        .when(k == 1, F.format_string("%03d/%02d/%02d", year, month, day))
        .when(k == 2, F.format_string("%03d%02d%02d", year, month, day))
        .when(k == 3, F.date_format(d, "yyyy-MM-dd'T'HH:mm"))
        .otherwise(F.lit("date not stated"))
    )
    return t.orders.select("o_orderkey", _ymd(dates.era_date(written)).alias("day"))


@plan("f6_numerals", """SELECT c_custkey, c_custkey % 99 + 1 AS n, NULL::VARCHAR AS junk FROM customer""")
def f6(t):
    n = F.col("c_custkey") % 99 + 1
    return t.customer.select(
        "c_custkey",
        dates.numeral(dates.to_numeral(n)).cast("long").alias("n"),
        dates.numeral(F.concat(dates.to_numeral(n), F.lit("x"))).cast("string").alias("junk"),
    )


@plan("f7_range_list", """SELECT p_partkey, 3 * p_size + 33 + p_size % 20 + 1 AS total, 4::BIGINT AS n, p_size % 20 + 1 AS first, true AS junk FROM part""")
def f7(t):
    s = F.col("p_size")
    digits = lambda c: c.cast("string")
    spoken = dates.to_numeral(s % 20 + 1)
    span = F.concat(F.lit("第"), digits(s + 10), F.lit("-"), dates.to_numeral(s + 12))
    written = F.concat(span, F.lit("、"), spoken, F.lit("及"), digits(s + 11), F.lit("."), digits(s + 10), F.lit("，"), spoken)
    # a step of its own, so that each list is read once and not for every column
    read = t.part.select("p_partkey", dates.range_list(written).alias("found"), dates.range_list(F.concat(written, F.lit("、x"))).alias("junk"))
    return read.select(
        "p_partkey",
        F.aggregate("found", F.lit(0), lambda a, x: a + x).alias("total"),
        F.size("found").cast("long").alias("n"),
        F.get("found", F.lit(0)).alias("first"),
        F.col("junk").isNull().alias("junk"),
    )


@plan("f8_area_name", """SELECT c_custkey, CASE WHEN c_custkey % 4 <> 3 THEN lower(n_name) END AS area,
  CASE c_custkey % 4 WHEN 0 THEN 'ly-' || lower(n_name) || '-01' WHEN 3 THEN NULL
    ELSE 'ly-' || lower(n_name) || '-' || lpad(CAST(c_custkey % 4 AS VARCHAR), 2, '0') END AS district_id
  FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def f8(t):
    k = F.col("c_custkey") % 4
    areas = [f"NATION_{i}" for i in range(25)]  # the nation table is fixed at 25 rows
    written = (
        F.when(k == 0, F.col("n_name"))
        .when(k == 3, F.lit("at-large"))
        .otherwise(F.concat_ws(" ", "n_name", k.cast("string")))
    )
    parsed = ids.parse_area(written, areas, "at-large")
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select("c_custkey", parsed["area"].alias("area"), parsed["district_id"].alias("district_id"))


@plan("f9_id_grammar", f"""WITH {PERSON} SELECT person_id, area FROM person""")
def f9(t):
    d = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("ly-"), "district_id")).otherwise(F.col("district_id"))
    return t.persons().select("person_id", ids.area_of(d).alias("area"))


@plan("f10_id_mint", """SELECT c_custkey, 'p' || left(sha1('roster:' || c_name), 10) AS id FROM customer""")
def f10(t):
    return t.customer.select("c_custkey", ids.mint_id(F.lit("roster"), F.col("c_name")).alias("id"))


@plan("f11_code_composition", """SELECT o_orderkey, CASE WHEN o_custkey % 10 < 8 THEN
  'P' || o_orderstatus || left(o_orderpriority, 1) || lpad(CAST(o_custkey AS VARCHAR), 6, '0') END AS code FROM orders""")
def f11(t):
    guard = F.when(F.col("o_custkey") % 10 < 8, F.lit("0")).otherwise(F.lit("9"))
    village = F.concat(guard, F.lpad(F.col("o_custkey").cast("string"), 6, "0"))
    code = ids.village_code(F.lit("P"), F.col("o_orderstatus"), F.substring("o_orderpriority", 1, 1), village)
    return t.orders.select("o_orderkey", code.alias("code"))


@plan("f12_session_slug", """SELECT o_orderkey, year(o_orderdate) || '-' || month(o_orderdate) ||
  CASE WHEN o_orderstatus = 'O' THEN 'r' ELSE 't' END AS slug FROM orders""")
def f12(t):
    kind = F.when(F.col("o_orderstatus") == "O", F.lit("regular")).otherwise(F.lit("extra"))
    written = F.format_string("term %d %s meeting no. %d.", F.year("o_orderdate"), kind, F.month("o_orderdate"))
    return t.orders.select("o_orderkey", ids.session_slug(written, "regular").alias("slug"))


@plan("f13_clock", """SELECT event_id, (CAST(floor(value * 100) AS BIGINT) // 3600) || ':' ||
  lpad(CAST((CAST(floor(value * 100) AS BIGINT) // 60) % 60 AS VARCHAR), 2, '0') || ':' ||
  lpad(CAST(CAST(floor(value * 100) AS BIGINT) % 60 AS VARCHAR), 2, '0') AS clock FROM events""")
def f13(t):
    return t.events.select("event_id", dates.clock(F.col("value") * 100).alias("clock"))


@plan("f14_title_unwrap", """SELECT c_custkey, 'Vale' || c_custkey || 'Rowan' AS name FROM customer""")
def f14(t):
    written = F.concat(F.lit("Vale"), F.lit("Councillor"), F.col("c_custkey").cast("string"), F.lit("RowanSpeaker"))
    return t.customer.select("c_custkey", names.untitled(written, ["Councillor", "Speaker"]).alias("name"))


@plan("f15_name_list", """SELECT o_orderkey, 'n' || o_custkey || '|' || 'm' || o_custkey AS names,
  o_orderstatus AS notes, 2::BIGINT AS n FROM orders""")
def f15(t):
    k = F.col("o_custkey").cast("string")
    listed = F.concat(F.lit("n"), k, F.lit(" (" ), F.col("o_orderstatus"), F.lit("), m"), k, F.lit("、"))
    found = names.split_names(listed)
    return t.orders.select(
        "o_orderkey",
        F.array_join(F.transform(found, lambda p: p["name"]), "|").alias("names"),
        F.array_join(F.transform(found, lambda p: p["note"]), "|").alias("notes"),
        F.size(found).cast("long").alias("n"),
    )


@plan("f16_unique_segmentation", """WITH RECURSIVE tok AS (SELECT DISTINCT (c_custkey % 211) || '' || (c_custkey // 7 % 211)
    AS token FROM customer),
  known AS (SELECT DISTINCT CAST(s_suppkey % 211 AS VARCHAR) AS part FROM supplier WHERE length(CAST(s_suppkey % 211 AS VARCHAR)) >= 2),
  cut AS (SELECT token, 0 AS pos, '' AS path FROM tok UNION ALL
    SELECT token, pos + length(part), path || '|' || part FROM cut JOIN known
      ON substr(token, pos + 1, length(part)) = part AND pos + length(part) <= length(token)),
  whole AS (SELECT token, count(*) AS ways, min(path) AS path FROM cut WHERE pos = length(token) GROUP BY token)
  SELECT token, substr(path, 2) AS cuts FROM whole WHERE ways = 1""")
def f16(t):
    k = F.col("c_custkey")
    glued = t.customer.select(F.concat((k % 211).cast("string"), F.floor(k / 7 % 211).cast("string")).alias("token"))
    known = t.supplier.select((F.col("s_suppkey") % 211).cast("string").alias("name"))
    return names.unique_segmentation(glued, "token", known, "name").select("token", F.array_join("cuts", "|").alias("cuts"))


@plan("f17_one_edit_repair", """WITH tok AS (SELECT DISTINCT 'x' || c_custkey AS token FROM customer),
  known AS (SELECT 'x' || s_suppkey * 13 AS name FROM supplier),
  near AS (SELECT token, name FROM tok JOIN known ON length(token) = length(name) AND hamming(token, name) = 1
    WHERE token NOT IN (SELECT name FROM known))
  SELECT token, min(name) AS repaired FROM near GROUP BY token HAVING count(*) = 1""")
def f17(t):
    tokens = t.customer.select(F.concat(F.lit("x"), "c_custkey").alias("token"))
    known = t.supplier.select(F.concat(F.lit("x"), F.col("s_suppkey") * 13).alias("name"))
    return names.one_edit_repair(tokens, "token", known, "name")


@plan("f18_deep_links", """SELECT page_id, url || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 't=' || page_id AS at_time,
  CASE WHEN page_id % 2 = 0 THEN url || '#page=' || page_id ELSE url END AS at_page FROM pages""")
def f18(t):
    page = F.when(F.col("page_id") % 2 == 0, F.col("page_id"))
    return t.pages.select(
        "page_id",
        ids.time_link(F.col("url"), F.col("page_id") + 0.7).alias("at_time"),
        ids.page_link(F.col("url"), page).alias("at_page"),
    )


_PUBLISHERS = [("example.com", "Gazette"), ("example.org", "Council"), ("spam-farm.example.org", "Unlisted")]


@plan("f19_publisher", r"""WITH h AS (SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host FROM pages)
  SELECT page_id, host, CASE WHEN host = 'spam-farm.example.org' OR host LIKE '%.spam-farm.example.org' THEN 'Unlisted'
    WHEN host LIKE '%.example.com' THEN 'Gazette' WHEN host LIKE '%.example.org' THEN 'Council' END AS publisher FROM h""")
def f19(t):
    publishers = t.spark.createDataFrame(_PUBLISHERS, "host string, label string")
    return ids.publisher_of(t.pages, "url", publishers).select("page_id", "host", "publisher")


@plan("f20_local_date", """SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS day FROM events""")
def f20(t):
    return t.events.select("event_id", _ymd(dates.local_date(F.col("ts"), "Asia/Taipei")).alias("day"))


_ROLES = ["Chair", "Member", "Director"]


@plan("f21_speaker_label", r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS s FROM documents),
  q AS (SELECT doc_id, trim(split_part(s, ',', 1)) AS head, length(s) % 3 AS r FROM l WHERE s <> ''),
  lab AS (SELECT doc_id, head, r, length(head) + CASE r WHEN 0 THEN 6 ELSE 7 END AS n FROM q)
  SELECT doc_id, count(*) AS lines, count(*) FILTER (WHERE NOT regexp_matches(head, '[.;!?:]') AND r < 2 AND n <= 40) AS labels
  FROM lab GROUP BY doc_id""")
def f21(t):
    lines = t.documents.select("doc_id", F.explode(F.split("text", "\n")).alias("raw")).filter("raw <> ''")
    role = F.element_at(F.array(F.lit(" Chair"), F.lit(" Member"), F.lit(" said")), F.length("raw") % 3 + 1)
    line = F.concat(F.trim(F.split_part("raw", F.lit(","), F.lit(1))), role, F.lit(": "), F.col("raw"))
    label = text.speaker_label(line, _ROLES)
    return (
        lines.select("doc_id", label.alias("label"))
        .groupBy("doc_id")
        .agg(F.count(F.lit(1)).alias("lines"), F.count("label").alias("labels"))
    )


@plan("f22_merged_label", r"""WITH l AS (SELECT doc_id, string_split(regexp_replace(text, '[.]', '', 'g'), chr(10)) AS ls FROM documents),
  x AS (SELECT doc_id, unnest(ls) AS line, list_filter(list_distinct(list_transform(ls, lambda s: split_part(s, ' ', 1))), lambda w: length(w) > 0) AS known FROM l),
  hit AS (SELECT doc_id, line, list_sort(list_filter(known, lambda w: ends_with(line, w) AND length(line) > length(w)),
    'DESC', 'NULLS LAST') AS hits, known FROM x WHERE line <> ''),
  b AS (SELECT doc_id, line, list_max(list_transform(hits, lambda w: length(w))) AS longest FROM hit)
  SELECT doc_id, count(*) AS lines, count(longest) AS split_lines, CAST(coalesce(sum(longest), 0) AS BIGINT) AS label_chars,
    coalesce(string_agg(DISTINCT right(line, longest), '|' ORDER BY right(line, longest)), '') AS labels,
    CAST(coalesce(sum(length(line) - longest) FILTER (WHERE longest IS NOT NULL), 0) AS BIGINT) AS text_chars
  FROM b GROUP BY doc_id""")
def f22(t):
    # a document's own labels are known from the document alone, so the lookup stays inside the row
    lines = F.split(F.regexp_replace("text", "[.]", ""), "\n")
    known = F.array_distinct(F.transform(lines, lambda s: F.split_part(s, F.lit(" "), F.lit(1))))
    docs = t.documents.select("doc_id", lines.alias("lines"), F.filter(known, lambda w: F.length(w) > 0).alias("known"))
    per_line = docs.select("doc_id", F.explode("lines").alias("line"), "known").filter("line <> ''")
    split = text.merged_label(F.concat("line", F.lit("：")), F.col("known"))
    return (
        per_line.select("doc_id", split.alias("s"))
        .groupBy("doc_id")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.count("s").alias("split_lines"),
            F.coalesce(F.sum(F.length("s.label")), F.lit(0)).cast("long").alias("label_chars"),
            F.array_join(F.array_sort(F.collect_set("s.label")), "|").alias("labels"),
            F.coalesce(F.sum(F.length("s.text")), F.lit(0)).cast("long").alias("text_chars"),
        )
    )


@plan("f23_role_tag", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '' WHEN o_orderpriority = '1-URGENT' THEN 'suspended'
  WHEN o_orderpriority = '2-HIGH' THEN 'elected last term' WHEN o_custkey % 2 = 0 THEN 'incumbent'
  ELSE 'incumbent ' || o_orderstatus END AS tag FROM orders""")
def f23(t):
    office = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    basis = F.when(F.col("o_orderpriority") == "2-HIGH", F.lit("election")).otherwise(F.lit("roster"))
    tag = labels.role_tag(office, F.col("o_custkey") % 2 == 0, basis, F.col("o_orderpriority") == "1-URGENT")
    return t.orders.select("o_orderkey", tag.alias("tag"))


@plan("f24_eligibility", """WITH u AS (SELECT DISTINCT c_nationkey AS town, c_mktsegment AS village, CASE WHEN c_nationkey > 18 THEN 1 WHEN c_acctbal > 0 AND c_nationkey > 5 THEN 2 ELSE c_custkey % 3 END AS district
    FROM customer WHERE c_acctbal > 0 OR c_nationkey < 12),
  tv AS (SELECT town, village, count(*) AS n, min(district) AS d FROM u GROUP BY ALL),
  tt AS (SELECT town, count(DISTINCT district) AS n, min(district) AS d FROM u GROUP BY ALL)
  SELECT s_suppkey, CASE WHEN tv.n = 1 THEN tv.d WHEN tt.n = 1 THEN tt.d END AS district,
    (coalesce(tv.n, 0) <> 1 AND coalesce(tt.n, 0) = 1) AS fallback
  FROM supplier LEFT JOIN tv ON s_nationkey = tv.town AND tv.village = CASE WHEN s_suppkey % 2 = 0 THEN 'BUILDING' ELSE 'MACHINERY' END
  LEFT JOIN tt ON s_nationkey = tt.town""")
def f24(t):
    c = t.customer.filter("c_acctbal > 0 OR c_nationkey < 12")
    units = c.select(F.col("c_nationkey").alias("town"), F.col("c_mktsegment").alias("village"),
                     F.when(F.col("c_nationkey") > 18, 1).when((F.col("c_acctbal") > 0) & (F.col("c_nationkey") > 5), 2)
                     .otherwise(F.col("c_custkey") % 3).alias("district"))
    asked = t.supplier.select(
        "s_suppkey", F.col("s_nationkey").alias("town"),
        F.when(F.col("s_suppkey") % 2 == 0, F.lit("BUILDING")).otherwise(F.lit("MACHINERY")).alias("village"),
    )
    from attesta.operators.linking import eligible_district

    return eligible_district(asked, units, "s_suppkey")


@plan("f25_partial_coverage", """WITH u AS (SELECT c_nationkey, c_mktsegment, bool_and(c_acctbal > -900) AS inside, bool_or(c_acctbal > 9000) AS part
    FROM customer GROUP BY ALL),
  tw AS (SELECT c_nationkey, bool_and(part) AS whole, bool_or(part) AS touched,
    string_agg(CASE WHEN part THEN c_mktsegment END, ',' ORDER BY c_mktsegment) AS inside FROM u GROUP BY ALL)
  SELECT n_name, CASE WHEN whole THEN 'whole' WHEN touched THEN 'partly: ' || inside ELSE 'outside' END AS label
  FROM tw JOIN nation ON c_nationkey = n_nationkey""")
def f25(t):
    from attesta.operators.linking import coverage_label

    villages = t.customer.groupBy(F.col("c_nationkey").alias("town"), F.col("c_mktsegment").alias("village")).agg(
        F.bool_or(F.col("c_acctbal") > 9000).alias("inside")
    )
    return coverage_label(villages).join(t.nation, F.col("town") == F.col("n_nationkey")).select("n_name", "label")


@plan("f26_neutral_note", """SELECT o_custkey, CASE WHEN bool_and(o_orderstatus = 'F') THEN 'all listed candidates are qualified'
  WHEN bool_or(o_orderstatus = 'P') THEN 'review not finished' ELSE 'some registrations were not accepted' END AS note
  FROM orders GROUP BY o_custkey""")
def f26(t):
    state = t.orders.groupBy("o_custkey").agg(
        F.bool_and(F.col("o_orderstatus") == "F").alias("done"), F.bool_or(F.col("o_orderstatus") == "P").alias("open")
    )
    return state.select("o_custkey", labels.neutral_note(F.col("done"), F.col("open")).alias("note"))


@plan("f27_status_mark", """SELECT c_custkey, c_name AS name, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS note,
  c_mktsegment = 'BUILDING' AS current FROM customer""")
def f27(t):
    mark = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("")).otherwise(F.concat(F.lit(" ("), "c_mktsegment", F.lit(")")))
    parsed = names.status_mark(F.concat("c_name", mark))
    return t.customer.select("c_custkey", parsed["name"].alias("name"), parsed["note"].alias("note"),
                             parsed["current"].alias("current"))


@plan("f28_publication_table", f"""WITH {ROSTER} SELECT record_id, CASE WHEN office = 'mayor' AND s_nationkey < 6 THEN 'C1'
  WHEN office = 'mayor' THEN 'C2' WHEN s_nationkey < 6 THEN 'T1' ELSE 'T2' END AS code FROM roster""")
def f28(t):
    kind = F.when(F.col("s_nationkey") < 6, F.lit("city")).otherwise(F.lit("county"))
    return t.roster().select("record_id", labels.publication_table(F.col("office"), kind).alias("code"))


@plan("f29_half_links", """SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url || CASE WHEN page_id % 2 = 0 THEN '#page=' || page_id ELSE '' END
    ELSE url || '/profile' END AS profile,
  CASE WHEN page_id % 3 = 1 THEN url || '/profile' || CASE WHEN page_id % 2 = 0 THEN '#page=' || page_id ELSE '' END ELSE url END AS platform
  FROM pages""")
def f29(t):
    k = F.col("page_id")
    profile, platform = labels.half_links(
        F.when(k % 3 != 0, F.concat("url", F.lit("/profile"))),
        F.when(k % 3 != 1, F.col("url")),
        F.when(k % 2 == 0, k),
    )
    return t.pages.select("page_id", profile.alias("profile"), platform.alias("platform"))


@plan("f30_media_grain", """SELECT event_id, CASE WHEN event_type = 'view' THEN 'own start' WHEN event_type = 'click' THEN 'own slots'
  WHEN event_type = 'purchase' THEN 'clip' WHEN value > 10 THEN 'group' ELSE 'whole session' END AS grain FROM events""")
def f30(t):
    kind = F.col("event_type")
    grain = labels.media_grain(
        F.when(kind == "view", F.col("value")),
        F.when(kind == "click", F.array(F.lit(1).cast("long"))),
        kind == "purchase",
        F.when(F.col("value") > 10, F.lit(4)).otherwise(F.lit(1)),
    )
    return t.events.select("event_id", grain.alias("grain"))
