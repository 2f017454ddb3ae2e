"""T: text evidence over whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta.functions import text as tx
from attesta.operators import evidence
from attesta.plans.registry import plan
from attesta.scale import OrderedGroups

_BIGRAMS = r"""list_distinct(list_transform(list_zip(a, a[2:], true), lambda z: z[1] || z[2]))"""
_CHARS = r"""string_split(regexp_replace({0}, '[^\p{{L}}\p{{N}}]', '', 'g'), '')"""


@plan("t1_bigram_sets", f"""WITH c AS (SELECT doc_id, {_CHARS.format('text')} AS a FROM documents),
  b AS (SELECT doc_id, {_BIGRAMS} AS b FROM c)
  SELECT doc_id, CAST(len(b) AS BIGINT) AS n, list_min(b) AS first, list_max(b) AS last FROM b""")
def t1(t):
    b = tx.bigrams(F.col("text"))
    return t.documents.select("doc_id", b.alias("b")).select(
        "doc_id", F.size("b").cast("long").alias("n"), F.array_min("b").alias("first"), F.array_max("b").alias("last")
    )


_IDF = """df AS (SELECT bigram, count(*) AS df FROM (SELECT unnest(b) AS bigram FROM b) GROUP BY bigram),
  idf AS (SELECT bigram, df, CAST(round(greatest(ln((SELECT count(*) FROM b) / (df + 1)), 0) * 1000000) AS BIGINT) AS weight FROM df)"""


@plan("t2_bigram_idf", f"""WITH c AS (SELECT doc_id, {_CHARS.format('text')} AS a FROM documents),
  b AS (SELECT doc_id, {_BIGRAMS} AS b FROM c), {_IDF} SELECT bigram, df, weight FROM idf""")
def t2(t):
    return evidence.pair_weights(t.documents, "text")


def _claims(t):
    """Claim: an assistant turn; its citations: the user turns since the assistant turn before."""
    turns = t.conversations
    owner = OrderedGroups(turns, ["conv_id"], ["turn"], "turn").next_seen(
        "claim", F.when(F.col("role") == "assistant", F.col("turn"))
    ).rows()
    claims = turns.filter("role = 'assistant'").select("conv_id", F.col("turn").alias("claim"), F.col("text").alias("claim_text"))
    cites = owner.filter("role = 'user' AND claim IS NOT NULL").select("conv_id", "claim", "turn", F.col("text").alias("cited_text"))
    return claims, cites


@plan("t3_lexical_support", f"""WITH c AS (SELECT conv_id, turn, role, {_CHARS.format('text')} AS a FROM conversations),
  b AS (SELECT conv_id, turn, role, {_BIGRAMS} AS b FROM c), {_IDF},
  o AS (SELECT conv_id, turn, role, b, min(CASE WHEN role = 'assistant' THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS claim FROM b),
  x AS (SELECT q.conv_id, q.claim, q.turn, unnest(list_intersect(q.b, m.b)) AS bigram FROM o q JOIN b m
    ON q.conv_id = m.conv_id AND q.claim = m.turn WHERE q.role = 'user'),
  s AS (SELECT conv_id, claim, turn, sum(weight) AS score FROM x JOIN idf USING (bigram) GROUP BY ALL),
  m AS (SELECT conv_id, claim, max(score) AS score FROM s GROUP BY ALL)
  SELECT b.conv_id, b.turn AS claim, CAST(coalesce(score, 0) AS BIGINT) AS score, coalesce(score, 0) >= 8200000 AS kept
  FROM b LEFT JOIN m ON b.conv_id = m.conv_id AND b.turn = m.claim WHERE b.role = 'assistant'""")
def t3(t):
    claims, cites = _claims(t)
    texts = t.conversations.agg(F.count(F.lit(1))).scalar()
    return evidence.support(claims, ["conv_id", "claim"], cites, "turn", evidence.pair_weights(t.conversations, "text"), texts)


@plan("t4_citation_locator", r"""WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
  l AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) - 1 AS n, regexp_replace(unnest(ls), '\s+', '', 'g') AS s FROM d),
  p AS (SELECT doc_id, n // 5 + 1 AS page, sum(length(s)) OVER w - length(s) AS lo, sum(length(s)) OVER w AS hi FROM l
    WINDOW w AS (PARTITION BY doc_id ORDER BY n)),
  q AS (SELECT item_id, regexp_replace(text, '\s+', '', 'g') AS s FROM benchmark),
  f AS (SELECT doc_id, string_agg(s, '' ORDER BY n) AS s FROM l GROUP BY doc_id),
  h AS (SELECT item_id, doc_id, string_split(f.s, q.s) AS parts, length(q.s) AS len FROM q JOIN f ON contains(f.s, q.s)),
  o AS (SELECT item_id, doc_id, parts, len, unnest(range(1, len(parts))) AS j FROM h),
  k AS (SELECT item_id, o.doc_id, list_sum(list_transform(parts[1:j], lambda x: length(x))) + (j - 1) * len AS pos FROM o),
  r AS (SELECT DISTINCT item_id, k.doc_id, page FROM k JOIN p ON k.doc_id = p.doc_id AND lo <= pos AND pos < hi),
  u AS (SELECT item_id, count(*) AS n, min(doc_id) AS doc_id, min(page) AS page FROM r GROUP BY item_id)
  SELECT b.item_id, coalesce(n = 1, false) AS located, CASE WHEN n = 1 THEN u.doc_id END AS doc_id, CASE WHEN n = 1 THEN page END AS page
  FROM benchmark b LEFT JOIN u USING (item_id)""")
def t4(t):
    spans = lambda docs: evidence.line_spans(docs, "doc_id", "text", 5)
    return evidence.locate(t.benchmark, "item_id", "text", t.documents, "doc_id", "text", spans)


# two pieces with an ellipsis between them: the second must stand behind the first
@plan("t4_ellipsis_locator", r"""WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
  l AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) - 1 AS n, regexp_replace(unnest(ls), '\s+', '', 'g') AS s FROM d),
  p AS (SELECT doc_id, n // 5 + 1 AS page, sum(length(s)) OVER w - length(s) AS lo, sum(length(s)) OVER w AS hi FROM l
    WINDOW w AS (PARTITION BY doc_id ORDER BY n)),
  q AS (SELECT item_id, regexp_replace(substr(text, 1, length(text) // 3), '\s+', '', 'g') AS s,
    regexp_replace(substr(text, length(text) // 2), '\s+', '', 'g') AS t FROM benchmark),
  f AS (SELECT doc_id, string_agg(s, '' ORDER BY n) AS s FROM l GROUP BY doc_id),
  h AS (SELECT item_id, doc_id, f.s AS body, t, string_split(f.s, q.s) AS parts, length(q.s) AS len FROM q JOIN f ON contains(f.s, q.s)),
  o AS (SELECT *, unnest(range(1, len(parts))) AS j FROM h),
  k AS (SELECT *, CAST(list_sum(list_transform(parts[1:j], lambda x: length(x))) + (j - 1) * len AS BIGINT) AS pos FROM o),
  r AS (SELECT DISTINCT item_id, k.doc_id, page FROM k JOIN p ON k.doc_id = p.doc_id AND lo <= pos AND pos < hi
    WHERE contains(substr(body, pos + len + 1), t)),
  u AS (SELECT item_id, count(*) AS n, min(doc_id) AS doc_id, min(page) AS page FROM r GROUP BY item_id)
  SELECT b.item_id, coalesce(n = 1, false) AS located, CASE WHEN n = 1 THEN u.doc_id END AS doc_id, CASE WHEN n = 1 THEN page END AS page
  FROM benchmark b LEFT JOIN u USING (item_id)""")
def t4_pieces(t):
    n = F.length("text")
    cited = F.concat(F.col("text").substr(F.lit(1), F.floor(n / 3).cast("int")), F.lit("……"),
                     F.col("text").substr(F.floor(n / 2).cast("int"), n))
    spans = lambda docs: evidence.line_spans(docs, "doc_id", "text", 5)
    return evidence.locate(t.benchmark.select("item_id", cited.alias("cited")), "item_id", "cited", t.documents, "doc_id", "text", spans)


@plan("t5_short_evidence", r"""WITH s AS (SELECT doc_id, unnest(string_split(text, '. ')) AS s FROM documents)
  SELECT doc_id, count(*) AS cites, count(*) FILTER (WHERE length(regexp_replace(s, '[^\p{L}\p{N}]', '', 'g')) < 8) AS short FROM s GROUP BY doc_id""")
def t5(t):
    cited = t.documents.select("doc_id", F.explode(F.split("text", r"\. ")).alias("s"))
    marked = F.concat(F.lit("〔p3〕"), "doc_id", F.lit("Member: "), "s")
    return cited.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("cites"),
        F.count_if(evidence.short_evidence(marked, r"\d*Member")).alias("short"),
    )


@plan("t6_misplaced_claims", f"""WITH c AS (SELECT conv_id, turn, role, {_CHARS.format('text')} AS a FROM conversations),
  t AS (SELECT conv_id, turn, role, {_BIGRAMS} AS tb FROM c),
  l AS (SELECT conv_id, turn, string_split(text, chr(10)) AS ls FROM conversations WHERE role = 'assistant'),
  y AS (SELECT conv_id, turn, turn || '-' || (unnest(range(1, len(ls) + 1)) - 1) AS sentence_id, unnest(ls) AS sentence FROM l),
  z AS (SELECT conv_id, turn, sentence_id, {_CHARS.format('sentence')} AS a FROM y),
  s AS (SELECT conv_id, turn // 2 AS doc, turn, sentence_id, {_BIGRAMS} AS b FROM z),
  x AS (SELECT s.conv_id, sentence_id, doc, t.turn, t.turn // 2 AS tdoc, len(list_intersect(b, tb)) / len(b) AS cover
    FROM s JOIN t ON s.conv_id = t.conv_id AND (s.turn // 2 <> t.turn // 2 OR t.role <> 'assistant') WHERE len(b) >= 3),
  m AS (SELECT conv_id, sentence_id, coalesce(max(CASE WHEN doc = tdoc THEN cover END), 0) AS same,
    max(CASE WHEN doc <> tdoc THEN cover END) AS cover FROM x GROUP BY ALL)
  SELECT m.conv_id, m.sentence_id, (SELECT min(turn) FROM x WHERE x.conv_id = m.conv_id AND x.sentence_id = m.sentence_id AND doc <> tdoc AND x.cover = m.cover) AS turn_id,
    cover FROM m WHERE cover >= 0.4 AND cover - same >= 0.15""")
def t6(t):
    c = t.conversations
    sentences = c.filter("role = 'assistant'").select(
        "conv_id", "turn", F.floor(F.col("turn") / 2).alias("doc"), F.posexplode(F.split("text", "\n")).alias("at", "sentence")
    ).select("conv_id", F.concat_ws("-", "turn", "at").alias("sentence_id"), F.col("turn").alias("skip"), "doc", "sentence")
    turns = c.select("conv_id", F.col("turn").alias("turn_id"), F.floor(F.col("turn") / 2).alias("doc"), F.col("text").alias("turn_text"))
    # the answer's own turn is what is being checked, so only the other turn of its document counts as its source
    turns = turns.join(c.filter("role = 'assistant'").select("conv_id", F.col("turn").alias("turn_id"), F.lit(True).alias("answer")),
                       ["conv_id", "turn_id"], "left")
    return evidence.misplaced(sentences.drop("skip"), turns, "conv_id", answers="answer")


@plan("t7_same_source_rule", """WITH d AS (SELECT l_orderkey, l_suppkey, bool_or(l_returnflag <> 'R') AS c, bool_or(l_returnflag = 'R') AS r FROM lineitem GROUP BY ALL)
  SELECT l_orderkey, bool_or(r AND NOT c) AS response_removed, count(*) FILTER (WHERE c) AS claim_docs FROM d GROUP BY l_orderkey""")
def t7(t):
    flag = F.col("l_returnflag")
    return evidence.same_source_rule(t.lineitem, "l_orderkey", "l_suppkey", flag != "R", flag == "R")


@plan("t7_response_removal", """WITH d AS (SELECT l_orderkey, l_suppkey, bool_or(l_returnflag <> 'R') AS c, bool_or(l_returnflag = 'R') AS r FROM lineitem GROUP BY ALL),
  g AS (SELECT l_orderkey FROM d GROUP BY l_orderkey HAVING bool_or(r AND NOT c))
  SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag <> 'R' OR l_orderkey NOT IN (SELECT l_orderkey FROM g)""")
def t7_removal(t):
    flag = F.col("l_returnflag")
    cites = t.lineitem.select("l_orderkey", "l_suppkey", "l_linenumber", "l_returnflag")
    return evidence.without_responses(cites, "l_orderkey", "l_suppkey", flag != "R", flag == "R").select("l_orderkey", "l_linenumber")


_TERM = r"""regexp_extract({0}.text, '([\p{{L}}]+)[^\p{{L}}]*$', 1)"""


@plan("t8_banned_terms", rf"""WITH w AS (SELECT DISTINCT {_TERM.format('b')} AS term FROM benchmark b WHERE length({_TERM.format('b')}) >= 4),
  h AS (SELECT doc_id, text, term, string_split(text, term) AS parts FROM documents, w WHERE contains(text, term)),
  o AS (SELECT doc_id, text, term, parts, unnest(range(1, len(parts))) AS j FROM h),
  p AS (SELECT doc_id, text, term, CAST(list_sum(list_transform(parts[1:j], lambda x: length(x))) + (j - 1) * length(term) AS BIGINT) AS pos FROM o)
  SELECT doc_id, term, pos, substr(text, greatest(pos - 12, 0) + 1, pos - greatest(pos - 12, 0) + length(term) + 12) AS context FROM p""")
def t8(t):
    # the table of terms: the last word of each item
    terms = t.benchmark.select(F.regexp_extract("text", r"([\p{L}]+)[^\p{L}]*$", 1).alias("term")).filter(F.length("term") >= 4)
    return evidence.banned_terms(t.documents, "doc_id", "text", terms, "term")


@plan("t9_unexpected_entities", r"""WITH c AS (SELECT DISTINCT regexp_extract(text, '[\p{L}]+') AS name FROM benchmark),
  o AS (SELECT doc_id, regexp_extract(text, '[\p{L}]+') AS name FROM documents)
  SELECT DISTINCT d.doc_id, c.name FROM documents d JOIN c ON c.name <> '' AND contains(d.text, c.name)
  WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.doc_id = d.doc_id AND o.name = c.name)""")
def t9(t):
    # the roster: the first word of each item, of any length; a document's own label is its first word
    name = F.regexp_extract("text", r"[\p{L}]+", 0).alias("name")
    return evidence.unexpected_entities(t.documents, "doc_id", "text", t.benchmark.select(name), t.documents.select("doc_id", name))


@plan("t10_extraction_agreement", r"""WITH p AS (SELECT page_id, regexp_extract(html, '<title>(.*?)</title>', 1) AS field,
    regexp_replace(regexp_extract(html, '(?s)<article>.*?</h1>(.*)</article>', 1), '<[^>]*>', '', 'g') AS second FROM pages),
  s AS (SELECT page_id, regexp_replace(field, '\s+', '', 'g') AS f, regexp_replace(second, '\s+', '', 'g') AS g FROM p)
  SELECT page_id, f <> '' AND contains(g, f) AS ok FROM s""")
def t10(t):
    field = F.regexp_extract("html", "<title>(.*?)</title>", 1)
    second = F.regexp_replace(F.regexp_extract("html", "(?s)<article>.*?</h1>(.*)</article>", 1), "<[^>]*>", "")
    return t.pages.select("page_id", evidence.agrees(field, second).alias("ok"))


@plan("t11_answer_parser", r"""WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
  x AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) - 1 AS n, unnest(ls) AS line FROM l),
  k AS (SELECT doc_id, n, line, CASE WHEN n % 7 = 0 THEN 'Issue' WHEN n % 7 IN (1, 3) THEN 'Member' WHEN n % 7 = 5 THEN 'Response' END AS kind FROM x),
  p AS (SELECT doc_id, n, kind, count(kind) OVER w AS part, count(CASE WHEN kind = 'Issue' THEN 1 END) OVER w AS issue FROM k
    WINDOW w AS (PARTITION BY doc_id ORDER BY n))
  SELECT doc_id, CAST(issue AS INTEGER) AS issue, CAST(part - min(part) OVER (PARTITION BY doc_id, issue) + 1 AS INTEGER) AS part, kind, lines, marks FROM (
  SELECT doc_id, issue, part, max(kind) AS kind, count(*) AS lines, CAST(sum(CASE WHEN kind IS NOT NULL THEN 4 ELSE 0 END) AS BIGINT) AS marks FROM p GROUP BY ALL)""")
def t11(t):
    # answers in the fixed format, made from the documents' lines: every continuation line keeps its own text
    lines = F.transform(
        F.split("text", "\n"),
        lambda s, i: F.concat(
            F.when(i % 7 == 0, F.lit("Issue: ")).when((i % 7 == 1) | (i % 7 == 3), F.lit("- Member: "))
            .when(i % 7 == 5, F.lit("- Response: ")).otherwise(F.lit("")),
            F.translate(s, "[]", ""),
            F.lit("¶"),
            F.when((i % 7 == 0) | (i % 7 == 1) | (i % 7 == 3) | (i % 7 == 5), F.lit(" [1, 3-5]")).otherwise(F.lit("")),
        ),
    )
    answers = t.documents.select("doc_id", F.array_join(lines, "\n").alias("answer"))
    parsed = evidence.parse_answer(answers, "doc_id", "answer", "Issue", "Member", "Response")
    return parsed.select(
        "doc_id", "issue", "part", "kind",
        F.regexp_count("text", F.lit("¶")).cast("long").alias("lines"), F.size("marks").cast("long").alias("marks"),
    )


@plan("t12_reference_merge", """WITH f AS (SELECT CAST(props->>'$.k' AS BIGINT) AS n, user_id, event_type, min(event_id) AS first FROM events GROUP BY ALL)
  SELECT n, user_id, string_agg(event_type, ',' ORDER BY first) AS fields FROM f GROUP BY ALL""")
def t12(t):
    refs = t.events.withColumn("n", F.get_json_object("props", "$.k").cast("long"))
    merged = evidence.merge_references(refs, ["n", "user_id"], "event_type", "event_id")
    return merged.select("n", "user_id", F.array_join("fields", ",").alias("fields"))
