"""The operators as queries over the whole input tables, and the comparison SQL of those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.llm import (
    column_bwt, hash_tree, latent_leaks, line_labels, line_spread, nearest_examples, ngram_join, secret_forest, shallot, tier_packing,
    token_counts, turn_repair, warc,
)
from attesta.session import scratch

MIN_SITES = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"))


def op2_latent_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return latent_leaks.leaks(docs, table(spark, sf_dir, "benchmark"), latent_leaks.fit(docs))


def op3_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_spread.drop_boilerplate(table(spark, sf_dir, "documents"), MIN_SITES)
    return cut.select("doc_id", "n_lines", "n_removed", F.md5("text").alias("kept_md5"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op5_line_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_labels.label_documents(docs, line_labels.fit(docs, table(spark, sf_dir, "labels")))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    columns = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    responses = warc.read_archives(spark, path, f"{columns}, payload binary").filter("record_type = 'response'")
    revisits = warc.read_archives(spark, path, columns).filter("record_type = 'revisit'")
    return warc.verified(responses).drop("payload").unionByName(revisits)


def op7_column_bwt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_bwt.remove_repeats(table(spark, sf_dir, "documents"))


def op8_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_forest.scan(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_tier_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tier_packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = hash_tree.tree(2, 3, 4)
    return hash_tree.assign(table(spark, sf_dir, "documents"), root, hash_tree.grow(root))


def op11_nearest_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_examples.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair(turn_repair.damage(table(spark, sf_dir, "conversations")))


def op13_shallot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shallot.cluster(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_join, op2_latent_leaks, op3_line_spread, op4_token_counts, op5_line_labels, op6_warc, op7_column_bwt,
        op8_secret_forest, op9_tier_packing, op10_hash_tree, op11_nearest_examples, op12_turn_repair, op13_shallot, pipeline,
    )
}



def _repair_sql() -> str:
    """The cheapest repair by a table of four states per row; a label is nine digits of cost, the audit, a mark and the turns."""
    def label(x: str, cost: str, edit: str, turn: str = "''") -> str:
        return (f"(printf('%09d', CAST(left({x}, 9) AS INTEGER) + {cost}) || substr(split_part({x}, chr(1), 1), 10) || '{edit}' || chr(1)"
                f" || substr({x}, strpos({x}, chr(1)) + 1) || {turn})")

    def insert(x: str, role: str) -> str:
        return label(x, "3", "I", f"chr(10) || '{role}:'")

    def closed(rows: str) -> str:
        one = f"SELECT * REPLACE (least(u, {insert('e', 'user')}, {insert('s', 'user')}, {insert('a', 'user')}) AS u) FROM ({rows})"
        return f"SELECT * REPLACE (least(a, {insert('u', 'assistant')}) AS a) FROM ({one})"

    def keep(x: str, initial: str) -> str:
        return f"CASE WHEN NOT forced AND initial = '{initial}' THEN {label(x, 'late', 'K', 'chr(10) || role || chr(58) || text')} END"

    def rerole(x: str, role: str) -> str:
        return f"CASE WHEN NOT forced THEN {label(x, '(3 + late)', 'R', f'chr(10) || {chr(39)}{role}:{chr(39)} || text')} END"

    def to_user(x: str) -> str:
        return f"{keep(x, 'u')}, {rerole(x, 'user')}"

    gone = {x: label(x, "4", "D") for x in "esua"}
    step = closed("SELECT dp.conv_id, i.pos, e, s, u, a, forced, late, initial, role, text FROM dp JOIN items i ON i.conv_id IS NOT DISTINCT FROM dp.conv_id AND i.pos = dp.pos + 1")
    return f"""
WITH RECURSIVE sown AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
      list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ord(c) AS BIGINT))),
      lambda c, b: list_reduce(list_prepend(xor(c, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
        lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END))) % 20 AS lot
  FROM conversations),
rows AS (
  SELECT conv_id, turn, CASE WHEN lot = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN lot = 1 THEN '' WHEN lot = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE WHEN lot = 3 THEN 2 ELSE 1 END)) FROM sown WHERE lot <> 0)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
    regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS body FROM rows),
faulty AS (SELECT *, body = '' AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) AS pair FROM placed),
items AS (SELECT conv_id, pos, turn, role, text, pair, blank, NOT blank AND again AS duplicate, blank OR again AS forced, left(role, 1) AS initial,
    CASE WHEN blank OR again OR right(body, 1) IN ('.', '!', '?') THEN 0 ELSE 3 END AS late FROM faulty),
dp AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS pos, '000000000' || chr(1) AS e, CAST(NULL AS VARCHAR) AS s, CAST(NULL AS VARCHAR) AS u, CAST(NULL AS VARCHAR) AS a
  FROM conversations
  UNION ALL
  SELECT conv_id, pos, {gone['e']}, least({gone['s']}, {keep('e', 's')}), least({gone['u']}, {to_user('e')}, {to_user('s')}, {to_user('a')}),
    least({gone['a']}, {keep('u', 'a')}, {rerole('u', 'assistant')}) FROM ({step})),
ended AS (SELECT conv_id, least(e, a) AS best FROM ({closed("SELECT * FROM dp QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY pos DESC) = 1")})),
counted AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (late > 0) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM items GROUP BY conv_id)
SELECT d.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(left(best, 9) AS BIGINT) AS cost, substr(split_part(best, chr(1), 1), 10) AS audit,
  sha256(substr(best, strpos(best, chr(1)) + 2)) AS repaired_sha256
FROM ended d LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM d.conv_id"""


def _kmeans_sql(k: int = 16, rounds: int = 3) -> str:
    """Plain k-means: every distance of every round, one common table expression a round."""
    def assigned(i: int) -> str:
        return f"""a{i} AS (SELECT id, min(struct_pack(d := list_sum(list_transform(list_zip(e.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), j := c.j)) AS m
  FROM e, c{i} c GROUP BY id)"""

    def moved(i: int) -> str:
        return f"""s{i} AS (SELECT a.m.j AS j, p.pos, CAST(sum(e.v[p.pos]) AS BIGINT) AS s, count(*) AS n
  FROM a{i} a JOIN e USING (id), (SELECT unnest(range(1, 65)) AS pos) p GROUP BY ALL),
f{i} AS (SELECT j, list((s - ((s % n) + n) % n) // n ORDER BY pos) AS v FROM s{i} GROUP BY j),
c{i + 1} AS (SELECT c.j, coalesce(f.v, c.v) AS v FROM c{i} c LEFT JOIN f{i} f ON c.j = f.j)"""

    steps = ",\n".join(f"{assigned(i)},\n{moved(i)}" for i in range(rounds))
    return f"""
WITH e AS (SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS j, v FROM e QUALIFY j < {k}),
{steps},
{assigned(rounds)},
t AS (SELECT m.j AS j, CAST(sum(m.d) AS BIGINT) AS inertia FROM a{rounds} GROUP BY ALL)
SELECT e.vec_id, CAST(a.m.j AS INTEGER) AS cluster, CAST(a.m.d AS BIGINT) AS distance, t.inertia AS cluster_inertia,
  (SELECT CAST(sum(inertia) AS BIGINT) FROM t) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN e USING (id) JOIN t ON t.j = a.m.j JOIN c{rounds} c ON c.j = a.m.j"""


SQL: dict[str, str] = {
    "op3_line_spread": f"""
WITH lines AS (
  SELECT doc_id, source, pos, list[pos] AS line
  FROM (SELECT doc_id, source, string_split(text, chr(10)) AS list, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS pos
        FROM documents WHERE text IS NOT NULL)),
worded AS (SELECT * FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
spread AS (SELECT line, min(doc_id) AS first FROM worded GROUP BY line HAVING count(DISTINCT source) >= {MIN_SITES}),
marked AS (SELECT l.doc_id, l.pos, l.line, regexp_matches(l.line, '[^\\x20\\x09-\\x0D]') AS worded,
    s.first IS NOT NULL AND l.doc_id <> s.first AS gone
  FROM lines l LEFT JOIN spread s ON l.line = s.line),
kept AS (SELECT doc_id, count(*) FILTER (worded) AS n_lines, count(*) FILTER (gone) AS n_removed,
    coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed, md5(k.text) AS kept_md5
FROM documents d LEFT JOIN kept k USING (doc_id)""",
    "op6_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
f AS (SELECT html, min(page_id) AS first FROM p GROUP BY html),
h AS (SELECT p.page_id, CAST(strlen(p.html) AS BIGINT) AS payload_bytes, sha1(p.html) AS sha, f.first FROM p JOIN f USING (html))
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + (
    (CAST(('0x' || substr(sha, CAST(1 + (k // 8) * 10 AS BIGINT), 10)) AS BIGINT) >> CAST(35 - 5 * (k % 8) AS BIGINT)) & 31) AS BIGINT), 1)),
    'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM h""",
    "op12_turn_repair": _repair_sql(),
    "op13_shallot": _kmeans_sql(),
}
