import pytest
from pyspark.sql import functions as F

from attesta.operators import lifecycle as life
from attesta.session import scratch
from attesta.sources import scans, sinks
from helpers import rows

FACT = "k long, kind string, v string, fetched_at int"


def fact(spark, *data):
    return spark.createDataFrame(list(data), FACT)


def test_unchanged_rows_keep_their_stamp(spark):
    old = fact(spark, (1, "a", "x", 1), (2, "a", None, 1), (3, "a", "z", 1))
    new = fact(spark, (1, "a", "x", 2), (2, "a", None, 2), (3, "a", None, 2), (4, "a", "n", 2))
    got = life.upsert(old, new, ["k"])
    assert rows(got.select("k", F.coalesce("v", F.lit("-")), "fetched_at")) == [(1, "x", 1), (2, "-", 1), (3, "-", 2), (4, "n", 2)]
    again = life.upsert(got, new.withColumn("fetched_at", F.lit(3)), ["k"])
    assert again.exceptAll(got).count() == 0  # running twice changes nothing


def test_a_key_repeated_in_the_batch_is_written_once(spark):
    old = fact(spark, (1, "a", "x", 1))
    new = fact(spark, (1, "a", "y", 2), (1, "a", "z", 3), (2, "a", "p", 2), (2, "a", "p", 2), (3, "a", "n", 5), (3, "a", "m", 4))
    newest = [(1, "z", 3), (2, "p", 2), (3, "n", 5)]
    assert rows(life.upsert(old, new, ["k"]).select("k", "v", "fetched_at")) == newest
    assert rows(life.sparse_upsert(old, new, ["k"]).select("k", "v", "fetched_at")) == newest
    target, report = life.scope_replace(old, new, ["k"], F.col("kind") == "a")
    assert rows(target.select("k", "v", "fetched_at")) == newest and rows(report) == [("written", 3)]
    assert rows(life.write_once(old, new, ["k"]).select("k", "v", "fetched_at")) == [(1, "x", 1), (2, "p", 2), (3, "m", 4)]


def test_scope_replace_leaves_other_scopes(spark):
    old = fact(spark, (1, "a", "x", 1), (2, "a", "y", 1), (3, "b", "z", 1))
    target, report = life.scope_replace(old, fact(spark, (1, "a", "x", 2)), ["k"], F.col("kind") == "a")
    assert rows(target.select("k", "fetched_at")) == [(1, 1), (3, 1)]
    assert rows(report) == [("deleted", 1), ("written", 1)]


def test_failed_parse_deletes_nothing(spark):
    old = fact(spark, (1, "a", "p", 1), (2, "a", "q", 1))
    targets = spark.createDataFrame([("p",)], "v string")
    got = life.purge_departed(old, old.limit(0), ["k"], "v", F.col("kind") == "a", targets)
    assert rows(got.select("k")) == [(1,)]


def test_review_must_know_its_rows(spark):
    rows_ = spark.createDataFrame([(1, "registered", None, 5), (2, "registered", None, 5)], "k long, status string, url string, fetched_at int")
    ok = spark.createDataFrame([(1, "disqualified", "u"), (2, "qualified", "u")], "k long, result string, review_url string")
    assert rows(life.review_transition(rows_, ok, ["k"], "status", "url")) == [(2, "qualified", "u", 5)]
    stray = spark.createDataFrame([(9, "qualified", "u")], "k long, result string, review_url string")
    with pytest.raises(Exception, match="reviewed but not stored: 9"):
        life.review_transition(rows_, stray, ["k"], "status", "url").collect()


def document(spark):
    return spark.sql("""SELECT 1 AS id, array(
        named_struct('topic', 'Bridge', 'points', array('repair it soon', 'and paint it'), 'response', 'We will. In June.',
          'citations', array(named_struct('page', 3L, 'text', 'the bridge'), named_struct('page', 3L, 'text', 'the paint'), named_struct('page', 4L, 'text', 'June'))),
        named_struct('topic', 'School', 'points', array('meals'), 'response', CAST(NULL AS STRING), 'citations', array(named_struct('page', 5L, 'text', 'meals')))) AS issues""")


def edited(spark, *edits):
    e = spark.createDataFrame([(1, i, *x) for i, x in enumerate(edits)], "id int, no int, topic string, action string, text string, page long")
    return life.apply_edits(document(spark), e, ["id"]).first().issues


def test_edits_only_delete(spark):
    got = edited(spark, ("School", "drop_issue", None, None), ("Bridge", "drop_point_text", " soon", None),
                 ("Bridge", "drop_response_sentence", "In June.", None), ("Bridge", "drop_citation", "the paint", 3))
    assert len(got) == 1
    assert got[0].points == ["repair it", "and paint it"] and got[0].response == "We will."
    assert [c.text for c in got[0].citations] == ["the bridge", "June"]


@pytest.mark.parametrize("edit", [
    ("Harbour", "drop_issue", None, None),
    ("Bridge", "drop_point_text", "it", None),  # two points
    ("Bridge", "drop_point_text", "absent", None),
    ("School", "drop_point_text", "meals", None),  # nothing would be left
    ("Bridge", "drop_response_sentence", "absent", None),
    ("Bridge", "drop_citation", None, 3),  # two different quotations on the page
    ("School", "drop_citation", None, 5),  # the last one
    ("Bridge", "rewrite", "x", None),
])
def test_an_edit_that_does_not_match_once_fails(spark, edit):
    with pytest.raises(Exception, match="edit does not match"):
        edited(spark, edit)


def test_an_edit_of_an_unknown_document_fails(spark):
    e = spark.createDataFrame([(2, 1, "Bridge", "drop_issue", None, None)], "id int, no int, topic string, action string, text string, page long")
    with pytest.raises(Exception, match="edit of an unknown document: 2"):
        life.apply_edits(document(spark), e, ["id"]).collect()


@pytest.mark.parametrize("field", ["'x' AS text, false AS located, false AS short", "'x' AS text, true AS located, true AS short", "' ' AS text, true AS located, false AS short"])
def test_an_issue_keeps_a_usable_citation(spark, field):
    doc = spark.sql(f"""SELECT 1 AS id, array(named_struct('topic', 'T', 'points', array('p'), 'response', CAST(NULL AS STRING), 'citations', array(
        (SELECT struct(1L AS page, 'kept' AS text, true AS located, false AS short)), (SELECT struct(2L AS page, {field}))))) AS issues""")
    schema = "id int, no int, topic string, action string, text string, page long"
    assert len(life.apply_edits(doc, spark.createDataFrame([(1, 1, "T", "drop_citation", None, 2)], schema), ["id"]).first().issues[0].citations) == 1
    with pytest.raises(Exception, match="edit does not match: last citation"):
        life.apply_edits(doc, spark.createDataFrame([(1, 1, "T", "drop_citation", None, 1)], schema), ["id"]).collect()


def test_scopes_may_have_any_name_and_failures_say_why(spark):
    store = life.ScopeStore(spark, scratch(spark, "scopes"))

    def broken():
        raise ValueError("bad page 7")

    state = life.publish(store, {"a:b/c %": lambda: fact(spark, (1, "a", "x", 1)), "d": broken})
    assert rows(state) == [("a:b/c %", "published", None), ("d", "failed", "ValueError: bad page 7")]
    assert rows(store.read().select("k")) == [(1,)]
    assert life.run_failed(state) and not life.run_failed(state.filter("scope <> 'd'"))


def test_a_failing_scope_keeps_its_rows(spark):
    store = life.ScopeStore(spark, scratch(spark, "scopes"))
    life.publish(store, {"a": lambda: fact(spark, (1, "a", "x", 1)), "b": lambda: fact(spark, (2, "b", "y", 1))})

    def broken():
        return fact(spark, (3, "b", "z", 2)).withColumn("v", F.raise_error(F.lit("bad page")))

    state = life.publish(store, {"a": lambda: fact(spark, (4, "a", "n", 2)), "b": broken})
    assert rows(state.select("scope", "status")) == [("a", "published"), ("b", "failed")]
    assert rows(store.read().select("k", "kind")) == [(2, "b"), (4, "a")]


def test_redaction_and_reload(spark):
    base = scratch(spark, "snap")
    people = spark.createDataFrame([("p1", "Rowan", 1970)], "person_id string, name string, birth_year int")
    sinks.write_snapshot(people, base, "2024-01-01")
    sinks.write_snapshot(people.limit(0), base, "2023-01-01")
    want = people.withColumn("note", F.lit(None).cast("string")).schema
    got = scans.latest_snapshot(spark, base, want)
    assert [tuple(r) for r in got.collect()] == [("p1", "Rowan", None, None)]


def test_documents_continue_in_parts(spark, blocks):
    data = [("p", "a", f"event:{i:02d}", None if i == 7 else f"2024-01-{1 + i % 3:02d}") for i in range(11)]
    facts = spark.createDataFrame(data, "person_id string, kind string, fact_key string, date string").withColumn("date", F.to_date("date"))
    for c in ("data", "source_url", "fetched_at"):
        facts = facts.withColumn(c, F.lit("x"))
    docs = sinks.entity_docs(facts, per_part=4, key_prefix=6).orderBy("part").collect()
    assert [len(d.facts) for d in docs] == [4, 4, 3]
    keys = [f.fact_key for d in docs for f in d.facts]
    assert keys == sorted((d[2] for d in data if d[3]), key=lambda k: (-(int(k[-2:]) % 3), k)) + ["event:07"]


def test_member_of_an_unknown_district_fails(spark):
    d = spark.createDataFrame([("d1",)], "district string")
    m = spark.createDataFrame([("d1", 1), ("d9", 2)], "district string, id long")
    with pytest.raises(Exception, match="unknown district d9"):
        sinks.district_docs(d, m, "district", "id").collect()


def test_curated_table_is_strict(spark, tmp_path):
    def read(body):
        path = tmp_path / f"{abs(hash(body))}.csv"
        path.write_text("item,decision\n" + body)
        return scans.curated_csv(spark, str(path), "item string, decision string", ["item"], ["decision"], {"decision": ["add", "drop"]}).collect()

    assert len(read("a,add\nb,drop\n")) == 2
    for body, why in (("a,add\na,drop\n", "repeated key"), ("a,maybe\n", "not allowed"), ("a,\n", "missing")):
        with pytest.raises(Exception, match=why):
            read(body)


def test_incomplete_listing_fails(spark):
    pages = spark.sql("SELECT 'l' AS listing, 1L AS page, 3L AS total, array(named_struct('id', 1), named_struct('id', 2)) AS rows")
    assert not scans.page_completeness(pages).first().complete
    with pytest.raises(Exception, match="incomplete listing l"):
        scans.require_complete(pages).collect()
