import pytest
from pyspark.sql import functions as F

from attesta.operators import filters, gates
from attesta.sources import sinks
from helpers import rows


def test_row_constraints(spark):
    df = spark.createDataFrame([(1, "https://a", "{}", "p"), (2, None, "{", "p"), (3, "ftp://a", "[1]", "q")], "id int, url string, data string, person string")
    people = spark.createDataFrame([("p",)], "pid string")
    got = gates.row_constraints(df, "id", ["url"], "url", "data", [("person", people, "pid")])
    assert rows(got) == [(2, "data is no JSON"), (2, "url is no link"), (2, "url is null"), (3, "person unknown"), (3, "url is no link")]


def test_declared_count_reasons(spark):
    members = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, "a"), (3, "a")], "m int, name string")
    heads = spark.createDataFrame([(1, 2), (2, 2), (3, 2), (4, 1)], "m int, n int")
    got = {r.m: r.reason for r in gates.declared_count(members, heads, "m", "name", "n").collect()}
    assert got == {1: None, 2: "repeated name", 3: "count differs", 4: "no list"}


def test_a_table_with_unequal_columns_is_rejected(spark):
    df = spark.createDataFrame([("T", 5, 1), ("T", 4, 2), ("U", 5, 1), ("U", 4, 1)], "t string, present int, leave int")
    got = gates.equal_sums(df, "t", F.col("present") + F.col("leave"))
    ok, bad = gates.split(got)
    assert rows(ok) == [("T",)] and rows(bad) == [("U", "column sums differ")]


def test_both_lists(spark):
    p = spark.createDataFrame([(1,), (2,), (4,)], "id int")
    g = spark.createDataFrame([(2, "from 14:00"), (3, None), (4, None)], "id int, note string")
    assert rows(gates.both_lists(p, g, ["id"], "note")) == [(1, "present", False), (2, "present", True), (3, "leave", False), (4, "error", False)]


def test_identity_reports_the_first_difference(spark):
    a = spark.createDataFrame([(1, 5, "x"), (2, 6, "y"), (3, 7, "z"), (4, 8, "w")], "k int, year int, party string")
    b = spark.createDataFrame([(1, 5, "x"), (2, 9, "q"), (3, 7, None)], "k int, year int, party string")
    got = {r.k: r.reason for r in gates.identity_agreement(a, b, "k", ["year", "party"]).collect()}
    assert got == {1: None, 2: "year differs", 3: "party differs", 4: "no reference"}


def test_nested_sensitive_fields_are_found(spark):
    df = spark.sql("SELECT 1 AS id, array(named_struct('birth_date', 'x', 'm', map('a', named_struct('birth_year', 1)))) AS people")
    assert gates.forbidden_fields(df, ["birth_date", "birth_year"]) == ["people.birth_date", "people.m.birth_year"]


def test_reject_rate(spark):
    df = spark.createDataFrame([("f", i < 2, False) for i in range(5)] + [("g", i < 1, False) for i in range(3)] + [("h", False, i < 2) for i in range(3)],
                               "f string, bad boolean, bare boolean")
    got = {r.f: r.reason for r in gates.reject_rate(df, "f", F.col("bad"), F.col("bare")).collect()}
    assert got == {"f": "too many rejects", "g": None, "h": "names only"}


def test_unknown_shape_fails_loudly(spark):
    df = spark.createDataFrame([("weather",), ("session 3 video",)], "t string")
    assert rows(filters.known_shapes(df, "t", "session", {"video": r"session \d+ video"})) == [("session 3 video", "video")]
    odd = spark.createDataFrame([("session three video",)], "t string")
    with pytest.raises(Exception, match="unknown shape: session three video"):
        filters.known_shapes(odd, "t", "session", {"video": r"session \d+ video"}).collect()


def test_shifted_listing_fails(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, title string")
    assert gates.listing_agrees(a, a, "k", ["title"]).count() == 2
    with pytest.raises(Exception, match="differ at 2"):
        gates.listing_agrees(a, spark.createDataFrame([(2, "z")], "k int, title string"), "k", ["title"]).collect()


def test_require_empty(spark):
    df = spark.createDataFrame([(1,)], "id int")
    assert gates.require_empty(df.limit(0), "stray edit").count() == 0
    with pytest.raises(Exception, match="stray edit"):
        gates.require_empty(df, "stray edit").collect()


def test_sensitive_fields_inside_payloads(spark):
    data = [("f1", '{"a":[{"birth_date":1}]}'), ("f2", '{"a":"birth_date","b":[1,[{"c":{"birth_year":null}}],{"birth_date":{"birth_year":2}}]}'), ("f3", "no json"), ("f4", None), ("f5", "7"), ("f6", "{}")]
    facts = spark.createDataFrame(data, "fact_key string, data string")
    found = gates.payload_fields(facts, "fact_key", "data").filter(F.col("field").startswith("birth"))
    assert rows(found.select("fact_key", "path")) == [("f1", "a.[0].birth_date"), ("f2", "b.[1].[0].c.birth_year"), ("f2", "b.[2].birth_date"), ("f2", "b.[2].birth_date.birth_year")]
    assert gates.payload_fields(facts.limit(0), "fact_key", "data").count() == 0


def test_sensitive_fields_leave_payloads(spark):
    texts = ['{"a":[{"birth_date":1,"n":"é"}],"birth_year":[2]}', '{"birth\\u005fdate":1,"x":[]}', '{"note":"birth_date","k":1.5}', "not birth_date json", None, '{"k": 1}']
    df = spark.createDataFrame([(t,) for t in texts], "data string")
    got = [r[0] for r in df.select(sinks.redacted(F.col("data"), sinks.SENSITIVE)).collect()]
    assert got == ['{"a":[{"n":"é"}]}', '{"x":[]}', '{"note":"birth_date","k":1.5}', "not birth_date json", None, '{"k": 1}']
