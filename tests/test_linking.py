import random

import pytest
from pyspark.sql import functions as F

from attesta.operators import joins, linking
from helpers import rows

REMAP = [("aa", 1, 1), ("aa", 1, 2)]


def link(spark, records, candidates):
    r = spark.createDataFrame(records, "record_id string, area string, name string, office string, district_n long")
    c = spark.createDataFrame(candidates, "person_id string, name string, area string, district_id string")
    remap = spark.createDataFrame(REMAP, "area string, district_n long, new_n long")
    out = linking.certain_links(linking.new_districts(r, remap), c)
    return {x.record_id: (x.outcome, x.reason, x.person_id) for x in out.collect()}


def test_every_outcome(spark, blocks):
    records = [
        ("k1", "aa", "41 Ana", "councilor", 1), ("k2", "aa", "41", "councilor", 9), ("k3", "bb", "52", "councilor", 1),
        ("k4", "bb", "63 Lor", "councilor", 1), ("k5", "bb", "7ø", "councilor", 1), ("k6", "bb", "99", "councilor", 1),
        ("k7", "cc", "84", "mayor", 1), ("k8", "aa", "55", "councilor", 1), ("k9", "dd", "Rowan Vale", "councilor", 3),
    ]
    candidates = [
        ("p1", "41 Ana", "aa", "aa-council-1"), ("p3", "52", "bb", "bb-council-2"), ("p4", "63", "bb", "bb-council-1"),
        ("p5", "70", "bb", "bb-council-1"), ("p7", "84", "cc", "cc-council-5"), ("p8", "55", "aa", "aa-council-2"),
        ("p9", "Vale Rowan", "dd", "dd-council-3"),
    ]
    assert link(spark, records, candidates) == {
        "k1": ("review", "duplicate_name", None),  # another record shares the weak key
        "k2": ("review", "romanization", None),
        "k3": ("review", "no_overlap", None),
        "k4": ("review", "romanization", None),
        "k5": ("review", "variant", None),
        "k6": ("unregistered", "unregistered", None),
        "k7": ("link", None, "p7"),  # a mayor overlaps every district of the area
        "k8": ("link", None, "p8"),  # old district 1 became 1 and 2
        "k9": ("link", None, "p9"),  # an all-Latin name has a key of its own
    }


def test_weak_key_is_never_empty(spark):
    df = linking.with_name_keys(spark.createDataFrame([("Rowan Vale",), ("41",), ("41 Ana",)], "name string"))
    assert df.filter("weak IS NULL OR weak = ''").count() == 0


def test_namesakes_on_the_candidate_side_go_to_review(spark, blocks):
    got = link(spark, [("k", "aa", "41", "councilor", 3)], [(f"p{i}", "41", "aa", "aa-council-3") for i in range(9)])
    assert got == {"k": ("review", "duplicate_name", None)}


def test_required_lookup_fails_on_a_miss(spark):
    targets = spark.createDataFrame([("a", 1)], "name string, n long")
    members = spark.createDataFrame([("a", 2, "id")], "name string, n long, id string")
    try:
        linking.required_lookup(targets, members, ["name", "n"], "id").collect()
    except Exception as error:  # noqa: BLE001
        assert "no member for a 1" in str(error)
    else:
        raise AssertionError("a miss must fail")


def test_parent_value_is_inherited_only_when_unique(spark, blocks):
    rows_ = spark.createDataFrame([("v1", "p"), ("v2", "p"), ("v3", "q"), ("v4", "z")], "code string, parent string")
    exact = spark.createDataFrame([("v1", "p", "x"), ("w1", "q", "x"), ("w2", "q", "y")], "code string, parent string, value string")
    got = linking.unique_parent_fallback(rows_, exact, "code", "parent", "value").fillna("-")
    assert rows(got.select("code", "value", "how")) == [
        ("v1", "x", "exact"), ("v2", "x", "inherited"), ("v3", "-", "unmatched"), ("v4", "-", "unmatched")]


def test_range_tokens(spark):
    texts = spark.createDataFrame([(1, "East+Hill、Lake、West、Moor")], "text_id int, range string")
    units = spark.createDataFrame([("East", "Hill"), ("East", "Lake"), ("West", "Lake"), ("North", "Moor")], "town string, village string")
    got = linking.expand_ranges(texts, units).fillna("-")
    assert rows(got.select("at", "town_name", "village_name", "hits", "ok"), "at") == [
        (0, "East", "Hill", 1, True), (1, "East", "Lake", 1, True), (2, "West", "-", 1, True), (3, "East", "Moor", 0, False)]


def test_overlap_prefers_the_same_date(spark):
    docs = spark.createDataFrame([("s", "d", "a", 1), ("s", "d", "b", 1)], "kind string, doc string, m string, day int")
    groups = spark.createDataFrame([("s", "g1", "a", 1), ("s", "g1", "b", 1), ("s", "g2", "a", 2), ("s", "g2", "b", 2), ("s", "g3", "a", 1)],
                                   "kind string, grp string, m string, gday int")
    got = joins.best_overlap(docs, groups, "kind", "doc", "grp", "m", F.col("day"), F.col("gday"))
    assert rows(got.select("doc", "grp", "score")) == [("d", "g1", 2)]
    other = joins.best_overlap(docs, groups.withColumn("gday", F.lit(9)), "kind", "doc", "grp", "m", F.col("day"), F.col("gday"))
    assert rows(other.select("grp")) == [("g1",), ("g2",)]


@pytest.mark.parametrize("common", [0, 2, 1000])
@pytest.mark.parametrize("seed", [1, 2])
def test_best_overlap_matches_counting_all_pairs(spark, monkeypatch, seed, common):
    monkeypatch.setattr(joins, "COMMON", common)
    rnd = random.Random(seed)
    side = lambda n, everyone: [(rnd.choice("st"), f"x{rnd.randrange(n)}", rnd.randrange(30)) for _ in range(120)] + [(k, f"x{i}", 99) for k in "st" for i in range(n) if everyone]
    d, g = side(8, seed == 1), side(12, True)  # member 99 is in every group
    score = {}
    for k, doc, m in set(d):
        for k2, grp, m2 in set(g):
            if (k, m) == (k2, m2):
                score[k, doc, grp] = score.get((k, doc, grp), 0) + 1
    want = []
    for k, doc in {x[:2] for x in score}:
        best = max(n for key, n in score.items() if key[:2] == (k, doc))
        top = [(k, doc, grp, n) for (k2, doc2, grp), n in score.items() if (k2, doc2) == (k, doc) and n == best]
        want += [t for t in top if t[1] == t[2]] or top  # the same name stands for the same date
    df = spark.createDataFrame(d, "kind string, doc string, m int"), spark.createDataFrame(g, "kind string, grp string, m int")
    got = joins.best_overlap(*df, "kind", "doc", "grp", "m", F.col("doc"), F.col("grp"))
    assert rows(got.select("kind", "doc", "grp", "score")) == sorted(want)


def test_hopeless_pairs_are_not_counted(spark):
    d = spark.createDataFrame([("s", "d", m) for m in range(5)] + [("s", "d", 99)], "kind string, doc string, m int")
    g = spark.createDataFrame([("s", "g0", m) for m in range(5)] + [("s", f"g{i}", 99) for i in range(50)] + [("s", "g7", 1)], "kind string, grp string, m int")
    got = rows(joins.overlap_scores(d, g, "kind", "doc", "grp", "m", common=10).select("grp", "score"))
    assert got == [("g0", 6)]  # the 49 others cannot reach five


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_enclosing_spans_match_brute_force(spark, blocks, seed):
    rnd = random.Random(seed)
    spans = [(rnd.choice("ab"), i, *sorted((rnd.randrange(200), rnd.randrange(200)))) for i in range(25)] + [("a", 100, 0, 10_000_000), ("c", 101, 5, 5), (None, 102, 0, 9)]
    points = [(rnd.choice("abc"), rnd.randrange(220), i) for i in range(60)] + [("a", 9_999_999, 99), ("a", 10_000_000, 98)]
    want = sorted((d, p, i, s) for d, p, i in points for d2, s, lo, hi in spans if d == d2 and lo <= p < hi)
    p, s = spark.createDataFrame(points, "doc string, pos long, id int"), spark.createDataFrame(spans, "doc string, span int, lo long, hi long")
    assert rows(joins.enclosing_spans(p, s, "doc", "pos", "lo", "hi").select("doc", "pos", "id", "span")) == want


def test_a_long_span_is_a_few_rows(spark):
    df = spark.createDataFrame([(3, 10_000_000)], "lo long, hi long").select(F.explode(joins._nodes(F.col("lo"), F.col("hi"))).alias("n"))
    covered = sorted((r.n.place << r.n.level, (r.n.place + 1) << r.n.level) for r in df.collect())
    assert len(covered) <= 48 and covered[0][0] == 3 and covered[-1][1] == 10_000_000
    assert all(a[1] == b[0] for a, b in zip(covered, covered[1:]))


def test_contradiction_takes_the_whole_sentence(spark, blocks):
    a = spark.createDataFrame([(1, "x")], "day int, who string")
    b = spark.createDataFrame([(1, "x", "s1"), (1, "y", "s1"), (2, "x", "s2")], "day int, who string, sid string")
    assert rows(joins.drop_contradicted(a, b, ["day", "who"], "sid").select("sid", "day", "who")) == [("s2", 2, "x")]


def test_label_must_follow_the_call(spark, blocks):
    calls = spark.createDataFrame([("d", "a", 5), ("d", "a", 9), ("d", "b", 1)], "doc string, name string, pos long")
    said = spark.createDataFrame([("d", "a", 5), ("d", "a", 7), ("d", "c", 8)], "doc string, name string, pos long")
    got = joins.call_then_label(calls, said, ["doc", "name"], "pos")
    assert rows(got.select("name", "call_pos", "label_pos")) == [("a", 5, 7)]


def test_review_rows_name_the_candidates(spark):
    r = spark.createDataFrame([("k1", "bb", "63 Lor", "councilor", 1), ("k2", "bb", "7ø", "councilor", 1), ("k3", "cc", "84", "mayor", 1), ("k4", "bb", "99", "mayor", 1)],
                              "record_id string, area string, name string, office string, district_n long")
    c = spark.createDataFrame([("p1", "63", "bb", "bb-council-1"), ("p2", "63 Ana", "bb", "bb-council-2"), ("p3", "70", "bb", "bb-council-1"), ("p4", "84", "cc", "cc-mayor")],
                              "person_id string, name string, area string, district_id string")
    records = linking.new_districts(r, spark.createDataFrame(REMAP, "area string, district_n long, new_n long"))
    assert rows(linking.review_rows(records, c)) == [("k1", "romanization", "p1"), ("k1", "romanization", "p2"), ("k2", "variant", "p3")]
    nation = r.withColumn("area", F.when(F.col("record_id") != "k3", F.col("area")))
    assert rows(linking.nationwide_review(nation, c)) == [
        ("k1", "duplicate_name", "p1"), ("k1", "duplicate_name", "p2"), ("k2", "romanization_or_variant", "p3"), ("k3", "at_large", "p4")]


def test_a_repeated_record_key_stops_the_job(spark, blocks):
    r = spark.createDataFrame([("k1", "aa", "1"), ("k1", "aa", "2")], "record_id string, area string, name string")
    c = spark.createDataFrame([("p1", "1", "aa")], "person_id string, name string, area string")
    with pytest.raises(Exception, match="repeated record key: k1"):
        linking.nationwide_links(r, c).collect()
