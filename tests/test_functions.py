import datetime

import pytest
from pyspark.sql import functions as F

from attesta.functions import dates, ids, labels, names, text
from helpers import rows


def one(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select("i", expr(F.col("v")).alias("o")).orderBy("i").select("o").collect()]


def test_name_keys(spark):
    given = ["Rowan Vale", "vale・Rowan", "R‧41 (Ana)", "@FA3E@x 7", "７"]
    assert one(spark, given, names.latin_words) == ["rowan vale", "rowan vale", "ana r", "", ""]
    assert one(spark, ["12 Ana", "Ana Lor"], names.weak_key) == ["12", None]
    assert one(spark, ["O’Neil", "O＇Neil"], names.normalise) == ["O'Neil", "O'Neil"]
    assert one(spark, ["1ø2ß"], names.fold) == ["102s"]
    assert one(spark, ["ａｂｃ①"], names.nfkc) == ["abc1"]


def test_lists_and_marks(spark):
    found = one(spark, ["Rowan Vale (ill, home)、Imre Holt，  ;"], names.split_names)[0]
    assert [tuple(r) for r in found] == [("Rowan Vale", "ill, home"), ("Imre Holt", None)]
    marks = one(spark, ["Imre Holt (resigned)", "Imre Holt"], names.status_mark)
    assert [tuple(m) for m in marks] == [("Imre Holt", "resigned", False), ("Imre Holt", None, True)]


def test_dates_and_numerals(spark):
    given = ["114年5月28日", "114/05/28", "1140528", "2025-05-28T10:00", "114年13月1日", "unknown", None]
    day = datetime.date(2025, 5, 28)
    assert one(spark, given, dates.era_date) == [day, day, day, day, None, None, None]
    assert one(spark, ["十", "十一", "二十", "九十九", "三", "12", "百", "二x"], dates.numeral) == [10, 11, 20, 99, 3, 12, None, None]
    assert one(spark, ["8、13-16", "3", "1–2，9"], dates.number_ranges) == [[8, 13, 14, 15, 16], [3], [1, 2, 9]]
    assert one(spark, [3661.9, 59.0], dates.clock, "double") == ["1:01:01", "0:00:59"]


def test_numerals_round_trip(spark):
    df = spark.range(1, 100)
    assert df.filter(dates.numeral(dates.to_numeral(F.col("id"))) != F.col("id")).count() == 0


def test_squash_keeps_positions(spark):
    given = "〔p12〕Alpha  <i>be\nta"
    squashed = one(spark, [given], text.squash)[0]
    kept = one(spark, [given], text.kept_positions)[0]
    assert squashed == "Alphabeta" and "".join(given[i] for i in kept) == squashed
    assert len(one(spark, [given], text.blank_marks)[0]) == len(given)


@pytest.mark.parametrize("s", ["", "a", "ab", "abcab", "a.b c_d", "𝒳yz𝒳y"])
def test_bigrams(spark, s):
    bare = "".join(c for c in s if c.isalnum())
    assert sorted(one(spark, [s], text.bigrams)[0]) == sorted({bare[i : i + 2] for i in range(len(bare) - 1)})


def test_speaker_label(spark):
    given = ["First Chair: we begin", "It was, said Chair: no", "x" * 50 + " Chair: no", "Someone: no", "no label"]
    assert one(spark, given, lambda c: text.speaker_label(c, ["Chair"])) == ["First Chair", None, None, None, None]


def test_ids(spark):
    assert one(spark, ["ly-aa-03", "aa-council-01"], ids.area_of) == ["aa", "aa"]
    assert one(spark, ["http://a.org", "javascript:x", None], ids.safe_url) == ["https://a.org", None, None]
    parsed = one(spark, ["AA", "AA 2", "at-large", "ZZ 1"], lambda c: ids.parse_area(c, ["AA"], "at-large"))
    assert [tuple(p) for p in parsed] == [("aa", "ly-aa-01"), ("aa", "ly-aa-02"), (None, None), (None, None)]


def test_publisher_is_the_longest_suffix(spark):
    pages = spark.createDataFrame([("http://a.b.org/x",), ("http://b.org",), ("http://xb.org",), ("no link",)], "url string")
    known = spark.createDataFrame([("b.org", "B"), ("a.b.org", "A")], "host string, label string")
    assert rows(ids.publisher_of(pages, "url", known).select("url", "publisher").fillna("-")) == [
        ("http://a.b.org/x", "A"), ("http://b.org", "B"), ("http://xb.org", "-"), ("no link", "-")]


def test_media_grain(spark):
    df = spark.createDataFrame([(1.0, None, False, 1), (None, [5], True, 1), (None, None, True, 3), (None, None, False, 3), (None, None, False, 1)],
                               "s double, slots array<long>, clip boolean, n int")
    got = [r[0] for r in df.select(labels.media_grain(F.col("s"), F.col("slots"), F.col("clip"), F.col("n"))).collect()]
    assert got == ["own start", "own slots", "clip", "group", "whole session"]


def test_unique_segmentation_rejects_two_cuts(spark):
    tokens = spark.createDataFrame([("abcd",), ("abab",), ("abx",), ("ababab",)], "t string")
    known = spark.createDataFrame([("ab",), ("cd",), ("abab",)], "n string")
    got = names.unique_segmentation(tokens, "t", known, "n")
    assert rows(got.select("token", F.array_join("cuts", "+"))) == [("abcd", "ab+cd")]


def test_one_edit_repair_needs_one_candidate(spark):
    tokens = spark.createDataFrame([("rowan",), ("imra",), ("holt",), ("hold",), ("xx",)], "t string")
    known = spark.createDataFrame([("rowin",), ("imre",), ("imro",), ("holt",)], "n string")
    assert rows(names.one_edit_repair(tokens, "t", known, "n")) == [("hold", "holt"), ("rowan", "rowin")]


def test_range_list(spark):
    texts = ["第8.13-十六及3", "3、1、3", "二、三", "第十選", "", "5-2", "1-2-3", "x", None, " 7 "]
    assert one(spark, texts, dates.range_list) == [[3, 8, 13, 14, 15, 16], [1, 3], [2, 3], None, None, None, None, None, None, [7]]
    assert one(spark, ["1, x", "2-y"], dates.number_ranges) == [None, None]


def test_numerals_inside_lists(spark):
    texts = ["十、三十", "二十一–二十三及十一~十二", "一-3，0，九十九", "一二", "二十十", "3、", "、3", "-3", "12345", "1十"]
    assert one(spark, texts, dates.range_list) == [[10, 30], [11, 12, 21, 22, 23], [0, 1, 2, 3, 99], *[None] * 7]
    assert one(spark, ["十", "二十", "十九", "七十五", "7", "07", "123", "", None], dates.numeral) == [10, 20, 19, 75, 7, 7, None, None, None]


def test_merged_label(spark):
    known = F.array(*[F.lit(k) for k in ("Lee", "Ann Lee", "")])
    lines = ["so it is Ann Lee：", "so it is Lee: ", "Ann Lee:", "so it is Lee", "nobody:", None]
    got = one(spark, lines, lambda c: text.merged_label(c, known))
    assert [tuple(g) if g else None for g in got] == [("so it is ", "Ann Lee"), ("so it is ", "Lee"), ("Ann ", "Lee"), None, None, None]


def test_upper_keeps_the_length(spark):
    given = ["Erß", "ﬁn ŉ ᾳ ᾲ", "straße é ø 𐐨", "", None]
    assert one(spark, given, text.upper) == ["ERẞ", "ﬁN ŉ ᾼ ᾲ", "STRAẞE É Ø 𐐀", "", None]


def test_compatibility_form_of_odd_texts(spark):
    assert one(spark, ["ﬁ①", "e\u0301", "", None, "가"], names.nfkc) == ["fi1", "é", "", None, "가"]
