"""Dates, numerals and ranges written as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the era begins in 1911; numerals 1-10
ERA_OFFSET = 1911
NUMERALS = "一二三四五六七八九"
TEN = "十"
WRITTEN = f"[{NUMERALS}]?{TEN}[{NUMERALS}]?|[{NUMERALS}]"


def era_date(text: Column) -> Column:
    """``114年5月28日``, ``114/05/28``, ``1140528`` or ISO text → date; null when unreadable."""
    spaced = r"^\s*(\d{2,4})\s*[年./-]\s*(\d{1,2})\s*[月./-]\s*(\d{1,2})"
    compact = r"^\s*(\d{3})(\d{2})(\d{2})\s*$"

    def part(i: int) -> Column:
        found = F.coalesce(
            F.nullif(F.regexp_extract(text, spaced, i), F.lit("")),
            F.nullif(F.regexp_extract(text, compact, i), F.lit("")),
        )
        return found.cast("int")

    year = F.when(part(1) < ERA_OFFSET, part(1) + ERA_OFFSET).otherwise(part(1))
    return F.try_to_date(F.format_string("%04d-%02d-%02d", year, part(2), part(3)), "yyyy-MM-dd")


def _in_digits(text: Column) -> Column:
    """Valid numerals written as digits: 十 → 10, 三十 → 30, 二十一 → 21; the rest stays."""
    tens = F.regexp_replace(text, f"(?<![{NUMERALS}]){TEN}", NUMERALS[0] + TEN)
    return F.translate(F.regexp_replace(tens, f"{TEN}(?![{NUMERALS}])", "0"), NUMERALS + TEN, "123456789")


def numeral(text: Column) -> Column:
    """Numeral 1-99 (or plain digits) → int; null for anything else."""
    return F.when(text.rlike(rf"\A(\d{{1,2}}|{WRITTEN})\z"), _in_digits(text).try_cast("int"))


def to_numeral(n: Column) -> Column:
    """1-99 → numeral, the inverse of ``numeral``."""
    digits = F.array(*[F.lit(c) for c in NUMERALS])
    tens, ones = F.floor(n / 10).cast("int"), (n % 10).cast("int")
    return F.concat(
        F.when(tens > 1, F.try_element_at(digits, tens)).otherwise(F.lit("")),
        F.when(tens > 0, F.lit(TEN)).otherwise(F.lit("")),
        F.when(ones > 0, F.try_element_at(digits, ones)).otherwise(F.lit("")),
    )


def range_list(text: Column) -> Column:
    """``第8.13-十六及3`` → [3, 8, 13, 14, 15, 16]: digits or numerals, in ascending order, each once; null for anything else.

    The whole list is tested and rewritten in digits before it is cut, as functions of elements are interpreted.
    """
    number, marks = rf"(\d{{1,4}}|{WRITTEN})", "[、,，.及]"
    span = f"{number}([-–~]{number})?"
    bare = F.regexp_replace(text, r"\s|第", "")
    plain = F.translate(_in_digits(bare), "–~、，.及", "--,,,,")
    spans = F.transform(F.transform(F.split(plain, ","), lambda p: F.split(p, "-").try_cast("array<int>")), lambda e: F.when(
        e[0] <= F.element_at(e, -1), F.sequence(e[0], F.element_at(e, -1))))
    found = F.sort_array(F.array_distinct(F.flatten(spans)))  # a null span makes the whole null
    return F.when(bare.rlike(rf"\A{span}({marks}{span})*\z"), found)


def number_ranges(text: Column) -> Column:
    """``8, 13-16`` → [8, 13, 14, 15, 16], as written; null if a part is no number."""
    parts = F.split(F.regexp_replace(text, r"\s|第", ""), "[、,，]")
    spans = F.transform(
        parts,
        lambda p: F.sequence(
            F.split_part(F.regexp_replace(p, "[–~]", "-"), F.lit("-"), F.lit(1)).try_cast("int"),
            F.coalesce(
                F.nullif(F.split_part(F.regexp_replace(p, "[–~]", "-"), F.lit("-"), F.lit(2)), F.lit("")),
                F.split_part(p, F.lit("-"), F.lit(1)),
            ).try_cast("int"),
        ),
    )
    return F.flatten(spans)


def clock(seconds: Column) -> Column:
    """Seconds → ``h:mm:ss``."""
    s = F.floor(seconds).cast("long")
    return F.concat_ws(
        ":",
        F.floor(s / 3600).cast("string"),
        F.lpad((F.floor(s / 60) % 60).cast("string"), 2, "0"),
        F.lpad((s % 60).cast("string"), 2, "0"),
    )


def local_date(ts: Column, zone: str) -> Column:
    """UTC time → calendar date in ``zone``."""
    return F.to_date(F.from_utc_timestamp(ts.cast("timestamp"), zone))
