"""Text shapes used by the evidence operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: marks that matching ignores (page marks, short angle-bracket tags)
IGNORED_MARKS = r"〔p\d+〕|<[^<>\n]{0,40}>"
WHITE_SPACE = " \t\n\x0b\f\r"
WORD_CHARS = r"[^\p{L}\p{N}]"
# letters with one capital; all lie below 0x20000
CAPITALS = {c: u for c in map(chr, range(0x20000)) for u in [c.upper() if len(c.upper()) == 1 else c.title()] if len(u) == 1 and u != c} | {"ß": "ẞ"}


def squash(text: Column) -> Column:
    """Text without ignored marks and white space."""
    bare = F.when(text.contains("<") | text.contains("〔"), F.regexp_replace(text, IGNORED_MARKS, "")).otherwise(text)
    return F.translate(bare, WHITE_SPACE, "")


def blank_marks(text: Column) -> Column:
    """Ignored marks replaced by as many blanks, so character positions stay valid."""
    marks = F.transform(
        F.regexp_extract_all(text, F.lit(f"({IGNORED_MARKS})"), F.lit(1)),
        lambda m: F.repeat(F.lit(" "), F.length(m)),
    )
    pieces = F.split(text, IGNORED_MARKS)
    return F.array_join(F.zip_with(pieces, marks, lambda p, m: F.concat(p, F.coalesce(m, F.lit("")))), "")


def kept_positions(text: Column) -> Column:
    """0-based positions of the characters that ``squash`` keeps."""
    chars = F.split(blank_marks(text), "")
    at = F.transform(chars, lambda c, i: F.when(~c.isin("", *WHITE_SPACE), i))
    return F.filter(at, lambda i: i.isNotNull())


def upper(text: Column) -> Column:
    """Capitals one for one, so the length stays: ß → ẞ, and a letter without a single capital (ﬁ) is left; Spark's own gives SS and FI."""
    return F.translate(text, "".join(CAPITALS), "".join(CAPITALS.values()))


def word_chars(text: Column) -> Column:
    return F.regexp_replace(text, WORD_CHARS, "")


def bigrams(text: Column) -> Column:
    """Distinct character pairs of the de-punctuated text: the pairs at even and at odd places, each in one scan."""
    w = word_chars(text)
    pairs = lambda c: F.regexp_extract_all(c, F.lit("(?s).."), F.lit(0))
    return F.array_distinct(F.concat(pairs(w), pairs(F.substring(w, 2, 2147483647))))


def garble_ratio(text: Column, expected: str) -> Column:
    """Share of characters outside the expected class."""
    total = F.length(text)
    return F.when(total > 0, (total - F.length(F.regexp_replace(text, f"[^{expected}]", ""))) / total)


def merged_label(line: Column, known: Column) -> Column:
    """(text, label) of a line that ends in a known label and a colon, with text before it; the longest label counts.  Else null."""
    body = F.regexp_replace(line, r"[:：]+\s*$", "")
    fits = F.filter(known, lambda w: (F.length(w) > 0) & F.endswith(body, w) & (F.length(body) > F.length(w)))
    longest = F.array_max(F.transform(fits, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))
    split = F.struct(F.substring(body, F.lit(1), F.length(body) - longest["n"]).alias("text"), longest["w"].alias("label"))
    return F.when(line.rlike(r"[:：]\s*$") & longest.isNotNull(), split)


def speaker_label(line: Column, roles: list[str], longest: int = 40) -> Column:
    """The label a line opens with, or null: short, without sentence marks, ending in a role word."""
    label = F.trim(F.regexp_extract(line, r"^\s*([^:：\n]{1,%d})[:：]" % longest, 1))
    fits = (F.length(label) > 0) & ~label.rlike(r"[.,;!?。，；！？]") & label.rlike("(" + "|".join(roles) + ")$")
    return F.when(fits, label)
