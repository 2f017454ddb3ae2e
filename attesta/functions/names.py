"""Name normalisation and keys as column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: separators that are not part of a name, apostrophe spellings, variant characters
SEPARATORS = r"[\s・·‧•．.]"
APOSTROPHES = "’‘＇"
VARIANTS = {"ø": "0", "ä": "a", "ö": "o", "ü": "u", "ß": "s", "é": "e", "è": "e", "ê": "e", "ç": "c", "ñ": "n",
            "á": "a", "í": "i", "ó": "o", "ú": "u"}
LATIN_WORD = r"(?<![@0-9A-Za-z])[A-Za-z]+(?![@0-9A-Za-z])"  # a word glued to digits or @ is a glyph code, not a word


def normalise(name: Column) -> Column:
    """Drop separators, one spelling for apostrophes."""
    return F.translate(F.regexp_replace(name, SEPARATORS, ""), APOSTROPHES, "'" * len(APOSTROPHES))


def fold(name: Column) -> Column:
    """Map variant characters to one form."""
    return F.translate(name, "".join(VARIANTS), "".join(VARIANTS.values()))


def weak_key(name: Column) -> Column:
    """What is left of a name without its Latin words and brackets; null (never equal) when nothing is left."""
    bare = F.regexp_replace(normalise(F.regexp_replace(name, LATIN_WORD, "")), "[()（）]", "")
    return F.nullif(bare, F.lit(""))


def latin_words(name: Column) -> Column:
    """Lower-cased Latin words, sorted: word order differs between sources."""
    words = F.regexp_extract_all(name, F.lit(f"({LATIN_WORD})"), F.lit(1))
    return F.array_join(F.array_sort(F.transform(words, F.lower)), " ")


def untitled(name: Column, titles: list[str]) -> Column:
    """Take a title out of the middle or the end of a name."""
    return F.regexp_replace(name, "(" + "|".join(titles) + ")", "")


def split_names(text: Column) -> Column:
    """Delimited list → array of (name, note); a bracketed note belongs to the name before it."""
    # a delimiter inside brackets does not split
    tokens = F.split(text, r"[、，,;\n]\s*(?![^(]*\))")
    pairs = F.transform(
        tokens,
        lambda t: F.struct(
            F.trim(F.regexp_replace(t, r"\([^()]*\)", "")).alias("name"),
            F.nullif(F.regexp_extract(t, r"\(([^()]*)\)", 1), F.lit("")).alias("note"),
        ),
    )
    return F.filter(pairs, lambda p: F.length(p["name"]) > 0)


def status_mark(name: Column) -> Column:
    """Bracketed mark at the end of a name → (name, note, current); current only without a mark."""
    note = F.nullif(F.regexp_extract(name, r"[(\[]([^()\[\]]+)[)\]]\s*$", 1), F.lit(""))
    return F.struct(
        F.trim(F.regexp_replace(name, r"[(\[][^()\[\]]+[)\]]\s*$", "")).alias("name"),
        note.alias("note"),
        note.isNull().alias("current"),
    )


@F.udf(T.StringType(), useArrow=False)
def nfkc(text: str | None) -> str | None:
    """Unicode compatibility form; the one normalisation Spark has no expression for.  Rows go in hundreds: ten thousand long texts would fill a worker."""
    return text if text is None else unicodedata.normalize("NFKC", text)


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _only_cut(length: pd.Series, spans: pd.Series) -> pd.Series:
    """Starts of the single way to tile 0..length with the given spans, else null."""

    def tile(n, pairs):
        ways, step = [0] * n + [1], [None] * n
        for begin, end in sorted(((int(p["begin"]), int(p["end"])) for p in pairs), reverse=True):
            if ways[end]:
                ways[begin], step[begin] = ways[begin] + ways[end], end
        if n == 0 or ways[0] != 1:
            return None
        cuts, at = [], 0
        while at < n:
            cuts.append(at)
            at = step[at]
        return cuts

    return pd.Series([tile(int(n), p) for n, p in zip(length, spans)])


def unique_segmentation(tokens: DataFrame, token: str, names: DataFrame, name: str, shortest: int = 2) -> DataFrame:
    """Tokens that can be cut into known names in exactly one way → (token, cuts).

    Every substring of a distinct token meets the names in an equi-join, so the name list is neither collected nor
    broadcast; the spans of one token are at most the square of its length.
    """
    distinct = tokens.select(F.col(token).alias("token")).filter(F.length("token") > 0).distinct()
    begins = distinct.select("token", F.explode(F.sequence(F.lit(1), F.length("token"))).alias("b"))
    parts = begins.filter(F.col("b") + shortest - 1 <= F.length("token")).select(
        "token", "b", F.explode(F.sequence(F.col("b") + shortest - 1, F.length("token"))).alias("e")
    )
    parts = parts.withColumn("part", F.expr("substring(token, b, e - b + 1)"))
    known = names.select(F.col(name).alias("part")).filter(F.length("part") >= shortest).distinct()
    spans = (
        parts.join(known, "part")
        .groupBy("token")
        .agg(F.collect_list(F.struct((F.col("b") - 1).alias("begin"), F.col("e").alias("end"))).alias("spans"))
    )
    cut = spans.withColumn("starts", _only_cut(F.length("token"), F.col("spans"))).filter(F.col("starts").isNotNull())
    ends = F.concat(F.expr("slice(starts, 2, size(starts))"), F.array(F.length("token")))
    cuts = F.transform(
        F.arrays_zip(F.col("starts").alias("b"), ends.alias("e")),
        lambda s: F.col("token").substr(s["b"] + 1, s["e"] - s["b"]),
    )
    return cut.select("token", cuts.alias("cuts"))


def one_edit_repair(tokens: DataFrame, token: str, names: DataFrame, name: str) -> DataFrame:
    """Tokens one substitution away from exactly one known name → (token, repaired).

    Two strings of equal length differ in one place exactly when they agree with that place blanked, so the candidates
    come from an equi-join on blanked forms (one row per character) and no pair of unlike strings is ever built.
    """

    def blanked(df, column, alias):
        chars = F.sequence(F.lit(1), F.length(alias))
        at = df.select(F.col(column).alias(alias)).filter(F.length(alias) > 0).distinct()
        at = at.select(alias, F.explode(chars).alias("i"))
        form = F.concat(F.expr(f"substring({alias}, 1, i - 1)"), F.lit("\u0000"), F.expr(f"substring({alias}, i + 1)"))
        return at.select(alias, form.alias("form"))

    # per form only the smallest and largest name matter: equal means one name, different means ambiguous
    known = blanked(names, name, "known").groupBy("form").agg(
        F.min("known").alias("lo"), F.max("known").alias("hi")
    )
    exact = names.select(F.col(name).alias("token")).distinct()
    near = blanked(tokens, token, "token").join(exact, "token", "left_anti").join(known, "form")
    return (
        near.groupBy("token")
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .filter(F.col("lo") == F.col("hi"))
        .select("token", F.col("lo").alias("repaired"))
    )
