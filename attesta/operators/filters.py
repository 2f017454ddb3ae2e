"""Predicates of the record model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.scale import lookup


def is_current(term_ok: Column, *leave_fields: Column) -> Column:
    """Current when the term matches and none of the leave fields is set."""
    left = F.lit(False)
    for field in leave_fields:
        left = left | (F.coalesce(field.cast("string"), F.lit("")) != "")
    return F.coalesce(term_ok, F.lit(False)) & ~left


def classify(text: Column, keyword: str, shapes: dict[str, str]) -> Column:
    """ignore without the keyword, the name of the first known shape, unknown otherwise."""
    out = F.when(~text.rlike(keyword), F.lit("ignore"))
    for name, pattern in shapes.items():
        out = out.when(text.rlike(pattern), F.lit(name))
    return out.otherwise(F.lit("unknown"))


def known_shapes(df: DataFrame, text: str, keyword: str, shapes: dict[str, str]) -> DataFrame:
    """Rows with a known shape; a row with the keyword and no known shape fails the job."""
    kind = classify(F.col(text), keyword, shapes)
    fail = F.raise_error(F.concat(F.lit("unknown shape: "), F.col(text))).cast("string")
    return df.withColumn("shape", F.when(kind == "unknown", fail).otherwise(kind)).filter("shape <> 'ignore'")


def names_list(value: Column, delimiter: str) -> Column:
    """A string or an array of names → array of trimmed names."""
    return F.transform(F.split(value, delimiter), lambda x: F.trim(x))


def readable(text: Column, script: str, least: float = 0.5, garble: str = "�", most: float = 0.02) -> Column:
    """Enough characters of the expected script and hardly any garbled ones."""
    n = F.length(text)
    expected = n - F.length(F.regexp_replace(text, f"[{script}]", ""))
    broken = n - F.length(F.regexp_replace(text, f"[{garble}]", ""))
    return F.coalesce((n > 0) & (expected / n > least) & (broken / n <= most), F.lit(False))


def since(facts: DataFrame, targets: DataFrame, key: str, date: str, start: str) -> DataFrame:
    """Facts from each target's own start on; one start per target."""
    first = targets.groupBy(key).agg(F.min(start).alias("__since"))
    return lookup(facts, first, [key], "inner").filter(F.col(date) >= F.col("__since")).drop("__since")
