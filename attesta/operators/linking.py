"""Entity linking: a link is made only when it is certain, everything else is reported with a reason.

Uniqueness is decided on counts per key (map-side combined), so each record joins at most one row per lookup and no
pairs of namesakes are ever built, however many share a name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.functions import names
from attesta.scale import lookup


def with_name_keys(df: DataFrame, name: str = "name") -> DataFrame:
    """weak (script part; for all-Latin names the words themselves, never empty), words, folded."""
    c = F.col(name)
    words = names.latin_words(c)
    weak = F.coalesce(names.weak_key(c), words)
    return df.withColumns({"weak": weak, "words": words}).withColumn("folded", names.fold(F.col("weak")))


def _keyed(df: DataFrame, tiers: dict[str, Column], *carry: str) -> DataFrame:
    """One row per lookup key, so that several lookups become one join."""
    keys = F.array(*[F.struct(F.lit(name).alias("tier"), key.alias("key")) for name, key in tiers.items()])
    return df.select(*carry, F.inline(keys))


def new_districts(records: DataFrame, remap: DataFrame) -> DataFrame:
    """Old district → its new districts (one to many); areas without an entry keep their number."""
    table = remap.groupBy("area", "district_n").agg(F.array_sort(F.collect_set("new_n")).alias("new_ns"))
    joined = records.join(F.broadcast(table), ["area", "district_n"], "left")  # one row per district of the country
    ns = F.coalesce(F.col("new_ns"), F.array("district_n"))
    ids = F.transform(ns, lambda n: F.concat(F.col("area"), F.lit("-council-"), n.cast("string")))
    return joined.withColumn("district_ids", ids).drop("new_ns")


def districts_overlap(office: Column, area: Column, district_ids: Column, district_id: Column) -> Column:
    mayor = district_id == F.concat(area, F.lit("-mayor"))
    council = district_id.startswith(F.concat(area, F.lit("-council-")))
    return F.when(office == "mayor", mayor | council).otherwise(mayor | F.array_contains(district_ids, district_id))


def _full_key() -> Column:
    return F.concat_ws("|", "weak", "words")


def certain_links(records: DataFrame, candidates: DataFrame) -> DataFrame:
    """(record_id, outcome, reason, person_id, hits).

    Order of decisions: no exact hit → romanization, variant, unregistered; exact hit → duplicate_name when the weak
    key is not unique on both sides, link when the areas overlap, no_overlap otherwise.  ``hits`` counts the candidates
    behind a review row; they are found by (area, weak) in the candidate list.
    """
    weak, folded = F.col("weak"), F.col("folded")
    r, c = with_name_keys(records), with_name_keys(candidates)
    pool = _keyed(c, {"exact": _full_key(), "weak": weak, "folded": folded}, "area", "person_id", "district_id")
    own = _keyed(r, {"own": weak}, "area").withColumns(
        {x: F.lit(None).cast("string") for x in ("person_id", "district_id")}
    )
    index = pool.unionByName(own).groupBy("area", "tier", "key").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("person_id", "district_id")).alias("first")
    )
    asked = _keyed(
        r, {"exact": _full_key(), "weak": weak, "folded": folded, "own": weak}, "record_id", "area", "office", "district_ids"
    )
    found = lookup(asked, index, ["area", "tier", "key"])
    count = lambda tier: F.coalesce(F.max(F.when(F.col("tier") == tier, F.col("n"))), F.lit(0))
    j = found.groupBy("record_id").agg(
        *[count(x).alias(f"n_{x}") for x in ("exact", "weak", "folded", "own")],
        F.max(F.when(F.col("tier") == "exact", F.col("first"))).alias("first"),
        F.any_value(F.struct("office", "area", "district_ids")).alias("rec"),
    )
    hit = F.col("n_exact") > 0
    overlap = districts_overlap(F.col("rec.office"), F.col("rec.area"), F.col("rec.district_ids"), F.col("first.district_id"))
    reason = (
        F.when(~hit & (F.col("n_weak") > 0), F.lit("romanization"))
        .when(~hit & (F.col("n_folded") > 0), F.lit("variant"))
        .when(~hit, F.lit("unregistered"))
        .when((F.col("n_weak") > 1) | (F.col("n_own") > 1), F.lit("duplicate_name"))
        .when(~overlap, F.lit("no_overlap"))
    )
    outcome = (
        F.when(F.col("reason").isNull(), "link").when(F.col("reason") == "unregistered", "unregistered").otherwise("review")
    )
    return j.withColumn("reason", reason).select(
        "record_id",
        outcome.alias("outcome"),
        "reason",
        F.when(F.col("reason").isNull(), F.col("first.person_id")).alias("person_id"),
        F.when(hit, F.col("n_exact")).when(F.col("n_weak") > 0, F.col("n_weak")).otherwise(F.col("n_folded")).alias("hits"),
    )


def review_rows(records: DataFrame, candidates: DataFrame) -> DataFrame:
    """(record_id, reason, person_id): every candidate behind a record that ``certain_links`` left to review.

    The candidates are those of the key that decided: the weak key for ``romanization``, the folded one for ``variant``, the
    full one otherwise.
    """
    tier = F.when(F.col("reason") == "romanization", "weak").when(F.col("reason") == "variant", "folded").otherwise("exact")
    queue = certain_links(records, candidates).filter("outcome = 'review'").select("record_id", "reason", tier.alias("tier"))
    tiers = {"exact": _full_key(), "weak": F.col("weak"), "folded": F.col("folded")}
    pool = _keyed(with_name_keys(candidates), tiers, "area", "person_id")
    asked = _keyed(with_name_keys(records), tiers, "record_id", "area").join(queue, ["record_id", "tier"])
    return asked.join(pool, ["area", "tier", "key"]).select("record_id", "reason", "person_id")


def nationwide_review(records: DataFrame, candidates: DataFrame) -> DataFrame:
    """(record_id, reason, person_id): every candidate of the same folded name behind a record that was not linked."""
    queue = nationwide_links(records, candidates).filter("reason IS NOT NULL AND reason <> 'new'").select("record_id", "reason")
    pool = with_name_keys(candidates).select("folded", "person_id")
    return with_name_keys(records).select("record_id", "folded").join(queue, "record_id").join(pool, "folded").select("record_id", "reason", "person_id")


def cascade_match(records: DataFrame, candidates: DataFrame) -> DataFrame:
    """First tier with hits wins (exact, weak, folded); one hit is accepted, several are ambiguous."""
    tiers = {"1": _full_key(), "2": F.col("weak"), "3": F.col("folded")}
    pool = _keyed(with_name_keys(candidates), tiers, "area", "person_id")
    index = pool.groupBy("area", "tier", "key").agg(F.count(F.lit(1)).alias("n"), F.min("person_id").alias("one"))
    asked = _keyed(with_name_keys(records), tiers, "record_id", "area")
    found = lookup(asked, index, ["area", "tier", "key"])
    hit = F.when(F.col("n").isNotNull(), F.struct(F.col("tier").cast("int").alias("tier"), "n", "one"))
    out = found.groupBy("record_id").agg(F.min(hit).alias("best"))
    return out.select(
        "record_id",
        F.col("best.tier").alias("tier"),
        F.when(F.col("best.n") == 1, F.col("best.one")).alias("person_id"),
        F.when(F.col("best").isNull(), F.lit("not_found")).when(F.col("best.n") > 1, F.lit("ambiguous")).alias("reason"),
    )


def nationwide_links(records: DataFrame, candidates: DataFrame) -> DataFrame:
    """Uniqueness over the whole country on the folded weak key; an at-large record (null area) is never linked.

    A record key that occurs twice stops the job.
    """
    folded = F.col("folded")
    r, c = with_name_keys(records), with_name_keys(candidates)
    pool = _keyed(c, {"named": folded, "exact": _full_key()}, "person_id", "area")
    own = _keyed(r, {"own": folded}).withColumns({x: F.lit(None).cast("string") for x in ("person_id", "area")})
    index = pool.unionByName(own).groupBy("tier", "key").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("person_id", "area")).alias("first")
    )
    asked = _keyed(r, {"named": folded, "exact": _full_key(), "own": folded}, "record_id", "area")
    found = lookup(asked.withColumnRenamed("area", "own_area"), index, ["tier", "key"])
    pick = lambda tier, c: F.max(F.when(F.col("tier") == tier, F.col(c)))
    j = found.groupBy("record_id").agg(
        pick("named", "n").alias("n_named"), pick("own", "n").alias("n_own"), pick("exact", "first").alias("first"),
        F.max("own_area").alias("area"), F.count_if(F.col("tier") == "own").alias("copies"),
    )
    repeated = F.raise_error(F.concat_ws(" ", F.lit("repeated record key:"), F.col("record_id").cast("string")))
    j = j.filter(F.when(F.col("copies") > 1, repeated.cast("boolean")).otherwise(True))
    reason = (
        F.when(F.col("n_named").isNull(), F.lit("new"))
        .when((F.col("n_named") > 1) | (F.col("n_own") > 1), F.lit("duplicate_name"))
        .when(F.col("first").isNull(), F.lit("romanization_or_variant"))
        .when(F.col("area").isNull(), F.lit("at_large"))
        .when(F.col("first.area") != F.col("area"), F.lit("other_county"))
    )
    return j.withColumn("reason", reason).select(
        "record_id", "reason", F.when(F.col("reason").isNull(), F.col("first.person_id")).alias("person_id")
    )


def resolve_identity(records: DataFrame, manual: DataFrame, automatic: DataFrame, source: str) -> DataFrame:
    """Curated link before automatic link before a newly minted id; ``verified_by`` says which."""
    from attesta.functions.ids import mint_id

    j = records.join(manual.withColumnRenamed("person_id", "manual_id"), "record_id", "left").join(
        automatic.withColumnRenamed("person_id", "auto_id"), "record_id", "left"
    )
    minted = mint_id(F.lit(source), F.col("record_id"))
    return j.select(
        "record_id",
        F.coalesce("manual_id", "auto_id", minted).alias("person_id"),
        F.when(F.col("manual_id").isNotNull(), "curated").when(F.col("auto_id").isNotNull(), "automatic").otherwise(
            "minted"
        ).alias("verified_by"),
    )


def roster_lookup(df: DataFrame, roster: DataFrame, key: str, ident: str) -> DataFrame:
    """Name key → id when it is held by one id; otherwise a reason."""
    index = roster.groupBy(key).agg(F.min(ident).alias("lo"), F.max(ident).alias("hi"))
    j = lookup(df, index, [key])
    only = F.col("lo") == F.col("hi")
    return j.select(
        *df.columns,
        F.when(only, F.col("lo")).alias(ident),
        F.when(F.col("lo").isNull(), "no such person").when(~only, "duplicate").alias("reason"),
    )


def required_lookup(targets: DataFrame, members: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Every target must meet a member on all keys; a miss fails the job."""
    found = members.groupBy(*keys).agg(F.min(value).alias(value))
    j = lookup(targets, found, keys)
    miss = F.raise_error(F.concat_ws(" ", F.lit("no member for"), *[F.col(k).cast("string") for k in keys]))
    return j.withColumn(value, F.when(F.col(value).isNotNull(), F.col(value)).otherwise(miss.cast("string")))


def unique_parent_fallback(rows: DataFrame, exact: DataFrame, code: str, parent: str, value: str) -> DataFrame:
    """Value by exact code; else the parent's value when the parent has just one; else unmatched.

    ``code`` is the key of ``rows``; a parent may hold any number of them.
    """
    by_code = exact.groupBy(code).agg(F.min(value).alias("by_code"))
    by_parent = exact.groupBy(parent).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    j = lookup(rows, by_parent, [parent]).join(by_code, code, "left")
    inherited = F.when(F.col("lo") == F.col("hi"), F.col("lo"))
    return j.select(
        *rows.columns,
        F.coalesce("by_code", inherited).alias(value),
        F.when(F.col("by_code").isNotNull(), "exact").when(inherited.isNotNull(), "inherited").otherwise("unmatched").alias(
            "how"
        ),
    )


def eligible_district(asked: DataFrame, units: DataFrame, ident: str) -> DataFrame:
    """(town, village) → its district; the town's district when that is the only one; null otherwise."""
    village, town = F.concat_ws("|", "town", "village"), F.col("town").cast("string")
    index = _keyed(units, {"village": village, "town": town}, "district").groupBy("tier", "key").agg(
        F.min("district").alias("lo"), F.max("district").alias("hi")
    )
    found = lookup(_keyed(asked, {"village": village, "town": town}, ident), index, ["tier", "key"])
    only = lambda t: F.max(F.when((F.col("tier") == t) & (F.col("lo") == F.col("hi")), F.col("lo")))
    j = found.groupBy(ident).agg(only("village").alias("own"), only("town").alias("whole"))
    return j.select(
        ident, F.coalesce("own", "whole").alias("district"), (F.col("own").isNull() & F.col("whole").isNotNull()).alias("fallback")
    )


def coverage_label(villages: DataFrame) -> DataFrame:
    """Per town: wholly, partly (listing the villages, one row each in the input) or not inside the district."""
    t = villages.groupBy("town").agg(
        F.bool_and("inside").alias("whole"),
        F.bool_or("inside").alias("some"),
        F.array_sort(F.collect_set(F.when(F.col("inside"), F.col("village")))).alias("names"),
    )
    label = (
        F.when(F.col("whole"), "whole")
        .when(F.col("some"), F.concat(F.lit("partly: "), F.array_join("names", ",")))
        .otherwise("outside")
    )
    return t.select("town", label.alias("label"))


def expand_ranges(texts: DataFrame, universe: DataFrame) -> DataFrame:
    """``A、B、Town+village``: each token of a range text resolves to exactly one unit of the universe.

    A bare token is a town or a village of the town named last before it; tokens of one text stay in one row until
    resolved, so only the text's own length bounds the work.  Returns (text_id, at, token, town, village, hits, ok).
    """
    tokens = F.split("range", "、")
    # the town carried along: the prefix before + in the latest token that has one
    prefix = F.transform(tokens, lambda s: F.when(s.contains("+"), F.split_part(s, F.lit("+"), F.lit(1))))
    carried = F.transform(
        F.sequence(F.lit(1), F.size(prefix)),
        lambda i: F.try_element_at(F.filter(F.slice(prefix, F.lit(1), i), lambda p: p.isNotNull()), F.lit(-1)),
    )
    t = texts.select("text_id", F.posexplode(F.arrays_zip(tokens.alias("token"), carried.alias("current"))).alias("at", "x")).select(
        "text_id", "at", F.col("x.token").alias("token"), F.col("x.current").alias("current")
    )
    t = t.withColumn("unit", F.when(F.col("token").contains("+"), F.split_part("token", F.lit("+"), F.lit(2))).otherwise(F.col("token")))
    as_town = F.when(~F.col("token").contains("+"), F.col("unit"))
    asked = _keyed(t, {"town": as_town, "village": F.concat_ws("|", "current", "unit")}, "text_id", "at", "token", "current", "unit")
    units = _keyed(universe, {"village": F.concat_ws("|", "town", "village")})
    towns = _keyed(universe.select("town").distinct(), {"town": F.col("town")})
    index = units.unionByName(towns).groupBy("tier", "key").agg(F.count(F.lit(1)).alias("n"))
    count = lambda tier: F.coalesce(F.max(F.when(F.col("tier") == tier, F.col("n"))), F.lit(0))
    j = lookup(asked, index, ["tier", "key"]).groupBy("text_id", "at", "token", "current", "unit").agg(
        count("town").alias("towns"), count("village").alias("villages")
    )
    whole, hits = F.col("towns") > 0, (F.col("towns") + F.col("villages")).cast("int")
    return j.select(
        "text_id", "at", "token",
        F.when(whole, F.col("unit")).otherwise(F.col("current")).alias("town_name"),
        F.when(~whole, F.col("unit")).alias("village_name"),
        hits.alias("hits"), (hits == 1).alias("ok"),
    )


def fill_from_sole_donor(rows: DataFrame, donors: DataFrame, curated: DataFrame, key: str, value: str) -> DataFrame:
    """Missing attribute from the only donor with the same key, else from a curated row, else a review reason."""
    d = donors.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("donor"))
    c = curated.select(key, F.col(value).alias("curated"))
    j = lookup(rows, d.join(c, key, "full_outer"), [key])
    given = F.when(F.col("n") == 1, F.col("donor"))
    filled = F.coalesce(F.col(value), given, F.col("curated"))
    reason = F.when(filled.isNull() & F.col("n").isNull(), f"no_{value}").when(filled.isNull(), f"ambiguous_{value}")
    return j.select(*[x for x in rows.columns if x != value], filled.alias(value), reason.alias("reason"))
