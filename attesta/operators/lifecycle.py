"""Keyed merge and the life of a record: what changed, what stays, what may be deleted."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STAMP = "fetched_at"


def canonical_json(columns: Sequence[str]) -> Column:
    """JSON with keys in sorted order, so equal content is equal text."""
    return F.to_json(F.struct(*sorted(columns)))


def one_per_key(batch: DataFrame, key: Sequence[str], stamp: str = STAMP, first: bool = False) -> DataFrame:
    """Of rows with equal keys the one with the greatest (or least) stamp, then content: a key is written once."""
    rest = sorted((c for c in batch.columns if c not in key), key=lambda c: (c != stamp, c))
    if not rest:
        return batch.distinct()
    pick = (F.min if first else F.max)(F.struct(*rest)).alias("__row")
    return batch.groupBy(*key).agg(pick).select(*[c if c in key else F.col("__row")[c].alias(c) for c in batch.columns])


def _sides(target: DataFrame, batch: DataFrame, key: Sequence[str]):
    """Both sides of a keyed merge in one row; the key is unique on each side, so no row is multiplied."""
    t = target.select(*key, F.struct(*[c for c in target.columns if c not in key]).alias("old"))
    b = batch.select(*key, F.struct(*[c for c in batch.columns if c not in key]).alias("new"))
    return t.join(b, list(key), "full_outer")


def upsert(target: DataFrame, batch: DataFrame, key: Sequence[str], stamp: str = STAMP) -> DataFrame:
    """Insert or update by key; a row whose content is unchanged keeps its time stamp.  Of a key repeated in the batch the
    newest row counts."""
    cols = [c for c in target.columns if c not in key]
    changed = reduce(lambda a, b: a | b, [~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in cols if c != stamp], F.lit(False))
    take_new = F.col("new").isNotNull() & (F.col("old").isNull() | changed)
    j = _sides(target, one_per_key(batch.select(*target.columns), key, stamp), key)
    return j.select(*key, *[F.when(take_new, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in cols])


def sparse_upsert(target: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """Values that are absent in the batch never overwrite what is stored.  Of a repeated key the newest row counts."""
    given = set(batch.columns)
    j = _sides(target, one_per_key(batch, key), key)
    cols = [c for c in target.columns if c not in key]
    return j.select(
        *key, *[(F.coalesce(F.col(f"new.{c}"), F.col(f"old.{c}")) if c in given else F.col(f"old.{c}")).alias(c) for c in cols]
    )


def scope_replace(target: DataFrame, batch: DataFrame, key: Sequence[str], in_scope: Column) -> tuple[DataFrame, DataFrame]:
    """Upsert the batch, then delete rows of the same scope that the batch does not have → (target, report)."""
    gone = target.filter(in_scope).join(batch.select(*key), list(key), "left_anti")
    kept = target.join(gone.select(*key), list(key), "left_anti")
    merged = upsert(kept, batch, key)
    report = batch.select(*key).distinct().select(F.lit("written").alias("what")).unionByName(gone.select(F.lit("deleted").alias("what")))
    return merged, report.groupBy("what").agg(F.count(F.lit(1)).alias("n"))


def entity_replace(target: DataFrame, batch: DataFrame, key: Sequence[str], person: str, kind: str, kinds: Sequence[str], linked: DataFrame) -> DataFrame:
    """The listed kinds of a fetched person are replaced together; persons no longer linked lose them."""
    owned = F.col(kind).isin(*kinds)
    fetched = batch.select(person).distinct()
    own = target.filter(owned)
    # stored rows of linked persons that were not fetched this time stay
    stay = own.join(linked.select(person).distinct(), person, "left_semi").join(fetched, person, "left_anti")
    returning = own.join(batch.select(*key), list(key), "left_semi")
    return target.filter(~owned).unionByName(stay).unionByName(upsert(returning, batch, key).select(*target.columns))


def purge_departed(target: DataFrame, batch: DataFrame, key: Sequence[str], person: str, in_scope: Column, targets: DataFrame) -> DataFrame:
    """Delete only what belongs to persons who left the target set; rows this run failed to read stay."""
    departed = target.filter(in_scope).join(targets.select(person).distinct(), person, "left_anti")
    return upsert(target.join(departed.select(*key), list(key), "left_anti"), batch, key)


def write_once(target: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of new keys; of a key repeated in the batch the oldest row counts."""
    fresh = one_per_key(batch, key, first=True)
    return target.unionByName(fresh.join(target.select(*key), list(key), "left_anti").select(*target.columns))


def scan_plan(covered: DataFrame, wanted: DataFrame, source: str, member: str) -> DataFrame:
    """Per source: a member the last full scan did not cover asks for another full scan."""
    c = covered.select(source, member, F.lit(True).alias("c"), F.lit(False).alias("w"))
    w = wanted.select(source, member, F.lit(False).alias("c"), F.lit(True).alias("w"))
    each = c.unionByName(w).groupBy(source, member).agg(F.bool_or("c").alias("c"), F.bool_or("w").alias("w"))
    return each.groupBy(source).agg(
        F.count_if(F.col("w") & ~F.col("c")).alias("new_members"),
        F.when(F.bool_or(F.col("w") & ~F.col("c")), "full").otherwise("incremental").alias("scan"),
    )


def reread_window(stored: DataFrame, fresh: DataFrame, key: Sequence[str], date: str, last_run: Column, days: int = 60) -> DataFrame:
    """Fresh rows of the overlap replace stored rows of the same key; everything else stays."""
    from attesta.operators.sets import cached_merge

    window = fresh.filter(F.col(date) >= F.date_sub(last_run, days))
    return cached_merge(stored, window.select(*stored.columns), key)


def review_transition(rows: DataFrame, review: DataFrame, key: Sequence[str], status: str, url: str) -> DataFrame:
    """Disqualified rows go; the others take the review's status and link and keep their time stamp.

    A reviewed row that is not stored fails the job: the review list must be a subset of what it reviews.
    """
    r = review.select(*key, F.col("result").alias("__result"), F.col("review_url").alias("__url"))
    j = rows.withColumn("__stored", F.lit(True)).join(r, list(key), "full_outer")
    fail = F.raise_error(F.concat_ws(" ", F.lit("reviewed but not stored:"), *[F.col(k).cast("string") for k in key]))
    kept = j.filter(F.when(F.col("__stored").isNull(), fail.cast("boolean")).otherwise(F.coalesce(F.col("__result"), F.lit("")) != "disqualified"))
    return kept.withColumn(status, F.coalesce("__result", status)).withColumn(url, F.coalesce("__url", url)).select(*rows.columns)


def approved_only(docs: DataFrame, reviews: DataFrame, key: Sequence[str]) -> DataFrame:
    """Only documents with an approved review enter; no review is no approval."""
    return docs.join(reviews.filter("status = 'approved'").select(*key).distinct(), list(key), "left_semi")


def route_output(fresh: DataFrame, approved: DataFrame, key: Sequence[str]) -> DataFrame:
    """New output never overwrites an approved one: it is marked for the pending folder instead."""
    a = approved.select(*key).distinct().withColumn("__a", F.lit(True))
    return fresh.join(a, list(key), "left").withColumn("route", F.when(F.col("__a"), "pending").otherwise("publish")).drop("__a")


# --- curated edits -----------------------------------------------------------------------------------------------

CITATIONS = "array<struct<page:bigint,text:string,located:boolean,short:boolean>>"
ISSUES = f"array<struct<topic:string,points:array<string>,response:string,citations:{CITATIONS}>>"


def _mismatch(e: Column, what: str) -> Column:
    return F.raise_error(F.concat_ws(" ", F.lit("edit does not match:"), F.lit(what), e["topic"], e["text"], e["page"].cast("string")))


def _without(text: Column, part: Column) -> Column:
    """Text without the first occurrence of a part."""
    at = F.instr(text, part)
    return F.trim(F.concat(text.substr(F.lit(1), at - 1), text.substr(at + F.length(part), F.length(text))))


def _edit_issue(i: Column, e: Column) -> Column:
    in_point = F.size(F.filter(i["points"], lambda p: F.contains(p, e["text"])))
    points = F.filter(
        F.transform(i["points"], lambda p: F.when(F.contains(p, e["text"]), _without(p, e["text"])).otherwise(p)),
        lambda p: F.length(p) > 0,
    )
    points = (
        F.when(e["action"] != "drop_point_text", i["points"])
        .when(F.coalesce(in_point, F.lit(0)) != 1, _mismatch(e, "point").cast("array<string>"))
        .when(F.size(points) == 0, _mismatch(e, "last point").cast("array<string>"))
        .otherwise(points)
    )
    said = F.coalesce(F.contains(i["response"], e["text"]), F.lit(False))
    response = (
        F.when(e["action"] != "drop_response_sentence", i["response"])
        .when(~said, _mismatch(e, "response").cast("string"))
        .otherwise(F.nullif(_without(i["response"], e["text"]), F.lit("")))
    )
    meant = lambda c: (c["page"] == e["page"]) & F.startswith(c["text"], F.coalesce(e["text"], F.lit("")))
    usable = lambda c: (F.trim(F.coalesce(c["text"], F.lit(""))) != "") & F.coalesce(c["located"], F.lit(True)) & ~F.coalesce(c["short"], F.lit(False))
    kinds = F.size(F.array_distinct(F.transform(F.filter(i["citations"], meant), lambda c: c["text"])))
    left = F.filter(i["citations"], lambda c: ~F.coalesce(meant(c), F.lit(False)))
    kind = CITATIONS
    citations = (
        F.when(e["action"] != "drop_citation", i["citations"])
        .when(F.coalesce(kinds, F.lit(0)) != 1, _mismatch(e, "citation").cast(kind))
        .when(~F.exists(left, usable), _mismatch(e, "last citation").cast(kind))
        .otherwise(left)
    )
    return F.struct(i["topic"].alias("topic"), points.alias("points"), response.alias("response"), citations.alias("citations"))


def apply_edits(docs: DataFrame, edits: DataFrame, key: Sequence[str]) -> DataFrame:
    """Delete-only edits, in order; an edit that does not match exactly one place fails the job.

    docs: (key, issues); edits: (key, no, topic, action, text, page) with the actions drop_issue, drop_point_text,
    drop_response_sentence and drop_citation.  An edit of a document that is not there fails the job as well.  An issue must
    keep a usable citation: one with a text that was located and is not short; ``located`` and ``short`` may be missing.  The edits of one document are a hand-written list and are applied inside
    the document's row.
    """
    actions = ("drop_issue", "drop_point_text", "drop_response_sentence", "drop_citation")
    script = edits.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("no", "topic", "action", "text", "page"))).alias("script"))

    def step(issues, e):
        named = F.size(F.filter(issues, lambda i: i["topic"] == e["topic"]))
        edited = F.transform(issues, lambda i: F.when(i["topic"] == e["topic"], _edit_issue(i, e)).otherwise(i))
        return (
            F.when(~e["action"].isin(*actions), _mismatch(e, "action").cast(ISSUES))
            .when(named == 0, _mismatch(e, "issue").cast(ISSUES))
            .when(e["action"] == "drop_issue", F.filter(issues, lambda i: i["topic"] != e["topic"]))
            .otherwise(edited)
        ).cast(ISSUES)

    fields = [f.name for f in docs.schema["issues"].dataType.elementType["citations"].dataType.elementType]
    flag = lambda c, name: (c[name] if name in fields else F.lit(None)).cast("boolean").alias(name)
    whole = lambda c: F.struct(c["page"].alias("page"), c["text"].alias("text"), flag(c, "located"), flag(c, "short"))
    full = F.transform("issues", lambda i: i.withField("citations", F.transform(i["citations"], whole)))
    j = docs.withColumn("issues", full).withColumn("__known", F.lit(True)).join(script, list(key), "full_outer")
    stray = F.raise_error(F.concat_ws(" ", F.lit("edit of an unknown document:"), *[F.col(k).cast("string") for k in key]))
    j = j.filter(F.when(F.col("__known").isNull(), stray.cast("boolean")).otherwise(True)).drop("__known")
    script_type = "array<struct<no:int,topic:string,action:string,text:string,page:bigint>>"
    listed = F.coalesce(F.col("script").cast(script_type), F.array().cast(script_type))
    issues = F.aggregate(listed, F.col("issues").cast(ISSUES), step)
    return j.withColumn("issues", issues).drop("script")


# --- publishing one scope at a time --------------------------------------------------------------------------------


class ScopeStore:
    """Facts by scope: a scope is written to a new folder and becomes current by one manifest entry.

    A scope that fails leaves its current folder in place, so the other scopes publish without it.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self.manifest = f"{self.base}/manifest"

    def current(self) -> dict[str, tuple[int, str]]:
        """Scope → (version, folder); the scopes are the sources of a run, a list of dozens."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.manifest)
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return {}
        m = self.spark.read.schema("scope string, version long, path string").json(self.manifest)
        newest = m.groupBy("scope").agg(F.max(F.struct("version", "path")).alias("m")).select("scope", "m.version", "m.path")
        return {r.scope: (r.version, r.path) for r in newest.collect()}

    def read(self, scopes: Sequence[str] | None = None, current: dict | None = None) -> DataFrame | None:
        current = self.current() if current is None else current
        paths = [path for scope, (_, path) in current.items() if scopes is None or scope in scopes]
        return self.spark.read.parquet(*paths) if paths else None

    def write(self, scope: str, rows: DataFrame, version: int) -> None:
        path = f"{self.base}/data/{quote(scope, safe='')}/v{version}"  # a scope may hold any character
        rows.write.mode("overwrite").parquet(path)
        self._commit([(scope, version, path)])

    def _commit(self, entries: list[tuple[str, int, str]]) -> None:
        log = self.spark.createDataFrame(entries, "scope string, version long, path string")
        log.coalesce(1).write.mode("append").json(self.manifest)


def publish(store: ScopeStore, sources: dict[str, Callable[[], DataFrame]]) -> DataFrame:
    """Run every source; a failing one keeps its old rows and is reported → (scope, status, message).

    ``run_failed`` tells whether the run as a whole has failed.
    """
    state, current = [], store.current()
    for scope, build in sources.items():
        try:
            store.write(scope, build(), current.get(scope, (-1, ""))[0] + 1)
            state.append((scope, "published", None))
        except Exception as error:  # noqa: BLE001 - one source must not stop the others
            state.append((scope, "failed", f"{type(error).__name__}: {error}".splitlines()[0][:500]))
    return store.spark.createDataFrame(state, "scope string, status string, message string")


def run_failed(status: DataFrame) -> bool:
    """A run with a failed source must end with a failing exit status, after the others have been published."""
    return not status.filter("status = 'failed'").isEmpty()


# --- shaping facts -------------------------------------------------------------------------------------------------


def explicit_status(roster: DataFrame, rows: DataFrame, key: Sequence[str], empty: str) -> DataFrame:
    """Every roster member gets a row: counted records, or the explicit status that there are none."""
    n = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("records"))
    j = roster.select(*key).join(n, list(key), "left").fillna(0, ["records"])
    return j.withColumn("status", F.when(F.col("records") > 0, "ok").otherwise(empty))


def with_exclusions(accepted: DataFrame, rejected: DataFrame, kind: str) -> DataFrame:
    """Accepted facts and, for every rejected one, a fact that says why it is missing."""
    a = accepted.withColumn("kind", F.lit(kind)).withColumn("reason", F.lit(None).cast("string"))
    r = rejected.withColumn("kind", F.lit(f"{kind}_excluded"))
    return a.unionByName(r, allowMissingColumns=True)


def fan_out(events: DataFrame, names: str, people: DataFrame, prefix: str, key: str) -> tuple[DataFrame, DataFrame]:
    """One event naming k people becomes k facts; names without a person are skipped and counted."""
    each = events.withColumn("name", F.explode(names)).drop(names)
    facts = each.join(people.select("name", "person_id"), "name")
    facts = facts.withColumn("fact_key", F.concat_ws(":", F.lit(prefix), F.col(key).cast("string"), "person_id"))
    unmapped = each.join(people.select("name"), "name", "left_anti").groupBy("name").agg(F.count(F.lit(1)).alias("skipped"))
    return facts, unmapped


def attach_incumbency(candidates: DataFrame, offices: DataFrame, remap: DataFrame, person: str) -> DataFrame:
    """Candidates with their present offices as an array, renumbered districts expanded.

    offices: (person, office, district_id, suspended, basis).  Offices are made distinct per person before they are
    collected, so the array holds the few offices of a person however many rows state them.
    """
    new = remap.select(F.col("old").alias("district_id"), F.col("new").alias("__new"))
    placed = offices.join(new, "district_id", "left").withColumn("district_id", F.coalesce("__new", "district_id")).drop("__new")
    distinct = placed.groupBy(person, "office", "district_id", "basis").agg(F.bool_or("suspended").alias("suspended"))
    held = distinct.groupBy(person).agg(F.array_sort(F.collect_list(F.struct("office", "district_id", "suspended", "basis"))).alias("incumbent"))
    return candidates.join(held, person, "left")


def summary_kind(holds_office: Column, covered: Column, records: Column) -> Column:
    """What a person's summary is about: new, unrecorded, none or records."""
    return (
        F.when(~holds_office, "new").when(~covered, "unrecorded").when(records == 0, "none").otherwise("records")
    )


def select_dimensions(dims: Column, chosen: Sequence[str]) -> tuple[Column, Column]:
    """Chosen dimensions in their own order, and the ones left out, which are disclosed."""
    return F.filter(dims, lambda d: d["id"].isin(*chosen)), F.transform(F.filter(dims, lambda d: ~d["id"].isin(*chosen)), lambda d: d["id"])
