"""Patches of studies: what they may touch, how they are applied, and whether they do harm.

Records: (paper_id, kind, record_id, ...). A patch proposes records and names removals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RECORD = ["paper_id", "kind", "record_id"]
#: Counters that must not grow, in a record's before and after.
COUNTERS = ("validation_issues", "semantic_issues", "missing_claims")


def worklist(gaps: DataFrame, findings: DataFrame) -> DataFrame:
    """(paper_id, reason, kind, record_ids, block_ids, detail): work items of coverage gaps and validation findings;
    of items with the same reason, kind, records and detail the last stays.

    ``gaps``: (paper_id, ordinal, status, kind, record_ids, block_ids, label, has_missing_targets); covered,
    context and uncertain ones are no work. ``findings``: (paper_id, ordinal, kind, record_id, block_ids, path, reason)."""
    why = F.when(F.col("status") == "unclaimed", "unclaimed_record").when(F.col("has_missing_targets"), "shared_quantity_scope").when(F.col("status") == "possible_match", "claim_possible_match").otherwise("claim_unmatched")
    a = gaps.where(~F.col("status").isin("covered", "context", "uncertain")).select("paper_id", F.lit(0).alias("part"), "ordinal", why.alias("reason"), "kind", "record_ids", F.array_sort(F.array_distinct("block_ids")).alias("block_ids"), F.col("label").alias("detail"))
    scope = F.when(F.contains("reason", F.lit("absorber")), "absorber_scope").otherwise("validation_issue")
    ids = F.filter(F.array("record_id"), lambda x: x.isNotNull() & (x != ""))
    b = findings.select("paper_id", F.lit(1).alias("part"), "ordinal", scope.alias("reason"), "kind", ids.alias("record_ids"), F.array_sort(F.array_distinct("block_ids")).alias("block_ids"), F.concat_ws(": ", "path", "reason").alias("detail"))
    w = Window.partitionBy("paper_id", "reason", "kind", "record_ids", "detail").orderBy(F.desc("part"), F.desc("ordinal"))
    return a.unionByName(b).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "part", "ordinal")


def scope_issues(proposed: DataFrame, removals: DataFrame, work: DataFrame) -> DataFrame:
    """(paper_id, kind, record_id, issue): proposed records of kinds that are no work or whose id repeats, removals
    that were not asked for, and records both proposed and removed. No row: the patch is in scope."""
    kinds = work.select("paper_id", "kind").distinct()
    asked = work.where("reason = 'unclaimed_record'").select("paper_id", "kind", F.explode("record_ids").alias("record_id")).distinct()
    own, gone = proposed.select(*_RECORD), removals.select(*_RECORD)
    tag = lambda df, issue: df.select(*_RECORD, F.lit(issue).alias("issue"))
    return (
        tag(own.join(kinds, ["paper_id", "kind"], "left_anti"), "kind is no work").union(tag(own.groupBy(*_RECORD).count().where("count > 1"), "repeated id"))
        .union(tag(gone.join(asked, _RECORD, "left_anti"), "removal not asked for")).union(tag(own.join(gone, _RECORD, "left_semi").distinct(), "proposed and removed"))
    )


def restrict(proposed: DataFrame, removals: DataFrame, work: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The proposed records and removals that the work allows, and (paper_id, kind, discarded) of the others.

    A record is allowed by its id, or, where an item of its kind names none, as a new one."""
    normal = work.where("reason <> 'unclaimed_record'")
    named = normal.select("paper_id", "kind", F.explode("record_ids").alias("record_id")).distinct()
    fresh = normal.where(F.size("record_ids") == 0).select("paper_id", "kind").distinct()
    asked = work.where("reason = 'unclaimed_record'").select("paper_id", "kind", F.explode("record_ids").alias("record_id")).distinct()
    tagged = proposed.join(named.withColumn("_a", F.lit(True)), _RECORD, "left").join(fresh.withColumn("_b", F.lit(True)), ["paper_id", "kind"], "left").withColumn("_ok", F.col("_a").isNotNull() | F.col("_b").isNotNull())
    gone = removals.join(asked, _RECORD, "left_semi")
    lost = tagged.where(~F.col("_ok")).groupBy("paper_id", "kind").agg(F.count("*").alias("discarded"))
    unasked = removals.join(asked, _RECORD, "left_anti").groupBy("paper_id").agg(F.count("*").alias("discarded")).select("paper_id", F.lit("removals").alias("kind"), "discarded")
    return tagged.where("_ok").drop("_a", "_b", "_ok").select(*proposed.columns), gone, lost.union(unasked)


def apply_patch(records: DataFrame, proposed: DataFrame, removals: DataFrame, position: str) -> DataFrame:
    """``records`` less the removed, with the proposed in the place of those with their id, new ones at the end."""
    kept = records.join(removals.select(*_RECORD), _RECORD, "left_anti")
    held = kept.select(*_RECORD, F.col(position).alias("_old"))
    ends = records.groupBy("paper_id", "kind").agg(F.max(position).alias("_end"))
    placed = proposed.join(held, _RECORD, "left").join(ends, ["paper_id", "kind"], "left")
    w = Window.partitionBy("paper_id", "kind").orderBy(position, "record_id")
    new = placed.withColumn("_at", F.coalesce("_old", F.coalesce("_end", F.lit(-1)) + F.sum(F.col("_old").isNull().cast("int")).over(w))).withColumn(position, F.col("_at").cast(records.schema[position].dataType))
    return kept.join(proposed.select(*_RECORD), _RECORD, "left_anti").unionByName(new.select(*records.columns))


def patch_counts(proposed: DataFrame, removals: DataFrame) -> DataFrame:
    """(paper_id, kind, n): proposed records of each kind, and removals."""
    a = proposed.groupBy("paper_id", "kind").agg(F.count("*").alias("n"))
    return a.union(removals.groupBy("paper_id").agg(F.count("*").alias("n")).select("paper_id", F.lit("removals").alias("kind"), "n"))


def merged_notes(before: Column, added: Column) -> Column:
    """Notes in order, each once."""
    return F.array_distinct(F.concat(F.coalesce(before, F.array().cast("array<string>")), F.coalesce(added, F.array().cast("array<string>"))))


def lost_values(before: DataFrame, after: DataFrame) -> DataFrame:
    """(paper_id, lost): verified values (scope, name, raw_value, block_id) that a candidate no longer has."""
    key = ["paper_id", "scope", "name", "raw_value", "block_id"]
    papers = before.select("paper_id").distinct()
    gone = before.select(*key).distinct().join(after.select(*key).distinct(), key, "left_anti").groupBy("paper_id").agg(F.count("*").alias("lost"))
    return papers.join(gone, "paper_id", "left").fillna(0, ["lost"])


def is_monotonic(before: str = "before", after: str = "after") -> Column:
    """No counter of the struct ``after`` above that of ``before``, and no verified value lost."""
    out = F.col(f"{after}.lost_verified_values") == 0
    for name in COUNTERS:
        out = out & (F.col(f"{after}.{name}") <= F.col(f"{before}.{name}"))
    return out


def choose(drafts: DataFrame, candidates: DataFrame, by: list[str]) -> DataFrame:
    """(by, chosen): candidate where it does no harm to the draft, else draft. Both: (by, quality struct)."""
    both = drafts.select(*by, F.col("quality").alias("before")).join(candidates.select(*by, F.col("quality").alias("after")), by, "left")
    return both.select(*by, F.when(F.coalesce(is_monotonic(), F.lit(False)), "candidate").otherwise("draft").alias("chosen"))


def record_changes(before: DataFrame, after: DataFrame, content: str) -> DataFrame:
    """(paper_id, kind, record_id, change): added, removed and changed records, by a hash of their content."""
    a, b = (x.select(*_RECORD, F.sha2(F.col(content), 256).alias(n)) for x, n in ((before, "_a"), (after, "_b")))
    change = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(F.col("_a") != F.col("_b"), "changed")
    return a.join(b, _RECORD, "full_outer").select(*_RECORD, change.alias("change")).where("change is not null")


# ------------------------------------------------------------------ ledgers of claims
def namespaced(rows: DataFrame, namespace: Column, ids: list[str], lists: list[str] = ()) -> DataFrame:
    """``rows`` with namespace: before the ids of the given columns and arrays."""
    own = lambda x: F.concat(namespace, F.lit(":"), x)
    return rows.withColumns({x: own(F.col(x)) for x in ids} | {x: F.transform(x, own) for x in lists})


def combine_objects(objects: DataFrame, content: list[str]) -> DataFrame:
    """(paper_id, reading, object_id, retained_id): objects of several readings that agree in all content share
    the first one's id, unless some reading holds that content twice: such objects stay apart."""
    key = F.sha2(F.to_json(F.struct(*content), {"ignoreNullFields": "false"}), 256)
    keyed = objects.withColumn("_k", key)
    twice = keyed.groupBy("paper_id", "reading", "_k").count().where("count > 1").select("paper_id", "_k").distinct().withColumn("_twice", F.lit(True))
    first = keyed.groupBy("paper_id", "_k").agg(F.min_by("object_id", F.struct("reading", "object_id")).alias("_first"))
    both = keyed.join(first, ["paper_id", "_k"]).join(twice, ["paper_id", "_k"], "left")
    return both.select("paper_id", "reading", "object_id", F.when(F.col("_twice").isNotNull(), F.col("object_id")).otherwise(F.col("_first")).alias("retained_id"))


def combine_claims(claims: DataFrame, objects: DataFrame, content: list[str]) -> DataFrame:
    """(paper_id, claim_id, subjects, origins): claims that agree in content and (retained) subjects are one, under
    the first one's id. ``claims`` has reading and subject_object_ids; ``objects`` is ``combine_objects``' result."""
    places = claims.select("paper_id", "reading", "claim_id", F.posexplode_outer("subject_object_ids").alias("p", "object_id"))
    mapped = places.join(objects.select("paper_id", "object_id", "retained_id"), ["paper_id", "object_id"], "left")
    subjects = mapped.groupBy("paper_id", "reading", "claim_id").agg(F.transform(F.array_sort(F.collect_list(F.when(F.col("p").isNotNull(), F.struct("p", "retained_id")))), lambda x: x["retained_id"]).alias("subjects"))
    keyed = claims.drop("subject_object_ids").join(subjects, ["paper_id", "reading", "claim_id"])
    key = F.sha2(F.to_json(F.struct(*content, "subjects"), {"ignoreNullFields": "false"}), 256).alias("_k")
    out = keyed.groupBy("paper_id", key).agg(F.min_by("claim_id", F.struct("reading", "claim_id")).alias("claim_id"), F.first("subjects").alias("subjects"), F.array_sort(F.collect_list("claim_id")).alias("origins"))
    return out.drop("_k")
