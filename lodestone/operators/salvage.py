"""Greedy mending of studies: one change at a time, kept only if validation says that it did good.

A study's next step depends on what its steps before left, so steps are rounds; but a round takes one step
of every study at once, validates all of them in one job and is written before the next one begins. Studies
that have no step left take no part any more. The validation is the caller's, on DataFrames."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.operators import repair
from lodestone.sources import shared

_RECORD = ["paper_id", "kind", "record_id"]
_COUNTERS = [*repair.COUNTERS, "lost_verified_values"]
_QUALITY = "struct<" + ",".join(f"{x}:bigint" for x in _COUNTERS) + ">"


def _counted(found: DataFrame, name: str) -> DataFrame:
    """Quality as a struct of whole numbers, null counters 0."""
    return found.select("paper_id", F.struct(*[F.coalesce(F.col(f"quality.{x}").cast("long"), F.lit(0)).alias(x) for x in _COUNTERS]).cast(_QUALITY).alias(name))


def salvage(records: DataFrame, proposed: DataFrame, removals: DataFrame, position: str, kinds: list[str], quality: Callable[[DataFrame, DataFrame], DataFrame], folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What of a patch does good by itself: (records, steps, qualities).

    Proposed records are tried kind by kind in the order of ``kinds`` (others after them), each by ``position``, then removals;
    each stays if no counter gets worse, no verified value is lost and validation or semantic issues
    get fewer, judged on what the steps before left. ``quality(rows, baseline)`` gives (paper_id, quality), a struct of
    validation_issues, semantic_issues, missing_claims and lost_verified_values; a study without a row has none of
    them. steps: (paper_id, step, kind, record_id, removal, accepted); qualities: (paper_id, before, after) of the studies
    that have steps. There are as many rounds as the longest patch of one study has entries. Rows with a null id are an error of the caller's."""
    rank = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, kinds)), F.col("kind")), F.lit(0)), F.lit(len(kinds) + 1))
    row = F.struct(*records.columns)
    parts = proposed.select(*_RECORD, F.lit(False).alias("removal"), F.col(position).cast("double").alias("_at"), row.alias("_row"))
    parts = parts.unionByName(removals.select(*_RECORD, F.lit(True).alias("removal"), F.lit(None).cast("double").alias("_at"), F.lit(None).cast(parts.schema["_row"].dataType).alias("_row")))
    order = Window.partitionBy("paper_id").orderBy("removal", rank, F.asc_nulls_last("_at"), "record_id")
    entries = shared.written(parts.withColumn("step", F.row_number().over(order)), f"{folder}/entries")
    last = entries.groupBy("paper_id").agg(F.max("step").alias("_last"))
    rounds = entries.agg(F.max("step")).first()[0] or 0
    state = shared.written(records, f"{folder}/state-0")
    begun = shared.written(last.join(_counted(quality(state, state), "before"), "paper_id", "left").select("paper_id", F.coalesce("before", _none()).alias("before")), f"{folder}/quality-0")
    done, judged, current = [state.join(last, "paper_id", "left_anti")], [], begun.select("paper_id", F.col("before").alias("quality"))
    for k in range(1, rounds + 1):
        entry, active = entries.where(F.col("step") == k), last.where(F.col("_last") >= k)
        own = state.join(active, "paper_id", "left_semi")
        trial = shared.written(repair.apply_patch(own, entry.where(~F.col("removal")).select("_row.*"), entry.where("removal"), position), f"{folder}/trial-{k}")
        after = _counted(quality(trial, own), "after")
        both = entry.join(current.withColumnRenamed("quality", "before"), "paper_id").join(after, "paper_id", "left").withColumn("after", F.coalesce("after", _none()))
        fewer = (F.col("after.validation_issues") < F.col("before.validation_issues")) | (F.col("after.semantic_issues") < F.col("before.semantic_issues"))
        verdict = both.select(*_RECORD, "step", "removal", (repair.is_monotonic() & fewer).alias("accepted"), "before", "after")
        verdict = shared.written(verdict, f"{folder}/verdict-{k}")
        good = verdict.where("accepted").select("paper_id")
        state = shared.written(own.join(good, "paper_id", "left_anti").unionByName(trial.join(good, "paper_id", "left_semi")), f"{folder}/state-{k}")
        current = verdict.select("paper_id", F.when(F.col("accepted"), F.col("after")).otherwise(F.col("before")).alias("quality"))
        ended = last.where(F.col("_last") == k)
        done.append(state.join(ended, "paper_id", "left_semi"))
        judged.append((verdict.select("paper_id", "step", "kind", "record_id", "removal", "accepted"), current.join(ended, "paper_id", "left_semi")))
    steps = reduce(DataFrame.unionByName, [v for v, _ in judged]) if judged else entries.select("paper_id", "step", "kind", "record_id", "removal", F.lit(False).alias("accepted"))
    ends = reduce(DataFrame.unionByName, [q for _, q in judged]) if judged else current
    return reduce(DataFrame.unionByName, done), steps, begun.join(ends.withColumnRenamed("quality", "after"), "paper_id")


def _none() -> F.Column:
    return F.struct(*[F.lit(0).cast("long").alias(x) for x in _COUNTERS]).cast(_QUALITY)


def drop_unsupported(claims: DataFrame, validate: Callable[[DataFrame], DataFrame], removable: list[str], folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Optional claims that validation finds unsupported, dropped one by one: (claims, removals, issues left).

    ``claims``: (paper_id, claim_id, optional, ...), one row a claim; ``validate(claims)`` gives (paper_id, ordinal, claim_id, reason), claim_id null
    for issues of no claim. In each round a study tries the first issue with a reason of ``removable``, by ordinal, whose
    claim is optional and which was not tried since its last removal: the claim goes if there are fewer issues
    without it and of no reason more. removals: (paper_id, step, claim_id, reason). There are as many rounds as one study has
    trials at most; a round reads the studies that still have an issue to try."""
    claims = shared.written(claims, f"{folder}/claims")
    optional = claims.where("optional").select("paper_id", "claim_id")
    issues = shared.written(validate(claims).select("paper_id", F.col("ordinal").cast("long").alias("ordinal"), "claim_id", "reason", F.lit(-1).cast("long").alias("_after")), f"{folder}/issues-0")
    gone, left, k = claims.select("paper_id", F.lit(0).alias("step"), "claim_id", F.lit("").alias("reason")).where("false"), [], 0
    while True:
        k += 1
        tried = issues.where(F.col("reason").isin(*removable) & (F.col("ordinal") > F.col("_after"))).join(optional, ["paper_id", "claim_id"], "left_semi")
        first = F.min(F.struct("ordinal", "claim_id", "reason")).alias("_c")
        candidate = shared.written(tried.groupBy("paper_id").agg(first).select("paper_id", "_c.*"), f"{folder}/candidate-{k}")
        left.append(issues.join(candidate, "paper_id", "left_anti"))
        if candidate.isEmpty():
            return claims.join(gone, ["paper_id", "claim_id"], "left_anti"), gone, reduce(DataFrame.unionByName, left).drop("_after")
        issues = issues.join(candidate, "paper_id", "left_semi")
        drop = gone.select("paper_id", "claim_id").union(candidate.select("paper_id", "claim_id"))
        trial = claims.join(candidate, "paper_id", "left_semi").join(drop, ["paper_id", "claim_id"], "left_anti")
        found = shared.written(validate(trial).select("paper_id", F.col("ordinal").cast("long").alias("ordinal"), "claim_id", "reason", F.lit(-1).cast("long").alias("_after")), f"{folder}/found-{k}")
        counts = issues.select("paper_id", "reason", F.lit(1).alias("_a"), F.lit(0).alias("_b")).union(found.select("paper_id", "reason", F.lit(0), F.lit(1)))
        counts = counts.groupBy("paper_id", "reason").agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b")).groupBy("paper_id").agg(((F.sum("_b") < F.sum("_a")) & ~F.bool_or(F.col("_b") > F.col("_a"))).alias("accepted"))
        verdict = shared.written(candidate.join(counts, "paper_id"), f"{folder}/verdict-{k}")
        good = verdict.where("accepted")
        again = issues.drop("_after").join(verdict.where(~F.col("accepted")).select("paper_id", F.col("ordinal").alias("_after")), "paper_id")
        issues = shared.written(again.unionByName(found.join(good, "paper_id", "left_semi")), f"{folder}/issues-{k}")
        gone = shared.written(gone.unionByName(good.select("paper_id", F.lit(k).alias("step"), "claim_id", "reason")), f"{folder}/gone-{k}")
