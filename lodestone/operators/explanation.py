"""Why a fact was matched or not: one reason a selected fact, and the candidates that came nearest."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

REASONS = ("matched", "owner_unmatched", "one_to_one_competition", "ambiguity", "property_mismatch", "no_candidate", "value_mismatch", "context_mismatch", "value_and_context_mismatch")
_PLACE, _FACT = ["paper_id", "side", "path"], ["paper_id", "view", "side", "path"]


def explanations(selections: DataFrame, facts: DataFrame, pairs: DataFrame, found: DataFrame, most: int = 5) -> DataFrame:
    """(paper_id, view, side, path, reason, n_candidates, n_eligible, candidates) of each selected fact.

    ``selections``: (paper_id, view, side, path), side truth or prediction, view recovery or another; paths that are no
    fact, and repeated ones, have no row of their own. ``facts``: (paper_id, side, path, owner, owner_unmatched, ambiguous), one row a
    path; null flags are false. ``pairs``: (paper_id, truth_path, predicted_path, value_equal, context_equal, ambiguity_blocked) of the
    facts of one concept, one row a pair. ``found``: (paper_id, view, truth_path, predicted_path), the matches.

    A candidate is eligible if its value is equal and, but for recovery, its context too and nothing is
    ambiguous. ``candidates`` holds at most ``most``: the chosen one first, then eligible ones, then those that agree in most,
    then by path. A pair is one row, without views, until it stands beside its two facts: all
    that is shuffled by fact is a row a fact and two a pair, however many views there are."""
    flags = {x: F.coalesce(x, F.lit(False)) for x in ("value_equal", "context_equal", "ambiguity_blocked")}
    chosen = found.groupBy("paper_id", "truth_path", "predicted_path").agg(F.collect_set("view").alias("_chosen"))  # a pair's views
    judged = pairs.withColumns(flags).join(chosen, ["paper_id", "truth_path", "predicted_path"], "left")
    ends = F.array(*[F.struct(F.lit(side).alias("side"), F.col(name).alias("path")) for side, name in (("truth", "truth_path"), ("prediction", "predicted_path"))])
    near = judged.withColumn("_end", F.explode(ends)).select("paper_id", "_end.side", "_end.path", "truth_path", "predicted_path", *flags, "_chosen", F.lit(True).alias("_any"))
    is_ = lambda side: F.coalesce(F.bool_or(F.col("side") == side).over(Window.partitionBy("paper_id", "owner")), F.lit(False))
    shared = F.col("owner").isNotNull() & F.when(F.col("side") == "truth", is_("prediction")).otherwise(is_("truth"))
    flagged = facts.select(*_PLACE, F.struct(F.coalesce("owner_unmatched", F.lit(False)).alias("alone"), F.coalesce("ambiguous", F.lit(False)).alias("ambiguous"), shared.alias("shared")).alias("_f"))
    known = flagged.groupBy(*_PLACE).agg(F.collect_list("_f").alias("_own"))  # one, or more if a path repeats
    own = selections.groupBy(*_PLACE).agg(F.collect_set("view").alias("_views")).join(known, _PLACE)
    recovery = F.col("view") == "recovery"
    rows = own.join(near, _PLACE, "left").withColumn("view", F.explode("_views")).drop("_views").withColumn("selected", F.coalesce(F.array_contains("_chosen", F.col("view")), F.lit(False))).drop("_chosen")
    rows = rows.withColumn("eligible", F.col("value_equal") & (recovery | (F.col("context_equal") & ~F.col("ambiguity_blocked"))))
    nearness = F.col("value_equal").cast("int") + F.col("context_equal").cast("int")
    w = Window.partitionBy(*_FACT).orderBy(F.desc("selected"), F.desc("eligible"), F.desc(nearness), "truth_path", "predicted_path")
    shown = F.struct(F.col("_rank").alias("rank"), "truth_path", "predicted_path", "value_equal", "context_equal", "ambiguity_blocked", "eligible", "selected")
    own = rows.withColumn("_rank", F.row_number().over(w)).groupBy(*_FACT).agg(
        F.first("_own").alias("_own"), F.count("_any").alias("n_candidates"), F.count_if("eligible").alias("n_eligible"), F.bool_or("selected").alias("_hit"), F.bool_and("ambiguity_blocked").alias("_all_blocked"),
        F.bool_or(F.col("ambiguity_blocked") & F.col("context_equal") & F.col("value_equal")).alias("_blocked"), F.bool_or("value_equal").alias("_value"), F.bool_or(F.col("context_equal") & ~F.col("ambiguity_blocked")).alias("_context"),
        F.array_sort(F.collect_list(F.when(F.col("_any") & (F.col("_rank") <= most), shown))).alias("candidates"),
    )
    own = own.withColumn("_own", F.explode("_own"))
    has = lambda x: F.coalesce(F.col(x), F.lit(False))
    none = F.col("n_candidates") == 0
    reason = (
        F.when(has("_hit"), "matched").when(~recovery & F.col("_own.alone"), "owner_unmatched").when(F.col("n_eligible") > 0, "one_to_one_competition")
        .when(~recovery & (F.col("_own.ambiguous") | has("_all_blocked") | has("_blocked")), "ambiguity")
        .when(none & F.col("_own.shared"), "property_mismatch").when(none, "no_candidate").when(recovery, "value_mismatch")
        .when(has("_value"), "context_mismatch").when(has("_context"), "value_mismatch").otherwise("value_and_context_mismatch")
    )
    return own.select(*_FACT, reason.alias("reason"), "n_candidates", "n_eligible", "candidates")
