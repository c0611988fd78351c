"""Review logs: events of reviewers, folded to the current state of records and stages.

Events: (paper_id, revision, event_id, reviewer_id, kind, undoes: id of the event it withdraws or null,
record_key, record_digest, decision, stage). An event that another one undoes has never happened."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_KEY = ["paper_id", "reviewer_id"]


def marked_undone(events: DataFrame, by: list[str] = ("paper_id",)) -> DataFrame:
    """``events`` with is_undone: whether an event of the same paper undoes it, by id."""
    gone = events.where("undoes is not null").select(*by, F.col("undoes").alias("event_id")).distinct().withColumn("_gone", F.lit(True))
    return events.join(gone, [*by, "event_id"], "left").withColumn("is_undone", F.coalesce("_gone", F.lit(False))).drop("_gone")


def live(events: DataFrame) -> DataFrame:
    """Events that stand: not undone, and after the last live reset of their reviewer in the paper."""
    standing = marked_undone(events).where(~F.col("is_undone")).drop("is_undone")
    resets = standing.where("kind = 'review_reset'").groupBy(*_KEY).agg(F.max("revision").alias("_reset"))
    return standing.join(resets, _KEY, "left").where((F.col("kind") != "review_reset") & (F.col("revision") > F.coalesce("_reset", F.lit(-1)))).drop("_reset")


def current_decisions(events: DataFrame, catalog: DataFrame) -> DataFrame:
    """(paper_id, reviewer_id, record_key, decision, event_id): each reviewer's last live decision on a
    record, if it was made on what the record holds now.

    ``catalog``: (paper_id, record_key, digest) of the current records. A decision on another digest is
    none at all, so an earlier one on the present digest stands."""
    made = live(events).where(F.col("kind").isin("record_decision", "spreadsheet_review", "adjudication_decision"))
    valid = made.join(catalog, ["paper_id", "record_key"]).where("record_digest = digest")
    return valid.groupBy(*_KEY, "record_key").agg(*[F.max_by(x, F.struct("revision", "event_id")).alias(x) for x in ("decision", "event_id")])


def current_stages(events: DataFrame) -> DataFrame:
    """(paper_id, reviewer_id, stage, event_id): the last live completion of each stage."""
    return live(events).where("kind = 'stage_complete'").groupBy(*_KEY, "stage").agg(F.max_by("event_id", F.struct("revision", "event_id")).alias("event_id"))


def badge_events(events: DataFrame, catalog: DataFrame) -> DataFrame:
    """(paper_id, reviewer_id, event_id): the events behind what a reviewer's page shows now."""
    audits = live(events).where("kind = 'inventory_audit'").groupBy(*_KEY).agg(F.max_by("event_id", F.struct("revision", "event_id")).alias("event_id"))
    parts = [current_decisions(events, catalog), current_stages(events), audits]
    return parts[0].select(*_KEY, "event_id").union(parts[1].select(*_KEY, "event_id")).union(parts[2].select(*_KEY, "event_id")).distinct()


def summaries(events: DataFrame, catalog: DataFrame, papers: DataFrame) -> DataFrame:
    """(paper_id, n_records, n_decided, n_reviewers, stages): a row for each paper, of papers without events too."""
    decided = current_decisions(events, catalog).groupBy("paper_id").agg(F.countDistinct("record_key").alias("n_decided"), F.countDistinct("reviewer_id").alias("n_reviewers"))
    stages = current_stages(events).groupBy("paper_id").agg(F.array_sort(F.collect_set("stage")).alias("stages"))
    counts = catalog.groupBy("paper_id").agg(F.count("*").alias("n_records"))
    out = papers.select("paper_id").distinct().join(counts, "paper_id", "left").join(decided, "paper_id", "left").join(stages, "paper_id", "left")
    return out.fillna(0, ["n_records", "n_decided", "n_reviewers"]).withColumn("stages", F.coalesce("stages", F.array().cast("array<string>")))


def progress(events: DataFrame, catalog: DataFrame) -> DataFrame:
    """(reviewer_id, n_papers, n_decisions, n_stages): what of each reviewer's work stands."""
    a = current_decisions(events, catalog).groupBy("reviewer_id").agg(F.count("*").alias("n_decisions"), F.collect_set("paper_id").alias("_a"))
    b = current_stages(events).groupBy("reviewer_id").agg(F.count("*").alias("n_stages"), F.collect_set("paper_id").alias("_b"))
    none = F.array().cast("array<string>")
    both = a.join(b, "reviewer_id", "full_outer")
    return both.select("reviewer_id", F.size(F.array_union(F.coalesce("_a", none), F.coalesce("_b", none))).alias("n_papers"), F.coalesce("n_decisions", F.lit(0)).alias("n_decisions"), F.coalesce("n_stages", F.lit(0)).alias("n_stages"))


def last_review(events: DataFrame) -> DataFrame:
    """(paper_id, reviewer_id, event_id, revision): the end of each reviewer's saved work, undo events apart."""
    work = live(events).where(F.col("undoes").isNull() & F.col("kind").isin("record_decision", "mutation", "structural_mutation", "inventory_audit", "spreadsheet_review"))
    return work.groupBy(*_KEY).agg(F.max_by("event_id", F.struct("revision", "event_id")).alias("event_id"), F.max("revision").alias("revision"))


def untouched(catalog: DataFrame, touches: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """The ``catalog``'s records that no event after the paper's cutoff touched, even if it was taken back.

    ``touches``: (paper_id, revision, record_key; null for all of ``collection``, and both null for the
    whole paper). ``cutoffs``: (paper_id, cutoff); papers without one have no row."""
    late = touches.join(cutoffs, "paper_id").where("revision > cutoff")
    whole = late.where("record_key is null and collection is null").select("paper_id").distinct()
    groups = late.where("record_key is null and collection is not null").select("paper_id", "collection").distinct()
    keys = late.where("record_key is not null").select("paper_id", "record_key").distinct()
    kept = catalog.join(cutoffs.select("paper_id"), "paper_id", "left_semi").join(whole, "paper_id", "left_anti").join(keys, ["paper_id", "record_key"], "left_anti")
    return kept.withColumn("collection", F.split_part("record_key", F.lit(":"), F.lit(1))).join(groups, ["paper_id", "collection"], "left_anti").drop("collection")


def scope_changes(touches: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """(paper_id, event_id, revision, removed, metadata_changed): events after the cutoff that took a record
    away or changed the paper itself; decisions of adjudication do neither.

    ``touches``: as in ``untouched``, with event_id, kind and removed (whether the record went)."""
    late = touches.join(cutoffs, "paper_id").where("revision > cutoff and kind <> 'adjudication_decision'")
    meta = F.bool_or((F.col("kind") == "mutation") & F.col("record_key").isNull() & F.col("collection").isNull())
    out = late.groupBy("paper_id", "event_id", "revision").agg(F.array_sort(F.collect_set(F.when(F.col("removed"), F.col("record_key")))).alias("removed"), meta.alias("metadata_changed"))
    return out.where((F.size("removed") > 0) | F.col("metadata_changed"))


def sequenced(events: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """``events`` with sequence: 1, 2, ... in each log."""
    return events.withColumn("sequence", F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long"))


def stage_spans(events: DataFrame, by: list[str], span: str, kind: str, at: Column, start: str = "start", finish: str = "finish") -> DataFrame:
    """(by, span, started, finished, seconds): a row for each span; one that has not ended has no seconds."""
    first = F.min(F.when(F.col(kind) == start, at)).alias("started")
    last = F.max(F.when(F.col(kind) == finish, at)).alias("finished")
    spans = events.where(F.col(kind).isin(start, finish)).groupBy(*by, span).agg(first, last).where("started is not null")
    return spans.withColumn("seconds", F.unix_micros(F.col("finished").cast("timestamp")) / 1e6 - F.unix_micros(F.col("started").cast("timestamp")) / 1e6)


def history_issues(events: DataFrame, heads: DataFrame) -> DataFrame:
    """(paper_id, revision, expected): papers whose advertised revision is not that of their last event (0: none),
    or whose revisions are not 1, 2, ..."""
    held = events.groupBy("paper_id").agg(F.max("revision").alias("expected"), (F.count("*") != F.max("revision")).alias("_gap"))
    both = heads.join(held, "paper_id", "left").fillna(0, ["expected"])
    return both.where((F.col("revision") != F.col("expected")) | F.coalesce("_gap", F.lit(False))).select("paper_id", "revision", "expected")


def stage_gate(stages: DataFrame, decisions: DataFrame, catalog: DataFrame, order: list[str]) -> DataFrame:
    """(paper_id, reviewer_id, stage, issue): completed stages whose predecessor is not complete, or, from the
    second on, whose reviewer has undecided records."""
    place = F.create_map(*[x for i, name in enumerate(order) for x in (F.lit(name), F.lit(i))])
    own = stages.select(*_KEY, "stage", F.try_element_at(place, F.col("stage")).alias("i")).where("i > 0")
    before = stages.select(*_KEY, (F.try_element_at(place, F.col("stage")) + 1).alias("i"))
    skipped = own.join(before, [*_KEY, "i"], "left_anti").select(*_KEY, "stage", F.lit("predecessor not complete").alias("issue"))
    wanted = own.select(*_KEY, "stage").join(catalog.select("paper_id", "record_key"), "paper_id")
    open_ = wanted.join(decisions.select(*_KEY, "record_key"), [*_KEY, "record_key"], "left_anti").select(*_KEY, "stage", F.lit("records without a decision").alias("issue")).distinct()
    return skipped.union(open_)
