"""Experiments with a control and a treatment arm: rosters, settings, paired scores, intervals.

Runs: (paper_id, repeat, arm, ...). Settings: (paper_id, repeat, arm, name, value) with JSON values."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.operators import nested

ARMS = ("control", "treatment")
_RUN = ["paper_id", "repeat", "arm"]


def interval(values: np.ndarray, samples: int, seed: int) -> tuple[float | None, float | None, float | None, str]:
    """Mean, the values at 2.5 and 97.5 % of ``samples`` resampled means (rank rounded down), and a status."""
    values = np.sort(values[~np.isnan(values)])
    if not len(values):
        return None, None, None, "no_values"
    mean = math.fsum(values) / len(values)
    if not samples or len(values) == 1:
        return mean, None, None, "disabled" if not samples else "insufficient_papers"
    draw = np.random.default_rng(seed)
    means = np.sort([values[draw.integers(0, len(values), len(values))].mean() for _ in range(samples)])
    return mean, float(means[int(0.025 * (samples - 1))]), float(means[int(0.975 * (samples - 1))]), "available"


def bootstrap(df: DataFrame, by: list[str], value: str, samples: int = 2000, seed: int = 0) -> DataFrame:
    """(by, n, mean, low, high, status): the interval of each group's known values. Values are resampled
    by their order of size, so the rows' order does not count. One value a paper: a group is one task's array."""
    schema = df.select(*by).schema.add("n", "long").add("mean", "double").add("low", "double").add("high", "double").add("status", "string")

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        values = frame["_v"].to_numpy(float)
        mean, low, high, status = interval(values, samples, seed)
        return pd.DataFrame([[*frame[by].iloc[0], int((~np.isnan(values)).sum()), mean, low, high, status]], columns=schema.names)

    return df.select(*by, F.col(value).cast("double").alias("_v")).groupBy(*by).applyInPandas(one, schema)


def paired_deltas(scores: DataFrame, pairs: DataFrame, score: str) -> DataFrame:
    """(paper_id, repeat, control, treatment, delta, complete) for every planned pair."""
    wide = scores.where(F.col("arm").isin(*ARMS)).groupBy("paper_id", "repeat").agg(*[F.max(F.when(F.col("arm") == a, F.col(score))).alias(a) for a in ARMS])
    out = pairs.select("paper_id", "repeat").distinct().join(wide, ["paper_id", "repeat"], "left")
    return out.withColumn("delta", F.col("treatment") - F.col("control")).withColumn("complete", F.col("delta").isNotNull())


def agreement(scores: DataFrame, pairs: DataFrame, score: str, blocked: bool = False, samples: int = 2000, seed: int = 0) -> DataFrame:
    """One row: planned and complete pairs, papers, the mean of the papers' mean differences with its interval,
    and a status (blocked, no_complete_pairs, complete_roster or conditional_on_complete_pairs)."""
    deltas = paired_deltas(scores, pairs, score)
    counts = deltas.agg(F.count("*").alias("planned"), F.count_if("complete").alias("complete"))
    papers = deltas.where("complete").groupBy("paper_id").agg(F.avg("delta").alias("delta"))
    if blocked:
        papers = papers.limit(0)
    spread = bootstrap(papers.withColumn("_all", F.lit(1)), ["_all"], "delta", samples, seed)
    status = F.when(F.lit(blocked), "blocked").when(F.col("complete") == 0, "no_complete_pairs").when(F.col("complete") == F.col("planned"), "complete_roster").otherwise("conditional_on_complete_pairs")
    both = counts.withColumn("_all", F.lit(1)).join(F.broadcast(spread), "_all", "left")  # one row each
    return both.select("planned", "complete", F.coalesce("n", F.lit(0)).alias("papers"), F.col("mean").alias("mean_delta"), "low", "high", F.col("status").alias("interval_status"), status.alias("status"))


def is_ready(status: Column, accounting_issues: Column) -> Column:
    """Whether a comparison can end without a reviewer."""
    return (status == "complete_roster") & (accounting_issues == 0)


def cohort_issues(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(paper_id, repeat, issue): planned pairs that are missing and others that were not planned."""
    a, b = (x.select("paper_id", "repeat").distinct() for x in (expected, actual))
    return a.exceptAll(b).withColumn("issue", F.lit("missing")).union(b.exceptAll(a).withColumn("issue", F.lit("unexpected")))


def expected_pairs(papers: DataFrame, repeats: int) -> DataFrame:
    """(paper_id, repeat) for 1 to ``repeats`` of each paper."""
    return papers.select("paper_id").distinct().select("paper_id", F.explode(F.sequence(F.lit(1), F.lit(repeats))).alias("repeat"))


def roster_issues(runs: DataFrame) -> DataFrame:
    """(paper_id, repeat, arm, issue) of a roster (paper_id, arm, repeat, run_dir, role): unknown arms and roles,
    repeats below 1, paired keys or folders that repeat, paired runs without their other arm, and
    accounting rows of papers and arms that no pair has."""
    role = F.coalesce(F.nullif("role", F.lit("")), F.lit("paired"))
    rows = runs.withColumn("role", role)
    key = [*_RUN]
    bad = rows.select(*key, F.when(~F.coalesce(F.col("arm").isin(*ARMS), F.lit(False)) | F.nullif(F.col("paper_id").cast("string"), F.lit("")).isNull(), "no paper or arm").when(~F.col("role").isin("paired", "accounting_only"), "unknown role").when(F.coalesce(F.col("repeat") < 1, F.col("role") == "paired"), "repeat below 1").when(F.nullif(F.col("run_dir").cast("string"), F.lit("")).isNull(), "no folder").alias("issue")).where("issue is not null")
    paired = rows.where("role = 'paired'")
    twice = paired.groupBy(*key).count().where("count > 1").select(*key, F.lit("repeated run").alias("issue"))
    folders = rows.groupBy("run_dir").agg(F.count("*").alias("n"), *[F.min(x).alias(x) for x in key]).where("n > 1").select(*key, F.lit("reused folder").alias("issue"))
    alone = paired.groupBy("paper_id", "repeat").agg(F.countDistinct("arm").alias("n"), F.min("arm").alias("arm")).where("n < 2").select(*key, F.lit("other arm missing").alias("issue"))
    extra = rows.where("role = 'accounting_only'").join(paired.select("paper_id", "arm").distinct(), ["paper_id", "arm"], "left_anti").select(*key, F.lit("accounting without a pair").alias("issue"))
    return bad.union(twice).union(folders).union(alone).union(extra)


def factor_issues(settings: DataFrame, runs: DataFrame, factors: list[tuple[str, str, str]]) -> DataFrame:
    """(paper_id, repeat, arm, name, value): runs without a declared factor's value (JSON) for their arm.

    ``factors``: (name, control, treatment), as declared for the experiment."""
    declared = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(a).alias("control"), F.lit(b).alias("treatment")) for n, a, b in factors])
    wanted = runs.select(*_RUN).distinct().select(*_RUN, F.explode(declared).alias("_f")).select(*_RUN, "_f.*")
    held = wanted.join(settings, [*_RUN, "name"], "left")
    expected = F.when(F.col("arm") == "control", F.col("control")).otherwise(F.col("treatment"))
    return held.where(F.col("value").isNull() | ~nested.same_json(F.col("value"), expected)).select(*_RUN, "name", "value")


def drift_issues(settings: DataFrame, runs: DataFrame) -> DataFrame:
    """(paper_id, repeat, arm, name): settings that differ from those of the arm's first run, by paper and repeat."""
    first = runs.groupBy("arm").agg(F.min(F.struct("paper_id", "repeat")).alias("_f"))
    tagged = settings.join(F.broadcast(first), "arm")
    base = tagged.where((F.col("paper_id") == F.col("_f.paper_id")) & (F.col("repeat") == F.col("_f.repeat"))).select("arm", "name", F.col("value").alias("base"))
    others = runs.select(*_RUN).distinct().join(F.broadcast(first), "arm").where(~((F.col("paper_id") == F.col("_f.paper_id")) & (F.col("repeat") == F.col("_f.repeat")))).drop("_f")
    # a row an arm: its setting names, which are as many as an experiment declares
    names = settings.select("arm", "name").distinct().groupBy("arm").agg(F.collect_list("name").alias("_names"))
    wide = others.join(F.broadcast(names), "arm").select(*_RUN, F.explode("_names").alias("name")).join(settings, [*_RUN, "name"], "left").join(base, ["arm", "name"], "left")
    return wide.where(~nested.same_json(F.col("value"), F.col("base"))).select(*_RUN, "name")


def equal_factors(factors: DataFrame) -> DataFrame:
    """Declared factors whose arms do not differ."""
    return factors.where(nested.same_json(F.col("control"), F.col("treatment"))).select("name")


def hash_issues(reference: DataFrame, run: DataFrame, by: list[str], digest: str) -> DataFrame:
    """(by, issue): groups whose sets of source hashes differ, or that one side lacks."""
    a, b = (x.groupBy(*by).agg(F.array_sort(F.collect_set(digest)).alias(n)) for x, n in ((reference, "_a"), (run, "_b")))
    issue = F.when(F.col("_b").isNull(), "missing").when(F.col("_a").isNull(), "unexpected").when(F.col("_a") != F.col("_b"), "different sources")
    return a.join(b, by, "full_outer").select(*by, issue.alias("issue")).where("issue is not null")


def usage(records: DataFrame, by: list[str], order: str) -> DataFrame:
    """Usage of each group's calls: token sums, cost and latency (unknown values add nothing) with flags
    that tell complete sums; the total cost only if all are known; responses; and the different models and
    providers in order, with the one if there is only one."""
    tokens = ("prompt_tokens", "completion_tokens", "total_tokens")
    sums = [F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in tokens]
    known = F.bool_and(F.col("cost").isNotNull())
    cost = F.round(F.coalesce(F.sum("cost"), F.lit(0.0)), 8)
    named = [F.array_sort(F.collect_list(F.when(F.col(x).isNotNull(), F.struct(F.col(order).alias("o"), F.col(x).alias("x"))))).alias(f"_{x}") for x in ("response_model", "provider")]
    out = records.groupBy(*by).agg(
        *sums, cost.alias("cost"), known.alias("cost_tracking_complete"), F.when(known, cost).alias("total_cost_usd"), F.bool_and(F.expr(" and ".join(f"{x} is not null" for x in tokens))).alias("token_tracking_complete"),
        F.round(F.coalesce(F.sum("latency_seconds"), F.lit(0.0)), 6).alias("latency_seconds"), F.count_if(F.coalesce("response_received", F.lit(True))).alias("provider_responses"), *named,
    )
    for x in ("response_model", "provider"):
        every = F.array_distinct(F.transform(f"_{x}", lambda r: r["x"]))
        out = out.withColumn(f"{x}s", every).withColumn(x, F.when(F.size(every) == 1, F.get(every, F.lit(0)))).drop(f"_{x}")
    return out


def detail_sums(details: DataFrame, by: list[str]) -> DataFrame:
    """(by, name, total, complete) of (by, call, name, value): null totals where no call knows the value; complete
    if all calls of the group do."""
    calls = details.groupBy(*by).agg(F.countDistinct("call").alias("_n"))
    known = details.where("name is not null").groupBy(*by, "name").agg(F.sum("value").alias("total"), F.countDistinct(F.when(F.col("value").isNotNull(), F.col("call"))).alias("_k"))
    return known.join(calls, by).select(*by, "name", "total", (F.col("_k") == F.col("_n")).alias("complete"))


def call_summary(calls: DataFrame, by: list[str]) -> DataFrame:
    """Counts of calls: all, live (not from a cache, with an attempt), from the cache, blocked, and attempts."""
    cached = F.coalesce("cache_hit", F.lit(False))
    return calls.groupBy(*by).agg(
        F.count("*").alias("logical_calls"), F.count_if(~cached & (F.coalesce("attempt_count", F.lit(1)) > 0)).alias("live_calls"), F.count_if(cached).alias("cache_hits"),
        F.count_if(F.coalesce(F.col("status") == "blocked", F.lit(False))).alias("blocked_calls"), F.sum(F.coalesce("attempt_count", F.lit(0))).alias("provider_attempts"),
    )


def shuffled(df: DataFrame, key: list[str], seed: int) -> DataFrame:
    """``df`` in a random order that only the seed and the keys decide."""
    return df.orderBy(F.xxhash64(F.lit(seed), *key), *key)
