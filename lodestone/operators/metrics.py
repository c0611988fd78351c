"""Counts to rates, agreement, micro and macro means, null-aware sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rate(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator, null where the denominator is 0 or unknown."""
    return F.when(denominator > 0, numerator / denominator)


def precision_recall(df: DataFrame, predicted: str, truth: str, matched: str) -> DataFrame:
    """Adds precision, recall and f1 = 2 matched / (predicted + truth)."""
    p, t, m = F.col(predicted), F.col(truth), F.col(matched)
    return df.withColumns({"precision": rate(m, p), "recall": rate(m, t), "f1": rate(2 * m, p + t)})


def micro_macro(df: DataFrame, by: list[str], predicted: str, truth: str, matched: str) -> DataFrame:
    """Micro (sums, then rate) and macro (mean of defined rates) F1 of each group."""
    f1 = rate(2 * F.col(matched), F.col(predicted) + F.col(truth))
    sums = [F.sum(x).alias(x) for x in (predicted, truth, matched)]
    out = df.withColumn("_f1", f1).groupBy(*by).agg(*sums, F.avg("_f1").alias("macro_f1"), F.count("_f1").alias("n_defined"))
    return out.withColumn("micro_f1", rate(2 * F.col(matched), F.col(predicted) + F.col(truth)))


def known_sum(column: str, alias: str) -> list[Column]:
    """A sum that is null unless every value is known, the sum of known values, and the flag."""
    complete = F.count("*") == F.count(column)
    return [F.when(complete, F.sum(column)).alias(alias), F.coalesce(F.sum(column), F.lit(0)).alias(f"{alias}_known"), complete.alias(f"{alias}_complete")]


def agreement(left: DataFrame, right: DataFrame, key: list[str], value: str) -> DataFrame:
    """Full outer comparison: keys matched, missed and extra, values that agree, and the confusion counts."""
    a = left.select(*key, F.col(value).alias("_l"), F.lit(True).alias("_in_l"))
    b = right.select(*key, F.col(value).alias("_r"), F.lit(True).alias("_in_r"))
    return a.join(b, key, "full_outer").groupBy(F.col("_l").alias("truth"), F.col("_r").alias("predicted")).agg(
        F.count_if(F.col("_in_l") & F.col("_in_r")).alias("matched"), F.count_if(F.col("_in_r").isNull()).alias("missed"), F.count_if(F.col("_in_l").isNull()).alias("extra"),
    )


def multiset_agreement(left: DataFrame, right: DataFrame, by: list[str], item: str) -> DataFrame:
    """Size of the multiset intersection over the larger size, for each group."""
    rows = left.select(*by, item, F.lit(1).alias("_a"), F.lit(0).alias("_b")).union(right.select(*by, item, F.lit(0), F.lit(1)))
    both = rows.groupBy(*by, item).agg(F.sum("_a").alias("a"), F.sum("_b").alias("b"))
    sums = both.groupBy(*by).agg(F.sum(F.least("a", "b")).alias("shared"), F.sum("a").alias("n_left"), F.sum("b").alias("n_right"))
    return sums.withColumn("agreement", rate(F.col("shared"), F.greatest("n_left", "n_right")))
