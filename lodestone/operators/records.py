"""Records: identity, duplicates, merging, upserts, differences, constraints and log folding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merge_records(df: DataFrame, key: list[str], order: list[Column], first: list[str] = (), longest: list[str] = (), union: list[str] = (), either: list[str] = ()) -> DataFrame:
    """One row a key: first known value, longest text, sorted set of values, or of flags."""
    rank = F.struct(*order)
    columns = [F.min_by(F.when(F.col(x).isNotNull(), F.col(x)), F.when(F.col(x).isNotNull(), rank)).alias(x) for x in first]
    columns += [F.max_by(x, F.struct(F.length(x), F.col(x))).alias(x) for x in longest]
    columns += [F.array_sort(F.collect_set(x)).alias(x) for x in union] + [F.bool_or(x).alias(x) for x in either]
    return df.groupBy(*key).agg(*columns, F.count("*").alias("n_records"))


def duplicates(df: DataFrame, content: list[str], key: str) -> DataFrame:
    """Groups of rows with equal content (nulls are equal): least key, all keys, size."""
    return df.groupBy(*content).agg(F.min(key).alias("first_key"), F.count("*").alias("n"), F.array_sort(F.collect_list(key)).alias("keys")).where("n > 1")


def upsert(current: DataFrame, proposed: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``proposed``, and those of ``current`` whose key it does not hold."""
    return current.join(proposed.select(*key), key, "left_anti").unionByName(proposed.select(*current.columns))


def changes(before: DataFrame, after: DataFrame, key: list[str], content: list[str]) -> DataFrame:
    """Key and change (added, removed, changed) of records that differ."""
    a = before.select(*key, F.xxhash64(*content).alias("_a"), F.struct(*content).alias("_x"))
    b = after.select(*key, F.xxhash64(*content).alias("_b"), F.struct(*content).alias("_y"))
    kind = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(~F.col("_x").eqNullSafe(F.col("_y")), "changed")
    return a.join(b, key, "full_outer").select(*key, kind.alias("change")).where("change is not null")


def dangling(child: DataFrame, foreign: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose known foreign key has no parent."""
    return child.where(F.col(foreign).isNotNull()).join(parent.select(F.col(key).alias(foreign)), foreign, "left_anti")


def islands(df: DataFrame, by: list[str], order: list[str], value: str) -> DataFrame:
    """Adds ``island``: number of the run of equal consecutive values within ``by``."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_new", (~F.col(value).eqNullSafe(F.lag(value).over(w)) | (F.row_number().over(w) == 1)).cast("int")).withColumn("island", F.sum("_new").over(w)).drop("_new")


def pack(df: DataFrame, by: list[str], order: list[str], size: str, budget: int) -> DataFrame:
    """Adds ``window``: greedy packing in order, a new window when the budget would be passed; an
    oversized row is alone. One fold over the sizes of a group, in SQL functions."""
    step = lambda acc, x: F.struct(
        F.when((acc["used"] > 0) & (acc["used"] + x > budget), x).otherwise(acc["used"] + x).alias("used"),
        (acc["window"] + F.when((acc["used"] > 0) & (acc["used"] + x > budget), 1).otherwise(0)).alias("window"),
        F.array_append(acc["out"], (acc["window"] + F.when((acc["used"] > 0) & (acc["used"] + x > budget), 1).otherwise(0))).alias("out"),
    )
    rows = df.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(*order, F.col(size).cast("long").alias("_size")))).alias("_rows"))
    zero = F.struct(F.lit(0).cast("long").alias("used"), F.lit(0).alias("window"), F.array().cast("array<int>").alias("out"))
    folded = rows.withColumn("_w", F.aggregate(F.transform("_rows", lambda r: r["_size"]), zero, step, lambda a: a["out"]))
    return folded.select(*by, F.explode(F.arrays_zip("_rows", "_w")).alias("_r")).select(*by, *[F.col(f"_r._rows.{o}").alias(o) for o in order], F.col("_r._rows._size").alias(size), F.col("_r._w").alias("window"))
