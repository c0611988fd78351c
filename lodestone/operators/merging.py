"""Facts that stand in two places of a study: one fact with all its paths.

Linked containers (a layer and its only absorber, a device's treatment and its properties) repeat facts;
aliases (a layer's material, the same as a constituent) name one fact twice. Copies of a value agree
within rounding, in any unit; copies within one list stay apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions import quantities as qt
from lodestone.sources import shared

_KEY = ["paper_id", "side"]
_SAME = ["source", "owner", "name", "_context"]
#: Copies of a value differ by this share at most.
ROUNDING = 16 * 2.0**-52


def _linked(rows: DataFrame, links: DataFrame, of: str) -> DataFrame:
    """The facts below one end of each link, with the link."""
    own = rows.withColumn("_context", F.sort_array(F.map_entries("context")))
    ends = links.select(*_KEY, F.struct("left_path", "right_path").alias("_link"), F.concat(of, F.lit("/")).alias("_below"))
    return own.join(ends, _KEY).where(F.col("path").startswith(F.col("_below"))).select(*_KEY, "_link", *_SAME, "path", "claim", "text")


def copies(rows: DataFrame, links: DataFrame, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(paper_id, side, path, copy_path) of facts that both ends of a link state, and (paper_id, side, path,
    other_path) of those that contradict each other.

    ``rows``: facts (paper_id, side, source, owner, name, context, path, claim, text); ``links``: (paper_id, side,
    left_path, right_path). Facts of one owner, name and context are the same if their values are; the
    k-th copy of a value on one end is the k-th on the other, so repeated values stay repeated. A
    value that is alone on its end, and whose only counterpart differs, is a contradiction. A path
    below both ends, or a link to nothing, is no copy. The two tables come from one table of pairs, which is written to
    ``folder``, if given, and else made for each."""
    left, right = _linked(rows, links, "left_path"), _linked(rows, links, "right_path")
    keys = [*_KEY, "_link", *_SAME]
    alone = Window.partitionBy(*keys)
    a, b = (x.select(*keys, F.struct("path", "claim", "text", (F.count("*").over(alone) == 1).alias("alone")).alias(n)) for x, n in ((left, "a"), (right, "b")))
    texts = F.col("a.text").eqNullSafe(F.col("b.text")) & F.col("a.text").isNotNull()
    claimed = F.col("a.claim").isNotNull() & F.col("b.claim").isNotNull()
    equal = F.coalesce(F.when(claimed, qt.equal_claims(F.col("a.claim"), F.col("b.claim"), ROUNDING, 0.0)).otherwise(texts), F.lit(False))
    pairs = a.join(b, keys).where("a.path <> b.path").select(*keys, F.col("a.path").alias("path"), F.col("b.path").alias("other_path"), equal.alias("_equal"), (claimed & F.col("a.alone") & F.col("b.alone")).alias("_single")).where("_equal or _single")
    place = lambda x: F.struct(F.length(x), F.col(x))
    # what is counted within the keys of the join stays where the join has dealt it
    of = lambda x, y: F.row_number().over(Window.partitionBy(*keys, x, "_equal").orderBy(place(y)))
    told = pairs.withColumn("_i", of("other_path", "path")).withColumn("_j", of("path", "other_path")).where("not _equal or _i = _j").select(*_KEY, "path", "other_path", "_equal").distinct()
    told = shared.written(told, f"{folder}/pairs") if folder else told
    return told.where("_equal").select(*_KEY, "path", F.col("other_path").alias("copy_path")), told.where("not _equal").select(*_KEY, "path", "other_path")


def representatives(edges: DataFrame, folder: str) -> DataFrame:
    """(paper_id, side, path, representative) of all paths of ``edges`` (paper_id, side, path, copy_path), however they
    chain: of joined paths the one that is no copy, or, of several or none, the shortest and least.

    Labels go from neighbour to neighbour until none changes: as many rounds as the longest chain, each
    an aggregate and a join by path, written to ``folder``. No group is gathered."""
    edges = shared.written(edges.where("path <> copy_path").select(*_KEY, "path", "copy_path").distinct(), f"{folder}/edges")
    ways = shared.written(edges.union(edges.select(*_KEY, F.col("copy_path"), F.col("path"))).toDF(*_KEY, "path", "to"), f"{folder}/ways")
    copied = edges.select(*_KEY, F.col("copy_path").alias("path")).distinct().withColumn("_copy", F.lit(True))
    label = F.struct(F.coalesce("_copy", F.lit(False)).alias("c"), F.length("path").alias("n"), F.col("path").alias("p"))
    labels = shared.written(ways.select(*_KEY, "path").distinct().join(copied, [*_KEY, "path"], "left").select(*_KEY, "path", label.alias("label")), f"{folder}/labels")
    turn = 0
    while True:
        near = ways.join(labels, [*_KEY, "path"]).groupBy(*_KEY, F.col("to").alias("path")).agg(F.min("label").alias("_near"))
        better = shared.written(labels.join(near, [*_KEY, "path"]).select(*_KEY, "path", F.least("label", "_near").alias("label"), (F.col("_near") < F.col("label")).alias("_changed")), f"{folder}/labels{turn}")
        labels, turn = better.drop("_changed"), turn + 1
        if better.where("_changed").isEmpty():
            return labels.select(*_KEY, "path", F.col("label.p").alias("representative"))


def merged(rows: DataFrame, edges: DataFrame, folder: str) -> DataFrame:
    """``rows`` without the copies, with source_paths: of each fact that stays its own path and those of all its copies,
    in order. Edges to paths that no fact has are left out, so that no fact is lost."""
    ends = edges.select(*_KEY, F.explode(F.array("path", "copy_path")).alias("path")).distinct()
    known = shared.written(ends.join(rows.select(*_KEY, "path"), [*_KEY, "path"], "left_semi"), f"{folder}/known")
    held = edges.join(known, [*_KEY, "path"], "left_semi").join(known.withColumnRenamed("path", "copy_path"), [*_KEY, "copy_path"], "left_semi")
    named = representatives(held, folder)
    paths = named.groupBy(*_KEY, F.col("representative").alias("path")).agg(F.collect_list("path").alias("_paths"))  # the copies of one fact of one paper
    own = rows.join(named.join(paths, [*_KEY, "path"], "left"), [*_KEY, "path"], "left")
    others = F.array_sort(F.filter("_paths", lambda p: p != F.col("path")))
    return own.where("representative is null or representative = path").drop("representative").withColumn("source_paths", F.when(F.col("_paths").isNull(), F.array("path")).otherwise(F.concat(F.array("path"), others))).drop("_paths")
