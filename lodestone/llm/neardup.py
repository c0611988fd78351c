"""Near-duplicates with DartMinHash signatures.

A document is a weighted set of word shingles. Every element of weight w owns regions of the
weight axis, [2^v - 1, 2^(v+1) - 1); into each, hashed darts fall as a Poisson process along the
rank axis. A dart counts if its weight lies below w; the earliest dart of each coordinate is the
signature there. Only darts of rank below about (k log k) / (total weight) are thrown, so a
document of any length costs about the same; the limit is raised for documents that leave a
coordinate empty. Two signatures agree at a coordinate with the probability of the weighted
Jaccard similarity. Bands of the signature are joined to candidate links, which count only if
the exact similarity of the shingle sets is high enough."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as c

WORDS, LEAST = 5, 0.8
BANDS, ROWS = 32, 5
#: Buckets of up to so many members are compared in full at once; larger ones in rounds.
SMALL = 8
ROUNDS = 2
_SEED = np.random.default_rng(77).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def shingle_hashes(column: pa.Array, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The row and hash of each shingle: runs of ``size`` words (all words of a shorter text)."""
    data, bounds = c.text_bytes(column)
    data = c.lower_ascii(data)
    starts, ends = c.words(data, bounds)
    hashes = c.span_hashes(data, starts, ends)
    edges = np.searchsorted(starts, bounds)
    total = np.diff(edges)
    n = len(hashes)
    out = np.zeros(max(0, n - size + 1), np.uint64)
    for j in range(size if len(out) else 0):
        out = out * _SEED[0] + hashes[j : n - size + 1 + j]
    row_of = np.repeat(np.arange(len(total)), total)
    inside = row_of[: len(out)] == row_of[size - 1 :] if len(out) else np.zeros(0, bool)
    rows, found = row_of[: len(out)][inside], out[inside]
    short = np.flatnonzero((total > 0) & (total < size))
    if len(short):
        extra = np.zeros(len(short), np.uint64)
        for j in range(size - 1):
            has = total[short] > j
            extra[has] = extra[has] * _SEED[1] + hashes[np.minimum(edges[short] + j, n - 1)[has]]
        rows, found = np.concatenate((rows, short)), np.concatenate((found, extra))
    return rows, c.mix(found)


def weighted_sets(column: pa.Array, size: int = WORDS, counted: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, distinct shingles (ordered by row, then hash) and weights: 1, or how often they stand."""
    rows, hashes = shingle_hashes(column, size)
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    weights = np.diff(np.append(at, len(rows))) if counted else np.ones(len(at), np.int64)
    return rows[at], hashes[at], weights.astype(np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(rows: np.ndarray, hashes: np.ndarray, weights: np.ndarray, n: int, k: int) -> np.ndarray:
    """(n, k) dart ids; rows without elements keep zeros."""
    ids = np.zeros(n * k, np.uint64)
    ranks = np.full(n * k, np.inf)
    mass = np.bincount(rows, weights, n)
    with np.errstate(divide="ignore"):
        limit = np.where(mass > 0, k * (math.log(k) + 2.0) / mass, 0.0)
    floor = np.zeros(n)
    # one entry for each element and region of the weight axis that its weight reaches
    top = np.floor(np.log2(weights + 1)).astype(np.int64) + (np.log2(weights + 1) % 1 > 0)
    regions = np.maximum(top, 1)
    of = np.repeat(np.arange(len(rows)), regions)
    level = np.arange(len(of)) - np.repeat(np.cumsum(regions) - regions, regions)
    todo = np.arange(len(of))
    while len(todo):
        row = rows[of[todo]]
        scale = np.exp2(level[todo].astype(np.float64))
        key = c.mix(hashes[of[todo]] + _SEED[2] * (level[todo].astype(np.uint64) + np.uint64(1)))
        rank = np.zeros(len(todo))
        live, step = np.arange(len(todo)), 0
        while len(live):
            key[live] = c.mix(key[live] + _SEED[3])
            rank[live] -= np.log(_unit(key[live])) / scale[live]
            live = live[rank[live] < limit[row[live]]]
            dart = c.mix(key[live] ^ _SEED[4])
            weight = (_unit(c.mix(dart ^ _SEED[5])) + 1) * scale[live] - 1
            fits = (weight < weights[of[todo[live]]]) & (rank[live] >= floor[row[live]])
            own, dart = live[fits], dart[fits]
            if len(own):
                place = row[own] * k + (c.mix(dart ^ _SEED[6]) % np.uint64(k)).astype(np.int64)
                np.minimum.at(ranks, place, rank[own])
                won = ranks[place] == rank[own]
                ids[place[won]] = dart[won] | np.uint64(1)
            step += 1
        filled = np.isfinite(ranks.reshape(n, k)).all(1)
        again = ~filled & (mass > 0)
        floor, limit = limit, np.where(again, limit * 2, 0.0)
        todo = np.flatnonzero(again[rows[of]])
    return ids.reshape(n, k)


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.zeros((len(signature), bands), np.uint64)
    for j in range(rows):
        out = c.mix(out * _SEED[7] + signature[:, j * bands : (j + 1) * bands])
    return out


def _sketches(docs: DataFrame, size: int, counted: bool, bands: int, rows: int) -> DataFrame:
    """(node, text) -> (node, digest of the weighted set, band hashes); null digest without words."""

    @c.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in c.shards(batches, "text"):
            n = batch.num_rows
            own, hashes, weights = weighted_sets(batch.column("text"), size, counted)
            mixed = c.mix(hashes * _SEED[8] + weights.astype(np.uint64))
            a, b = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
            np.add.at(a, own, mixed)
            np.add.at(b, own, c.mix(mixed ^ _SEED[9]))
            some = np.bincount(own, minlength=n) > 0
            digests = [x.tobytes() + y.tobytes() if s else None for x, y, s in zip(a, b, some)]
            keys = band_hashes(signatures(own, hashes, weights, n, bands * rows), bands, rows).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * bands, pa.int32()), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(digests, pa.binary()), lists], ["node", "digest", "bands"])

    return docs.select("node", "text").mapInArrow(run, "node binary, digest binary, bands array<long>")


def _sets(docs: DataFrame, size: int, counted: bool) -> DataFrame:
    """(node, text) -> (node, items): hashes of the set; with counts, one item for each repeat."""

    @c.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in c.shards(batches, "text"):
            own, hashes, weights = weighted_sets(batch.column("text"), size, counted)
            times = weights.astype(np.int64)
            nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            items = c.mix(np.repeat(hashes, times) + _SEED[10] * nth.astype(np.uint64)).view(np.int64)
            edges = np.searchsorted(np.repeat(own, times), np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(items))], ["node", "items"])

    return docs.select("node", "text").mapInArrow(run, "node binary, items array<long>")


def _counts(sets: DataFrame, cells: int = 128) -> DataFrame:
    """(node, size, counts): how many items fall into each cell of their hash."""

    @c.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("items")
            size = lists.value_lengths().fill_null(0).to_numpy()
            rows = np.repeat(np.arange(batch.num_rows), size)
            cell = lists.flatten().to_numpy(zero_copy_only=False) & (cells - 1)
            table = np.bincount(rows * cells + cell, minlength=batch.num_rows * cells).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(size.astype(np.int32)), pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * cells, pa.int32()), pa.array(table))], ["node", "size", "counts"])

    return sets.mapInArrow(run, "node binary, size int, counts array<int>")


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose sets have a Jaccard similarity of at least ``least``."""
    left = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("x", "y"))
    return both.where(shared >= least * (F.size("x") + F.size("y") - shared) - 1e-9).select("a", "b")


def links(buckets: DataFrame, sets: DataFrame, folder: str, least: float = LEAST) -> DataFrame:
    """Verified links (a, b) that join every pair of similar nodes that share a bucket, up to
    connection, from ``buckets`` (band, h, node).

    Small buckets: all pairs. Larger ones: each member with the bucket's centre, first the
    member that shares most buckets with others, then another one; a bucket is done when its
    members are connected. What is left is compared in full: every pair of different components
    once, in its first common bucket, and with exact sets where the pair's counts of shingles by
    hash, whose differences are at most those of the sets, still allow the similarity."""
    sized = buckets.groupBy("band", "h").agg(F.count("*").alias("n")).where("n > 1")
    held = c.materialise(buckets.join(sized, ["band", "h"]), folder, "buckets")
    few = held.where(F.col("n") <= SMALL).groupBy("band", "h").agg(F.array_sort(F.collect_set("node")).alias("m"))
    pairs = few.select(F.explode(F.flatten(F.transform("m", lambda x, i: F.transform(F.slice("m", i + 2, F.greatest(F.size("m") - i - 1, F.lit(0))), lambda y: F.struct(x.alias("a"), y.alias("b")))))).alias("p")).select("p.*")
    done = c.materialise(_verified(pairs.distinct(), sets, least), folder, "links-small")
    large = held.where(F.col("n") > SMALL)
    mass = large.groupBy("node").agg(F.sum("n").alias("mass"))
    open_ = c.materialise(large.join(mass, "node").select("band", "h", "node", "mass", F.col("node").alias("root")), folder, "open0")
    for turn in range(ROUNDS):
        if open_.isEmpty():
            return done
        order = F.struct(F.col("mass") if turn == 0 else F.xxhash64("node"), F.col("node"))
        centre = open_.groupBy("band", "h").agg(F.max_by("node", order).alias("centre"), F.max_by("root", order).alias("other"))
        asked = open_.join(centre, ["band", "h"]).where("node <> centre and root <> other").select(F.greatest("node", "centre").alias("a"), F.least("node", "centre").alias("b"))
        done = c.materialise(done.union(_verified(asked.distinct(), sets, least)), folder, f"links{turn}")
        roots = c.components(done, f"{folder}/round{turn}")
        rooted = open_.drop("root").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        spread = rooted.groupBy("band", "h").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("band", "h")
        open_ = c.materialise(rooted.join(spread, ["band", "h"]).select("band", "h", "node", "mass", "root"), folder, f"open{turn + 1}")
    if open_.isEmpty():
        return done
    own = open_.groupBy("node").agg(F.array_sort(F.collect_set(F.xxhash64("band", "h"))).alias("own"))
    counts = _counts(sets.join(own.select("node"), "node", "left_semi"))
    rows = c.materialise(open_.join(own, "node").join(counts, "node").select("band", "h", "node", "root", "own", "size", "counts"), folder, "rest")
    main = open_.groupBy("band", "h", "root").agg(F.count("*").alias("n")).groupBy("band", "h").agg(F.max_by("root", F.struct("n", "root")).alias("main"))
    minor = rows.join(main, ["band", "h"]).where("root <> main")
    other = rows.join(main, ["band", "h"]).select(*[F.col(x).alias(f"{x}2") for x in rows.columns], (F.col("root") == F.col("main")).alias("is_main"))
    apart = F.aggregate(F.zip_with("counts", "counts2", lambda x, y: F.abs(x.cast("int") - y.cast("int"))), F.lit(0), lambda x, y: x + y)
    first = F.get(F.array_intersect("own", "own2"), F.lit(0))
    asked = minor.join(other, (F.col("band") == F.col("band2")) & (F.col("h") == F.col("h2")) & (F.col("is_main") | (F.col("root") < F.col("root2"))) & (F.col("root") != F.col("root2")) & (first == F.xxhash64("band", "h")) & (apart * (1 + least) <= (F.col("size") + F.col("size2")) * (1 - least) + 1e-9))
    asked = c.materialise(asked.select(F.greatest("node", "node2").alias("a"), F.least("node", "node2").alias("b")), folder, "asked")
    return c.materialise(done.union(_verified(asked.distinct(), sets, least)), folder, "links-rest")


def classes(docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text", words: int = WORDS, least: float = LEAST, counted: bool = False, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(node, class_node) for each different text: ``node`` is the md5 of the text (null: empty).

    Texts with the same weighted shingle set are one node of the search, so copies add no pairs;
    a hot group's rows are aggregated before each shuffle. A text of one to four words is one
    shingle of all its words; texts without words are alike only to equal texts. Similarity is
    the Jaccard similarity of shingle sets (of multisets if ``counted``)."""
    texts = docs.select(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    texts = texts.select(F.unhex(F.md5("text")).alias("node"), "text")
    sketched = c.materialise(_sketches(texts, words, counted, bands, rows), folder, "sketches")
    nodes = sketched.groupBy("node").agg(F.first("digest").alias("digest"))
    nodes = nodes.withColumn("digest", F.coalesce("digest", "node"))
    heads = c.materialise(nodes.groupBy("digest").agg(F.min("node").alias("head")), folder, "heads")
    single = sketched.where("digest is not null").join(heads.select(F.col("head").alias("node")), "node", "left_semi")
    buckets = single.select("node", F.posexplode("bands").alias("band", "h")).groupBy("band", "h", "node").agg(F.lit(1).alias("one")).drop("one")
    crowded = buckets.groupBy("band", "h").agg(F.count("*").alias("n")).where("n > 1").select("band", "h")
    buckets = c.materialise(buckets.join(crowded, ["band", "h"]), folder, "crowded")
    asked = buckets.select("node").distinct()
    wanted = texts.join(F.broadcast(asked) if asked.count() <= 1_000_000 else asked, "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))
    sets = c.materialise(_sets(wanted, words, counted), folder, "sets")
    roots = c.components(links(buckets, sets, folder, least), f"{folder}/all")
    joined = nodes.join(heads, "digest").join(roots.select(F.col("node").alias("head"), "root"), "head", "left")
    return joined.select("node", F.coalesce("root", "head").alias("class_node"))


def near_duplicates(docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """A row for each row of ``docs``: key, class_id (the least key of its class) and class_size.

    Null keys are members, and a class's id only if all its keys are null; repeated rows count
    each. An empty table gives no rows."""
    slim = docs.select(F.col(f"`{key}`").alias(key), F.unhex(F.md5(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))).alias("node"))
    found = classes(docs.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").alias("text")), folder, key, "text", **options)
    member = c.materialise(slim.join(found, "node"), folder, "member")
    named = member.groupBy("class_node").agg(F.min(key).alias("class_id"), F.count("*").alias("class_size"))
    return member.join(named, "class_node").select(key, "class_id", "class_size")


def drop_near_duplicates(docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each class: that of the least key (null last), then least
    text hash; of rows that agree in both, one."""
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("_row"), F.col(f"`{key}`").alias("k"), F.unhex(F.md5(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))).alias("node"))
    found = c.materialise(classes(docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("text")), folder, "k", "text", **options), folder, "classes")
    kept = rows.drop("_row").join(found, "node").groupBy("class_node").agg(F.min(F.struct(F.col("k").isNull().alias("z"), "k", "node")).alias("m")).select(F.col("m.k").alias("k0"), F.col("m.node").alias("n0"))
    kept = c.materialise(kept, folder, "kept")
    first = rows.join(kept, (F.col("node") == F.col("n0")) & F.col("k").eqNullSafe(F.col("k0")))
    twice = first.groupBy("n0").agg(F.count("*").alias("times")).where("times > 1").select(F.col("n0").alias("n1"))
    single = first.join(twice, F.col("n0") == F.col("n1"), "left_anti").select("_row.*")
    repeated = first.join(twice, F.col("n0") == F.col("n1"), "left_semi").groupBy("n0").agg(F.first("_row").alias("_row")).select("_row.*")
    return single.unionByName(repeated)
