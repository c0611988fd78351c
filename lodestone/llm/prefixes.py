"""The prefix trie of conversations: nodes are distinct sequences of first turns, told by 128 bits of
hash. Each node's child of most conversations goes on its path (ties: the least conversation); sums
over subtrees are suffix sums along path arrays, and the paths that hang beside are added to their
parents level by level. A path of a lower level holds at most half of the conversations of its
parent, so there are as many rounds as the logarithm of their number."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from . import common as c

#: Turns of one conversation, or nodes of one path, in one window or array; longer ones are cut.
BLOCK = 1024
#: Bytes of joined ids in one row between the two steps of a digest.
CHUNK_BYTES = 1 << 18
ID = ["depth", "x1", "x2"]
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def _running(df: DataFrame, key: list[str], block: Column, order: list[Column], **kept: Column) -> DataFrame:
    """``df`` with running aggregates over each key in the given order: name=aggregate (of sum, max or bit_xor).

    In two steps, so that no key is one task's: within blocks, then over a row a block."""
    joins = {"sum": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)), "max": F.greatest, "bit_xor": lambda a, b: F.coalesce(a, F.lit(0)).bitwiseXOR(F.coalesce(b, F.lit(0)))}
    call = {"sum": F.sum, "max": F.max, "bit_xor": F.bit_xor}
    df = df.withColumn("_block", block)
    inside = Window.partitionBy(*key, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    whole = df.groupBy(*key, "_block").agg(*[call[how](value).alias(f"_w_{n}") for n, (how, value) in kept.items()])
    whole = whole.select(*key, "_block", *[call[how](f"_w_{n}").over(before).alias(f"_b_{n}") for n, (how, _) in kept.items()])
    df = df.select("*", *[call[how](value).over(inside).alias(f"_i_{n}") for n, (how, value) in kept.items()]).join(whole, [*key, "_block"])
    made = {n: joins[how](F.col(f"_b_{n}"), F.col(f"_i_{n}")) for n, (how, _) in kept.items()}
    return df.withColumns(made).drop("_block", *[f"_{x}_{n}" for x in "bi" for n in kept])


def ranked(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, rank, h1, h2, size): each turn's place in its conversation, from 1, by turn (null first),
    then role and text; hashes of role and text (null: empty) and the text's code points.

    Turns that are equal in all of it each have a place. Rows without a key belong to no conversation
    and are left out. Keys are whole numbers; others are an error."""
    if turns.schema[key].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise ValueError(f"{key} must be a whole number")
    said = [F.coalesce(F.col(f"`{n}`").cast("string"), F.lit("")) for n in (role, text)]
    rows = turns.where(F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"), said[0].alias("role"), said[1].alias("text"))
    order = [F.asc_nulls_first("turn"), F.col("role"), F.col("text")]
    placed = _running(rows, ["conv"], F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(2**62))), order, rank=("sum", F.lit(1)))
    return placed.select("conv", "rank", F.xxhash64("role", "text").alias("h1"), F.xxhash64("text", F.lit("turn"), "role").alias("h2"), F.char_length("text").cast("long").alias("size"))


def sequences(turns: DataFrame) -> DataFrame:
    """Ranked ``turns`` as (conv, depth, h1, h2, size), with a row of depth 0 for each conversation."""
    return turns.withColumnRenamed("rank", "depth").unionByName(_roots(turns.select("conv").distinct()))


def _roots(convs: DataFrame) -> DataFrame:
    none = F.lit(0).cast("long")
    return convs.select("conv", none.alias("depth"), none.alias("h1"), none.alias("h2"), none.alias("size"))


def rebuilt(turns: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """The sequences of conversations whose first turns are those of their group's first one: of
    conversation k, the first h of k - k % ``group`` (all if fewer), then k's own after its first h, where h
    is crc32 of k's decimal digits modulo ``most``. A conversation left without a turn keeps depth 0."""
    def head(k: str) -> Column:
        return F.pmod(F.crc32(F.col(k).cast("string").cast("binary")), F.lit(most))

    base = F.col("conv") - F.col("conv") % group
    # at most ``most`` - 1 turns of one conversation in ``group``
    heads = turns.where((F.col("conv") % group == 0) & (F.col("rank") < most)).groupBy(F.col("conv").alias("base")).agg(F.array_sort(F.collect_list(F.struct("rank", "h1", "h2", "size"))).alias("head"))
    convs = turns.select("conv").distinct()
    first = convs.withColumn("base", base).join(heads, "base").select("conv", F.explode(F.slice("head", F.lit(1), head("conv").cast("int"))).alias("t")).select("conv", F.col("t.rank").alias("depth"), "t.h1", "t.h2", "t.size")
    kept = F.least(head("conv"), F.coalesce(F.size("head"), F.lit(0)).cast("long"))
    own = turns.where(F.col("rank") > head("conv")).withColumn("base", base).join(heads.select("base", "head"), "base", "left")
    own = own.select("conv", (kept + F.col("rank") - head("conv")).alias("depth"), "h1", "h2", "size")
    return first.unionByName(own).unionByName(_roots(convs))


# ---------------------------------------------------------------- digests of ends
_CHUNK = "depth long, x1 long, x2 long, first long, ids binary"


def _same(columns: list[np.ndarray]) -> np.ndarray:
    """Bounds of the runs of rows that are equal in all columns."""
    n = len(columns[0])
    new = np.zeros(n, bool)
    for x in columns:
        new[1:] |= x[1:] != x[:-1]
    return np.concatenate(([0], np.flatnonzero(new), [n])) if n else np.zeros(1, int)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (depth, x1, x2, conv) rows to joined decimal ids, a row for each node and CHUNK_BYTES at most."""
    step = CHUNK_BYTES // 21
    for batch in batches:
        held = [batch.column(n).to_numpy(zero_copy_only=False) for n in (*ID, "conv")]
        bounds = _same(held[:3])
        cuts = [(p, min(p + step, to)) for at, to in zip(bounds, bounds[1:]) for p in range(at, to, step)]
        joined = [",".join(map(str, held[3][a:b].tolist())).encode() for a, b in cuts]
        at = [a for a, _ in cuts]
        yield pa.RecordBatch.from_arrays([*[pa.array(x[at]) for x in held], pa.array(joined, pa.binary())], names=[*ID, "first", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks sorted by node and first id to one digest a node; only its running state is held."""
    node, state = None, None
    for batch in batches:
        done = []
        for row in zip(*[batch.column(n).to_pylist() for n in ID], batch.column("ids")):
            if row[:3] == node:
                state.update(b",")
            else:
                if state:
                    done.append((*node, state.hexdigest()))
                node, state = row[:3], hashlib.sha256()
            state.update(row[3].as_buffer())
        if done:
            yield _told(done)
    if state:
        yield _told([(*node, state.hexdigest())])


def _told(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=[*ID, "ends_sha256"])


def ends_digests(ends: DataFrame) -> DataFrame:
    """(depth, x1, x2, ends_sha256) of the nodes at which conversations end (conv, depth, x1, x2).

    Rows are dealt by ranges of node and conversation, so a node at which a third of all end is many
    tasks'; each joins its ids to chunks. A digest takes its chunks in order, one at a time: that
    part alone is one task's, as a digest reads its bytes one after the other."""
    chunks = ends.select(*ID, "conv").repartitionByRange(*ID, "conv").sortWithinPartitions(*ID, "conv").mapInArrow(_chunks, _CHUNK)
    return chunks.repartition(*ID).sortWithinPartitions(*ID, "first").mapInArrow(_digests, "depth long, x1 long, x2 long, ends_sha256 string")


# -------------------------------------------------------------------------- trie
@F.arrow_udf(ArrayType(LongType()))
def _suffix_sums(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Each list's entries to the sums from there to its end."""
    for lists in batches:
        values = lists.flatten().to_numpy(zero_copy_only=False)
        ends = lists.value_lengths().to_numpy(zero_copy_only=False).cumsum()
        whole = np.concatenate(([0], np.cumsum(values)))
        sums = np.repeat(whole[ends], np.diff(ends, prepend=0)) - whole[:-1]
        yield pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(sums, pa.int64()))


def _subtree_sums(level: DataFrame) -> DataFrame:
    """The nodes of some paths (h_*: the path's head) with leaves and saved summed from each to its path's end."""
    path = ["h_depth", "h_x1", "h_x2"]
    rest = [n for n in level.columns if n not in (*path, "leaves", "saved")]
    arrays = level.groupBy(*path, F.floor(F.col("depth") / BLOCK).alias("block")).agg(F.array_sort(F.collect_list(F.struct("depth", "leaves", "saved", F.struct(*rest).alias("node")))).alias("nodes"))
    arrays = arrays.select(*path, "block", "nodes", *[_suffix_sums(F.col(f"nodes.{x}")).alias(x) for x in ("leaves", "saved")])
    after = Window.partitionBy(*path).orderBy("block").rowsBetween(1, Window.unboundedFollowing)  # a row a block
    arrays = arrays.select("*", *[F.coalesce(F.sum(F.get(x, F.lit(0))).over(after), F.lit(0)).alias(f"later_{x}") for x in ("leaves", "saved")])
    each = arrays.select(*path, "later_leaves", "later_saved", F.explode(F.arrays_zip(F.col("nodes.node").alias("node"), "leaves", "saved")).alias("t"))
    return each.select(*path, *[F.col("t.node")[n].alias(n) for n in rest], *[(F.col(f"t.{x}") + F.col(f"later_{x}")).alias(x) for x in ("leaves", "saved")])


def trie(turns: DataFrame, folder: str) -> DataFrame:
    """The nodes of the prefix trie of sequences ``turns`` (conv, depth, h1, h2, size; depth 0 for each
    conversation): depth, conv_id (least member), parent_conv_id (root: null), n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256.

    Conversations that are equal throughout are counted once they are hashed and go on as one.
    Joins are by node or conversation and split by adaptive execution; groups are pre-aggregated. An
    empty table has no node, not even a root."""
    one, two = F.xxhash64("depth", "h1", "h2"), F.xxhash64("h2", "depth", "h1")
    none = F.lit(0).cast("long")
    own = turns.select("conv", "depth", "size", F.when(F.col("depth") > 0, one).otherwise(none).alias("e1"), F.when(F.col("depth") > 0, two).otherwise(none).alias("e2"))
    block = F.floor(F.col("depth") / BLOCK)
    rows = _running(own, ["conv"], block, [F.col("depth")], x1=("bit_xor", F.col("e1")), x2=("bit_xor", F.col("e2")))
    rows = c.materialise(rows.select("conv", *ID, F.col("x1").bitwiseXOR(F.col("e1")).alias("p1"), F.col("x2").bitwiseXOR(F.col("e2")).alias("p2"), "size"), folder, "prefixes")
    ends = rows.groupBy("conv").agg(F.max(F.struct(*ID)).alias("end")).select("conv", "end.*")
    ends = c.materialise(ends, folder, "ends")
    different = ends.groupBy(*ID).agg(F.min("conv").alias("conv"), F.count("*").alias("copies")).select("conv", "copies")
    rows = c.materialise(rows.join(different, "conv"), folder, "different")
    nodes = rows.groupBy(*ID).agg(F.sum("copies").alias("n_convs"), F.min("conv").alias("conv_id"), F.max("size").alias("size"), F.max(F.struct("p1", "p2")).alias("p")).select(*ID, "n_convs", "conv_id", "size", "p.*")
    nodes = c.materialise(nodes, folder, "nodes")
    kids = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("x1"), F.col("p2").alias("x2")).agg(F.count("*").alias("n_children"), F.max(F.struct("n_convs", F.bitwise_not("conv_id").alias("least"))).alias("heavy"))
    nodes = c.materialise(nodes.join(kids, ID, "left"), folder, "counted")
    parents = nodes.where("heavy is not null").select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), F.bitwise_not("heavy.least").alias("next"))
    nodes = nodes.drop("heavy").join(parents, ["depth", "p1", "p2"], "left").withColumn("light", F.coalesce(F.col("conv_id") != F.col("next"), F.lit(True))).drop("next")
    nodes = c.materialise(nodes, folder, "parents")
    walked = rows.select("conv", *ID).join(nodes.select(*ID, "light", (F.lit(True)).alias("known")), ID)
    walked = _running(walked, ["conv"], block, [F.col("depth")], level=("sum", F.col("light").cast("long")), head=("max", F.when(F.col("light"), F.struct(*ID))))
    placed = walked.select(*ID, F.col("conv").alias("conv_id"), "level", *[F.col("head")[n].alias(f"h_{n}") for n in ID])
    whole = nodes.drop("light").join(placed, [*ID, "conv_id"]).withColumn("leaves", F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long")).withColumn("saved", (F.col("n_convs") - 1) * F.col("size"))
    whole = whole.withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    levels, done = f"{folder}/levels", f"{folder}/summed"
    whole.write.partitionBy("level").parquet(levels)
    spark = turns.sparkSession
    whole = spark.read.schema(whole.schema).parquet(levels)
    last = whole.agg(F.max("level")).first()[0]
    if last is None:
        return whole.select("depth", "conv_id", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.lit("").alias("ends_sha256"))
    hung, schema = None, None
    for level in range(last, 0, -1):  # the root is the head of level 1
        nodes = whole.where(F.col("level") == level).drop("level")
        if hung is not None:
            added = nodes.join(hung, ID, "left")
            nodes = added.withColumns({x: F.col(x) + F.coalesce(f"more_{x}", F.lit(0)) for x in ("leaves", "saved")}).drop("more_leaves", "more_saved")
        summed = _subtree_sums(nodes)
        schema = summed.schema
        summed.write.parquet(f"{done}/{level}")
        heads = spark.read.schema(schema).parquet(f"{done}/{level}").where("depth = h_depth and x1 = h_x1 and x2 = h_x2 and depth > 0")
        hung = heads.groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("x1"), F.col("p2").alias("x2")).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    summed = spark.read.schema(schema).parquet(*[f"{done}/{level}" for level in range(1, last + 1)])
    out = summed.join(ends_digests(ends), ID, "left")
    return out.select("depth", "conv_id", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame, folder: str, group: int | None = None, **names: str) -> DataFrame:
    """The nodes of ``conversations``' prefix trie (see ``trie``), of those rebuilt in groups of ``group`` if
    given (see ``rebuilt``), else as they are. ``names``: the columns key, turn, role and text. Other
    columns are left out."""
    turns = ranked(conversations, **names)
    return trie(sequences(turns) if group is None else rebuilt(c.materialise(turns, folder, "ranked"), group), folder)
