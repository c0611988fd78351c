"""What the operators of this subpackage share: Arrow text buffers, byte-level
words, 64-bit hashing, shared scratch folders and connected components."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import itertools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHARD_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which driver and executors share.

    Only where a local session (single-machine tests) has no such setting is one set; on a
    cluster that is an error, as no folder of one machine will do."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "/tmp/checkpoints"
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/lodestone-{uuid.uuid4().hex}"


def materialise(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: lineage ends there."""
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` less the columns that an operator is about to add (any letter case)."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


# ---------------------------------------------------------------- text buffers
def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column (null: empty) and the offset of each row."""
    column = column.cast(pa.large_string()).fill_null("")
    bounds = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    held = column.buffers()[2] if len(column) else None
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def shards(batches: Iterator[pa.RecordBatch], column: str, limit: int = SHARD_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches' rows again, about ``limit`` bytes of text in each; a longer text is alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = 0
        for part in slices(batch.column(column), limit):
            yield batch.slice(at, len(part))
            at += len(part)


def slices(column: pa.Array, limit: int = SHARD_BYTES) -> Iterator[pa.Array]:
    """The column's texts again, about ``limit`` bytes at a time; a longer text is alone."""
    _, bounds = text_bytes(column)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, "right")) - 1)
        yield column.slice(at, to - at)
        at = to


def opened(held):
    """A broadcast value that this process does not keep."""
    value = held.value
    held.__dict__.pop("_value", None)
    return value


def groups(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[list[pa.RecordBatch]]:
    """Lists of shards, of ``limit`` bytes of text and a shard at most."""
    held, size = [], 0
    for batch in shards(batches, column):
        held.append(batch)
        size += int(text_bytes(batch.column(column))[1][-1])
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, bool)
_IS_WORD[0x30:0x3A] = _IS_WORD[0x61:0x7B] = _IS_WORD[0x80:] = True


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def runs(flags: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes; none crosses a row's bounds."""
    if not len(flags):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = flags.copy()
    first[1:] &= ~flags[:-1]
    last = flags.copy()
    last[:-1] &= ~flags[1:]
    inner = bounds[(bounds > 0) & (bounds < len(flags))]
    first[inner] = flags[inner]
    last[inner - 1] = flags[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def words(lowered: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of words: digits, a-z and everything beyond ASCII."""
    return runs(_IS_WORD[lowered], bounds)


def released(run):
    """A task's generator that gives its memory back when it ends: a reused worker keeps no tables
    of one stage through the next ones."""

    @functools.wraps(run)
    def bounded(batches):
        try:
            yield from run(batches)
        finally:
            _POWERS.clear()
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
                ctypes.CDLL(None).malloc_trim(0)

    return bounded


# --------------------------------------------------------------------- hashing
_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(1, 2**64, 256, dtype=np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
UNBASE = np.uint64(pow(int(BASE), -1, 2**64))
_POWERS = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept between calls."""
    held = _POWERS.get(int(base))
    if held is None or len(held) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        held = np.full(size, base, np.uint64)
        held[0] = 1
        held = np.cumprod(held, dtype=np.uint64)
        _POWERS[int(base)] = held
    return held[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash, never 0, of each of the disjoint, ordered byte spans."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = ends - starts
    inside = np.repeat(starts - np.concatenate(([0], np.cumsum(size)[:-1])), size)
    at = np.arange(len(inside))
    place = at + inside
    step = place - np.repeat(starts, size)
    terms = _BYTE[data[place]] * powers(BASE, int(size.max()))[step]
    sums = np.add.reduceat(terms, np.concatenate(([0], np.cumsum(size)[:-1])))
    return np.maximum(mix(sums + size.astype(np.uint64)), np.uint64(1))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Prefix polynomial hashes: entry i covers data[:i]."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(BASE, len(data)), out=out[1:])
    return out


def window_hashes(prefix: np.ndarray, starts: np.ndarray | slice, size: int) -> np.ndarray:
    """Hashes of data[s : s + size], comparable between buffers."""
    if isinstance(starts, slice):
        n = len(prefix) - size
        return mix((prefix[size:] - prefix[:n]) * powers(UNBASE, n)) if n > 0 else np.zeros(0, np.uint64)
    return mix((prefix[starts + size] - prefix[starts]) * powers(UNBASE, len(prefix))[starts])


# ---------------------------------------------------------- graph of documents
#: Links in one file, and so in one task, of the tables between the turns below.
EDGES_A_FILE = 400_000


def components(edges: DataFrame, folder: str) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the least node it is joined to.

    Alternates the two star steps (every neighbour to the least; then the lesser ones to the
    least), as DataFrame joins written to the shared folder after each turn, until no edge
    changes. No group is gathered in one task: all steps are aggregates and joins by node."""
    edges = materialise(edges.select("a", "b").where("a <> b").distinct(), folder, "edges")
    files = max(1, -(-edges.count() // EDGES_A_FILE))  # the links only get fewer
    edges = edges.coalesce(files)
    last = None
    for turn in itertools.count():  # both star steps only ever lower a node's links, so this ends
        both = edges.union(edges.select(F.col("b"), F.col("a")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").toDF("a", "b")
        edges = materialise(small.where("a <> b").distinct().coalesce(files), folder, f"edges{turn}")
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == last:
            break
        last = tuple(seen)
    roots = edges.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return roots.union(edges.select("b").distinct().join(roots, F.col("b") == F.col("node"), "left_anti").select(F.col("b").alias("node"), F.col("b").alias("root")))
