"""Benchmark decontamination with suffix arrays of the training texts.

Each shard of training text gets a sparse word-level suffix array; every test suffix is
binary-searched in it, which gives the places where a test window stands verbatim, the
longest verbatim match of each document, and the words that are hit."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c

WINDOW = 13
#: Bytes of test text in one block; of several blocks a task has one in its memory at a time.
BLOCK_BYTES = 1 << 20
#: Bytes of text that a task searches with each block of several before it takes the next one.
GROUP_BYTES = 16 << 20
_STEP = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA5A3564E27F8862B))
_TOP = np.uint64(2**64 - 1)
_BITS = np.uint64(44)  # 64 - 20
COLUMNS = ["n_words", "n_hit", "hit_spans", "item_ids", "longest_match", "longest_at"]
_SCHEMA = "n_words long, n_hit long, hit_spans array<struct<start:long,end:long>>, item_ids array<string>, longest_match long, longest_at long"


class TestSuffixes:
    """The distinct windows of some benchmark items, as rows of word hashes."""

    __test__ = False

    def __init__(self, items: list[tuple[object, str | None]], window: int = WINDOW):
        column = pa.array([t or "" for _, t in items], pa.large_string())
        data, bounds = c.text_bytes(column)
        data = c.lower_ascii(data)
        starts, ends = c.words(data, bounds)
        hashes = c.span_hashes(data, starts, ends)
        self.spelt = {int(h): data[s:e].tobytes() for h, s, e in zip(hashes, starts, ends)}
        self.window = window
        self.ids = [str(i) if i is not None else "null" for i, _ in items]
        rows: dict[bytes, int] = {}
        lengths: list[int] = []
        owners: list[set[int]] = []
        edges = np.searchsorted(starts, bounds)
        #: next_row[r]: the windows that follow window r in some item, for longest matches
        self.follows: set[tuple[int, int]] = set()
        for k in range(len(items)):
            own = hashes[edges[k] : edges[k + 1]]
            size = min(window, len(own))
            before = -1
            for at in range(len(own) - size + 1 if size else 0):
                key = own[at : at + size].tobytes()
                row = rows.setdefault(key, len(rows))
                if row == len(lengths):
                    lengths.append(size)
                    owners.append(set())
                owners[row].add(k)
                if before >= 0:
                    self.follows.add((before, row))
                before = row
        self.lengths = np.array(lengths, np.int64)
        self.suffixes = np.zeros((len(rows), window), np.uint64)
        for key, row in rows.items():
            self.suffixes[row, : lengths[row]] = np.frombuffer(key, np.uint64)
        self.owner_at = np.concatenate(([0], np.cumsum([len(o) for o in owners]))).astype(np.int64)
        self.owner = np.array([k for o in owners for k in sorted(o)], np.int64)
        self.lead = np.minimum(self.lengths, 3)
        self.lead_keys = np.zeros(len(rows), np.uint64)
        self.bits = {}
        for d in (1, 2, 3):
            own = np.flatnonzero(self.lead == d)
            if len(own):
                self.lead_keys[own] = _lead([self.suffixes[own, j] for j in range(d)])
                self.bits[d] = np.zeros(1 << 20, bool)
                self.bits[d][self.lead_keys[own] >> _BITS] = True


def _lead(columns: list[np.ndarray]) -> np.ndarray:
    out = columns[0].copy()
    for j, x in enumerate(columns[1:]):
        out = out * _STEP[j] + x
    return c.mix(out)


def _bound(array: np.ndarray, queries: np.ndarray, past: bool = False) -> np.ndarray:
    """For each query row, how many rows of the sorted array are less (or equal, if past), by binary search."""
    low, high = np.zeros(len(queries), np.int64), np.full(len(queries), len(array), np.int64)
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        mid = (low[open_] + high[open_]) >> 1
        row, query = array[mid], queries[open_]
        unlike = row != query
        first = unlike.argmax(1)
        k = np.arange(len(open_))
        less = np.where(unlike[k, first], row[k, first] < query[k, first], past)
        low[open_] = np.where(less, mid + 1, low[open_])
        high[open_] = np.where(less, high[open_], mid)


def search(test: TestSuffixes, hashes: np.ndarray, row_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, window): each place of the shard's words where a test window begins.

    Suffixes whose first words begin no test suffix are left out of the array (it is sparse)."""
    n = len(hashes)
    wanted = np.zeros(n, bool)
    for d, bits in test.bits.items():
        if n >= d:
            keys = _lead([hashes[j : n - d + 1 + j] for j in range(d)])
            wanted[: n - d + 1] |= bits[keys >> _BITS]
    begin = np.flatnonzero(wanted)
    if not len(begin):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    padded = np.concatenate((hashes, np.zeros(test.window, np.uint64)))
    owner = np.concatenate((row_of, np.full(test.window, -1, np.int64)))
    reach = begin[:, None] + np.arange(test.window)
    suffixes = np.where(owner[reach] == row_of[begin][:, None], padded[reach], np.uint64(0))
    order = np.lexsort(suffixes.T[::-1])
    array = suffixes[order]
    here = np.zeros(len(test.lengths), bool)
    for d in test.bits:
        own = np.flatnonzero(test.lead == d)
        keys = _lead([array[:, j] for j in range(d)])
        seen = np.zeros(1 << 20, bool)
        seen[keys >> _BITS] = True
        here[own] = seen[test.lead_keys[own] >> _BITS]
    asked = np.flatnonzero(here)
    queries = test.suffixes[asked]
    first = _bound(array, queries)
    past = _bound(array, np.where(np.arange(test.window) < test.lengths[asked][:, None], queries, _TOP), past=True)
    count = past - first
    asked, first, count = asked[count > 0], first[count > 0], count[count > 0]
    places = np.repeat(first - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum()) if len(count) else np.zeros(0, np.int64)
    return begin[order[places]], np.repeat(asked, count)


def _hits(test: TestSuffixes, column: pa.Array) -> tuple[np.ndarray, list[tuple[int, list, set, int, int]]]:
    """Words of each text; for those with hits (row, spans, items, longest, its place)."""
    data, bounds = c.text_bytes(column)
    data = c.lower_ascii(data)
    starts, ends = c.words(data, bounds)
    edges = np.searchsorted(starts, bounds)
    total = np.diff(edges)
    hashes = c.span_hashes(data, starts, ends)
    row_of = np.repeat(np.arange(len(total)), total)
    place, window = search(test, hashes, row_of)
    if len(place):  # the words themselves decide, not their hashes
        size = test.lengths[window]
        cover = np.zeros(len(hashes) + 1, np.int64)
        np.add.at(cover, place, 1)
        np.add.at(cover, place + size, -1)
        bad = np.zeros(len(hashes) + 1, np.int64)
        for at in np.flatnonzero(np.cumsum(cover[:-1]) > 0):
            bad[at + 1] = test.spelt.get(int(hashes[at])) != data[starts[at] : ends[at]].tobytes()
        bad = np.cumsum(bad)
        keep = bad[place + size] == bad[place]
        place, window = place[keep], window[keep]
    found = []
    if len(place):
        order = np.lexsort((window, place))
        place, window = place[order], window[order]
        cuts = np.flatnonzero(np.diff(row_of[place])) + 1
        for at, kinds in zip(np.split(place, cuts), np.split(window, cuts)):
            row = int(row_of[at[0]])
            spans: list[list[int]] = []
            items: set[str] = set()
            chain: dict[int, tuple[int, int]] = {}
            reach, before, longest, longest_at = {}, -1, 0, 0
            for p, w in zip(at.tolist(), kinds.tolist()):
                p0, size = p - int(edges[row]), int(test.lengths[w])
                if spans and p0 <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], p0 + size)
                else:
                    spans.append([p0, p0 + size])
                items.update(test.ids[k] for k in test.owner[test.owner_at[w] : test.owner_at[w + 1]])
                if p0 != before:
                    chain, reach, before = reach if p0 == before + 1 else {}, {}, p0
                linked = [x for v, x in chain.items() if (v, w) in test.follows]
                start, length = max(linked, key=lambda x: x[1], default=(p0, size - 1))
                reach[w] = (start, length + 1)
                if length + 1 > longest:
                    longest, longest_at = length + 1, start
            found.append((row, spans, items, longest, longest_at))
    return total, found


def _merge(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def _blocks(spark: SparkSession, benchmark: DataFrame, item_id: str, item_text: str, window: int, block_bytes: int) -> list:
    """Broadcast test suffixes, built one block after the other."""
    plain = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("id"), F.col(f"`{item_text}`").cast("string").alias("text"))
    size = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    out = []
    for k in range(blocks):
        own = plain if blocks == 1 else plain.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == k)
        out.append(spark.sparkContext.broadcast(TestSuffixes([(r["id"], r["text"]) for r in own.toLocalIterator()], window)))
    return out


def _searched(tests: list, columns: list[pa.Array]) -> list[tuple[np.ndarray, dict[int, list]]]:
    """Words of each text, and for those with hits [spans, items, longest, its place], over all blocks."""
    out: list = [None] * len(columns)
    for held in tests:
        test = held.value if len(tests) == 1 else c.opened(held)
        for i, column in enumerate(columns):
            total, found = _hits(test, column)
            _, hits = out[i] = out[i] or (total, {})
            for row, spans, items, longest, at in found:
                old = hits.get(row)
                if old is None:
                    hits[row] = [spans, items, longest, at]
                else:
                    old[0], old[1] = _merge([*old[0], *spans]), old[1] | items
                    if longest > old[2]:
                        old[2:] = [longest, at]
        del test
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, keep_text: bool = True, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with n_words, n_hit, hit_spans (word ranges), item_ids, longest_match (words),
    longest_at (its first word) and contaminated (n_hit > 0 and 20 * n_hit >= n_words).

    The texts are read once and never shuffled. The test suffixes go to the executors in
    blocks of about ``block_bytes`` of benchmark text (an item is never split). A match shorter than
    a window is none: longest_match is 0 then.
    Null and empty texts have no words and no hits; items without words have no windows;
    null item_ids are written ``null``; items that repeat an item_id count once; rows of
    documents may repeat and are judged each. Columns of ``docs`` that have the name of an
    added column are replaced. An empty benchmark hits nothing."""
    docs = c.without(docs, [*COLUMNS, "contaminated"])
    tests = _blocks(docs.sparkSession, benchmark, item_id, item_text, window, block_bytes)
    keep = [x for x in docs.columns if keep_text or x != text]
    schema = docs.select(*[F.col(f"`{k}`") for k in keep]).schema
    for field in docs.limit(0).selectExpr(*[f"cast(null as {t}) as {n}" for n, t in (x.split(" ", 1) for x in _SCHEMA.replace(", ", "|").split("|"))]).schema:
        schema = schema.add(field)

    @c.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        for group in c.groups(batches, text, GROUP_BYTES if len(tests) > 1 else 0):
            for batch, (total, hits) in zip(group, _searched(tests, [b.column(text) for b in group])):
                found = [hits.get(r, ([], (), 0, 0)) for r in range(batch.num_rows)]
                spans = [x[0] for x in found]
                flat = [x for own in spans for x in own]
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in spans]))).astype(np.int32)
                pairs = pa.StructArray.from_arrays([pa.array([x[0] for x in flat], pa.int64()), pa.array([x[1] for x in flat], pa.int64())], ["start", "end"])
                made = [pa.array(total, pa.int64()), pa.array([sum(e - s for s, e in x) for x in spans], pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pairs), pa.array([sorted(x[1]) for x in found], pa.list_(pa.string())), *(pa.array([x[i] for x in found], pa.int64()) for i in (2, 3))]
                yield pa.RecordBatch.from_arrays([a.cast(t.type) for a, t in zip([*(batch.column(k) for k in keep), *made], target)], schema=target)

    return docs.mapInArrow(run, schema).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their columns as they were. Only the
    texts go to Python, and only the verdicts come back; the rules are those of ``contamination``."""
    tests = _blocks(docs.sparkSession, benchmark, item_id, item_text, window, block_bytes)

    @F.arrow_udf("boolean")
    @c.released
    def contaminated(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            flags = []
            for total, hits in _searched(tests, list(c.slices(texts))):
                n_hit = np.zeros(len(total), np.int64)
                for row, (spans, *_) in hits.items():
                    n_hit[row] = sum(e - s for s, e in spans)
                flags.append((n_hit > 0) & (20 * n_hit >= total))
            yield pa.array(np.concatenate(flags) if flags else np.zeros(0, bool))

    return docs.where(~contaminated(F.col(f"`{text}`").cast("string")))
