"""Language-model scoring by prediction by partial matching over bytes.

The trie of byte contexts is kept flat: counts of (order + 1)-grams of bytes of all training
texts, gathered with pre-aggregation, give the counts of every shorter context. A symbol's
probability is taken at the longest context in which it was seen; each escape from a longer
context costs distinct / (total + distinct) there (method C), and symbols seen in the longer
context are excluded from the counts below. All of it is computed once for each (context,
symbol) or context, so that a text is scored with table lookups.

The model is cut into blocks of contexts. A task scores some megabytes of text with one block
after the other, so one block is in its memory at a time, however large the model.

Words are scored against their corpus counts besides: frequent words in a table of bounded
size, the others in a join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as c

ORDER = 5
#: Words in the broadcast table at most, and (order + 1)-grams in one block of the model, about: all
#: grams with the same two symbols before the last are in one block.
HEAD_WORDS = 1 << 19
BLOCK_GRAMS = 1 << 21
#: Bytes of text that a task scores with each block of several before it takes the next one.
GROUP_BYTES = 16 << 20
#: Counts that a task merges before it hands them on.
HELD_COUNTS = 1 << 20
_END_TOKEN = np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row and hash of each token (one end token a row), and the lowered bytes with their bounds."""
    data, bounds = c.text_bytes(column)
    data = c.lower_ascii(data)
    starts, ends = c.runs(~_SPACE[data], bounds)
    hashes = c.span_hashes(data, starts, ends)
    hashes[hashes == _END_TOKEN] = np.uint64(2)
    rows = np.searchsorted(bounds, starts, "right") - 1
    n = len(bounds) - 1
    return np.concatenate((rows, np.arange(n))), np.concatenate((hashes, np.full(n, _END_TOKEN))), data, bounds


def grams(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each byte and for the end of each text the gram of it and the ``ORDER`` symbols before.

    A text is preceded and ended by byte 0xFF, which UTF-8 never holds."""
    n = len(bounds) - 1
    size = np.diff(bounds)
    padded = np.full(len(data) + n * (ORDER + 1), 0xFF, np.uint64)
    first = bounds[:-1] + np.arange(n) * (ORDER + 1) + ORDER
    padded[np.arange(len(data)) + np.repeat(first - bounds[:-1], size)] = data
    out = np.zeros(len(padded) - ORDER, np.uint64)
    for j in range(ORDER + 1):
        out = (out << np.uint64(8)) | padded[j : len(padded) - ORDER + j]
    where = np.arange(len(data) + n) + np.repeat(first - bounds[:-1] - np.arange(n), size + 1) - ORDER
    return out[where]


def _count(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values = np.sort(values)
    at = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, np.int64)
    return values[at], np.diff(np.append(at, len(values)))


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    key, n = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    at = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return key[at], np.add.reduceat(n, at) if len(at) else n


def corpus_counts(docs: DataFrame, folder: str, text: str = "text") -> DataFrame:
    """(kind, key, n): kind 0 counts word hashes, kind 1 grams, over all rows of ``docs``."""

    def rows(kind: int, held: list) -> pa.RecordBatch:
        key, n = _merged(held)
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(key), kind, np.int32)), pa.array(key.astype(np.uint64).view(np.int64)), pa.array(n.astype(np.int64))], ["kind", "key", "n"])

    @c.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, list] = [], []
        for batch in c.shards(batches, text):
            _, hashes, data, bounds = tokens(batch.column(text))
            for kind, values in enumerate((hashes, grams(data, bounds))):
                held[kind].append(_count(values))
                if sum(len(key) for key, _ in held[kind]) > HELD_COUNTS:
                    held[kind][:] = [_merged(held[kind])]
                    if len(held[kind][0][0]) > HELD_COUNTS // 2:
                        yield rows(kind, held[kind])
                        held[kind].clear()
        for kind in (0, 1):
            if held[kind]:
                yield rows(kind, held[kind])

    slim = docs.select(F.col(f"`{text}`").cast("string").alias(text))
    return c.materialise(slim.mapInArrow(run, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")), folder, "counts")


class Sorted:
    """Sorted uint64 keys -> rows of values, by binary search."""

    def __init__(self, keys: np.ndarray, *values: np.ndarray):
        self.keys, self.values = keys, values

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places, and which keys were found there."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, self.keys[at] == keys


def _low(grams: np.ndarray, symbols: int) -> np.ndarray:
    return grams & np.uint64((1 << (8 * symbols)) - 1)


class Block:
    """The model's contexts of two symbols and more that end in some pairs, and all shorter ones.

    ``grams``/``counts``: the sorted (order + 1)-grams whose last two context symbols are in the block.
    ``pairs``: counts (256, 256) of symbol after symbol over the whole corpus.
    ``block_of``: the block of each pair of symbols."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, pairs: np.ndarray, block: int, block_of: np.ndarray):
        self.block, self.block_of = block, block_of
        levels = {ORDER: (grams.astype(np.uint64), counts.astype(np.float64))}
        for k in range(ORDER - 1, 1, -1):
            keys, place = np.unique(_low(levels[k + 1][0], k + 1), return_inverse=True)
            levels[k] = keys, np.bincount(place, levels[k + 1][1], len(keys))
        first, second = np.nonzero(pairs)
        levels[1] = (first.astype(np.uint64) << np.uint64(8)) | second.astype(np.uint64), pairs[first, second].astype(np.float64)
        single = pairs.sum(0)
        some = np.flatnonzero(single)
        levels[0] = some.astype(np.uint64), single[some].astype(np.float64)
        #: by level: (context, symbol) -> log10 of its share; context -> log10 of its escape, and what
        #: the exclusion of its symbols adds to a symbol and to an escape one level below
        self.symbols, self.contexts = [], []
        before = None
        for k in range(ORDER + 1):
            keys, n = levels[k]
            of, place = np.unique(keys >> np.uint64(8), return_inverse=True)
            total, distinct = np.bincount(place, n, len(of)), np.bincount(place, minlength=len(of)).astype(np.float64)
            with np.errstate(divide="ignore", invalid="ignore"):
                self.symbols.append(Sorted(keys, np.log10(n / (total + distinct)[place]).astype(np.float32)))
                escape = np.log10(distinct / (total + distinct))
                lost = more = np.zeros(len(of))
                if before:  # symbols seen in a context are excluded from the counts one level below
                    shorter, up, up_total, up_distinct = before
                    taken = np.bincount(place, levels[k - 1][1][np.searchsorted(shorter, _low(keys, k))], len(of))
                    at = np.searchsorted(up, _low(of, k - 1))
                    whole, left, kinds = (up_total + up_distinct)[at], up_total[at] - taken, up_distinct[at] - distinct
                    some_left = left + kinds > 0
                    lost = np.where(some_left, np.log10(whole / (left + kinds)), 0.0)
                    more = np.where(some_left, np.log10(kinds / (left + kinds)), 0.0) - np.log10(up_distinct[at] / whole)
            self.contexts.append(Sorted(of, *(x.astype(np.float32) for x in (escape, lost, more))))
            before = keys, of, total, distinct
        # below order 0: each of the 256 symbols that is excluded nowhere is as likely
        self.floor = -np.log10(max(1, 256 - len(some)))

    def mine(self, grams: np.ndarray) -> np.ndarray:
        return np.flatnonzero(self.block_of[(grams >> np.uint64(8)).astype(np.int64) & 0xFFFF] == self.block)

    def _excluded(self, level: int, grams: np.ndarray, column: int) -> np.ndarray:
        table = self.contexts[level]
        return table.values[column][table.find(_low(grams >> np.uint64(8), level))[0]]

    def score(self, grams: np.ndarray) -> np.ndarray:
        """log10 probability of each gram's last symbol after the others."""
        grams = grams.astype(np.uint64)
        out = np.zeros(len(grams))
        left = np.arange(len(grams))
        above = np.zeros(len(grams), bool)  # a longer context was seen, so exclusion applies
        for k in range(ORDER, -1, -1):
            at, found = self.symbols[k].find(_low(grams[left], k + 1))
            hit = left[found]
            out[hit] += self.symbols[k].values[0][at[found]]
            held = hit[above[hit]]
            if len(held):
                out[held] += self._excluded(k + 1, grams[held], 1)
            left = left[~found]
            if not len(left):
                return out
            at, seen = self.contexts[k].find(_low(grams[left] >> np.uint64(8), k))
            out[left[seen]] += self.contexts[k].values[0][at[seen]]
            held = left[seen & above[left]]
            if len(held):
                out[held] += self._excluded(k + 1, grams[held], 2)
            above[left] |= seen
        out[left] += self.floor
        return out


def _packed(sizes: np.ndarray, most: int) -> np.ndarray:
    """A block number for each pair: the largest first, each block filled until it holds ``most``."""
    order = np.argsort(-sizes, kind="stable")
    before = np.cumsum(sizes[order]) - sizes[order]
    out = np.zeros(len(sizes), np.int64)
    out[order] = before // most
    return np.unique(out, return_inverse=True)[1]


def _arrays(df: DataFrame, *columns: str) -> list[np.ndarray]:
    held = df.select(*columns).toArrow()
    return [held.column(x).to_numpy() for x in columns]


def scored(docs: DataFrame, training: Column, folder: str, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens, n_known, train_tokens, base_score and score (log10, of the whole text).

    The model and the word counts come from all rows where ``training`` holds. Counts are
    pre-aggregated by task. The grams go to the executors in blocks of a bounded number; all
    blocks are used in one pass over the texts. Of the words, those above the count that keeps the
    table within HEAD_WORDS are broadcast; the others, none of them frequent, are joined.
    Null texts are empty: an end token only. Without training rows every word is unknown and
    every symbol equally likely. Repeated rows count each, and are scored each. Columns with the
    names of added ones are replaced. Only the texts' length bounds a score; null keys are as others."""
    added = ["n_tokens", "n_known", "train_tokens", "base_score", "score", "_log", "_tail", "_times", "_row"]
    counts = corpus_counts(docs.where(training), folder, text)
    docs = c.without(docs, added)
    spark = docs.sparkSession
    words = counts.where("kind = 0")
    n_train, distinct = words.agg(F.sum("n"), F.count("*")).first()
    n_train = n_train or 0
    sizes = sorted(((r["k"], r["count"]) for r in words.groupBy(F.floor(F.log2("n")).cast("int").alias("k")).count().collect()), reverse=True)
    least, held_words = 63, 0
    for k, count in sizes:
        if held_words + count > HEAD_WORDS:
            break
        least, held_words = k, held_words + count
    limit = 1 << min(least, 62)
    key, n = _arrays(words.where(F.col("n") >= limit), "key", "n")
    order = np.argsort(key.view(np.uint64))
    head = spark.sparkContext.broadcast(Sorted(key.view(np.uint64)[order], n[order]))
    found = counts.where("kind = 1").select("key", "n", F.expr("(key >> 8) & 65535").cast("int").alias("p"))
    # at most 65,536 rows a query: pairs of symbols
    pairs, many = np.zeros((256, 256)), np.zeros(65536, np.int64)
    for r in found.groupBy(F.expr("key & 65535").alias("p")).agg(F.sum("n").alias("n")).toLocalIterator():
        pairs[r["p"] >> 8, r["p"] & 255] = r["n"]
    for r in found.groupBy("p").count().toLocalIterator():
        many[r["p"]] = r["count"]
    block_of = _packed(many, BLOCK_GRAMS)
    blocks = int(block_of.max()) + 1
    if blocks > 1:
        share = spark.createDataFrame([(i, int(b)) for i, b in enumerate(block_of)], "p int, b int")
        found.join(F.broadcast(share), "p").select("key", "n", "b").write.partitionBy("b").parquet(f"{folder}/grams")
        found = spark.read.schema("key long, n long, b int").parquet(f"{folder}/grams")
    held = []
    for b in range(blocks):
        key, n = _arrays(found if blocks == 1 else found.where(F.col("b") == b), "key", "n")
        order = np.argsort(key)
        held.append(spark.sparkContext.broadcast(Block(key[order], n[order], pairs, b, block_of)))
    scores = _pass(docs, held, head, text)
    scores = scores.withColumn("train_tokens", F.lit(n_train).cast("long"))
    unit = float(np.log10(n_train + distinct + 1))
    base = F.col("_log") - F.col("n_tokens") * unit
    kept = [F.col(f"`{x}`") for x in docs.columns if x != text]
    if held_words == distinct:
        return scores.select(*kept, "n_tokens", "n_known", "train_tokens", base.alias("base_score"), "score")
    scores = c.materialise(scores.withColumn("_row", F.monotonically_increasing_id()), folder, "scores")
    rare = words.where(F.col("n") < limit).select("key", "n")
    asked = scores.select("_row", F.explode(F.arrays_zip("_tail", "_times")).alias("t")).select("_row", F.col("t._tail").alias("key"), F.col("t._times").alias("times"))
    more = asked.join(rare, "key").groupBy("_row").agg(F.sum("times").alias("_k"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("_more"))
    return scores.join(more, "_row", "left").select(*kept, "n_tokens", (F.col("n_known") + F.coalesce("_k", F.lit(0))).alias("n_known"), "train_tokens", (base + F.coalesce("_more", F.lit(0.0))).alias("base_score"), "score")


def _pass(docs: DataFrame, blocks: list, head, text: str) -> DataFrame:
    """``docs`` less the text, with score, the word columns, and the words that ``head`` lacks."""
    keep = [x for x in docs.columns if x != text]
    schema = docs.select(*[F.col(f"`{x}`") for x in keep]).schema
    for name, kind in (("score", "double"), ("n_tokens", "long"), ("n_known", "long"), ("_log", "double"), ("_tail", "array<long>"), ("_times", "array<int>")):
        schema = schema.add(name, kind if not kind.startswith("array") else _array(kind))
    limit = GROUP_BYTES if len(blocks) > 1 else 0

    def scores(group: list[pa.RecordBatch]) -> list[np.ndarray]:
        parts = []
        for batch in group:
            _, _, data, bounds = tokens(batch.column(text))
            gram, place = np.unique(grams(data, bounds), return_inverse=True)
            parts.append((gram, place.astype(np.int32), np.zeros(len(gram)), bounds[:-1] + np.arange(batch.num_rows)))
        for held in blocks:
            block = c.opened(held)
            for gram, _, value, _ in parts:
                mine = block.mine(gram) if len(blocks) > 1 else slice(None)
                value[mine] = block.score(gram[mine])
            del block
        return [np.add.reduceat(value[place], first) for _, place, value, first in parts]

    def words(column: pa.Array) -> list[pa.Array]:
        rows, hashes, _, _ = tokens(column)
        n = len(column)
        kinds, place = np.unique(hashes, return_inverse=True)
        at, known = head.value.find(kinds)
        logs = np.zeros(len(kinds))
        if known.any():
            logs[known] = np.log10(head.value.values[0][at[known]].astype(np.float64) + 1)
        known = known[place]
        order = np.lexsort((hashes[~known], rows[~known]))
        r, h = rows[~known][order], hashes[~known][order]
        at = np.flatnonzero(np.concatenate(([True], (r[1:] != r[:-1]) | (h[1:] != h[:-1])))) if len(r) else np.zeros(0, np.int64)
        edges = pa.array(np.searchsorted(r[at], np.arange(n + 1)), pa.int32())
        return [
            pa.array(np.bincount(rows, minlength=n).astype(np.int64)), pa.array(np.bincount(rows[known], minlength=n).astype(np.int64)), pa.array(np.bincount(rows, logs[place], n)),
            pa.ListArray.from_arrays(edges, pa.array(h[at].view(np.int64))), pa.ListArray.from_arrays(edges, pa.array(np.diff(np.append(at, len(r))).astype(np.int32))),
        ]

    @c.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        for group in c.groups(batches, text, limit):
            for batch, score in zip(group, scores(group)):
                made = [*(batch.column(x) for x in keep), pa.array(score), *words(batch.column(text))]
                yield pa.RecordBatch.from_arrays([a.cast(t.type) for a, t in zip(made, target)], schema=target)

    return docs.mapInArrow(run, schema)


def _array(kind: str):
    from pyspark.sql import types as T

    return T.ArrayType(T.LongType() if "long" in kind else T.IntegerType())
