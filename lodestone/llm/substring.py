"""Removal of repeated byte strings with hash-compared suffix sorting.

All windows of ``size`` bytes that also start earlier are removed. Sorting all suffixes of all
documents would shuffle each byte many times, so a window is first named by its minimiser, the
32-byte piece of least hash in it, which equal windows share at equal offsets. Neighbouring
windows with one minimiser make a segment. Segments whose piece stands once need no more work.
Of the others each task sends the bytes of every different one once (a copy that a task has seen
at an earlier place is removed there, after a comparison of its bytes). All segments of a piece
meet in one bucket: equal ones are told by their bytes, and the windows of unlike ones are
suffix-sorted by a mergesort whose comparisons find the common extension of two suffixes with
prefix polynomial hashes and binary search. Neighbours in that order are one class only if their
bytes agree; hashes alone never decide."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as c

SIZE, PIECE = 100, 32
_PLACE = np.uint64(30)
#: Bits of the broadcast bitmap of repeated pieces at most (32 MB), and bits for each piece below that.
BITMAP_BITS, BITS_A_PIECE = 28, 16
#: Segments in one bucket, about, and occurrences from which a piece's windows are dealt one by one.
BUCKET_ROWS, HOT = 30_000, 4096
#: Pieces dealt by window at most: HOT rises until they are so few.
HOT_PIECES = 1_000_000
#: Segments that a task remembers; beyond that it begins anew, and may send one twice.
HELD = 100_000


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    out, reach = x, 1
    while reach * 2 <= width:
        out = np.minimum(out[:-reach], out[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def segments(data: np.ndarray, bounds: np.ndarray, size: int = SIZE, piece: int = PIECE):
    """(row, piece hash, first window, last window, minimiser) of each segment, places in row's
    bytes, and the prefix hashes of ``data``, which holds less than 2**30 bytes."""
    none = np.zeros(0, np.int64)
    if len(data) < size:
        return (none,) * 6
    prefix = c.prefix_hashes(data)
    hashes = c.window_hashes(prefix, slice(None), piece)
    key = ((hashes >> _PLACE) << _PLACE) | np.arange(len(hashes), dtype=np.uint64)
    least = _sliding_min(key, size - piece + 1)
    least = (least & np.uint64((1 << 30) - 1)).astype(np.int64)  # minimiser of each window
    room = np.maximum(np.diff(bounds) - size + 1, 0)
    rows = np.repeat(np.arange(len(room)), room)
    starts = np.arange(len(rows)) + np.repeat(bounds[:-1] - (np.cumsum(room) - room), room)
    if not len(starts):
        return (none,) * 6
    own = least[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (own[1:] != own[:-1]) | (rows[1:] != rows[:-1])
    at = np.flatnonzero(new)
    low, high, a = starts[at], starts[np.append(at[1:], len(starts)) - 1], own[at]
    base = bounds[rows[at]]
    return rows[at], hashes[a].view(np.int64), low - base, high - base, a - base, prefix


class Suffixes:
    """Suffixes of ``data`` at ``starts``, compared to ``size`` bytes by common extension."""

    def __init__(self, data: np.ndarray, size: int = SIZE):
        self.data, self.size = data, size
        self.prefix = c.prefix_hashes(data)
        self.back = c.powers(c.UNBASE, len(self.prefix))

    def same(self, a: np.ndarray, b: np.ndarray, n) -> np.ndarray:
        return (self.prefix[a + n] - self.prefix[a]) * self.back[a] == (self.prefix[b + n] - self.prefix[b]) * self.back[b]

    def compare(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """-1, 0, 1: by the byte after the longest common extension, found by binary search."""
        out = np.zeros(len(a), np.int8)
        unlike = np.flatnonzero(~self.same(a, b, self.size))
        a, b = a[unlike], b[unlike]
        low, high = np.zeros(len(a), np.int64), np.full(len(a), self.size - 1, np.int64)
        while (low < high).any():
            mid = (low + high + 1) >> 1
            equal = self.same(a, b, mid)
            low, high = np.where(equal, mid, low), np.where(equal, high, mid - 1)
        out[unlike] = np.where(self.data[a + low] < self.data[b + low], -1, 1)
        return out

    def sort(self, starts: np.ndarray, lead: np.ndarray) -> np.ndarray:
        """``starts`` by ``lead``, and where that is equal in suffix order, by mergesort."""
        order = np.argsort(lead, kind="stable")
        starts, lead = starts[order], lead[order]
        head = np.flatnonzero(np.append(True, lead[1:] != lead[:-1]))
        sizes = np.diff(np.append(head, len(starts)))
        base = np.repeat(head, sizes)
        length = np.repeat(sizes, sizes)
        todo = np.flatnonzero(length > 1)
        width = 1
        while len(todo):
            inside = todo - base[todo]
            block = inside // width
            first = base[todo] + (block ^ 1) * width  # the sibling run
            last = np.minimum(first + width, base[todo] + length[todo])
            right = (block & 1) == 1
            low, high = np.minimum(first, last), last.copy()
            open_ = np.flatnonzero(low < high)
            while len(open_):
                mid = (low[open_] + high[open_]) >> 1
                sign = self.compare(starts[mid], starts[todo[open_]])
                less = (sign < 0) | ((sign == 0) & right[open_])
                low[open_] = np.where(less, mid + 1, low[open_])
                high[open_] = np.where(less, high[open_], mid)
                open_ = open_[low[open_] < high[open_]]
            place = base[todo] + (block & ~1) * width + (inside - block * width) + np.maximum(low - np.minimum(first, last), 0)
            moved = starts[todo]
            starts[place] = moved
            width *= 2
            todo = todo[length[todo] > width]
        return starts

    def classes(self, ordered: np.ndarray, lead: np.ndarray) -> np.ndarray | None:
        """A class number for each ordered suffix; neighbours are one class if their bytes agree.
        None if two hashes were equal by chance: the order is not to be trusted then."""
        new = np.ones(len(ordered), bool)
        near = np.flatnonzero((lead[1:] == lead[:-1]) & self.same(ordered[1:], ordered[:-1], self.size)) + 1 if len(ordered) > 1 else np.zeros(0, np.int64)
        reach = np.arange(self.size)
        for at in range(0, len(near), 20_000):
            i = near[at : at + 20_000]
            new[i] = (self.data[ordered[i][:, None] + reach] != self.data[ordered[i - 1][:, None] + reach]).any(1)
            if new[i].any():
                return None
        return np.cumsum(new) - 1


def _bitmap(pieces: DataFrame, n: int):
    """A broadcast bitmap of the pieces' low bits, made of the words that have bits: of bounded size,
    whatever their number. A piece that shares its bits with another one is sent in vain, no more."""
    bits = min(BITMAP_BITS, max(12, (BITS_A_PIECE * n).bit_length()))
    slot = f"(ah & {(1 << bits) - 1})"
    held = pieces.select(F.expr(f"shiftright({slot}, 6)").alias("w"), F.expr(f"shiftleft(1L, cast({slot} & 63 as int))").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    words = np.zeros(1 << (bits - 6), np.uint64)
    words[held.column("w").to_numpy()] = held.column("b").to_numpy().view(np.uint64)
    return words


def _pieces(texts: DataFrame, size: int) -> DataFrame:
    """(ah, n): the pieces of all segments, counted in each shard."""

    @c.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in c.shards(batches, "text"):
            piece, n = np.unique(segments(*c.text_bytes(batch.column("text")), size)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(n.astype(np.int32))], ["ah", "n"])

    return texts.select("text").mapInArrow(run, "ah long, n int")


class _Sender:
    """What one task sends: segments and windows that it meets for the first time, and the spans of
    those that stand earlier in the same task."""

    def __init__(self):
        self.first: dict[bytes, tuple] = {}
        self.sent: list[tuple] = []
        self.gone: list[list] = []

    def meet(self, route: int, place: tuple, at: int, raw: bytes) -> bool:
        """Whether the bytes were not met at this place or an earlier one; such ones are sent unless ``at`` is negative."""
        held = self.first.get(raw)
        if held is None or place < held:
            self.first[raw] = place
            if at >= 0:
                self.sent.append((route, *place, at, raw))
            return True
        if place > held:
            k, th, low = place
            last = self.gone[-1] if self.gone else None
            if last and last[0] == k and last[1] == th and last[2] <= low <= last[3]:
                last[3] = max(last[3], low + len(raw))
            else:
                self.gone.append([k, th, low, low + len(raw)])
        return False


def _dealt(texts: DataFrame, size: int, known, buckets: int) -> DataFrame:
    """Rows for the buckets: segments (windows of hot pieces) with their bytes; without bytes, spans
    (low, at) that are removed already."""
    schema = "bucket int, route long, k long, th long, low int, at int, raw binary"

    @c.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, hot = known.value
        sender = _Sender()
        for batch in c.shards(batches, "text"):
            data, bounds = c.text_bytes(batch.column("text"))
            rows, piece, low, high, at, prefix = segments(data, bounds, size)
            slot = piece & (len(bitmap) * 64 - 1)
            has = np.flatnonzero((bitmap[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1))
            rows, piece, low, high, at = (x[has] for x in (rows, piece, low, high, at))
            crowded = np.isin(piece, hot)
            k, th = (batch.column(x).to_numpy(zero_copy_only=False).astype(np.int64)[rows].tolist() for x in ("k", "th"))
            raw, base = data.tobytes(), bounds[rows]
            for a, b, own, key, text_hash, lo, hi, middle, by_window in zip((base + low).tolist(), (base + high + size).tolist(), piece.tolist(), k, th, low.tolist(), high.tolist(), at.tolist(), crowded.tolist()):
                if not by_window:
                    sender.meet(own, (key, text_hash, lo), middle, raw[a:b])
                elif hi == lo or sender.meet(own, (key, text_hash, lo), -1, raw[a:b]):
                    routes = c.mix(c.window_hashes(prefix, np.arange(a, a + hi - lo + 1), size)).view(np.int64).tolist()
                    for j, route in enumerate(routes):
                        sender.meet(route, (key, text_hash, lo + j), lo + j, raw[a + j : a + j + size])
            if len(sender.first) > HELD:
                sender.first = {}
            sent, gone, sender.sent, sender.gone = sender.sent, sender.gone, [], []
            route, key, text_hash, lo, middle, held = zip(*sent) if sent else ((),) * 6
            of, of_text, s, e = zip(*gone) if gone else ((),) * 4
            route = np.concatenate((np.array(route, np.int64), c.mix(np.array(of, np.int64).view(np.uint64)).view(np.int64)))
            numbers = [np.array(x + y, kind) for x, y, kind in ((key, of, np.int64), (text_hash, of_text, np.int64), (lo, s, np.int32), (middle, e, np.int32))]
            bucket = (c.mix(route.view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (bucket, route, *numbers)] + [pa.array([*held, *[None] * len(of)], pa.binary())], ["bucket", "route", "k", "th", "low", "at", "raw"])

    return texts.mapInArrow(run, schema)


def _runs(k: np.ndarray, th: np.ndarray, s: np.ndarray, e: np.ndarray) -> list[np.ndarray]:
    """Spans of each (k, th) as their maximal runs."""
    order = np.lexsort((s, th, k))
    k, th, s, e = k[order], th[order], s[order], e[order]
    if not len(k):
        return [k, th, s, e]
    doc = np.cumsum(np.append(False, (k[1:] != k[:-1]) | (th[1:] != th[:-1])))
    reach = np.maximum.accumulate(e + (doc << 32))
    at = np.flatnonzero(np.append(True, s[1:] + (doc[1:] << 32) > reach[:-1]))
    last = np.append(at[1:], len(s)) - 1
    return [k[at], th[at], s[at], reach[last] - (doc[last] << 32)]


def repeats(route: np.ndarray, k: np.ndarray, th: np.ndarray, low: np.ndarray, at: np.ndarray, raw: list[bytes], size: int = SIZE) -> list[np.ndarray]:
    """(k, th, s, e): spans of the windows that stand earlier, among all segments of some pieces."""
    order = np.lexsort((low, th, k, route))
    first: dict[tuple[int, bytes], int] = {}
    later, kinds = [], []
    for i, own in zip(order.tolist(), route[order].tolist()):
        j = first.setdefault((own, raw[i]), i)
        if j == i:
            kinds.append(i)
        elif (k[i], th[i], low[i]) != (k[j], th[j], low[j]):  # else a row that repeats key and text
            later.append(i)
    later, kinds = np.array(later, np.int64), np.array(kinds, np.int64)
    length = np.array([len(x) for x in raw], np.int64)
    out = [k[later], th[later], low[later], low[later] + length[later]]
    _, of, n = np.unique(route[kinds], return_inverse=True, return_counts=True)
    mixed = n[of] > 1
    kinds, of = kinds[mixed], of[mixed]
    if len(kinds):
        data = np.frombuffer(b"".join([raw[i] for i in kinds.tolist()]), np.uint8)
        room = length[kinds] - size + 1
        kind = np.repeat(np.arange(len(kinds)), room)
        step = np.arange(room.sum()) - np.repeat(np.cumsum(room) - room, room)
        starts = np.repeat(np.cumsum(length[kinds]) - length[kinds], room) + step
        place = low[kinds][kind] + step
        suffixes = Suffixes(data, size)
        # equal windows share piece, offset and hash: the others are left out of the sort
        lead = (of[kind] << 32) + (at[kinds][kind] - place + (1 << 20))
        hashes = c.window_hashes(suffixes.prefix, starts, size) ^ c.mix(lead.view(np.uint64))
        by = np.argsort(hashes, kind="stable")
        same = hashes[by][1:] == hashes[by][:-1]
        by = by[np.append(same, False) | np.append(False, same)]
        where = np.full(len(data), -1)
        where[starts[by]] = by
        ordered = suffixes.sort(starts[by], lead[by])
        entry = where[ordered]
        number = suffixes.classes(ordered, lead[entry])
        if number is None:  # a collision: sorted by the bytes themselves
            whole = data.tobytes()
            keys = {i: (int(lead[i]), whole[starts[i] : starts[i] + size]) for i in entry.tolist()}
            entry = np.array(sorted(entry.tolist(), key=keys.__getitem__), np.int64)
            number = np.cumsum([i > 0 and keys[x] != keys[y] for i, (x, y) in enumerate(zip(entry.tolist(), np.roll(entry, 1).tolist()))])
        of_k, of_th, p = k[kinds][kind[entry]], th[kinds][kind[entry]], place[entry]
        by = np.lexsort((p, of_th, of_k, number))
        again = by[np.append(False, number[by][1:] == number[by][:-1])] if len(by) else by
        out = [np.concatenate((x, y)) for x, y in zip(out, (of_k[again], of_th[again], p[again], p[again] + size))]
    return _runs(*out)


def repeated_spans(texts: DataFrame, folder: str, size: int = SIZE) -> DataFrame:
    """(k, th, s, e): byte spans of the windows that also start earlier, from (k, th, text).

    Two shuffles: of the pieces' counts, and of the bytes of the segments whose piece stands again.
    Both are aggregated in each task, so a piece or passage in a third of all documents sends a row
    a task (a shard, for the counts). A piece among many unlike texts, as that of a common short
    line, is hot: its windows are dealt each by its own hash, so no bucket gets them all."""
    spark = texts.sparkSession
    again = c.materialise(_pieces(texts, size).groupBy("ah").agg(F.sum("n").alias("n")).where("n > 1"), folder, "again")
    pieces, total = again.agg(F.count("*"), F.sum("n")).first()
    hot = HOT
    while again.where(F.col("n") > hot).count() > HOT_PIECES:
        hot *= 2
    crowded = again.where(F.col("n") > hot).select("ah").toArrow().column("ah").to_numpy()
    known = spark.sparkContext.broadcast((_bitmap(again, pieces), np.sort(crowded)))
    dealt = _dealt(texts, size, known, -(-(total or 1) // BUCKET_ROWS))

    def run(table: pa.Table) -> pa.Table:
        whole = table.filter(pa.compute.is_valid(table.column("raw")))
        done = table.filter(pa.compute.is_null(table.column("raw")))
        numbers = [whole.column(x).to_numpy().astype(np.int64) for x in ("route", "k", "th", "low", "at")]
        found = repeats(*numbers, whole.column("raw").to_pylist(), size)
        both = [np.concatenate((x, done.column(y).to_numpy().astype(np.int64))) for x, y in zip(found, ("k", "th", "low", "at"))]
        return pa.table([pa.array(x.astype(t)) for x, t in zip(both, (np.int64, np.int64, np.int32, np.int32))], ["k", "th", "s", "e"])

    return dealt.groupBy("bucket").applyInArrow(run, "k long, th long, s int, e int")


def _merged(spans: DataFrame) -> DataFrame:
    """The lists of spans, each as its maximal runs."""

    @c.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("spans")
            counts = lists.value_lengths().fill_null(0).to_numpy()
            flat = lists.flatten()
            s, e = (flat.field(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("s", "e"))
            rows = np.repeat(np.arange(batch.num_rows), counts)
            order = np.lexsort((s, rows))
            rows, s, e = rows[order], s[order] + (rows[order] << 32), e[order] + (rows[order] << 32)
            reach = np.maximum.accumulate(e) if len(e) else e
            new = np.append(True, s[1:] > reach[:-1]) if len(s) else np.zeros(0, bool)
            at = np.flatnonzero(new)
            low, high = s[at] & (2**32 - 1), reach[np.append(at[1:], len(s)) - 1] & (2**32 - 1) if len(s) else s
            edges = np.searchsorted(rows[at], np.arange(batch.num_rows + 1))
            pairs = pa.StructArray.from_arrays([pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))], ["s", "e"])
            yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("th"), pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pairs)], ["k", "th", "spans"])

    return spans.mapInArrow(run, "k long, th long, spans array<struct<s:int,e:int>>")


def remove_repeats(docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text", size: int = SIZE, digests: bool = False) -> DataFrame:
    """key, n_bytes, n_removed, n_spans, and kept (binary) or, with ``digests``, kept_sha256.

    Order is by key (null last), then by text hash for rows that share a key; rows that share
    key and text are one document, so they do not repeat each other, and get equal results.
    Null texts are empty; texts of fewer than ``size`` bytes have no window. All spans are
    judged on the input texts."""
    text_ = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    twice = docs.groupBy(F.col(f"`{key}`")).agg(F.count("*").alias("n")).where("n > 1").limit(1).count() > 0
    keyed = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(2**63 - 1)).alias("k"), (F.xxhash64(text_) if twice else F.lit(0)).cast("long").alias("th"), text_.alias("text"))
    spans = repeated_spans(keyed.select("k", "th", "text"), folder, size)
    own = c.materialise(_merged(spans.groupBy("k", "th").agg(F.collect_list(F.struct("s", "e")).alias("spans"))), folder, "spans")
    joined = keyed.join(own, ["k", "th"], "left").select(F.col("key").alias(key), "text", "spans")
    schema = T.StructType([joined.schema[0], *(T.StructField(x, T.LongType()) for x in ("n_bytes", "n_removed", "n_spans")), T.StructField("kept_sha256" if digests else "kept", T.StringType() if digests else T.BinaryType())])

    @c.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        for batch in c.shards(batches, "text"):
            data, bounds = c.text_bytes(batch.column("text"))
            lists = batch.column("spans")
            counts = lists.value_lengths().fill_null(0).to_numpy()
            flat = lists.flatten()
            base = np.repeat(bounds[:-1], counts)
            marks = np.zeros(len(data) + 1, np.int64)
            np.add.at(marks, flat.field("s").to_numpy(zero_copy_only=False) + base, 1)
            np.add.at(marks, flat.field("e").to_numpy(zero_copy_only=False) + base, -1)
            gone = np.cumsum(marks[:-1]) > 0
            starts, _ = c.runs(gone, bounds)
            removed = np.concatenate(([0], np.cumsum(gone)))
            n_spans = np.diff(np.searchsorted(starts, bounds))
            kept = []
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                left = data[a:b][~gone[a:b]].tobytes()
                kept.append(hashlib.sha256(left).hexdigest() if digests else left)
            made = [batch.column(0), pa.array(np.diff(bounds)), pa.array(np.diff(removed[bounds])), pa.array(n_spans.astype(np.int64)), pa.array(kept)]
            yield pa.RecordBatch.from_arrays([a.cast(t.type) for a, t in zip(made, target)], schema=target)

    return joined.mapInArrow(run, schema)
