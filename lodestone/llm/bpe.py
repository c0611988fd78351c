"""Byte-level BPE encoding and decoding.

Pre-tokenisation without regex: an array of code-point classes is refined with a two-character
look-ahead into symbols; the tokeniser is then a finite automaton, and because its transition
functions compose associatively, all texts of a shard are scanned together (functions of blocks
first, then a scan of the blocks, then the states inside the blocks). Boundaries follow from
(state, symbol). Slices go to a cached pair merging; their offsets are kept for decoding."""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as c

# classes of code points
LETTER, NUMBER, OTHER, SPACE = 0, 1, 2, 3
# symbols: classes with look-ahead
S_LETTER, S_NUMBER, S_OTHER, S_SHORT, S_LONG, S_BLANK, S_BREAK, S_RUN, S_END = range(9)
# states
FRESH, IN_LETTER, IN_NUMBER, IN_OTHER, IN_SPACE, AFTER_BLANK, ONE_MORE, TWO_MORE = range(8)
#: The white space of Unicode's White_Space property.
WHITE_SPACE = [0x9, 0xA, 0xB, 0xC, 0xD, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: What may follow an apostrophe in a contraction.
SHORT_ENDINGS, LONG_ENDINGS = ("s", "t", "m", "d"), ("re", "ve", "ll")
BLOCK = 64
END = 0x110000


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """next[state, symbol] and boundary-before[state, symbol]."""
    step, cut = np.zeros((8, 9), np.uint8), np.ones((8, 9), bool)
    plain = {S_LETTER: (IN_LETTER, {IN_LETTER, AFTER_BLANK}), S_NUMBER: (IN_NUMBER, {IN_NUMBER, AFTER_BLANK}), S_OTHER: (IN_OTHER, {IN_OTHER, AFTER_BLANK}), S_BLANK: (AFTER_BLANK, set()), S_BREAK: (IN_SPACE, set()), S_RUN: (IN_SPACE, {IN_SPACE}), S_END: (FRESH, set())}
    for state in range(8):
        for symbol in range(9):
            if symbol == S_END:
                step[state, symbol] = FRESH
            elif state in (ONE_MORE, TWO_MORE):
                step[state, symbol], cut[state, symbol] = (FRESH, ONE_MORE)[state == TWO_MORE], False
            elif symbol in (S_SHORT, S_LONG):
                inside = state in (IN_OTHER, AFTER_BLANK)
                step[state, symbol] = IN_OTHER if inside else (ONE_MORE if symbol == S_SHORT else TWO_MORE)
                cut[state, symbol] = not inside
            else:
                step[state, symbol], joined = plain[symbol]
                cut[state, symbol] = state not in joined
    return step, cut


STEP, CUT = _automaton()
_classes: list[np.ndarray] = []


def classes() -> np.ndarray:
    """The class of every code point (and SPACE for END)."""
    if not _classes:
        kind = {"L": LETTER, "N": NUMBER}
        table = np.fromiter((kind.get(unicodedata.category(chr(i))[0], OTHER) for i in range(END)), np.uint8, END)
        table[WHITE_SPACE] = SPACE
        _classes.append(np.append(table, np.uint8(SPACE)))
    return _classes[0]


def symbols(points: np.ndarray) -> np.ndarray:
    kind = classes()[points]
    out = kind.copy()
    after = np.append(points[1:], END)
    after2 = np.append(points[2:], [END, END])[: len(points)]
    ends = points == END
    space = (kind == SPACE) & ~ends
    last = space & (np.append(kind[1:], SPACE) != SPACE)
    out[space] = S_RUN
    out[last] = S_BREAK
    out[last & (points == 0x20)] = S_BLANK
    at = np.flatnonzero(points == 0x27)
    out[at[np.isin(after[at], [ord(x) for x in SHORT_ENDINGS])]] = S_SHORT
    for x in LONG_ENDINGS:
        out[at[(after[at] == ord(x[0])) & (after2[at] == ord(x[1]))]] = S_LONG
    out[ends] = S_END
    return out


_FOLLOW = STEP.T.tobytes().ljust(256, b"\0")  # [symbol * 8 + state]


def _follow(at: np.ndarray) -> np.ndarray:
    return np.frombuffer(at.tobytes().translate(_FOLLOW), np.uint8).reshape(at.shape)


def states_before(symbol: np.ndarray) -> np.ndarray:
    """The automaton's state before each symbol, by an associative scan of transition functions."""
    n = len(symbol)
    rows = max(1, -(-n // BLOCK))
    padded = np.full(rows * BLOCK, S_END, np.uint8)
    padded[:n] = symbol
    grid = np.ascontiguousarray(padded.reshape(rows, BLOCK).T)
    grid <<= 3
    function = np.broadcast_to(np.arange(8, dtype=np.uint8)[:, None], (8, rows))
    for j in range(BLOCK):
        function = _follow(grid[j] | function)
    function = np.ascontiguousarray(function.T)
    reach = 1  # inclusive scan: function r becomes the composition of 0..r
    scan = function
    while reach < rows:
        joined = scan.copy()
        joined[reach:] = np.take_along_axis(scan[reach:], scan[:-reach], 1)
        scan, reach = joined, reach * 2
    state = np.concatenate(([FRESH], scan[:-1, FRESH])).astype(np.uint8)
    out = np.empty((BLOCK, rows), np.uint8)
    for j in range(BLOCK):
        out[j] = state
        state = _follow(grid[j] | state)
    return np.ascontiguousarray(out.T).ravel()[:n]


def boundaries(points: np.ndarray) -> np.ndarray:
    """Where tokens begin; END code points, which part texts, begin one of their own."""
    symbol = symbols(points)
    return np.flatnonzero(CUT[states_before(symbol), symbol])


class Merger(dict):
    """Piece (str) -> its ids in decimal form and the bytes that they decode to; misses are merged and kept, up to ``most`` pieces of bounded length."""

    def __init__(self, ranks: dict[bytes, int], most: int = 200_000):
        super().__init__()
        self.ranks, self.most = ranks, most
        self.spelt = [b""] * (max(ranks.values(), default=-1) + 1)
        for raw, i in ranks.items():
            self.spelt[i] = raw

    def __missing__(self, piece: str) -> tuple[str, bytes]:
        ids = self.merge(piece.encode())
        held = " ".join(map(str, ids)), self.decode(ids)
        if len(piece) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[piece] = held
        return held

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.spelt.__getitem__, ids))

    def _merge_short(self, parts: list[bytes]) -> list[int]:
        ranks, none = self.ranks.get, len(self.ranks) + len(self.spelt)
        costs = [ranks(a + b, none) for a, b in zip(parts, parts[1:])]
        while costs and (least := min(costs)) != none:
            i = costs.index(least)
            parts[i] += parts.pop(i + 1)
            del costs[i]
            if i < len(costs):
                costs[i] = ranks(parts[i] + parts[i + 1], none)
            if i:
                costs[i - 1] = ranks(parts[i - 1] + parts[i], none)
        return [self.ranks[x] for x in parts]

    def merge(self, raw: bytes) -> list[int]:
        """Merges the pair of least rank, leftmost first, until none is left: n log n with a heap."""
        ranks = self.ranks
        if raw in ranks:
            return [ranks[raw]]
        n = len(raw)
        if n <= 24:
            return self._merge_short([raw[i : i + 1] for i in range(n)])
        right, left, end = [*range(1, n + 1)], [*range(-1, n - 1)], [*range(1, n + 1)]
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(raw[i : i + 2])) is not None]
        heapq.heapify(heap)
        alive = bytearray(b"\1") * n
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = right[i] if alive[i] else n
            if j >= n or end[j] != stop or not alive[i]:
                continue
            alive[j] = 0
            end[i] = stop
            right[i] = k = right[j]
            if k < n:
                left[k] = i
                if (r := ranks.get(raw[i : end[k]])) is not None:
                    heapq.heappush(heap, (r, i, end[k]))
            if (h := left[i]) >= 0 and (r := ranks.get(raw[h:stop])) is not None:
                heapq.heappush(heap, (r, h, stop))
        return [ranks[raw[i : end[i]]] for i in range(n) if alive[i]]


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


_models: dict[str, Merger] = {}


def model(path: str) -> Merger:
    """The merger of a rank file, kept by each worker."""
    if path not in _models:
        _models[path] = Merger(load_ranks(path))
    return _models[path]


def pieces(texts: list[str]) -> Iterator[tuple[list[str], np.ndarray]]:
    """For each text its pieces in order and their offsets (code points; one more at the end)."""
    joined = np.frombuffer("\0".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes + 1) - 1
    joined = np.append(joined, np.uint32(END))
    joined[ends] = END
    cuts = boundaries(joined)
    edges = np.searchsorted(cuts, ends)
    at = 0
    for text, size, end, to in zip(texts, sizes.tolist(), ends.tolist(), edges.tolist()):
        offsets = np.append(cuts[at:to] - (end - size), size)
        o = offsets.tolist()
        yield [text[a:b] for a, b in zip(o, o[1:])], offsets
        at = to + 1


def encode(texts: list[str], path: str) -> Iterator[tuple[list[int], list[str], np.ndarray]]:
    """For each text: ids, its pieces, and their offsets."""
    merger = model(path)
    for own, offsets in pieces(texts):
        yield [*map(int, " ".join([merger[piece][0] for piece in own]).split())], own, offsets


def decode(ids: list[int], path: str) -> bytes:
    return model(path).decode(ids)


def encoded(docs: DataFrame, path: str, text: str = "text", digests: bool = False, keep_text: bool = True) -> DataFrame:
    """``docs`` with n_tokens and, by default, token_ids and piece_offsets (code points), or with
    ``digests`` ids_sha256 and decoded_sha256 of the ids and of the bytes decoded from them.

    ``path`` names the rank file, which every executor must have. Null texts are empty: no
    tokens. Rows are independent; texts of any length are encoded whole. Columns of ``docs``
    with the name of an added column are replaced."""
    added = ["n_tokens", *(["ids_sha256", "decoded_sha256"] if digests else ["token_ids", "piece_offsets"])]
    docs = c.without(docs, added)
    keep = [k for k in docs.columns if keep_text or k != text]
    schema = docs.select(*[F.col(f"`{k}`") for k in keep]).schema
    from pyspark.sql import types as T

    schema = schema.add("n_tokens", T.LongType())
    for name in added[1:]:
        schema = schema.add(name, T.StringType() if digests else T.ArrayType(T.IntegerType()))

    @c.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        merger = Merger(load_ranks(path))
        for batch in c.shards(batches, text):
            texts = batch.column(text).cast(pa.large_string()).fill_null("").to_pylist()
            count, first, second = [], [], []
            for own, offsets in pieces(texts):
                held = [merger[piece] for piece in own]
                written = " ".join([x[0] for x in held])
                count.append(written.count(" ") + 1 if written else 0)
                if digests:
                    first.append(hashlib.sha256(written.encode()).hexdigest())
                    second.append(hashlib.sha256(b"".join([x[1] for x in held])).hexdigest())
                else:
                    first.append([*map(int, written.split())])
                    second.append(offsets.tolist())
            made = [pa.array(count, pa.int64()), *([pa.array(first, pa.string()), pa.array(second, pa.string())] if digests else [pa.array(x, pa.list_(pa.int32())) for x in (first, second)])]
            yield pa.RecordBatch.from_arrays([a.cast(t.type) for a, t in zip([*(batch.column(k) for k in keep), *made], target)], schema=target)

    return docs.mapInArrow(run, schema)
