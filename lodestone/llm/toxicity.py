"""Toxicity by compression distance: one zstandard dictionary from toxic text and one from
ordinary text; each window (a word between blanks) is compressed with both, and its distance is
the share of its length that the toxic dictionary saves over the ordinary one.

A match costs zstandard three to four bytes, as much as a short word. So windows and
dictionaries are written with every byte tripled, which makes the saving outweigh that cost.
Thresholds on the distances are calibrated by a logistic fit on texts that the dictionaries
have not seen."""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as c

#: Labelled rows of each class that the model is fitted on at most.
FIT_ROWS = 1500
#: A word belongs to the toxic dictionary from so many different neighbourhoods and so many
#: times its frequency in ordinary text; copies of a text share neighbourhoods.
CONTEXTS, RATIO = 8, 12
COMMON_WORDS = 8000
DISTANCES = (0.35, 0.45)
_WORD = re.compile(r"[^\W\d_]+")
_WINDOW_CHARS = 64


def windows(text: str) -> list[str]:
    """Words; a longer run of letters is cut into windows of 64, all of them scored."""
    found = _WORD.findall(text.lower())
    if any(len(w) > _WINDOW_CHARS for w in found):
        found = [w[i : i + _WINDOW_CHARS] for w in found for i in range(0, len(w), _WINDOW_CHARS)]
    return found


def _wide(text: str) -> bytes:
    return np.repeat(np.frombuffer(text.encode(), np.uint8), 3).tobytes()


def _contexts(texts: list[str]) -> tuple[dict[str, int], int]:
    seen: dict[str, set] = defaultdict(set)
    for text in texts:
        own = windows(text)
        for before, word, after in zip(["", *own], own, [*own[1:], ""]):
            seen[word].add((before, after))
    return {w: len(s) for w, s in seen.items()}, sum(map(len, seen.values())) or 1


class Model:
    """Two dictionaries and the calibration. Without texts of both classes it always gives 0."""

    def __init__(self, toxic: list[str], ordinary: list[str]):
        fit_t, fit_o = toxic[::3] + toxic[1::3], ordinary[::3] + ordinary[1::3]
        (tc, tn), (oc, on) = _contexts(fit_t), _contexts(fit_o)
        marked = [w for w, k in tc.items() if k >= min(CONTEXTS, max(2, len(fit_t) // 8)) and (k + 0.5) / tn > RATIO * (oc.get(w, 0) + 0.5) / on]
        marked.sort(key=lambda w: (tc[w], w))
        taken = set(marked)
        ranked = [w for w in sorted(oc, key=lambda w: (-oc[w], w)) if w not in taken]
        common, rest, size = ranked[:COMMON_WORDS][::-1], [], sum(len(w) + 1 for w in marked)
        for w in ranked[COMMON_WORDS:]:
            if size <= 0:
                break
            rest.append(w)
            size -= len(w) + 1
        #: contents of the dictionaries: the same common words, then those of the class
        self.toxic, self.ordinary = (_wide(" " + " ".join(x) + " ") for x in (common + marked, common + rest))
        self.usable = bool(marked and fit_o)
        self.weights = np.zeros(len(DISTANCES) + 3)
        self.weights[0] = -20.0
        if self.usable:
            table = Distances(self)
            rows = [(1.0, t) for t in toxic[2::3] or toxic] + [(0.0, t) for t in ordinary[2::3] or ordinary]
            x = np.array([table.features(t) for _, t in rows])
            self.weights = _logistic(x, np.array([y for y, _ in rows]))


def _logistic(x: np.ndarray, y: np.ndarray, turns: int = 40, ridge: float = 0.05) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(turns):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - ridge * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w + np.linalg.solve(bend, slope)
    return w


class Distances(dict):
    """Window -> distance; each different window is compressed once and kept, up to ``most``."""

    def __init__(self, model: Model, most: int = 200_000):
        super().__init__()
        self.model, self.most = model, most
        shape = zstandard.ZstdCompressionParameters(window_log=20, hash_log=18, chain_log=19, search_log=8, min_match=6, target_length=128, strategy=zstandard.STRATEGY_BTOPT, write_content_size=0, write_dict_id=0, write_checksum=0)
        self.by = [zstandard.ZstdCompressor(compression_params=shape, dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for d in (model.ordinary, model.toxic)]

    def __missing__(self, word: str) -> float:
        raw = _wide(f" {word} ")
        ordinary, toxic = (len(x.compress(raw)) for x in self.by)
        if len(self) >= self.most:
            self.clear()
        self[word] = found = (ordinary - toxic) / len(raw)
        return found

    def features(self, text: str) -> list[float]:
        own = windows(text)
        far = np.fromiter(map(self.__getitem__, own), np.float64, len(own))
        return [1.0, *(math.log1p(int((far >= d).sum())) for d in DISTANCES), float(far.max()) if own else 0.0, math.log1p(len(own)) / 10]

    def score(self, text: str) -> float:
        if not self.model.usable:
            return 0.0
        z = float(np.dot(self.features(text), self.model.weights))
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = FIT_ROWS) -> Model:
    """A model of at most ``rows`` labelled documents of each class, those of least key hash.

    Null labels and null keys are left out; the chosen keys (bounded) are broadcast. Of rows that
    repeat a key the least text is taken; a key labelled both ways counts as toxic. The same rows
    come back each time, whatever their order."""
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.max(F.col(label).cast("int")).alias("y"))
    texts = {}
    for y in (1, 0):
        chosen = known.where(F.col("y") == y).select("k").orderBy(F.xxhash64("k"), "k").limit(rows)
        found = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t")).join(F.broadcast(chosen), "k", "left_semi").groupBy("k").agg(F.min("t").alias("t"))
        texts[y] = sorted((r["t"] for r in found.select("t").toLocalIterator()), key=lambda t: (hash_of(t), t))
    return Model(texts[1], texts[0])


def hash_of(text: str) -> int:
    import zlib

    return zlib.crc32(text.encode())


def scored(docs: DataFrame, model: Model, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with score, the calibrated probability that the text is toxic.

    All windows of a text count. Null and empty texts have no window and get the score of a
    text without toxic windows. Rows are independent. A column named score is replaced."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    docs = c.without(docs, ["score"])
    keep = [k for k in docs.columns if keep_text or k != text]
    schema = docs.select(*[F.col(f"`{k}`") for k in keep]).schema.add("score", T.DoubleType())

    @c.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        table = Distances(held.value)
        for batch in c.shards(batches, text):
            texts = batch.column(text).cast(pa.large_string()).fill_null("").to_pylist()
            made = pa.array([table.score(t) for t in texts], pa.float64())
            yield pa.RecordBatch.from_arrays([a.cast(t.type) for a, t in zip([*(batch.column(k) for k in keep), made], target)], schema=target)

    return docs.mapInArrow(run, schema)
