"""Language identification, words first: known words score by their log frequency in each
language, unseen words by progressively shorter character n-grams."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as c

#: Different labelled texts that the model is fitted on at most, as many of each language.
FIT_ROWS = 2500
LONGEST_GRAM = 5
#: Words whose scores a task remembers.
HELD_WORDS = 100_000
_WORD = regex.compile(r"\p{L}+")  # the Unicode letters; numerals such as ½, ² or Ⅷ are none
#: UTF-8 bytes with blanks for the ASCII ones that are no letters.
_BLANKED = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256))
#: Words that are scored at a time.
_AT_ONCE = 8192


def words_of(text: str) -> list[str]:
    """The runs of letters, in lower case. Where all beyond ASCII is letters, blanks part them."""
    lowered = text.lower()
    parts = lowered.encode().translate(_BLANKED).decode().split()
    return parts if not parts or "".join(parts).isalpha() else _WORD.findall(lowered)


class Model:
    """Per-language word and n-gram log10 frequencies from labelled texts. A word or n-gram that
    stands once in all of them is no evidence: such words are scored as unseen ones."""

    def __init__(self, rows: list[tuple[str, str]], longest: int = LONGEST_GRAM):
        self.labels = sorted({lang for lang, _ in rows})
        self.longest = longest
        of = {lang: i for i, lang in enumerate(self.labels)}
        n = len(self.labels)
        words: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(n))
        for lang, text in rows:
            for word, k in Counter(words_of(text)).items():
                words[word][of[lang]] += k
        total = np.maximum(sum(words.values(), np.zeros(n)), 1)
        known = len(words) + 1
        grams: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(n))
        for word, k in words.items():
            marked = f"^{word}$"
            for size in range(1, longest + 1):
                for i in range(len(marked) - size + 1):
                    grams[marked[i : i + size]] += np.sqrt(k)
        sums = np.ones((longest + 1, n))
        for g, k in grams.items():
            sums[len(g)] += k
        #: word or n-gram -> row of ``rows``: its score in each language
        self.words, self.grams = ({x: i for i, x in enumerate(x for x, k in table.items() if k.sum() > 1)} for table in (words, grams))
        self.word_rows = np.array([np.log10((words[w] + 0.5) / (total + 0.5 * known)) for w in self.words], np.float32).reshape(-1, max(1, n))
        self.gram_rows = np.array([np.log10((grams[g] + 0.5) / (sums[len(g)] + 0.5 * known)) for g in self.grams], np.float32).reshape(-1, max(1, n))
        self.floor = np.full(n, -math.log10(2 * known + float(np.max(total, initial=1.0))), np.float32)

    def unseen(self, words: list[str]) -> np.ndarray:
        """A row a word: the mean over positions of the longest n-gram known there, else the next shorter."""
        known, longest = self.grams.get, self.longest
        held, counts, lengths = [], [], []
        for word in words:
            marked, before = f"^{word}$", len(held)
            end = len(marked)
            for at in range(end):
                for to in range(min(at + longest, end), at, -1):
                    row = known(marked[at:to])
                    if row is not None:
                        held.append(row)
                        break
            counts.append(len(held) - before)
            lengths.append(end)
        some = np.flatnonzero(counts)
        sums = np.zeros((len(words), len(self.labels)), np.float32)
        if len(some):
            starts = np.cumsum([0, *counts[:-1]])[some]
            sums[some] = np.add.reduceat(self.gram_rows[held], starts, axis=0)
        length = np.array(lengths, np.float32)[:, None]
        return (sums + self.floor * (length - np.array(counts, np.float32)[:, None])) / length


class Table(dict):
    """word -> row of ``rows``: its score in each language, and whether it is known. Words are scored
    once, many at a time, and kept; beyond ``most`` the table begins anew."""

    def __init__(self, model: Model, most: int = HELD_WORDS):
        super().__init__()
        self.model, self.most = model, most
        self.rows = np.zeros((1024, len(model.labels) + 1))

    def meet(self, words: set[str]) -> None:
        """Scores those of the words that the table does not hold."""
        new = [w for w in words if w not in self]
        if self and len(self) + len(new) > self.most:
            self.clear()
            new = list(words)
        start, known = len(self), self.model.words.get
        if start + len(new) > len(self.rows):
            self.rows = np.concatenate((self.rows[:start], np.zeros((max(start, len(new)) + 1024, self.rows.shape[1]))))
        for low in range(0, len(new), _AT_ONCE):
            part = new[low : low + _AT_ONCE]
            at = [known(w, -1) for w in part]
            own = self.rows[start + low : start + low + len(part)]
            own[:, -1] = met = np.array(at) >= 0
            own[met, :-1] = self.model.word_rows[[i for i in at if i >= 0]]
            own[~met, :-1] = self.model.unseen([w for w, i in zip(part, at) if i < 0])
            self.update(zip(part, range(start + low, start + low + len(part))))


def predict(table: Table, texts: list[str]) -> tuple[list[str], list[float], list[float]]:
    """Labels, their shares of the likelihood, and the shares of words that are known in any language."""
    labels, scores, known = [], [], []
    each = [words_of(text) for text in texts]
    if table.model.labels:
        table.meet(set().union(*each))
    for found in each:
        if not found or not table.model.labels:
            labels.append("und")
            scores.append(0.0)
            known.append(0.0)
            continue
        places = np.fromiter(map(table.__getitem__, found), np.int64, len(found))
        sums = table.rows[places].sum(0)
        likely = sums[:-1]
        best = int(likely.argmax())
        labels.append(table.model.labels[best])
        scores.append(float(1 / np.power(10.0, np.maximum(likely - likely[best], -300)).sum()))
        known.append(float(sums[-1] / len(found)))
    return labels, scores, known


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", rows: int = FIT_ROWS) -> Model:
    """A model of at most ``rows`` different labelled texts, as many of each language, those of least hash.

    Null labels are left out. Rows that repeat a text in one language count once, so copies crowd out
    nothing, and a rare language is learned from what there is. With more than ``rows`` languages
    those of most texts are learned. The same rows come back each time, whatever their order. Without
    labelled rows the model has no label and every prediction is ``und``."""
    known = labelled.where(F.col(f"`{lang}`").isNotNull()).select(F.col(f"`{lang}`").cast("string").alias("lang"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    known = known.withColumn("h", F.xxhash64("text"))
    different = known.groupBy("lang", "h").agg(F.lit(1).alias("one")).drop("one")
    sizes = different.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(rows).collect()  # at most ``rows`` languages
    if not sizes:
        return Model([])
    each = max(1, rows // len(sizes))
    # of uniform hashes the least ``each`` lie below a share that leaves few others for the ranking
    bounds = [(r["lang"], int(min(1.0, (each + 6 * each**0.5 + 10) / r["count"]) * 2**31)) for r in sizes]
    shares = labelled.sparkSession.createDataFrame(bounds, "lang string, below long")
    place = F.pmod("h", F.lit(2**31))
    few = different.join(F.broadcast(shares), "lang").where(place < F.col("below"))
    chosen = few.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy(place, "h"))).where(F.col("n") <= each).select("lang", "h")
    found = known.join(F.broadcast(chosen), ["lang", "h"], "left_semi").groupBy("lang", "h").agg(F.min("text").alias("text")).orderBy("lang", "h")
    return Model([(r["lang"], r["text"]) for r in found.toLocalIterator()])


def predictor(model: Model, spark) -> Callable[[Column], Column]:
    """Column of texts -> struct of lang_pred, score and known. Only the texts go to Python."""
    held = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred:string,score:double,known:double>")
    @c.released
    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = Table(held.value)
        for texts in batches:
            parts = [predict(table, part.cast(pa.large_string()).fill_null("").to_pylist()) for part in c.slices(texts)]
            made = [pa.array([x for part in parts for x in part[i]], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.float64()))]
            yield pa.StructArray.from_arrays(made, ["lang_pred", "score", "known"])

    return predicted


def languages(docs: DataFrame, model: Model, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with lang_pred, score (the label's share of the likelihood, 0 to 1, which nears 1 as a
    text gets longer) and known (the share of its words that the model has met, which does not).

    Texts that are null or have no letter get ``und``, 0 and 0. Ties go to the label that sorts
    first. Rows are independent. Columns with the names of added ones are replaced."""
    added = ["lang_pred", "score", "known"]
    docs = c.without(docs, added)
    keep = [F.col(f"`{k}`") for k in docs.columns if keep_text or k != text]
    found = docs.select(*keep, predictor(model, docs.sparkSession)(F.col(f"`{text}`").cast("string")).alias("lang_pred"))
    return found.select(*[F.col(f"`{k}`") for k in found.columns[:-1]], *[F.col("lang_pred")[x].alias(x) for x in added])


def recognised(docs: DataFrame, model: Model, text: str = "text", least: float = 0.1) -> DataFrame:
    """The rows of ``docs`` whose text is in a learned language, with their columns as they were:
    texts without a letter go, and those of whose words fewer than the share ``least`` are known."""
    found = predictor(model, docs.sparkSession)(F.col(f"`{text}`").cast("string"))
    return docs.where((found["lang_pred"] != "und") & (found["known"] >= least))
