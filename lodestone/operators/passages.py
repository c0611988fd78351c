"""Source blocks: passages that can be cited, and windows of blocks within a budget."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions import text as tx
from lodestone.sources import shared

#: Code points in a passage at most, and up to which sentences are put together.
LONGEST, TARGET = 1200, 700
# Fixed value: where a sentence ends.
_SENTENCE = re.compile(r"(?<=[.!?])\s+(?=[\[('“\"A-Z0-9])")


#: The whole rest, or as much as fits up to a blank in its second half, or as much as fits.
_PIECE = re.compile(rf"(?s)\s*(\S.{{0,{LONGEST - 1}}}\s*\Z|\S.{{{LONGEST // 2 - 1},{LONGEST - 1}}}(?=\x20)|\S.{{0,{LONGEST - 1}}})")
_TRIMMED = re.compile(r"(?s)\S(?:.*\S)?")


def bounded(text: str) -> list[str]:
    """The text in pieces of at most LONGEST, cut at the last blank of their second half or else anywhere."""
    return [piece.strip() for piece in _PIECE.findall(text.strip())]


def prose(text: str) -> list[str]:
    """Neighbouring sentences in passages of about TARGET; a longer sentence is bounded.

    Sentences are trimmed spans, so a passage's length is its last end less its first start: a fold
    over the spans either moves the last passage's end or begins another."""
    starts = [0, *(m.end() for m in _SENTENCE.finditer(text))]
    spans = [m.span() for a, b in zip(starts, [*starts[1:], len(text)]) if (m := _TRIMMED.search(text, a, b))]

    def grown(out: list[tuple[int, int]], span: tuple[int, int]) -> list[tuple[int, int]]:
        if out and span[1] - out[-1][0] <= TARGET:
            out[-1] = (out[-1][0], span[1])
        else:
            out.append(span)
        return out

    return [piece for a, b in reduce(grown, spans, []) for piece in bounded(text[a:b])]


def passages_of(text: str | None, kind: str | None) -> list[str]:
    """Rows of a table, or passages of prose."""
    if "table" in (kind or "").casefold():
        return [x for line in (text or "").splitlines() for x in bounded(line)]
    return prose(text or "")


def passages(text: Column, kind: Column) -> Column:
    """Array of a block's passages; null and empty texts have none."""

    @F.arrow_udf("array<string>")
    def cut(texts: pa.Array, kinds: pa.Array) -> pa.Array:
        return pa.array([passages_of(t, k) for t, k in zip(texts.to_pylist(), kinds.to_pylist())], pa.list_(pa.string()))

    return cut(text, kind)


def number_passages(blocks: DataFrame, by: list[str], order: str, block_id: str = "block_id", text: str = "text", kind: str = "kind") -> DataFrame:
    """(by, span_id, block_id, text): the passages of each group numbered from 1 in the order of blocks."""
    found = blocks.select(*by, order, block_id, F.posexplode(passages(F.col(text), F.col(kind))).alias("_p", "text"))
    w = Window.partitionBy(*by).orderBy(order, block_id, "_p")
    return found.select(*by, F.row_number().over(w).cast("long").alias("span_id"), block_id, "text")


def catalog_digest(spans: DataFrame, by: list[str]) -> DataFrame:
    """(by, digest): SHA-256 of each group's numbered passages as canonical JSON. A group's passages are
    one array in memory, as they are in a request."""

    def digest(rows: pd.Series) -> str:
        made = [{"block_id": r["block_id"], "span_id": int(r["span_id"]), "text": r["text"]} for r in rows]
        return hashlib.sha256(json.dumps(made, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()

    @F.pandas_udf("string")
    def digests(lists: pd.Series) -> pd.Series:
        return lists.map(digest)

    rows = F.array_sort(F.collect_list(F.struct("span_id", "block_id", "text")))
    return spans.groupBy(*by).agg(rows.alias("_rows")).select(*by, digests("_rows").alias("digest"))


def evidence_blocks(blocks: DataFrame, flag: Column) -> DataFrame:
    """The blocks that are not marked as withheld (``flag`` false; unknown is kept)."""
    return blocks.where(F.coalesce(flag, F.lit(True)))


def drop_repeated_supplement(blocks: DataFrame, by: list[str], source: str, text: str, block_id: str, page: str, order: str, main: str = "main", least: int = 40) -> DataFrame:
    """``blocks`` less those of other sources whose whole text of more than ``least`` characters stands in
    the main source too; with duplicate_locations: where the text of a main block was left out.

    Of several main blocks with one text the last is the kept one's record. Joined by a hash of the text."""
    keyed = blocks.withColumn("_k", tx.block_key(F.col(text))).withColumn("_h", F.sha2("_k", 256)).withColumn("_long", F.length("_k") > least)
    own = keyed.where((F.col(source) == main) & F.col("_long")).groupBy(*by, "_h").agg(F.max_by(block_id, order).alias("_keeper"))
    joined = keyed.join(own, [*by, "_h"], "left")
    gone = F.col("_keeper").isNotNull() & (F.col(source) != main) & F.col("_long")
    places = joined.where(gone).groupBy(*by, F.col("_keeper").alias(block_id)).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("order"), F.col(source).alias("source"), F.col(page).alias("page"), F.col(block_id).alias("block_id")))).alias("duplicate_locations"))
    kept = joined.where(~F.coalesce(gone, F.lit(False))).drop("_k", "_h", "_long", "_keeper")
    return kept.join(places, [*by, block_id], "left")


# ------------------------------------------------------------------ windows
def _sections(rows: list[dict]) -> list[list[dict]]:
    return [list(own) for _, own in groupby(rows, key=lambda r: r["section"])]


def _units(section: list[dict], budget: int) -> list[list[dict]]:
    """Whole pages of a section that is too long; blocks of a page that is too long."""
    pages = [list(own) for _, own in groupby(section, key=lambda r: r["page"])]
    return [unit for page in pages for unit in ([page] if _size(page) <= budget else [[r] for r in page])]


def _size(rows: list[dict]) -> int:
    return sum(r["size"] for r in rows)


def packed(rows: list[dict], budget: int) -> list[list[dict]]:
    """Windows of whole sections in order, as full as the budget allows; a section that does not fit is
    begun anew and cut into pages, then blocks. A single block beyond the budget is alone."""
    out: list[list[dict]] = []
    held: list[dict] = []

    def close() -> None:
        if held:
            out.append(held.copy())
            held.clear()

    for section in _sections(rows):
        whole = _size(section) <= budget
        if not whole:
            close()
        for unit in [section] if whole else _units(section, budget):
            if held and _size(held) + _size(unit) > budget:
                close()
            held.extend(unit)
            if _size(unit) > budget:
                close()
    close()
    return out


def plan_windows(blocks: DataFrame, by: list[str], order: str, source: str = "source", section: str = "section", page: str = "page", size: str = "size", block_id: str = "block_id", budget: int = 60_000, main: str = "main", context_budget: int = 20_000) -> DataFrame:
    """(by, source, window, window_id, block_id, position): each block in one window of its source.

    If the main source is small enough, windows of other sources leave room for it (has_context).
    One group, a document's blocks without their texts, is planned in one task."""
    if budget <= 0 or not 0 <= context_budget < budget:
        raise ValueError("budget must be positive, and the context's less than that")
    slim = blocks.select(*by, F.col(order).alias("order"), F.col(source).alias("source"), F.coalesce(F.col(section).cast("string"), F.concat(F.lit("page:"), F.col(page).cast("string"))).alias("section"), F.col(page).cast("long").alias("page"), F.col(size).cast("long").alias("size"), F.col(block_id).alias("block_id"))
    schema = slim.select(*by, "source", "block_id").schema.add("window", "long").add("window_id", "string").add("position", "long").add("has_context", "boolean")

    def plan(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("order", kind="stable")
        if frame["block_id"].duplicated().any():
            raise ValueError(f"block ids repeat: {sorted(frame['block_id'][frame['block_id'].duplicated()].unique())}")
        context = int(frame.loc[frame["source"] == main, "size"].sum())
        context = context if context <= context_budget else 0
        out = []
        for name in frame["source"].drop_duplicates():
            own = frame[frame["source"] == name].to_dict("records")
            extra = context if name != main else 0
            for i, rows in enumerate(packed(own, budget - extra), 1):
                fits = name != main and extra > 0 and _size(rows) + extra <= budget
                out += [{**{k: r[k] for k in by}, "source": name, "block_id": r["block_id"], "window": i, "window_id": f"{name}-{i:04d}", "position": p, "has_context": fits} for p, r in enumerate(rows, 1)]
        return pd.DataFrame(out, columns=schema.names)

    return shared.spread(slim, *by).groupBy(*by).applyInPandas(plan, schema)


def halved(window_id: str, sizes: list[int], context: int, limit: int, estimate: Callable[[int], int]) -> Iterator[tuple[str, int, int, bool]]:
    """(id, first, last + 1, with context) of the parts of a window whose estimates fit: first the
    context goes, then halves are taken until they fit. A single block that does not fit is an error."""
    pending = [(window_id, 0, len(sizes), context > 0)]
    while pending:
        name, a, b, with_context = pending.pop()
        own = sum(sizes[a:b])
        if with_context and estimate(own + context) > limit:
            with_context = False
        if estimate(own + (context if with_context else 0)) <= limit:
            yield name, a, b, with_context
        elif b - a == 1:
            raise ValueError(f"a block of {own} in {name} is beyond the limit of {limit}")
        else:
            middle = a + (b - a) // 2
            pending += [(f"{name}-b", middle, b, with_context), (f"{name}-a", a, middle, with_context)]


def fit_windows(windows: DataFrame, by: list[str], limit: int, overhead: int = 64, bytes_a_token: int = 3) -> DataFrame:
    """``plan_windows``'s rows with size (bytes) and context_size, in windows whose token estimate
    (bytes / 3, rounded up, and an overhead) is within the limit."""
    schema = windows.schema

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("position").reset_index(drop=True)
        context = int(frame["context_size"].iloc[0]) if bool(frame["has_context"].iloc[0]) else 0
        parts = halved(frame["window_id"].iloc[0], frame["size"].tolist(), context, limit, lambda n: -(-n // bytes_a_token) + overhead)
        return pd.concat([frame.iloc[a:b].assign(window_id=name, has_context=with_context, position=range(1, b - a + 1)) for name, a, b, with_context in parts])

    return windows.groupBy(*by, "window_id").applyInPandas(fit, schema)


def cover_issues(blocks: DataFrame, windows: DataFrame, by: list[str], block_id: str = "block_id") -> DataFrame:
    """(by, block_id, issue): blocks in no window, in several, or in a window but not in the source."""
    a = blocks.select(*by, block_id).distinct().withColumn("_known", F.lit(True))
    b = windows.groupBy(*by, block_id).agg(F.count("*").alias("_times"))
    issue = F.when(F.col("_times").isNull(), "missing").when(F.col("_known").isNull(), "unknown").when(F.col("_times") > 1, "repeated")
    return a.join(b, [*by, block_id], "full_outer").select(*by, block_id, issue.alias("issue")).where("issue is not null")
