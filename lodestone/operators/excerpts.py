"""Quotations that were stitched together from two places of their block, cut back to what stands there.

All of it is SQL functions over the quotations that do not stand in their block. Memory is linear in the
texts: there is no table of one text against the other."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions import grounding as gr
from lodestone.functions import text as tx
from lodestone.functions.vocabulary import let

# The longest citation, the shortest quotation that is mended, the shortest part of it, the most citations of a record.
LONGEST, STITCHED, PART, MOST_CITED = 1600, 80, 40, 8

# ASCII characters that count in a comparison, as ``grounding.folded`` has it: for them no folding is asked.
_COUNTED = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_.%<>~=+/-"

_RESULT = "struct<rule:string,new_quotes:array<string>>"


def is_ordered_subset(query: Column, source: Column) -> Column:
    """Whether the characters of one text stand in the other in their order; an empty one always does."""
    after = lambda at, c: F.nullif(F.call_function("locate", c, source, at + 1), F.lit(0))
    return F.aggregate(F.filter(F.split(query, ""), lambda c: c != ""), F.lit(0), lambda at, c: after(at, c)).isNotNull()


def _held(source: Column, query: Column, end: str) -> Column:
    """How many characters of the query's left or right end stand together in the source: by halving."""
    side = F.left if end == "left" else F.right
    # the answer is in [lo, hi): each round asks for the middle
    rounds = F.sequence(F.lit(1), F.greatest(F.lit(1), F.ceil(F.log2(F.length(query) + 1)).cast("int") + 1))
    bounds = F.struct(F.lit(0).alias("lo"), (F.length(query) + 1).alias("hi"))

    def halve(b: Column, _: Column) -> Column:
        def asked(mid: Column) -> Column:
            stands = F.contains(source, side(query, mid))
            return F.struct(F.when(stands, mid).otherwise(b["lo"]).alias("lo"), F.when(stands, b["hi"]).otherwise(mid).alias("hi"))

        return F.when(b["hi"] - b["lo"] <= 1, b).otherwise(let(F.floor((b["lo"] + b["hi"]) / 2).cast("int"), asked))

    return F.aggregate(rounds, bounds, halve, lambda b: b["lo"])


def two_spans(query: Column, source: Column, least: int = PART) -> Column:
    """The two places (0-based start, size) of the source whose texts make up the query, in order, each of
    ``least`` characters or more; null if there is none, if the query stands there whole, or if a longer
    piece of it stands elsewhere.

    The places are those that repeated search for the longest common piece finds: that piece is an end
    of the query (of equally long ones the one that starts first in the query, then in the source), and
    the other end stands whole after, or before, it. So only the two longest ends that the source holds
    are tried; a longer piece would have to hold the query's middle and is looked for there."""
    n = F.length(query)
    span = lambda at, size: F.struct(at.cast("int").alias("start"), size.cast("int").alias("size"))
    place = lambda wanted, hay: F.call_function("locate", wanted, hay)

    def inner(size: Column) -> Column:
        """Whether a piece of that size that is neither end stands in the source."""
        tried = F.when(n - size - 1 >= 1, F.sequence(F.lit(2), n - size)).otherwise(F.array().cast("array<int>"))
        return F.exists(tried, lambda i: F.contains(source, F.substring(query, i, size)))

    def first_left(p: Column) -> Column:
        at = place(F.left(query, p), source)
        return let(at, lambda j: let(F.call_function("locate", F.right(query, n - p), source, j + p), lambda k: F.when(k > 0, F.array(span(j - 1, p), span(k - 1, n - p)))))

    def first_right(z: Column) -> Column:
        at = place(F.right(query, z), source)
        return let(at, lambda j: let(place(F.left(query, n - z), F.left(source, j - 1)), lambda k: F.when(k > 0, F.array(span(k - 1, n - z), span(j - 1, z)))))

    def decided(ends: Column) -> Column:
        p, z = ends["p"], ends["z"]
        left = (p >= z) & (p >= least) & (n - p >= least)
        right = (z > p) & (z >= least) & (n - z >= least)
        return F.when((p >= n) | (p + z < n), None).when(left & ~inner(p + 1), first_left(p)).when(right & ~inner(z), first_right(z))

    return let(F.struct(_held(source, query, "left").alias("p"), _held(source, query, "right").alias("z")), decided)


def restitched(citations: DataFrame, blocks: DataFrame, by: list[str], stands: Callable[[Column, Column], Column] = gr.contains_quote) -> DataFrame:
    """``citations`` (paper_id, block_id, quote, and ``by``, the list in which they stand) with rule and new_quotes.

    A quotation that does not stand in its block, but whose characters do, in order, is replaced by
    the block if that is no longer than a citation; else by the two exact spans of which it was made, or,
    in a list that is full, by the longer one (the first of two equal ones). rule is null and new_quotes
    holds the quotation where nothing changes: also without a block, or if the block is empty. Of blocks that
    share an id the greatest text counts; a null quotation is empty and stays. ``stands`` tells whether a text
    holds a quotation; ``contains_folded`` also takes one that is cut within a word."""
    texts = blocks.groupBy("paper_id", "block_id").agg(F.max("text").alias("_t"))
    full = F.count(F.lit(1)).over(Window.partitionBy("paper_id", *by)) >= MOST_CITED
    own = citations.withColumn("_full", full).join(texts, ["paper_id", "block_id"], "left")
    wrong = F.col("_t").isNotNull() & (F.coalesce("quote", F.lit("")) != "") & ~stands(F.col("_t"), F.col("quote"))
    own = own.withColumn("_wrong", wrong)
    own = own.withColumn("_q", F.when(F.col("_wrong"), gr.folded(F.col("quote")))).withColumn("_s", F.when(F.col("_wrong"), gr.folded(F.col("_t"))))
    long = F.length("_q") >= STITCHED
    whole = long & (F.char_length("_t") <= LONGEST) & is_ordered_subset(F.col("_q"), F.col("_s"))
    own = own.withColumn("_whole", F.coalesce(whole, F.lit(False)))
    own = own.withColumn("_spans", F.when(long & ~F.col("_whole"), two_spans(F.col("_q"), F.col("_s"))))

    def cut(raw: Column, spans: Column) -> Column:
        """Texts of spans of the folded text: each character counts as often as its folding is long."""
        chars = F.split(raw, "")
        size = lambda c: F.when(F.contains(F.lit(_COUNTED), c), 1).when(F.ascii(c) < 128, 0).otherwise(F.length(gr.folded(c)))
        at = F.flatten(F.transform(chars, lambda c, i: F.array_repeat(i, size(c))))
        one = lambda s, places: raw.substr(F.get(places, s["start"]) + 1, F.get(places, s["start"] + s["size"] - 1) - F.get(places, s["start"]) + 1)
        return let(at, lambda places: F.transform(spans, lambda s: F.trim(one(s, places))))

    raw = F.regexp_replace(tx.nfkc(F.col("_t")), "[−–—]", "-")
    own = own.withColumn("_cut", F.when(F.col("_spans").isNotNull(), let(raw, lambda x: cut(x, F.col("_spans")))))
    fits = F.forall("_cut", lambda x: (x != "") & (F.char_length(x) <= LONGEST))
    first, second = F.get("_cut", F.lit(0)), F.get("_cut", F.lit(1))
    result = lambda rule, quotes: F.struct(F.lit(rule).alias("rule"), quotes.alias("new_quotes")).cast(_RESULT)
    longer = F.when(F.char_length(second) > F.char_length(first), second).otherwise(first)
    out = (
        F.when(F.col("_whole"), result("restore_complete_short_block", F.array("_t")))
        .when(F.col("_cut").isNotNull() & fits & ~F.col("_full"), result("split_two_exact_source_spans", F.col("_cut")))
        .when(F.col("_cut").isNotNull() & fits, result("retain_longest_exact_source_span", F.array(longer)))
        .otherwise(result(None, F.array("quote")))
    )
    return own.withColumn("_r", out).select(*citations.columns, "_r.rule", "_r.new_quotes")
