"""Claims that readers noted, held against source blocks and final records.

Blocks: (paper_id, block_id, text, source, page, order). Citations: (paper_id, owner_id, block_id, quote).
Objects: (paper_id, object_id, label, role, scope). Claims: (paper_id, claim_id, kind, raw_value, scope).
Subjects: (paper_id, claim_id, object_id)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions import grounding as gr
from lodestone.operators import records
from lodestone.sources import shared

# Kinds of records that objects of a role become.
RECORD_OF_ROLE = {"device_design": "device_family", "individual_device": "individual_device", "population": "population_statistic", "performance_measurement": "performance_observation", "stability_experiment": "stability_test"}

#: Quotes of a paper that are held against its blocks in one task.
_SHARE = 500


def grounded_citations(citations: DataFrame, blocks: DataFrame) -> DataFrame:
    """The citations whose quote stands in their block, by what counts in values."""
    joined = citations.join(blocks.select("paper_id", "block_id", "text"), ["paper_id", "block_id"])
    return joined.where(gr.contains_value(F.col("text"), F.col("quote"))).select(*citations.columns)


def ground(objects: DataFrame, claims: DataFrame, subjects: DataFrame, citations: DataFrame, blocks: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Objects and claims that the source supports, and (paper_id, source_id, reason) of the others.

    An object needs a grounded citation; a claim also all of its subjects, and a quote that holds its value."""
    good = grounded_citations(citations, blocks)
    held = good.select("paper_id", F.col("owner_id")).distinct()
    kept = objects.join(held.withColumnRenamed("owner_id", "object_id"), ["paper_id", "object_id"], "left_semi")
    broken = subjects.join(kept.select("paper_id", "object_id"), ["paper_id", "object_id"], "left_anti").select("paper_id", "claim_id").distinct().withColumn("_broken", F.lit(True))
    quotes = good.withColumnRenamed("owner_id", "claim_id").join(claims.select("paper_id", "claim_id", "raw_value"), ["paper_id", "claim_id"])
    quotes = quotes.withColumn("_holds", F.col("raw_value").isNull() | gr.contains_value(F.col("quote"), F.col("raw_value")))
    shown = quotes.groupBy("paper_id", "claim_id").agg(F.bool_or("_holds").alias("_shown"))
    judged = claims.join(shown, ["paper_id", "claim_id"], "left").join(broken, ["paper_id", "claim_id"], "left")
    ok = F.coalesce(F.col("_shown"), F.lit(False)) & F.col("_broken").isNull()
    reason = F.when(F.col("_shown") == False, "raw value absent from cited evidence").otherwise("unresolved evidence or subject")  # noqa: E712
    lost = objects.join(kept.select("paper_id", "object_id"), ["paper_id", "object_id"], "left_anti").select("paper_id", F.col("object_id").alias("source_id"), F.lit("unresolved evidence").alias("reason"))
    return kept, judged.where(ok).select(*claims.columns), lost.union(judged.where(~ok).select("paper_id", F.col("claim_id").alias("source_id"), reason.alias("reason")))


def cited_blocks(blocks: DataFrame, citations: DataFrame, main: str = "main") -> DataFrame:
    """The blocks that are cited, and those of the main source's first page; all of a paper without any such."""
    first = blocks.where(F.col("source") == main).groupBy("paper_id").agg(F.min("page").alias("_first"))
    cited = citations.select("paper_id", "block_id").distinct().withColumn("_cited", F.lit(True))
    noted = citations.select("paper_id").distinct().withColumn("_noted", F.lit(True))
    tagged = blocks.join(first, "paper_id", "left").join(cited, ["paper_id", "block_id"], "left").join(noted, "paper_id", "left")
    own = F.col("_cited").isNotNull() | F.coalesce((F.col("source") == main) & (F.col("page") == F.col("_first")), F.lit(False))
    tagged = tagged.withColumn("_own", own).withColumn("_some", F.max(F.col("_own").cast("int")).over(Window.partitionBy("paper_id")))
    return tagged.where("_own or _noted is null or _some = 0").select(*blocks.columns)


def cited_spans(spans: DataFrame, blocks: DataFrame, citations: DataFrame, main: str = "main") -> DataFrame:
    """The spans (paper_id, span_id, block_id, text) that are cited, their neighbours in the block, and those
    of the main source's first page; all of a paper without any such."""
    first = blocks.where(F.col("source") == main).groupBy("paper_id").agg(F.min("page").alias("_first"))
    headers = blocks.join(first, "paper_id").where((F.col("source") == main) & (F.col("page") == F.col("_first"))).select("paper_id", "block_id").distinct().withColumn("_head", F.lit(True))
    cited = citations.select("paper_id", "block_id", F.col("quote").alias("text")).distinct().withColumn("_cited", F.lit(True))
    noted = citations.select("paper_id").distinct().withColumn("_noted", F.lit(True))
    tagged = spans.join(cited, ["paper_id", "block_id", "text"], "left").join(headers, ["paper_id", "block_id"], "left").join(noted, "paper_id", "left")
    w = Window.partitionBy("paper_id", "block_id").orderBy("span_id")
    hit = F.col("_cited").isNotNull()
    near = hit | F.coalesce(F.lag(hit).over(w), F.lit(False)) | F.coalesce(F.lead(hit).over(w), F.lit(False))
    tagged = tagged.withColumn("_near", near | F.col("_head").isNotNull()).withColumn("_some", F.max(F.col("_near").cast("int")).over(Window.partitionBy("paper_id")))
    return tagged.where("_near or _noted is null or _some = 0").select(*spans.columns)


def evidence_matches(citations: DataFrame, record_citations: DataFrame, by: list[str]) -> DataFrame:
    """(paper_id, owner_id, by, match) of noted citations and records that share a block: covered where a long
    quote of one holds one of the other, else possible_match."""

    def gathered(df: DataFrame, key: list[str], name: str) -> DataFrame:
        return df.groupBy("paper_id", *key).agg(F.collect_set(F.when(F.length("_q") > 0, F.col("_q"))).alias(name))

    a, b = (df.withColumn("_q", gr.folded(F.col("quote"))) for df in (citations, record_citations))
    shared = a.select("paper_id", "owner_id", "block_id").distinct().join(b.select("paper_id", *by, "block_id").distinct(), ["paper_id", "block_id"]).select("paper_id", "owner_id", *by).distinct()
    both = shared.join(gathered(a, ["owner_id"], "_a"), ["paper_id", "owner_id"]).join(gathered(b, by, "_b"), ["paper_id", *by])
    return both.select("paper_id", "owner_id", *by, F.when(gr.covered_by_quotes(F.col("_a"), F.col("_b")), "covered").otherwise("possible_match").alias("match"))


def object_coverage(objects: DataFrame, citations: DataFrame, recorded: DataFrame, record_citations: DataFrame) -> DataFrame:
    """(paper_id, id, label, status, kind, record_ids): each object's state (covered, possible_match, unmatched;
    context or uncertain if it is no target of a record's role) and each record that no object claims.

    ``recorded``: (paper_id, kind, record_id); ``record_citations`` has kind and record_id too."""
    kind = F.try_element_at(F.create_map(*[F.lit(x) for pair in RECORD_OF_ROLE.items() for x in pair]), F.col("role"))
    own = objects.withColumn("kind", kind).withColumn("_target", F.coalesce((F.col("scope") == "target"), F.lit(False)) & F.col("kind").isNotNull())
    own = own.withColumn("kind", F.when(F.col("scope") == "context", None).otherwise(F.col("kind")))
    found = evidence_matches(citations, record_citations, ["kind", "record_id"]).withColumnRenamed("owner_id", "object_id")
    pairs = own.join(found, ["paper_id", "object_id", "kind"], "left")
    covered = F.array_sort(F.collect_set(F.when(F.col("match") == "covered", F.col("record_id"))))
    any_ = F.array_sort(F.collect_set("record_id"))
    grouped = pairs.groupBy("paper_id", F.col("object_id").alias("id"), "label", "scope", "kind", "_target").agg(covered.alias("_c"), any_.alias("_a"))
    state = F.when(F.col("_target"), F.when(F.size("_c") > 0, "covered").when(F.size("_a") > 0, "possible_match").otherwise("unmatched")).when(F.col("scope") == "context", "context").otherwise("uncertain")
    items = grouped.select("paper_id", "id", "label", state.alias("status"), "kind", F.when(F.col("_target") & (F.size("_c") > 0), F.col("_c")).otherwise(F.col("_a")).alias("record_ids"))
    claimed = items.select("paper_id", "kind", F.explode("record_ids").alias("record_id")).distinct()
    free = recorded.join(claimed, ["paper_id", "kind", "record_id"], "left_anti").select("paper_id", F.concat_ws(":", F.lit("unclaimed"), "kind", "record_id").alias("id"), F.lit(None).cast("string").alias("label"), F.lit("unclaimed").alias("status"), "kind", F.array("record_id").alias("record_ids"))
    return items.unionByName(free)


def relinked(citations: DataFrame, blocks: DataFrame, folder: str | None = None) -> DataFrame:
    """``citations`` with new_block_id and status: kept where the quote stands in its block; relinked where it
    stands in exactly one block of the paper; else unresolved. Quotes of fewer than 12 counted characters or of
    one word are not searched for.

    Only the wrong citations are joined with the blocks of their paper: each text and quote is folded once, and a pair is judged
    only if the one holds the other's ``spine``. A paper's quotes are dealt by _SHARE, so that a large one is many
    tasks' work. What the blocks say is judged once if it may be written to ``folder``, and else twice."""
    own = citations.join(blocks.select("paper_id", "block_id", F.col("text").alias("_t")), ["paper_id", "block_id"], "left")
    wide = (F.length(gr.folded(F.col("quote"))) >= 12) & (F.size(F.regexp_extract_all("quote", F.lit(r"(?U)\w+"), F.lit(0))) >= 2)
    judged = own.withColumn("_ok", F.col("_t").isNotNull() & gr.contains_quote(F.col("_t"), F.col("quote"))).withColumn("_long", wide).drop("_t")
    judged = shared.written(judged, f"{folder}/judged") if folder else judged
    asked = judged.where(~F.col("_ok") & F.col("_long")).select("paper_id", "quote").distinct()
    shares = asked.groupBy("paper_id").agg(F.ceil(F.count("*") / _SHARE).cast("int").alias("_n"))
    dealt = asked.join(shares, "paper_id").withColumn("_share", F.pmod(F.xxhash64("quote"), F.col("_n")).cast("int")).withColumn("_spine", gr.spine(F.col("quote"))).drop("_n")
    texts = blocks.groupBy("paper_id", "text").agg(F.min("block_id").alias("_first"), F.max("block_id").alias("_last")).join(shares, "paper_id")
    texts = texts.withColumn("_bare", gr.without_dashes(F.col("text"))).withColumn("_share", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).drop("_n")
    found = dealt.join(texts, ["paper_id", "_share"]).where(F.contains("_bare", "_spine")).where(gr.contains_quote(F.col("text"), F.col("quote")))
    found = found.groupBy("paper_id", "quote").agg(F.min("_first").alias("_new"), F.max("_last").alias("_last"))  # where a quote stands is a matter of the quote, not of the row
    one = F.coalesce(F.col("_new") == F.col("_last"), F.lit(False))
    status = F.when(F.col("_ok"), "kept").when(~F.col("_long"), "too_short").when(one, "relinked").otherwise("unresolved")
    moved = F.when(F.col("_ok"), F.col("block_id")).when(F.col("_long") & one, F.col("_new"))
    return judged.join(found, ["paper_id", "quote"], "left").select(*citations.columns, moved.alias("new_block_id"), status.alias("status"))


def id_issues(objects: DataFrame, claims: DataFrame, subjects: DataFrame) -> DataFrame:
    """(paper_id, id, issue): ids that repeat, that objects and claims share, and subjects that are no object."""
    ids = objects.select("paper_id", F.col("object_id").alias("id"), F.lit("object").alias("of")).union(claims.select("paper_id", F.col("claim_id").alias("id"), F.lit("claim").alias("of")))
    counts = ids.groupBy("paper_id", "id").agg(F.count("*").alias("n"), F.countDistinct("of").alias("kinds"))
    both = counts.where("n > 1").select("paper_id", "id", F.when(F.col("kinds") > 1, "shared by object and claim").otherwise("repeated").alias("issue"))
    lost = records.dangling(subjects.withColumn("_k", F.concat_ws("\0", "paper_id", "object_id")), "_k", objects.withColumn("_k", F.concat_ws("\0", "paper_id", "object_id")), "_k")
    return both.union(lost.select("paper_id", F.col("object_id").alias("id"), F.lit("no such subject").alias("issue")).distinct())


def expand_spans(citations: DataFrame, spans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Citations by span number with their block and exact quote, and those whose number is in no catalogue."""
    key = ["paper_id", "span_id"]
    return citations.join(spans.select(*key, "block_id", F.col("text").alias("quote")), key), citations.join(spans.select(*key), key, "left_anti")


def compact_spans(citations: DataFrame, spans: DataFrame) -> DataFrame:
    """``citations`` (block_id, quote) with span_id: of the one span of the block that is the quote, else of the one
    that holds it; null if there is none or several."""
    joined = citations.withColumn("_row", F.xxhash64(*citations.columns)).join(spans.select("paper_id", "block_id", "span_id", "text"), ["paper_id", "block_id"], "left")
    same, within = F.col("text") == F.col("quote"), F.contains("text", "quote")
    grouped = joined.groupBy(*citations.columns, "_row").agg(F.count_if(same).alias("n1"), F.min(F.when(same, F.col("span_id"))).alias("s1"), F.count_if(within).alias("n2"), F.min(F.when(within, F.col("span_id"))).alias("s2"))
    return grouped.select(*citations.columns, F.when(F.col("n1") == 1, F.col("s1")).when((F.col("n1") == 0) & (F.col("n2") == 1), F.col("s2")).alias("span_id"))
