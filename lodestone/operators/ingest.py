"""Records of papers from several sources: one form, merged, carried through runs with their state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import text as tx

# States of a record.
TERMINAL = ("downloaded", "excluded", "irrelevant")
RETRYABLE = ("new", "error", "no_pdf", "missing_doi")
_TEXTS = ("identifier", "title", "summary", "link", "doi", "pdf_url", "openalex_id", "publication_date", "zotero_item_key")


def _text(df: DataFrame, name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")) if name in df.columns else F.lit("")


def feed_records(entries: DataFrame, source: str, curated: bool = False) -> DataFrame:
    """Feed entries (any of doi, link, id, guid, title, summary, description, ...) as records; a missing field is
    empty. The identifier is the DOI of the first field that holds one, else id, guid, link or title."""
    own = lambda name: _text(entries, name)
    doi = tx.first_doi(*[own(x) for x in ("prism_doi", "dc_identifier", "doi", "link", "id", "summary", "title", "description", "guid", "pdf_url")])
    title = tx.plain_text(own("title"))
    summary = tx.plain_text(F.coalesce(F.nullif(own("summary"), F.lit("")), own("description")))
    some = lambda name: F.nullif(own(name), F.lit(""))
    topics = F.col("topic_ids") if "topic_ids" in entries.columns else F.array().cast("array<string>")
    return entries.select(
        tx.identifier(doi, own("id"), own("guid"), own("link"), title).alias("identifier"), F.array(F.lit(source)).alias("sources"), topics.alias("topic_ids"), title.alias("title"), summary.alias("summary"),
        own("link").alias("link"), doi.alias("doi"), some("pdf_url").alias("pdf_url"), some("openalex_id").alias("openalex_id"), some("publication_date").alias("publication_date"), some("zotero_item_key").alias("zotero_item_key"), F.lit(curated).alias("curated"),
    )


def work_entries(works: DataFrame) -> DataFrame:
    """Works of a bibliographic index (id, doi, display_name, abstract_inverted_index, topics, primary_location,
    best_oa_location, publication_date) as feed entries."""
    empty = F.lit("")
    return works.select(
        F.col("id"), F.col("doi"), F.coalesce("display_name", empty).alias("title"), tx.abstract(F.col("abstract_inverted_index")).alias("summary"),
        F.coalesce(F.nullif(F.col("primary_location.landing_page_url"), empty), F.col("doi"), empty).alias("link"), F.nullif(F.col("best_oa_location.pdf_url"), empty).alias("pdf_url"), "publication_date",
        F.transform(F.filter("topics", lambda t: F.nullif(t["id"], empty).isNotNull()), lambda t: F.element_at(F.split(t["id"], "/"), -1)).alias("topic_ids"), F.col("id").alias("openalex_id"),
    )


def library_entries(items: DataFrame, group: str) -> DataFrame:
    """Items of a reference library (key, itemType, parentItem, contentType, linkMode, DOI, extra, url, title,
    filename, abstractNote, date) as feed entries; notes, annotations and child files are none."""
    attached = F.col("itemType") == "attachment"
    own_file = F.col("parentItem").isNull() & (F.col("contentType") == "application/pdf") & F.col("linkMode").isin("imported_file", "imported_url")
    key = F.trim(F.coalesce("key", F.lit("")))
    kept = items.where((key != "") & ~F.coalesce(F.col("itemType").isin("note", "annotation"), F.lit(False)) & (~F.coalesce(attached, F.lit(False)) | own_file))
    doi = F.when(attached, tx.doi(F.col("url"))).otherwise(F.coalesce(tx.doi(F.col("DOI")), tx.doi(F.col("extra")), tx.doi(F.col("url"))))
    empty = F.lit("")
    return kept.withColumn("_doi", doi).select(
        F.concat(F.lit(f"zotero:{group}:"), key).alias("id"), F.col("_doi").alias("doi"), F.coalesce(F.nullif("title", empty), F.when(attached, F.col("filename")), empty).alias("title"),
        F.when(attached, "").otherwise(F.coalesce("abstractNote", empty)).alias("summary"), F.coalesce(F.nullif("url", empty), F.when(~attached, F.concat(F.lit("https://doi.org/"), "_doi")), empty).alias("link"),
        F.when(~attached, tx.publication_date(F.col("date")).cast("string")).alias("publication_date"), key.alias("zotero_item_key"),
    )


def merge_records(records: DataFrame, order: list[str]) -> DataFrame:
    """One record for each identifier: sources and topics in the order in which they come, the longest title
    and summary (the first of equals), the first known value of each other field; curated if any is."""
    rank = F.struct(*order)
    rows = F.array_sort(F.collect_list(F.struct(rank.alias("rank"), "sources", "topic_ids")))
    first = [F.min_by(F.when(F.nullif(F.col(x), F.lit("")).isNotNull(), F.col(x)), F.when(F.nullif(F.col(x), F.lit("")).isNotNull(), rank)).alias(x) for x in ("link", "doi", "pdf_url", "openalex_id", "publication_date", "zotero_item_key")]
    best = []
    for x in ("title", "summary"):
        longest = F.max(F.length(x))
        best += [longest.alias(f"_{x}"), F.collect_list(F.struct(F.length(x).alias("n"), rank.alias("rank"), F.col(x).alias("x"))).alias(x)]
    out = records.groupBy("identifier").agg(rows.alias("_rows"), *best, *first, F.bool_or("curated").alias("curated"), F.count("*").alias("n_records"))
    def longest_of(x: str) -> Column:
        return F.array_min(F.transform(F.filter(x, lambda r: r["n"] == F.col(f"_{x}")), lambda r: F.struct(r["rank"], r["x"])))["x"]

    def in_order(x: str) -> Column:
        return F.array_distinct(F.flatten(F.transform("_rows", lambda r: r[x])))

    for x in ("title", "summary"):
        out = out.withColumn(x, longest_of(x)).drop(f"_{x}")
    for x in ("sources", "topic_ids"):
        out = out.withColumn(x, in_order(x))
    return out.drop("_rows").withColumn("link", F.coalesce("link", F.lit("")))


def merge_previous(records: DataFrame, state: DataFrame) -> DataFrame:
    """``records`` with what the last state knew of them: found by identifier, else by DOI (of several the
    least identifier). attempts and status are the state's (0 and new for new ones); previous is its key."""
    known = state.select(F.col("identifier").alias("_key"), F.col("doi").alias("_doi"), F.col("sources").alias("_sources"), F.col("topic_ids").alias("_topics"), F.col("attempts").alias("_attempts"), F.col("status").alias("_status"), F.col("pdf_url").alias("_pdf"), F.col("curated").alias("_curated"))
    own = records.join(known.drop("_doi"), F.col("identifier") == F.col("_key"), "left")
    by_doi = known.where("_doi is not null").groupBy("_doi").agg(F.min_by(F.struct(*[F.col(x).alias(f"{x}2") for x in known.columns if x != "_doi"]), "_key").alias("_other"))
    both = own.join(by_doi, own["_key"].isNull() & (F.col("doi") == F.col("_doi")), "left")
    pick = lambda x: F.coalesce(F.col(x), F.col(f"_other.{x}2"))
    none = F.array().cast("array<string>")
    return both.select(
        *[F.col(x) for x in records.columns if x not in ("sources", "topic_ids", "pdf_url", "curated")],
        F.array_distinct(F.concat(F.coalesce(pick("_sources"), none), "sources")).alias("sources"), F.array_distinct(F.concat(F.coalesce(pick("_topics"), none), "topic_ids")).alias("topic_ids"),
        F.coalesce("pdf_url", pick("_pdf")).alias("pdf_url"), (F.col("curated") | F.coalesce(pick("_curated"), F.lit(False))).alias("curated"),
        F.coalesce(pick("_attempts"), F.lit(0)).alias("attempts"), F.coalesce(pick("_status"), F.lit("new")).alias("status"), pick("_key").alias("previous"),
    )


def pending_retries(state: DataFrame, discovered: DataFrame, most: int, current: Column | None = None) -> DataFrame:
    """The state's records that were not found again, by identifier or DOI, are not curated, and are
    retryable within ``most`` attempts or downloaded with a file that is not ``current``."""
    seen = state.join(discovered.select("identifier").distinct(), "identifier", "left_anti").join(discovered.where("doi is not null").select("doi").distinct(), "doi", "left_anti")
    stale = (F.col("status") == "downloaded") & ~F.coalesce(current if current is not None else F.lit(True), F.lit(False))
    again = F.col("status").isin(*RETRYABLE) & (F.col("attempts") < most)
    return seen.where(~F.col("curated") & (stale | again))


def is_current(records: DataFrame, files: DataFrame) -> DataFrame:
    """``records`` with is_current: whether the file at downloaded_file still has the hash pdf_sha256."""
    found = files.select(F.col("path").alias("downloaded_file"), F.col("sha256").alias("pdf_sha256")).distinct().withColumn("_ok", F.lit(True))
    return records.join(found, ["downloaded_file", "pdf_sha256"], "left").withColumn("is_current", F.coalesce("_ok", F.lit(False))).drop("_ok")


def next_status(status: Column, attempts: Column, excluded: Column, relevant: Column, doi: Column, found_pdf: Column, error: Column, most: int = 3) -> Column:
    """The state of a record after a run: terminal ones stay, those out of attempts too; then the title's
    exclusion, relevance, a missing DOI, an error and a missing file decide, in that order."""
    return (
        F.when(status.isin(*TERMINAL) | (attempts >= most), status).when(excluded, "excluded").when(~relevant, "irrelevant").when(F.nullif(doi, F.lit("")).isNull(), "missing_doi")
        .when(error.isNotNull(), "error").when(~found_pdf, "no_pdf").otherwise("downloaded")
    )


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """(counter, n) of a run's outcomes (status, disposition): evaluated ones by status, skipped ones by reason and status."""
    name = F.when(F.col("disposition") == "evaluated", F.col("status")).otherwise(F.concat(F.regexp_replace("disposition", "^skipped_", ""), F.lit(":"), "status"))
    return outcomes.groupBy(name.alias("counter")).agg(F.count("*").alias("n"))


def first_success(attempts: DataFrame, by: list[str], order: str, result: str, error: str) -> DataFrame:
    """(by, result, failures): the first result of each record's sources in their order, and the errors before it."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(result).alias("r"), F.col(error).alias("e"))))
    held = attempts.groupBy(*by).agg(rows.alias("_rows"), F.min(F.when(F.col(result).isNotNull(), F.col(order))).alias("_first"))
    before = F.filter("_rows", lambda x: (F.col("_first").isNull() | (x["o"] < F.col("_first"))) & x["e"].isNotNull())
    return held.select(*by, F.get(F.filter("_rows", lambda x: x["o"] == F.col("_first")), F.lit(0))["r"].alias(result), F.transform(before, lambda x: x["e"]).alias("failures"))
