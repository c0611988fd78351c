"""Canonical exact digests of documents, with DataFrame and SQL functions only.

Canonical form: Unicode NFKC, full case folding, NFKC again, runs of white space folded to one
blank, ends trimmed. The fingerprint is a wide xxhash (two 64-bit values over the canonical
bytes with different leads); equal fingerprints count as equal texts only after their canonical
bytes are compared. Unicode normalisation and folding are static methods of the ICU library
that Spark ships, called with SQL's ``reflect``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as c

#: Rows that share a bucket of consecutive keys, about; and the most buckets, whose bounds (not
#: rows) the driver holds. With more rows the buckets grow, and their window spills.
BUCKET_ROWS = 2000
MOST_BUCKETS = 50_000
#: Bounds of buckets in one block: a key's bucket is found by its block first.
BLOCK_BOUNDS = 256
#: Repeated fingerprints that are broadcast at most; more of them are joined by shuffle.
MOST_BROADCAST = 1_000_000


def canonical(text: Column) -> Column:
    """The canonical form; null is the form of the empty text."""
    def nfkc(x: Column) -> Column:
        return F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), x, F.lit(True))

    folded = F.reflect(F.lit("com.ibm.icu.lang.UCharacter"), F.lit("foldCase"), nfkc(F.coalesce(text.cast("string"), F.lit(""))), F.lit(True))
    return F.trim(F.regexp_replace(nfkc(folded), r"(?U)\s+", " "))


def wide_hash(form: Column) -> Column:
    """32 hexadecimal digits: two xxhash64 of the same bytes."""
    return F.lower(F.concat(*[F.lpad(F.hex(h), 16, "0") for h in (F.xxhash64(form), F.xxhash64(F.lit("lodestone"), form))]))


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with canonical_text and fingerprint. A narrow step."""
    docs = c.without(docs, ["canonical_text", "fingerprint"])
    return docs.withColumn("canonical_text", canonical(F.col(f"`{text}`"))).withColumn("fingerprint", wide_hash(F.col("canonical_text")))


def _classes(made: DataFrame, key: str) -> DataFrame:
    """(_f, form, class_id, class_size): fingerprints and sizes of the classes of several rows among ``made``.

    Only rows whose fingerprint occurs again are grouped by their bytes. ``form`` is null where all
    rows of the fingerprint have the same bytes; it tells classes apart where they have not."""
    again = made.groupBy("fingerprint").agg(F.count("*").alias("n")).where("n > 1").select("fingerprint")
    small = again.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
    if small:
        again = F.broadcast(again)
    grouped = made.join(again, "fingerprint", "left_semi").groupBy("fingerprint", "canonical_text").agg(F.min(key).alias("class_id"), F.count("*").alias("class_size"))
    forms = F.count("*").over(Window.partitionBy("fingerprint"))
    classes = grouped.select("fingerprint", F.when(forms > 1, F.col("canonical_text")).alias("form"), "class_id", "class_size").withColumnRenamed("fingerprint", "_f")
    return F.broadcast(classes) if small else classes


def _with_class(rows: DataFrame, classes: DataFrame, key: str, own: str) -> DataFrame:
    """``rows`` with class_id and class_size; a row without a class of several is its own."""
    joined = rows.join(classes, (F.col("fingerprint") == F.col("_f")) & (F.col("form").isNull() | (F.col("form") == F.col(own))), "left")
    return joined.withColumns({"class_id": F.when(F.col("class_size").isNull(), F.col(key)).otherwise(F.col("class_id")), "class_size": F.coalesce("class_size", F.lit(1))}).drop("_f", "form")


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint, class_id, class_size): class_id is the least key of the documents with
    the same canonical bytes.

    Rows are pre-aggregated by fingerprint and bytes before they are shuffled, so a third of all
    rows in one class sends one row from each task. Within a fingerprint, classes are told apart
    by their bytes. Null keys belong to their class but are never its id unless all are null;
    null and empty texts are one class; repeated rows count each."""
    made = fingerprints(docs.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").alias("text")))
    return _with_class(made, _classes(made, key), key, "canonical_text").select(key, "fingerprint", "class_id", "class_size")


def _bucket(k: Column, bounds: list[int]) -> Column:
    """How many of the descending bounds are above the key; nulls come after all of them."""
    if not bounds:
        return F.when(k.isNull(), 1).otherwise(0)
    blocks = [bounds[i : i + BLOCK_BOUNDS] for i in range(0, len(bounds), BLOCK_BOUNDS)]

    def literal(x: list[int]) -> Column:
        return F.from_json(F.lit(str(x)), "array<bigint>")

    block = F.size(F.filter(literal([x[-1] for x in blocks]), lambda x: x > k))
    own = F.get(F.from_json(F.lit(str(blocks)), "array<array<bigint>>"), block)
    inside = F.coalesce(F.size(F.filter(own, lambda x: x > k)), F.lit(0))
    return F.when(k.isNull(), len(bounds) + 1).otherwise(F.least(block * BLOCK_BOUNDS, F.lit(len(bounds))) + F.greatest(inside, F.lit(0)))


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, next_text): the text of the next lesser key; after the least, of the greatest.

    Keys are whole numbers of at most 64 bits. They are dealt into buckets of consecutive values
    between quantiles of all keys, so that uneven keys make even buckets and one shuffle brings
    neighbours together; the first row of each bucket is sent to the bucket before it as well. Null
    keys come last, equal keys are ordered by text; rows of one key are in one bucket, which spills."""
    kind = docs.select(F.col(f"`{key}`")).schema[0].dataType
    if not isinstance(kind, (T.IntegralType, T.NullType)):
        raise TypeError(f"{key} must hold whole numbers, not {kind.simpleString()}")
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("k"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("t"))
    n = rows.agg(F.count("k")).first()[0]
    buckets = min(MOST_BUCKETS, -(-n // BUCKET_ROWS))
    bounds = []
    if buckets > 1:
        shares = [i / buckets for i in range(1, buckets)]
        bounds = sorted(set(rows.agg(F.percentile_approx("k", shares, max(10_000, 4 * buckets))).first()[0]), reverse=True)
    bucketed = rows.select("k", "t", _bucket(F.col("k"), bounds).cast("long").alias("b"))
    # the first row of each bucket, in the order of keys descending, nulls last, then text
    first = F.struct(F.bitwise_not("k"), F.col("t"))
    heads = bucketed.groupBy("b").agg(F.min_by("k", first).alias("k"), F.min_by("t", first).alias("t"))
    ids = [r["b"] for r in heads.select("b").orderBy("b").toLocalIterator()]
    before = {b: a for a, b in zip([ids[-1], *ids], ids)} if ids else {}
    moved = heads.where(F.lit(bool(before)))
    table = docs.sparkSession.createDataFrame(list(before.items()) or [(0, 0)], "b long, to long")
    sent = moved.join(F.broadcast(table), "b").select("k", "t", F.col("to").alias("b"), F.lit(1).alias("sent"))
    both = bucketed.withColumn("sent", F.lit(0)).unionByName(sent)
    order = Window.partitionBy("b").orderBy("sent", F.col("k").desc_nulls_last(), "t")
    return both.withColumn("next_text", F.lead("t").over(order)).where("sent = 0").select(F.col("k").alias(key), F.col("t").alias("text"), "next_text")


def edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text, its neighbour, and the text whose last third is replaced by the neighbour's start:
    key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, and the
    class_id and class_size of ``exact_groups``.

    An exact digest is like another (1) or not (0): equal fingerprints whose canonical bytes are
    equal too. Null texts are empty; a single document is its own neighbour."""
    k = F.floor(F.char_length("text") / 3).cast("int")
    rows = with_next(docs, key, text).withColumn("edited", F.concat(F.expr("substring(text, 1, char_length(text) - cast(floor(char_length(text) / 3) as int))"), F.substring(F.col("next_text"), F.lit(1), k)))
    forms = rows.select(F.col(f"`{key}`"), F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), canonical(F.col("text")).alias("own"), canonical(F.col("edited")).alias("other"), canonical(F.col("next_text")).alias("following"))
    prints = forms.select("*", wide_hash(F.col("own")).alias("fingerprint"), wide_hash(F.col("other")).alias("edited_fingerprint"), wide_hash(F.col("following")).alias("next_fingerprint"))

    def alike(a: str, form: str) -> Column:
        return F.when((F.col("fingerprint") == F.col(a)) & (F.col("own") == F.col(form)), 1.0).otherwise(0.0)

    compared = prints.select(F.col(f"`{key}`"), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", alike("edited_fingerprint", "other").alias("near_edited"), alike("next_fingerprint", "following").alias("near_next"), "own")
    made = fingerprints(docs.select(F.col(f"`{key}`").cast("long").alias(key), F.col(f"`{text}`").alias("text")))
    return _with_class(compared, _classes(made, key), key, "own").drop("own")
