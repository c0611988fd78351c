"""The registered queries of this subpackage: one for each operator, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import contamination

    docs = c.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, c.table(spark, sf_dir, "benchmark"), keep_text=False)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("item_ids"), ","), 256).alias("items_sha256"), "contaminated",
    )


QUERIES = {"op1_decontaminate": op1_decontaminate}

ORACLE_SQL = {
    "op1_decontaminate": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bl AS (SELECT item_id, w, least(13, len(w)) AS k FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, k, array_to_string(w[p:p + k - 1], ' ') AS win FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM bl)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS win FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, ks WHERE len(w) >= k)),
h AS (SELECT doc_id, p, k, item_id FROM dw JOIN bw USING (k, win)),
hit AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM h) GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM h GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(it.n, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)""",
}


def _fold(modulus: int):
    """crc32 of doc_id as text, modulo; a null doc_id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .bpe import encoded

    docs = c.table(spark, sf_dir, "documents").select("doc_id", "text")
    return encoded(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), digests=True, keep_text=False)


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import fit, languages

    docs = c.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = _fold(4) == 2
    model = fit(docs.where(~held_out))
    return languages(docs.select("doc_id", held_out.alias("held_out"), "text"), model, keep_text=False)


QUERIES |= {"op4_bpe": op4_bpe, "op8_language": op8_language}


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import fit, scored

    docs = c.table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = _fold(3) == 1
    model = fit(docs.where(~held_out), c.table(spark, sf_dir, "labels").where(~held_out))
    return scored(docs.select("doc_id", held_out.alias("held_out"), "text"), model, keep_text=False).withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


QUERIES["op5_toxicity"] = op5_toxicity


def op3_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fingerprint import edits

    return edits(c.table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES["op3_fingerprint"] = op3_fingerprint


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import round_trip

    return round_trip(c.table(spark, sf_dir, "pages").select("page_id", "url", "html"), c.scratch(spark))


QUERIES["op10_warc"] = op10_warc
ORACLE_SQL["op10_warc"] = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to
FROM q"""


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import find, report

    return report(find(c.table(spark, sf_dir, "documents").select("doc_id", "text"), c.scratch(spark)), ["doc_id"])


QUERIES["op6_pii"] = op6_pii


def op7_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .neardup import near_duplicates

    return near_duplicates(c.table(spark, sf_dir, "documents").select("doc_id", "text"), c.scratch(spark))


QUERIES["op7_neardup"] = op7_neardup


def op2_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ppm import scored

    docs = c.table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = _fold(7) == 2
    return scored(docs.select("doc_id", held_out.alias("held_out"), "text"), ~F.col("held_out"), c.scratch(spark))


QUERIES["op2_ppm"] = op2_ppm


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring import remove_repeats

    return remove_repeats(c.table(spark, sf_dir, "documents").select("doc_id", "text"), c.scratch(spark), digests=True)


QUERIES["op9_substrings"] = op9_substrings


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .whitening import report

    return report(c.table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), c.scratch(spark))


QUERIES["op11_whitening"] = op11_whitening


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scan

    return scan(c.table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)


def _op12_sql() -> str:
    from .licenses import oracle_sql

    return oracle_sql()


QUERIES["op12_licenses"] = op12_licenses
ORACLE_SQL["op12_licenses"] = _op12_sql()


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .prefixes import prefix_trie

    nodes = prefix_trie(c.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"), c.scratch(spark), group=100)
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


QUERIES["op13_prefix_trie"] = op13_prefix_trie
ORACLE_SQL["op13_prefix_trie"] = """
WITH o AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS r FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 6 AS h FROM (SELECT DISTINCT conv_id FROM o)),
t AS (SELECT c.conv_id, 0 AS part, o.r, o.role, o.text FROM c JOIN o ON o.conv_id = c.base AND o.r <= c.h
  UNION ALL SELECT c.conv_id, 1, o.r, o.role, o.text FROM c JOIN o ON o.conv_id = c.conv_id AND o.r > c.h),
s AS (SELECT c.conv_id, coalesce(list(sha256(len(role)::VARCHAR || ':' || role || text) ORDER BY part, r) FILTER (WHERE r IS NOT NULL), []) AS w, coalesce(list(len(text)::BIGINT ORDER BY part, r) FILTER (WHERE r IS NOT NULL), []) AS k FROM c LEFT JOIN t USING (conv_id) GROUP BY c.conv_id),
p AS (SELECT conv_id, d AS depth, sha256(array_to_string(w[1:d], ',')) AS node, CASE WHEN d > 0 THEN sha256(array_to_string(w[1:d - 1], ',')) END AS up, CASE WHEN d > 0 THEN k[d] ELSE 0 END AS size, d = len(w) AS ends FROM (SELECT *, unnest(range(0, len(w) + 1)) AS d FROM s)),
n AS (SELECT depth, node, up, min(conv_id) AS conv_id, count(*) AS n_convs, max(size) AS size, coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ids FROM p GROUP BY depth, node, up),
k AS (SELECT depth - 1 AS depth, up AS node, count(*) AS n FROM n WHERE depth > 0 GROUP BY ALL),
m AS (SELECT n.*, coalesce(k.n, 0) AS n_children, pa.conv_id AS parent_conv_id FROM n LEFT JOIN k USING (depth, node) LEFT JOIN n pa ON pa.depth = n.depth - 1 AND pa.node = n.up),
b AS (SELECT p.depth, p.node, count(*) FILTER (WHERE m.n_children = 0) AS n_leaves, sum((m.n_convs - 1) * m.size) AS saved FROM m JOIN p ON p.conv_id = m.conv_id AND p.depth <= m.depth GROUP BY ALL)
SELECT m.conv_id, m.depth::BIGINT AS depth, m.parent_conv_id, n_convs::BIGINT AS n_convs, n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(ids) AS ends_sha256
FROM m JOIN b USING (depth, node)"""
