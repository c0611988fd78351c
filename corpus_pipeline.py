"""The corpus pipeline: stages over ``documents``, each kept set feeding the next.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next one's docs. Nulls, empty tables and repeated rows behave as the operators
that the stages call say."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import lodestone
from lodestone.llm import bpe, common, decontaminate, langid, neardup, pii

#: A document is kept if so large a share of its words is known in some language.
KNOWN_SHARE = 0.1


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a recognised language: texts without a letter go, and those of whose words
    fewer than a tenth are known in any language of the labels, whatever their length."""
    return langid.recognised(docs, langid.fit(docs), least=KNOWN_SHARE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near-duplicates."""
    return neardup.drop_near_duplicates(docs, common.scratch(spark))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold benchmark passages."""
    return decontaminate.decontaminate(docs, common.table(spark, sf_dir, "benchmark"))


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Generalises personal data in the texts; n_chars follows."""
    clean = pii.sanitise(docs, common.scratch(spark))
    return clean.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else clean


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the kept texts, and the offsets of the pieces for decoding."""
    import public_tokenizers

    return bpe.encoded(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), keep_text=False)


STAGES = [("language_id", language), ("minhash_near_dedup", near_dedup), ("benchmark_decontamination", decontamination), ("pii", sanitise), ("byte_bpe", encode)]

#: Language models and signatures are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written to the shared folder and read again."""
    lodestone.ship(spark)
    docs, folder = common.table(spark, sf_dir, "documents"), common.scratch(spark)
    for k, (name, stage) in enumerate(STAGES):
        docs = common.materialise(stage(spark, docs, sf_dir), folder, f"{k}-{name}")
    return docs
