"""Training-data pipeline: five stages over whole tables, each written and read again.

A stage is a function (spark, docs, sf_dir) -> DataFrame that works on all rows its
predecessor kept.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recordlens.llm import decontaminate, language, packing, pii, simhash
from recordlens.llm.common import read_table, stage
from recordlens.llm.queries import tokenizer_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified."""
    return language.keep_identified(docs, read_table(spark, sf_dir, "pages"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked."""
    return pii.redact(docs, pii.train(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontaminate", decontaminated),
          ("pii", redacted), ("packing", packed)]

#: Fingerprints, fitted models and tokenizer ids are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, name)
    return docs
