"""Registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from recordlens.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-first quality verdict of every document."""
    from recordlens.llm.quality import quality
    return quality(read_table(spark, sf_dir, "documents")).drop("clean_text")


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document from its text, declared language and address."""
    from recordlens.llm.language import identify
    return identify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "pages"))


@query
def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from recordlens.llm import html
    pages = read_table(spark, sf_dir, "pages")
    return html.extract(pages, html.train(pages, read_table(spark, sf_dir, "documents")))


@query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    from recordlens.llm.simhash import near_duplicates
    return near_duplicates(read_table(spark, sf_dir, "documents"))


@query
def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted, staged and read back from the formatted segments."""
    from recordlens.llm import chat
    from recordlens.llm.common import stage
    own = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], own.schema)
    return chat.read_back(stage(chat.format_chat(own.unionByName(extra)), "chat"))


@query
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    from recordlens.llm import pii
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find(docs, pii.train(docs))


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file, the same on all machines."""
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-id files of all documents, written and read back."""
    from recordlens.llm import tokenfile
    path = tokenfile.write_token_files(read_table(spark, sf_dir, "documents"), tokenfile.new_path(spark),
                                       tokenizer_path("byte_bpe_50k.json"))
    return tokenfile.digest(spark, path)


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of power-of-two lengths."""
    from recordlens.llm import packing
    return packing.digest(packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json")))


@query
def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model and unigram log probability of every document."""
    from recordlens.llm import lm
    return lm.score(read_table(spark, sf_dir, "documents"))


@query
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark hits of every document."""
    from recordlens.llm.decontaminate import decontaminate
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark")).drop("text")


@query
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that ten documents share."""
    from recordlens.llm import linededup
    return linededup.digest(linededup.line_dedup(read_table(spark, sf_dir, "documents")))


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each filter removes, in every order of the five filters."""
    from recordlens.llm.audit import audit
    return audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with the frequent words that they misspell."""
    from recordlens.llm.spelling import spelling_variants
    return spelling_variants(read_table(spark, sf_dir, "documents"))
