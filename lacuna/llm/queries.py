"""The operators of this package as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.llm import (
    alignment,
    chat,
    decontam,
    html_template,
    langid,
    packing,
    quality,
    sharding,
    simhash,
    spelling,
    suffix_dedup,
    token_store,
    url_filter,
)
from lacuna.llm.common import table
from lacuna.scratch import new_folder

URL_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES, keep=("page_id",))


@query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "document.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op3_html_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_template.extract(table(spark, sf_dir, "pages"))


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


@query
def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_format(table(spark, sf_dir, "conversations"))


@query
def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return langid.identify(documents, langid.train(documents))


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query
def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "tokens")
    token_store.write_tokens(table(spark, sf_dir, "documents"), folder)
    return token_store.stored(spark, folder)


@query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "contaminated", "n_items", "item_ids")


@query
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alignment of the two tokenizers in every document; ``groups_sha256`` of its groups."""
    found = alignment.align(table(spark, sf_dir, "documents"))
    none = (F.col("n_a") == 0) & (F.col("n_b") == 0)
    digest = F.when(none, "").otherwise(F.sha2("groups", 256))
    return found.select("doc_id", *alignment.FIGURES, digest.alias("groups_sha256"))


@query
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents with their near words, forms and roots."""
    found = spelling.variants(table(spark, sf_dir, "documents"))
    return found.select("word", "n", "n_near", "form", "form_n", "root")


@query
def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards by the law ``bytes``; ``text_crc32`` is of the texts placed."""
    found = sharding.shard(table(spark, sf_dir, "documents"), shards=16)
    return found.select(
        "document.doc_id",
        "size",
        F.crc32(F.coalesce("document.text", F.lit(""))).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
