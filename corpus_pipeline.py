"""The corpus pipeline: quality rules, near-dedup, passage dedup, decontamination, packing.

Every stage works on all rows the one before kept.  All but the last return the columns
of ``documents``; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.llm import decontam, packing, quality, simhash, suffix_dedup
from lacuna.scratch import new_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.kept_documents(docs).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose SimHash fingerprints link, the one with the smallest id stays."""
    return simhash.keep_one(docs).select(*COLUMNS)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document with a smaller id holds too are cut out.

    A character of which a byte goes, goes; ``n_chars`` is counted anew.  Documents of which
    nothing but white space is left go; those nothing was cut from stay as they are.
    """
    found = suffix_dedup.suffix_dedup(docs.select(*COLUMNS), whole_characters=True)
    return (
        found.withColumn("text", F.col("kept").cast("string"))
        .filter((F.col("n_removed") == 0) | F.col("text").rlike(r"\S"))
        .select("document.doc_id", "text", "document.lang", "document.source", F.length("text").cast("long").alias("n_chars"))
    )


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.clean_documents(docs.select(*COLUMNS), benchmark)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of all remaining documents as pieces of fixed windows."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_dedup),
    ("suffix_array_dedup", passage_dedup),
    ("benchmark_decontamination", decontamination),
    ("retrieval_packing", pack),
]

#: SQL cannot express majority bits over a text's shingles, components or retrieval;
#: tests/llm/test_dedup.py compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each on the written rows of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = new_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
