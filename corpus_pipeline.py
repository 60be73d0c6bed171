"""The corpus pipeline: quality rules, near-duplicate removal, decontamination, redaction, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and read again as the
next one's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquery.llm import bpe, pii
from docquery.llm.decontaminate import decontaminate
from docquery.llm.jaccard_join import jaccard_components
from docquery.llm.quality_rules import quality_rules
from docquery.llm.shared import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
TOKENIZER = "byte_bpe_multi_50k.tiktoken"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    return quality_rules(docs.select(COLUMNS)).where("kept").select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked rows, the one with the least id; rows that repeat as a whole stay once.

    Rows are told apart by a stored key, so that of rows that share an id, or have none, one of a group stays too; a row
    without an id comes after those with one.  Rows without a word belong to no group.
    """
    rows = stored(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("_row")), "pipeline-rows")
    own = jaccard_components(rows.select("_row", "text"), "_row").join(rows.select("_row", "doc_id"), "_row")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")).alias("_least")
    stay = own.groupBy("component_id").agg(least).select("_least._row")
    return rows.join(stay, "_row", "left_semi").select(COLUMNS).dropDuplicates(COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate(docs.select(COLUMNS), benchmark).where(~F.col("contaminated")).select(COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; each span of personal data is replaced by its kind, and n_chars is the new length."""
    redacted = pii.redact(docs.select(COLUMNS))
    return redacted.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, with digests of the ids and of the bytes that they decode to."""
    ranks = bpe.read_ranks(spark, public_tokenizers.path(TOKENIZER))
    encoded = bpe.encode(docs.select(COLUMNS), ranks, public_tokenizers.PATTERN)
    return bpe.decode(encoded, ranks).select(
        "doc_id", "lang", "source", "n_chars", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("personal data", personal_data),
    ("byte-level BPE", tokens),
]
#: Bootstrapped patterns and ranked merges are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
