"""The training-data pipeline over ``documents``: five stages, each written and read again.

1. language: compression classification; texts that it rejects go.
2. exact duplicates: of equal texts (A-Z lower-cased), the one with the largest id stays.
3. near-duplicates: of each group linked by 5-word shingles at 80 %, the one with the least id stays.
4. secrets: every span found, also below layers of encoding, is masked; ``n_chars`` follows the text.
5. packing: documents in length buckets and token-budget batches.

All stages but the last return the columns they got. Rows without an id pass
all stages; null texts go in the first stage, as they have no language.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from claimloom.llm import exact_dedup, language, near_dedup, packing, secret_scan
from claimloom.staging import stage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    samples = language.language_samples(docs, "lang", "text")
    return language.drop_rejected(docs, samples, "text")


def drop_exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_duplicates(docs, "doc_id", "text")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_duplicates(docs, "doc_id", "text")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keep = {f"c{i}": docs[c] for i, c in enumerate(docs.columns) if c != "text"}
    masked = secret_scan.mask_secrets(docs, "text", keep)
    columns = {c: F.col("masked" if c == "text" else f"c{i}") for i, c in enumerate(docs.columns)}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("n_secrets") > 0, F.length("masked")).otherwise(columns["n_chars"])
    return masked.select(*[column.alias(c) for c, column in columns.items()])


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, "doc_id")


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_exact_duplicates),
    ("near_dedup", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("packing", pack_batches),
]

# Compression and layered decoding cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
