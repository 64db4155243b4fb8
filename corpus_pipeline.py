"""From raw documents to token files: quality, near-duplicates, benchmark, mix, tokens.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept.
All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm import decontaminate, mixing, neardup, quality, staging, tokens


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays; links from a similarity of 0.8 on, over shingles of five words."""
    return neardup.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, read back: one row for each document copy."""
    return tokens.encoded(docs, tokens.public_vocabulary()).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality rules", keep_quality),
    ("near-duplicates", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token files", write_tokens),
]

#: Entropy balancing and the token files have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staging.stage(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs.select("doc_id", "start", "n_tokens", F.col("ids_crc32"))
