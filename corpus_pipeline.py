"""Documents to packed training sequences, in five stages.

Each stage works on all that the one before it kept; what it wrote is read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from nightfolio.llm import decontaminate, jaccard_join, languages, packing, pii
from nightfolio.llm.common import stored, tuned


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a language."""
    tuned(spark)
    return languages.keep_identified(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    tuned(spark)
    return jaccard_join.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold benchmark passages."""
    return decontaminate.keep_clean(docs, tuned(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts."""
    tuned(spark)
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the texts in sequences."""
    tuned(spark)
    return packing.packed(docs)


STAGES = [
    ("language", identify),
    ("near_duplicates", deduplicate),
    ("decontamination", decontaminated),
    ("personal_data", redact),
    ("packing", pack),
]

#: The stages learn and iterate; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
