"""A corpus cleaning pipeline over ``documents`` made of the llm operators.

Each stage takes (spark, docs, sf_dir), works on everything its predecessor
kept, and returns the columns of documents; the last returns packed sequences.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import packing, pii, quality, simhash, winnow
from tidewatch.session import ensure_checkpoint_dir, shared_path

SHINGLE, MAX_BITS = 3, 2  # of the SimHash contract


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: rejected documents go."""
    return quality.quality_filter(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: one document of each near-duplicate class stays."""
    return simhash.drop_near_duplicates(docs, SHINGLE, MAX_BITS)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that hold a benchmark window go."""
    return winnow.drop_contaminated(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: personal data and disclosing terms are replaced."""
    return pii.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: sequences with their bucket, batch and slot."""
    return packing.pack(docs)


STAGES = [("quality_rules", quality_stage), ("simhash_near_dedup", simhash_stage), ("decontamination", decontaminate_stage),
          ("pii", pii_stage), ("packing", packing_stage)]
# SimHash needs XXH64 with a seed, which DuckDB lacks; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents.

    What a stage keeps is written as Parquet to a folder of this run in the
    shared folder and read again, so no stage is computed twice and a lost
    executor costs no earlier stage.  The folders stay until that folder is cleared.
    """
    ensure_checkpoint_dir(spark)
    folder = shared_path(spark, f"pipeline-{uuid.uuid4().hex}")
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
