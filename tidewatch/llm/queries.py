"""Registered queries of the llm operators: (spark, sf_dir) -> DataFrame over
the whole tables, with production parameters, and their DuckDB SQL."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import bpe, chat, fim, katz, licenses, merkle, packing, passages, pii, quality, secrets, simhash, winnow
from tidewatch.llm.sql import ORACLE_SQL  # noqa: F401
from tidewatch.session import ensure_checkpoint_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_secret_scan(spark, sf_dir):
    return secrets.secret_report(_table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark, sf_dir):
    return passages.passage_report(_table(spark, sf_dir, "documents"))


def op3_packing(spark, sf_dir):
    return packing.pack(_table(spark, sf_dir, "documents"))


def op4_pii(spark, sf_dir):
    return pii.pii_report(_table(spark, sf_dir, "documents"))


def op5_license_scan(spark, sf_dir):
    return licenses.license_report(_table(spark, sf_dir, "documents"), spark)


def op6_chat_format(spark, sf_dir):
    return chat.chat_report(_table(spark, sf_dir, "conversations"))


def op7_simhash_near_dedup(spark, sf_dir):
    return simhash.simhash_report(_table(spark, sf_dir, "documents"))


def op8_katz_scores(spark, sf_dir):
    return katz.katz_report(_table(spark, sf_dir, "documents"))


def op9_decontamination(spark, sf_dir):
    return winnow.decontamination_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_quality_rules(spark, sf_dir):
    return quality.quality_report(_table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark, sf_dir):
    return merkle.manifest_report(_table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark, sf_dir):
    return fim.fim_report(_table(spark, sf_dir, "documents"))


def op13_bpe(spark, sf_dir):
    return bpe.bpe_report(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_substring_dedup, op3_packing, op4_pii, op5_license_scan, op6_chat_format,
    op7_simhash_near_dedup, op8_katz_scores, op9_decontamination, op10_quality_rules,
    op11_merkle_manifest, op12_fill_in_middle, op13_bpe)}
