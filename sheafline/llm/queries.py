"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, hard_negatives, licenses, long_repeats, mixing, near_copies, neighbours, packing, phrases, pii, quality, secrets, toxicity
from .common import table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op3_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies.near_copies(table(spark, sf_dir, "documents"))


def op4_long_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return long_repeats.long_repeats(table(spark, sf_dir, "documents")).drop("spans", "passages")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_texts(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.drawn(table(spark, sf_dir, "documents"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_digests(table(spark, sf_dir, "documents"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents")).drop("found")


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents")).drop("found")


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.top_phrases(phrases.phrases(table(spark, sf_dir, "documents")))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality, op2_neighbours, op3_near_copies, op4_long_repeats, op5_toxicity, op6_licenses, op7_mixing, op8_byte_bpe, op9_secrets, op10_personal_data, op11_packing, op12_phrases, op13_hard_negatives)}


def oracle_sql() -> dict[str, str]:
    return {"op1_quality": quality.oracle(), "op6_licenses": licenses.oracle(), "op12_phrases": phrases.oracle(), "op13_hard_negatives": hard_negatives.oracle()}
