"""Corpus pipeline: toxicity, near copies, secrets, mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents. Toxic documents go; one document of each class of near
copies stays; secrets are masked in the texts; the mixture holds documents once for each draw (a document that crosses its
source's quota holds its first words); the last stage gives doc_id, n_tokens, and digests of the ids and of the bytes decoded
from them. Empty input goes through all stages and gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.llm import byte_bpe, common, mixing, near_copies, secrets, toxicity
from sheafline.llm.common import columns, table, written


def _as_documents(found: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of documents; n_chars follows the text where it is there."""
    if "n_chars" in like.columns:
        found = found.withColumn("n_chars", F.length("text").cast(like.schema["n_chars"].dataType))
    return found.select(*columns(like))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model).select(*columns(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_copies.drop_near_copies(docs).select(*columns(docs))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _as_documents(secrets.redact(docs), docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _as_documents(mixing.mixture(docs), docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_digests(docs)


STAGES = [("toxicity", drop_toxic), ("near copies", drop_near_copies), ("secrets", mask_secrets), ("mixing", mix), ("byte-level BPE", encode)]
#: The fitted model, MinHash and BPE are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        before = len(common.TABLES)
        docs = written(stage(spark, docs, sf_dir), f"stage-{k}")
        # the stage's own tables, and the stage before, are not needed any more
        common.remove_tables(spark, max(0, before - (k > 0)))
    return docs
