"""A cleaning pipeline over ``documents`` whose stages are operators of ``knotwork.llm``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from knotwork.llm import neardup, packing, quality, secret_tags, toxicity
from knotwork.session import written


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the string-kernel machine calls toxic go; it learns from the labelled documents of its input."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, _labels(spark, sf_dir)))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    return quality.drop_poor(docs, quality.train(docs, _labels(spark, sf_dir)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays; five-word shingles that are alike by 0.8 or more link documents too."""
    return neardup.keep_one_of_each_group(docs, similarity=0.8, words=5)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a sign; every document stays."""
    return secret_tags.mask(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as pieces in sequences of at most 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_dedup", near_dedup),
    ("secrets", mask_secrets),
    ("packing", pack),
]

#: Models trained on the data are beyond SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
