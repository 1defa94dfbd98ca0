"""Corpus pipeline over ``documents``: each stage is one of the training-data operators."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from occuspark.llm import mixing, neardup, packing, quality, toxicity
from occuspark.llm.common import held_out, read, release
from occuspark.session import ensure_checkpoint_dir


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores 0.3 or more."""
    model = quality.fit_labels(docs, read(spark, sf_dir, "labels"), ~held_out(5, 0))
    return quality.kept(docs, model, 0.3)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon scores under 0.7."""
    release(spark)  # what the stage before has left in the driver
    model = toxicity.fit_labels(docs, read(spark, sf_dir, "labels"), ~held_out(3, 1))
    return toxicity.kept(docs, model, 0.7)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the smallest id."""
    release(spark)  # what the stage before has left in the driver
    return neardup.representatives(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that the sources' words come near their targets."""
    release(spark)  # what the stage before has left in the driver
    return mixing.copies(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack every remaining document into sequences of 2048 tokens."""
    release(spark)  # what the stage before has left in the driver
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), 2048, 0)


STAGES = [("quality", keep_quality), ("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates),
          ("mixing", mix_sources), ("packing", pack_sequences)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written to the shared folder and read again."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            path = f"{base}/{k}-{name}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
