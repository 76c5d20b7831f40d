"""A training-corpus pipeline: quality, toxicity, near-duplicates, mixing, packing. Each stage reads its predecessor's rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import jaccard_join, mixing, packing, quality, toxicity
from tidemark.llm.batches import hand_back
from tidemark.llm.names import free_prefix
from tidemark.sources.work import Scratch

MINIMUM_QUALITY, TOXIC_FROM, MIX_BUDGET = 0.5, 0.7, 0.8


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior probability of good quality is at least ``MINIMUM_QUALITY``."""
    model = quality.fit_evidence(docs, _labels(spark, sf_dir))
    return quality.quality_posterior(docs, model).where(F.col(f"{free_prefix(docs)}quality") >= MINIMUM_QUALITY).select(*docs.columns)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below ``TOXIC_FROM``."""
    index = toxicity.fit_index(docs, _labels(spark, sf_dir))
    return toxicity.toxicity(docs, index).where(F.col(f"{free_prefix(docs)}toxicity") < TOXIC_FROM).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar texts (5-word shingles, 0.8 or more): the one that names the class."""
    hand_back()  # the driver held the toxicity index
    return jaccard_join.one_per_class(docs, width=5, num=80, den=100)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by their calibrated probabilities."""
    hand_back()
    return mixing.mixing_probabilities(docs, budget=MIX_BUDGET).where(F.col(f"{free_prefix(docs)}drawn")).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048, as pieces."""
    import public_tokenizers

    return packing.pack(docs, str(public_tokenizers.path("word_bpe_49k.json")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("toxicity", toxicity_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("mixing sources to target weights", mixing_stage),
    ("packing", packing_stage),
]
#: Similarity classes, model scores and token ids cannot be written in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark), None
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = scratch.write(docs)
            docs = spark.read.schema(docs.schema).parquet(path)
            if before:  # a stage reads its predecessor's table only
                scratch.drop(before)
            before = path
    return docs
