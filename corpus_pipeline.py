"""A training-corpus pipeline: each stage applies one operator to what the stage before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tideline.llm import packing
from tideline.llm.common import clean_up, materialise, table, written
from tideline.llm.exact_dedup import drop_duplicates
from tideline.llm.quality import drop_poor, fit_quality
from tideline.llm.queries import tokenizer_file
from tideline.llm.simhash import drop_similar
from tideline.llm.toxicity import drop_toxic, fit_toxicity


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return drop_poor(docs, model)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity tagger does not reject."""
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return drop_toxic(docs, model)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, the one with the largest doc_id."""
    return drop_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest doc_id.

    Near: five-word shingle sets of similarity 0.8 or more. The fingerprint index (``op3_simhash``'s, spanning forests and
    star contraction) classes the documents; sets are compared within classes, and across them for the pairs it cannot reach.
    """
    return drop_similar(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: pieces with their token ids.

    Fewer words are remembered than alone, as the stages before leave executors with larger heaps.
    """
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"), cache_bytes=88 << 20)


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("packing", packing_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read again.

    What a stage has written for itself is deleted as soon as its result is.
    """
    docs = table(spark, sf_dir, "documents")
    before = written()
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, name)
            clean_up(spark, before, keep=docs)
    return docs
