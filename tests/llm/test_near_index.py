"""The pipeline's near stage links through the fingerprint index; shared shingles are for pairs across its classes."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_similar import brute_classes, found, pairs
from tideline.llm import simhash
from tideline.llm.shingles import FOLD_AZ, clean_words, majority_bits, shingle_hashes


def print_of(words):
    hashes, counts = shingle_hashes(*clean_words(pa.array([" ".join(words)]), FOLD_AZ), simhash.SHINGLE_WORDS)
    return int(majority_bits(hashes, counts)[0])


def test_near_stage_uses_the_index(spark, monkeypatch):
    rng, seen = np.random.default_rng(3), []
    base = [f"w{i}" for i in rng.integers(0, 4000, 1000)]
    near = next(x for x in ([*base[:k], f"x{k}", *base[k + 1 : -1]] for k in range(500)) if 0 < bin(print_of(x) ^ print_of(base)).count("1") <= 2)
    docs = {1: base, 2: near, 3: [f"v{i}" for i in rng.integers(0, 4000, 300)]}
    links = simhash.links

    def spy(items, distance=simhash.MAX_DISTANCE, *rest):
        out = links(items, distance, *rest)
        seen.append((distance, out.count() > 0))
        return out

    monkeypatch.setattr(simhash, "links", spy)
    df = spark.createDataFrame([(d, " ".join(w)) for d, w in docs.items()], "doc_id long, text string")
    kept = {r["doc_id"] for r in corpus_pipeline.near_stage(spark, df, "").collect()}
    assert kept == {1, 3} and seen == [(2, True)]


@pytest.mark.parametrize("one_class", [True, False])
def test_classes_of_the_index_lose_and_add_no_pair(spark, monkeypatch, one_class):
    """All rows in one class, or every row alone: the links are those of brute force."""
    docs = dict(list(pairs().items())[:80])

    def label(prints, distance):
        least = prints.agg(F.min("id")).first()[0]
        return prints.withColumn("component_id", F.lit(least) if one_class else F.col("id"))

    monkeypatch.setattr(simhash, "_label", label)
    assert found(spark, docs) == brute_classes(docs)
