"""A query whose id is repeated still finds its true neighbours."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_tables import brute_topk
from tideline.llm import topk


@pytest.mark.parametrize("spread", [0.0, 40.0])
def test_repeated_query_ids(spark, spread):
    """Copies near one pivot, and copies in several cells."""
    rng = np.random.default_rng(8)
    rows = [(0, [100.0 - spread * (k % 3), 0.0, spread * (k % 2)]) for k in range(12)] if spread else [(0, [100.0, 0.0, 0.0])] * 12
    rows += [(k, [float(x) for x in rng.normal(size=3) + [10 * (k % 4), 5, 0]]) for k in range(1, 60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, topk.search(df, F.col("id") == 0, pivots=24).collect()))
    if spread:  # which of the differing rows of an id is asked is free
        wants = [brute_topk([r for r in rows[:12] if r == one][:1] + rows[12:], 5, 1000) for one in rows[:12]]
        assert got in wants
    else:
        assert got == brute_topk(rows, 5, 1000)
