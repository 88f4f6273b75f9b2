from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from spreadlab.llm import negatives
from spreadlab.llm.negatives import MiningParams

SCHEMA = "vec_id long, embedding array<float>, label int"
COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def brute(rows):
    good = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows
            if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, w, label in good:
        if a % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(w, u)), i, other) for i, u, other in good if i != a)
        for p, positive, _ in [s for s in scored if s[2] == label][:5]:
            inside = [(s, i) for s, i, other in scored if other != label and 50 * -p <= 100 * -s <= 95 * -p][:3]
            out += [(a, positive, rank, i, -p, -s) for rank, (s, i) in enumerate(inside, 1)]
    return sorted(out)


def mined(df, **params):
    return sorted(tuple(r[c] for c in COLUMNS) for r in negatives.mine(df, F.col("vec_id") % 50 == 0, **params).collect())


@pytest.mark.parametrize("m,k,n", [(1, 1, 1), (64, 64, 64), (65, 33, 70), (3, 200, 131), (0, 5, 4), (128, 0, 64)])
def test_products_are_exact(m, k, n):
    rng = np.random.default_rng(m + k + n)
    a, b = rng.integers(-2 ** 28, 2 ** 28, (m, k)), rng.integers(-2 ** 28, 2 ** 28, (k, n))
    assert (negatives.product(a, b, 8) == a @ b).all()


def test_sums_may_wrap_around_as_long_as_the_result_fits():
    a = np.full((16, 16), 2 ** 61, np.int64)
    assert (negatives.product(a, np.eye(16, dtype=np.int64), 4) == a).all()


@pytest.mark.parametrize("params", [MiningParams(), MiningParams(anchor_block=2, candidate_block=9, tile=2, leaf=2)])
def test_brute_force_with_ties_and_unusable_rows(spark, params):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(-3, 9, 6) / 8], int(rng.integers(0, 4))) for i in range(260)]
    rows[100] = (100, rows[50][1], 2)  # ties
    rows += [(300, None, 1), (301, [0.5] * 6, None), (302, [None] * 6, 1), (303, [float("nan")] * 6, 1),
             (304, [float("inf")] + [0.0] * 5, 1), (None, [1.0] * 6, 1), (305, [1.0, 1.0], 1), (306, [], 2)]
    assert mined(spark.createDataFrame(rows, SCHEMA), params=params) == brute(rows)


def test_a_frequent_vector_and_repeated_rows(spark):
    rows = [(i, [0.5, 0.25], i % 2) for i in range(150)] + [(0, [0.5, 0.25], 0)] * 2 + [(151 + i, [0.4, 0.2 + i / 100], 1) for i in range(6)]
    assert mined(spark.createDataFrame(rows, SCHEMA), params=MiningParams(candidate_block=16)) == brute(rows)


def test_own_names_extra_columns_and_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], "x", 7), (1, [1.0, 0.0], "x", 7), (2, [0.75, 0.0], "y", 7)],
                               "id long, v array<double>, kind string, row int").withColumn("anchor", F.lit(1)).withColumn("a", F.lit(1))
    found = negatives.mine(df, F.col("vec_id") == 0, "id", "v", "kind").collect()
    assert [tuple(r) for r in found] == [(0, 1, 1, 2, 65536, 49152)]
    assert mined(spark.createDataFrame([], SCHEMA)) == []
    lonely = spark.createDataFrame([(0, [1.0], 1), (1, [1.0], 2)], SCHEMA)
    assert mined(lonely) == []


def test_blocks_not_labels_make_the_groups(spark, plan):
    rows = [(i, [float(i % 7)], 0) for i in range(100)]
    text = plan(negatives.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0))
    assert "FlatMapCoGroupsInPandas" in text and "WindowGroupLimit" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
