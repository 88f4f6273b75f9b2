from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from spreadlab.llm import topk
from spreadlab.llm.topk import SearchParams

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k=5):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, w in good:
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(w, u)), i) for i, u in good if i != q)[:k]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)]
    return sorted(out)


@pytest.mark.parametrize("params", [SearchParams(), SearchParams(query_block=2, candidate_block=7), SearchParams(queries_at_once=2)])
def test_brute_force_with_ties_and_bad_vectors(spark, params):
    rows = [(i, [((i * 7 + d * 13) % 5 - 2) / 4 for d in range(6)]) for i in range(230)]
    rows[50] = (50, [0.0] * 6)
    rows += [(300, None), (301, [None] * 6), (302, [float("nan")] * 6), (303, [float("inf")] + [0.0] * 5), (None, [1.0] * 6), (350, [])]
    found = topk.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0, params=params)
    want = [r for r in brute(rows) if r[0] != 350]
    got = sorted(tuple(r) for r in found.collect())
    assert [r for r in got if r[0] != 350] == want


def test_few_and_no_rows(spark):
    two = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 4.0])], SCHEMA)
    assert [tuple(r) for r in topk.top_k(two, F.col("vec_id") % 50 == 0).collect()] == [(0, 1, 1, 256 * 256 * 11)]
    none = spark.createDataFrame([], SCHEMA)
    assert topk.top_k(none, F.col("vec_id") % 50 == 0).count() == 0
