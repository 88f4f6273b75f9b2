"""Exact top-k search by inner product, term at a time.

Components become integers (floor of 256 times the value).  Candidates are cut
into blocks by hash, queries too, and every block of queries meets every block
of candidates once.  There each dimension is a term: its posting list is the
candidates with a non-zero component, and each query with a non-zero weight
scatters weight times posting into its dense score array.  A partition
selection keeps the k best of the block, ties by the smaller id, and the
blocks' winners are merged.

Vectors that are NULL or hold a NULL or non-finite component take no part, on
either side.  Vectors of different length share the terms they both have; the
others count as zero.  Repeated ids are rows of their own; a query leaves out
the rows that bear its own id.  No candidates: no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spreadlab.session import staged


@dataclass(frozen=True)
class SearchParams:
    k: int = 5
    scale: int = 256
    query_block: int = 8192      # rows of a block, of which one task holds one of either side
    candidate_block: int = 8192
    queries_at_once: int = 256   # score arrays that are dense at a time


def weighted_rows(vectors: DataFrame, row_id: str, vector: str, scale: int) -> DataFrame:
    """vec_id, w: the integer components of the vectors that take part."""
    value = F.col(vector).cast("array<double>")
    fine = F.coalesce(F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    return vectors.where(F.col(row_id).isNotNull()).select(F.col(row_id).cast("long").alias("vec_id"), F.when(
        fine, F.transform(value, lambda x: F.floor(F.lit(float(scale)) * x))).alias("w")).where(F.col("w").isNotNull())


def dense(weights: pd.Series, terms: int) -> np.ndarray:
    """Rows of integer weights, cut or filled with zeros to ``terms``."""
    out = np.zeros((len(weights), terms), np.int64)
    for row, w in zip(out, weights):
        some = w[:terms]
        row[:len(some)] = some
    return out


def best_of_block(queries: pd.DataFrame, candidates: pd.DataFrame, k: int, at_once: int = 256) -> pd.DataFrame:
    """The k best candidates of one block for each query of one block, some queries at a time."""
    terms = max([*map(len, queries["w"]), 0])
    candidates = candidates.sort_values("vec_id", kind="stable")
    ids = candidates["vec_id"].to_numpy(np.int64)
    weights = dense(candidates["w"], terms)
    postings = [np.flatnonzero(weights[:, term]) for term in range(terms)]
    impacts = [weights[posting, term] for term, posting in enumerate(postings)]
    found = []
    for start in range(0, len(queries), at_once):
        some = queries.iloc[start:start + at_once]
        asked, scores = dense(some["w"], terms), np.zeros((len(some), len(ids)), np.int64)
        for term, (posting, impact) in enumerate(zip(postings, impacts)):
            if not len(posting):
                continue
            for q in np.flatnonzero(asked[:, term]):  # scatter the weighted posting list into the query's score array
                if len(posting) == len(ids):
                    scores[q] += asked[q, term] * impact
                else:
                    scores[q, posting] += asked[q, term] * impact
        for query, number, row in zip(some["vec_id"], some["q_row"], scores):
            at = np.flatnonzero(ids != query)
            if len(at) > k:
                bar = np.partition(row[at], len(at) - k)[len(at) - k]
                at = at[row[at] >= bar]
                at = at[np.argsort(-row[at], kind="stable")][:k]  # ids ascend, so a stable sort settles ties
            found.append(pd.DataFrame({"query_id": query, "q_row": number, "vec_id": ids[at], "score": row[at]}))
    return pd.concat(found, ignore_index=True)


def top_k(vectors: DataFrame, is_query: Column, row_id: str = "vec_id", vector: str = "embedding",
          params: SearchParams = SearchParams()) -> DataFrame:
    """query_id, rank, vec_id, score of the rows for which ``is_query`` holds, against all others."""
    rows = staged(weighted_rows(vectors, row_id, vector, params.scale), "weighted")
    asking = staged(rows.where(is_query).withColumn("q_row", F.monotonically_increasing_id()), "asking")
    q_blocks = max(1, -(-asking.count() // params.query_block))
    c_blocks = max(1, -(-rows.count() // params.candidate_block))
    q = asking.withColumn("q", F.pmod(F.xxhash64("q_row"), F.lit(q_blocks)).cast("int")).withColumn(
        "c", F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1))))
    c = rows.withColumn("c", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(c_blocks)).cast("int")).withColumn(
        "q", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))

    def block(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "q_row": [], "vec_id": [], "score": []}).astype("int64")
        return best_of_block(left, right, params.k, params.queries_at_once)

    schema = "query_id long, q_row long, vec_id long, score long"
    winners = q.groupBy("q", "c").cogroup(c.groupBy("q", "c")).applyInPandas(block, schema)
    order = Window.partitionBy("query_id", "q_row").orderBy(F.desc("score"), "vec_id")
    return (winners.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= params.k)
            .select("query_id", "rank", "vec_id", "score"))


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""
