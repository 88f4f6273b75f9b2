"""Hard-negative mining: for each anchor and positive the best rows of another label within a score window.

Components become integers (floor of 256 times the value) and a score is the
integer inner product.  Anchors and candidates are cut into blocks by a hash of
the row; every block of anchors meets every block of candidates once, and there
the scores are int64 tiles computed by Strassen's recursion on zero-padded
matrices.  Its additions and subtractions are exact in 64-bit integers, and
since they wrap around like the products, a score is right whenever it fits 64
bits, whatever the sums in between.

Two passes: the first keeps a bounded heap of positives per anchor (tiles join
only rows of equal label), the second a bounded heap per anchor, positive and
window.  Heaps of different tiles and blocks merge by keeping the first of
their union, so neither a frequent label nor a frequent vector makes a group
larger than a block.

Edge cases: rows with a NULL id, label or vector, or a NULL or non-finite
component take no part.  Vectors of different length share the components both
have; the others count as zero, and an empty vector scores zero with all.  Rows
that bear the anchor's id are not its positives or negatives; repeated rows are
rows of their own, as anchors, positives and negatives.  An anchor without
positives, or a positive without rows in its window, gives no rows; so does an
empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spreadlab.session import staged


@dataclass(frozen=True)
class MiningParams:
    positives: int = 5
    negatives: int = 3
    low_percent: int = 50        # a negative's score is at least this share of the positive's
    high_percent: int = 95       # and at most this one
    scale: int = 256
    anchor_block: int = 8192     # rows of a block, which is what one task holds
    candidate_block: int = 8192
    tile: int = 256              # anchors scored against a block at once
    leaf: int = 32               # recursion ends when a side would fall below


def padded(matrix: np.ndarray, rows: int, columns: int) -> np.ndarray:
    """The matrix with zeros added up to the given sides."""
    if matrix.shape == (rows, columns):
        return matrix
    out = np.zeros((rows, columns), np.int64)
    out[:matrix.shape[0], :matrix.shape[1]] = matrix
    return out


def strassen(a: np.ndarray, b: np.ndarray, levels: int) -> np.ndarray:
    """Product of int64 matrices whose sides are multiples of ``2 ** levels``, by seven half-sized products a level."""
    if levels == 0:
        return a @ b
    m, k, n = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    down = levels - 1
    out = np.empty((2 * m, 2 * n), np.int64)
    c11, c12, c21, c22 = out[:m, :n], out[:m, n:], out[m:, :n], out[m:, n:]
    p = strassen(a11 + a22, b11 + b22, down)
    c11[:], c22[:] = p, p
    p = strassen(a21 + a22, b11, down)
    c21[:] = p
    c22 -= p
    p = strassen(a11, b12 - b22, down)
    c12[:] = p
    c22 += p
    p = strassen(a22, b21 - b11, down)
    c11 += p
    c21 += p
    p = strassen(a11 + a12, b22, down)
    c11 -= p
    c12 += p
    c22 += strassen(a21 - a11, b11 + b12, down)
    c11 += strassen(a12 - a22, b21 + b22, down)
    return out


def product(a: np.ndarray, b: np.ndarray, leaf: int) -> np.ndarray:
    """``a @ b`` for int64 matrices of any sides, padded to what the recursion needs."""
    sides = (a.shape[0], a.shape[1], b.shape[1])
    if not min(sides):
        return np.zeros((sides[0], sides[2]), np.int64)
    levels = 0
    while min(sides) >> (levels + 1) >= leaf:
        levels += 1
    m, k, n = (-(-side // (1 << levels)) << levels for side in sides)
    return strassen(padded(a, m, k), padded(b, k, n), levels)[:sides[0], :sides[2]]


def integers(vectors: pd.Series, width: int, scale: int) -> np.ndarray:
    """Rows of integer components, cut or filled with zeros to ``width``."""
    out = np.zeros((len(vectors), width), np.int64)
    for row, vector in zip(out, vectors):
        value = np.floor(scale * np.asarray(vector, np.float64)[:width])
        row[:len(value)] = np.clip(value, -2.0 ** 63, 2.0 ** 63 - 1024)
    return out


def first(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, the highest first, equal ones in the given order."""
    at = np.arange(len(scores))
    if len(at) > k:
        at = np.flatnonzero(scores >= np.partition(scores, len(at) - k)[len(at) - k])
    return at[np.argsort(-scores[at], kind="stable")][:k]


class Block:
    """The candidates of a block in the order of their ids, which settles ties."""

    def __init__(self, rows: pd.DataFrame, width: int, params: MiningParams) -> None:
        rows = rows.sort_values("vec_id", kind="stable")
        self.ids, self.labels = rows["vec_id"].to_numpy(np.int64), rows["label"].to_numpy()
        self.columns = np.ascontiguousarray(integers(rows["vector"], width, params.scale).T)


def slices(anchors: pd.DataFrame, rows: int) -> Iterator[pd.DataFrame]:
    for at in range(0, len(anchors), rows):
        yield anchors.iloc[at:at + rows]


def positive_heaps(anchors: pd.DataFrame, candidates: pd.DataFrame, params: MiningParams) -> pd.DataFrame:
    """The block's first positives of each anchor; tiles are of one label."""
    width = max([*map(len, anchors["vector"]), 0])
    block = Block(candidates, width, params)
    found = []
    for label, alike in anchors.groupby("label", sort=False):
        at = np.flatnonzero(block.labels == label)
        if not len(at):
            continue
        ids, columns = block.ids[at], np.ascontiguousarray(block.columns[:, at])
        for part in slices(alike, params.tile):
            scores = product(integers(part["vector"], width, params.scale), columns, params.leaf)
            for row, anchor, score in zip(part["row"], part["vec_id"], scores):
                others = np.flatnonzero(ids != anchor)
                best = others[first(score[others], params.positives)]
                found.append(pd.DataFrame({"row": row, "positive_id": ids[best], "positive_score": score[best]}))
    return pd.concat(found, ignore_index=True) if found else pd.DataFrame(
        {"row": [], "positive_id": [], "positive_score": []}).astype("int64")


def window_heaps(anchors: pd.DataFrame, candidates: pd.DataFrame, params: MiningParams) -> pd.DataFrame:
    """The block's first negatives in the window of each anchor and positive."""
    width = max([*map(len, anchors["vector"]), 0])
    block = Block(candidates, width, params)
    keys, ids, scores = [], [], []
    for part in slices(anchors, params.tile):
        tile = product(integers(part["vector"], width, params.scale), block.columns, params.leaf)
        for row, anchor, label, positives, score in zip(part["row"], part["vec_id"], part["label"], part["positives"], tile):
            others = np.flatnonzero((block.labels != label) & (block.ids != anchor))
            score = score[others]
            for p in positives:
                bar = int(p["positive_score"])
                # whole bounds of low * p <= 100 * s <= high * p
                least, most = -((-params.low_percent * bar) // 100), (params.high_percent * bar) // 100
                inside = np.flatnonzero((score >= least) & (score <= most))
                if len(inside):
                    best = inside[first(score[inside], params.negatives)]
                    keys += [(row, anchor, p["place"], p["positive_id"], bar)] * len(best)
                    ids.append(block.ids[others[best]])
                    scores.append(score[best])
    out = pd.DataFrame(keys, columns=["row", "anchor_id", "place", "positive_id", "positive_score"], dtype="int64")
    return out.assign(negative_id=np.concatenate(ids) if ids else np.zeros(0, np.int64),
                      negative_score=np.concatenate(scores) if scores else np.zeros(0, np.int64))


def usable(vectors: DataFrame, row_id: str, vector: str, label: str) -> DataFrame:
    """vec_id, label, vector of the rows that take part."""
    fine = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(
        F.col(row_id).cast("long").alias("vec_id"), F.col(label).alias("label"),
        F.when(fine, F.col(vector)).alias("vector")).dropna()


def mine(vectors: DataFrame, is_anchor: Column, row_id: str = "vec_id", vector: str = "embedding", label: str = "label",
         params: MiningParams = MiningParams()) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; ``is_anchor`` is over vec_id and label."""
    numbered = usable(vectors, row_id, vector, label).withColumn("row", F.monotonically_increasing_id())
    rows = staged(numbered.withColumn("anchor", F.coalesce(is_anchor, F.lit(False))), "vectors")
    counts = rows.agg(F.count("*").alias("n"), F.count_if("anchor").alias("anchors")).first()
    a_blocks = max(1, -(-counts["anchors"] // params.anchor_block))
    c_blocks = max(1, -(-counts["n"] // params.candidate_block))

    def meeting(anchors: DataFrame):
        """Every block of anchors beside every block of candidates."""
        left = anchors.withColumn("a", F.pmod(F.xxhash64("row"), F.lit(a_blocks)).cast("int")).withColumn(
            "c", F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1))))
        right = rows.select("vec_id", "label", "vector", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(c_blocks)).cast("int").alias("c"),
                            F.explode(F.sequence(F.lit(0), F.lit(a_blocks - 1))).alias("a"))
        return left.groupBy("a", "c").cogroup(right.groupBy("a", "c"))

    def merged(heaps: DataFrame, keys: list[str], name: str, keep: int, place: str) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc(f"{name}_score"), f"{name}_id")
        return heaps.withColumn(place, F.row_number().over(order)).where(F.col(place) <= keep)

    asking = rows.where("anchor").select("row", "vec_id", "label", "vector")
    heaps = meeting(asking).applyInPandas(
        lambda left, right: positive_heaps(left, right, params), "row long, positive_id long, positive_score long")
    positives = merged(heaps, ["row"], "positive", params.positives, "place").groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("positives"))
    paired = staged(asking.join(positives, "row"), "anchors")
    heaps = meeting(paired).applyInPandas(
        lambda left, right: window_heaps(left, right, params),
        "row long, anchor_id long, place long, positive_id long, positive_score long, negative_id long, negative_score long")
    return merged(heaps, ["row", "place"], "negative", params.negatives, "rank").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike,
         CAST(list_sum(list_transform(list_zip(a.w, c.w), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
