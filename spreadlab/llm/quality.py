"""Text quality by voting among the nearest labelled texts in a latent-semantic space.

A text is a bag of terms of two views: its words, and its word shapes (runs of
capitals, small letters and digits stand for themselves, other characters stay)
with pairs of neighbouring shapes, where a word that repeats its predecessor has
a shape of its own.  Terms are hashed into a fixed number of slots, weighted by
logarithmic frequency and inverse document frequency, and each view has unit
length.  A truncated singular value decomposition of a bounded, documented
sample of labelled texts gives the latent space.  The sample's vectors are
broadcast; every document is multiplied with all of them in blocks, and its
nearest ones vote with their cosine as weight.

Edge cases: a NULL or blank text is like no labelled one, so its score is the
share of label 1 in the sample; without a labelled row every score is 0.5.
Rows without label, text or id are not learned from.  Copies of a text enter
the sample once per label, so a group of copies cannot fill it.  Repeated rows
are scored each on its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spreadlab.llm.text import Memo, frames, shared
from spreadlab.session import staged

REPEATED = np.uint64(0x5EED)  # the shape of a word that repeats its predecessor
CLASSES = [(re.compile(p), c) for p, c in ((r"[^\W\d_]+", ""), (r"\d+", "0"), (r"([^\w])\1+", r"\1\1"))]


@dataclass(frozen=True)
class QualityParams:
    rows_per_label: int = 1500   # bound of the training sample, distinct texts per label
    slots: int = 2048            # hashed terms of each view
    rank: int = 96               # dimensions of the latent space
    rounds: int = 8              # of the subspace iteration
    neighbours: int = 15         # voters
    rows_per_block: int = 512    # documents per cosine product


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray          # 2 * slots: inverse document frequencies
    basis: np.ndarray            # 2 * slots x rank
    vectors: np.ndarray          # rank x labelled texts, columns of unit length
    labels: np.ndarray
    params: QualityParams


def shape(word: str) -> str:
    """Runs of capitals, small letters and digits as A, a and 0; runs of another character at most two long."""
    out = CLASSES[0][0].sub(lambda m: "A" if m[0].isupper() else "Aa" if m[0][0].isupper() else "a", word)
    for pattern, to in CLASSES[1:]:
        out = pattern.sub(to, out)
    return out


def hashes(words: list[str]) -> list[tuple[int, int]]:
    """Hash of each word without case, and of its shape."""
    return [(xxhash.xxh64_intdigest(w.lower().encode("utf-8", "surrogatepass")),
             xxhash.xxh64_intdigest(shape(w).encode("utf-8", "surrogatepass"))) for w in words]


def counts(texts: list[str | None], params: QualityParams) -> np.ndarray:
    """Term counts of texts, words in the first half of the slots, shapes and pairs of shapes in the second."""
    memo = shared("quality", lambda: Memo(hashes))
    cut = [t.split() if isinstance(t, str) else [] for t in texts]
    known = memo.holding({w for words in cut for w in words if len(w) <= 64})
    out = np.zeros((len(texts), 2 * params.slots), np.float32)
    slots = np.uint64(params.slots)
    for row, words in zip(out, cut):
        if words:
            pairs = np.array([known[w] if len(w) <= 64 else hashes([w])[0] for w in words], np.uint64)
            word, form = pairs[:, 0], pairs[:, 1].copy()
            form[1:][word[1:] == word[:-1]] = REPEATED
            both = form[:-1] * np.uint64(0x9E3779B97F4A7C15) + form[1:]
            seen = np.r_[word % slots, slots + form % slots, slots + (both ^ (both >> np.uint64(29))) % slots]
            row += np.bincount(seen.astype(np.int64), minlength=len(row))
    return out


def weighted(count: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Logarithmic counts times weights, both views of unit length."""
    out = np.log1p(count) * weights
    for view in np.split(out, 2, axis=1):
        view /= np.maximum(np.sqrt(np.einsum("ij,ij->i", view, view)), 1e-6)[:, None]
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, learn: Column, label: str, params: QualityParams) -> pd.DataFrame:
    """label, slot, count of at most ``rows_per_label`` distinct texts of each label, drawn by a hash of the text.

    Only ids and hashes are joined and ranked; the drawn texts are read afterwards, and
    only their sparse counts (at most two times ``slots`` a text) reach the driver.
    """
    known = labels.where(learn & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).select(
        "doc_id", F.col(label).cast("int").alias("label"))
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", F.col("text").cast("string").alias("text"))
    digests = texts.select("doc_id", F.xxhash64("text").alias("digest"))
    distinct = digests.join(known, "doc_id").groupBy("label", "digest").agg(F.min("doc_id").alias("doc_id"))
    order = Window.partitionBy("label").orderBy(F.xxhash64("digest"), "digest")
    drawn = staged(distinct.withColumn("place", F.row_number().over(order)).where(F.col("place") <= params.rows_per_label), "drawn")

    def sparse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in frames(batches, params.rows_per_block):
            found = [(np.flatnonzero(row), row) for row in counts(part["text"].tolist(), params)]
            yield part[["label", "digest"]].assign(slot=[at for at, _ in found], n=[row[at] for at, row in found])

    chosen = texts.withColumn("digest", F.xxhash64("text")).join(F.broadcast(drawn.select("label", "digest", "doc_id")), ["doc_id", "digest"])
    return chosen.mapInPandas(sparse, "label int, digest long, slot array<int>, n array<float>").toPandas().drop_duplicates(
        ["label", "digest"]).sort_values(["label", "digest"], ignore_index=True)


def train(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality",
          params: QualityParams = QualityParams()) -> QualityModel:
    """Latent space and vectors of the labelled texts for which ``learn`` (over labels) holds."""
    sample = labelled_sample(docs, labels, learn, label, params)
    matrix = np.zeros((len(sample), 2 * params.slots), np.float32)
    for row, at, n in zip(matrix, sample["slot"], sample["n"]):
        row[at] = n
    weights = np.log((1 + len(sample)) / (1 + (matrix > 0).sum(axis=0))).astype(np.float32) + np.float32(0.1)
    matrix = weighted(matrix, weights)
    rank = min(params.rank, *matrix.shape)
    # subspace iteration from a fixed start: only matrices of the sample's size times the rank
    basis = np.random.default_rng(3).standard_normal((matrix.shape[1], rank)).astype(np.float32)
    for _ in range(params.rounds if rank else 0):
        basis, _ = np.linalg.qr(matrix.T @ (matrix @ basis))
    return QualityModel(weights, basis, unit(matrix @ basis).T.copy(), sample["label"].to_numpy(np.float32), params)


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-6)


def votes(texts: list[str | None], model: QualityModel) -> np.ndarray:
    """Score of each text: the share of label 1 among its nearest labelled texts, weighted by cosine."""
    if not len(model.labels):
        return np.full(len(texts), 0.5)
    near = unit(weighted(counts(texts, model.params), model.weights) @ model.basis) @ model.vectors
    k = min(model.params.neighbours, near.shape[1])
    voters = np.argpartition(near, near.shape[1] - k, axis=1)[:, near.shape[1] - k:]
    weight = np.maximum(np.take_along_axis(near, voters, axis=1), 0.0).astype(np.float64)
    total = weight.sum(axis=1)
    share = (weight * model.labels[voters]).sum(axis=1) / np.maximum(total, 1e-9)
    return np.clip(np.where(total > 1e-6, share, model.labels.mean()), 0.0, 1.0)


def score(docs: DataFrame, model: QualityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and score of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = sent.value
        for part in frames(batches, known.params.rows_per_block):
            yield pd.DataFrame({"doc_id": part["id"], "score": votes(part["body"].tolist(), known)})

    source = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("body"))
    return source.mapInPandas(run, "doc_id long, score double")
