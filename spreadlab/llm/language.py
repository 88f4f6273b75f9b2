"""Language identification with a string kernel.

A text is the set of its byte n-grams of one to three bytes (a blended
spectrum, presence only), hashed into a fixed number of slots.  The kernel of
two texts is the cosine of their presence vectors.  A bounded, documented
sample of labelled rows gives Nyström landmarks and the targets of one ridge
regression per language (one against the rest); scoring a text is one product
of presence rows with the landmark matrix and one with the folded weights.

Edge cases: a text that is NULL or has no letter is ``und`` with score 0; rows
without language are not learned from; without any labelled row every text is
``und``.  Repeated rows are predicted each on its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spreadlab.llm.text import frames, shared
from spreadlab.session import staged

UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageParams:
    slots: int = 8192            # hashed n-gram slots, a multiple of 8
    orders: tuple[int, ...] = (1, 2, 3)
    rows_per_language: int = 400  # bound of the training sample, distinct texts per language
    sample_rows: int = 20_000     # and in all
    landmarks: int = 96          # in all, evenly from the languages
    ridge: float = 1e-2
    rows_per_block: int = 128    # texts per matrix product


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    landmarks: np.ndarray        # slots x landmarks, columns of unit length
    weights: np.ndarray          # landmarks x languages: Nyström map and ridge weights folded into one
    params: LanguageParams


def presence(texts: list[str], params: LanguageParams) -> np.ndarray:
    """0/1 matrix of texts and n-gram slots."""
    out = np.zeros((len(texts), params.slots), np.bool_)
    for row, text in zip(out, texts):
        data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
        code = np.zeros(len(data), np.uint32)
        for order in range(1, max(params.orders) + 1):
            if len(data) < order:
                break
            code = code[:len(data) - order + 1] * np.uint32(257) + data[order - 1:] + np.uint32(1)
            if order in params.orders:
                row[((code * np.uint32(2654435761)) >> np.uint32(8)) % np.uint32(params.slots)] = True
    return out


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    dense = matrix.astype(np.float32)
    return dense / np.maximum(np.sqrt(dense.sum(axis=1, keepdims=True)), 1e-6)


def labelled_sample(docs: DataFrame, learn: Column, params: LanguageParams) -> pd.DataFrame:
    """Presence bits and language of at most ``rows_per_language`` distinct texts of each language, ``sample_rows`` in all.

    A hash of the text decides, so the sample depends neither on partitions nor
    on ids, and copies of a text are one of them.  The bounds hold before anything is
    collected: hashes are ranked first, and only the packed bits (``slots / 8`` bytes a row) of the texts
    drawn reach the driver.
    """
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        F.col("lang").cast("string").alias("lang"), "text", F.xxhash64("text").alias("digest"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("digest"), "digest")
    ranked = rows.groupBy("lang", "digest").agg(F.lit(1)).select("lang", "digest", F.row_number().over(order).alias("place"))
    # were there very many languages, each would still have its first texts in the sample
    drawn = staged(ranked.where(F.col("place") <= params.rows_per_language)
                   .orderBy("place", F.xxhash64("lang"), "lang").limit(params.sample_rows).select("lang", "digest"), "drawn")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in frames(batches, params.rows_per_block):
            bits = np.packbits(presence(part["text"].tolist(), params), axis=1)
            yield pd.DataFrame({"lang": part["lang"].to_numpy(), "bits": [b.tobytes() for b in bits]})

    texts = rows.join(F.broadcast(drawn), ["lang", "digest"]).groupBy("lang", "digest").agg(F.min("text").alias("text"))
    sample = texts.select("lang", "text").mapInPandas(pack, "lang string, bits binary").toPandas()
    return (sample.sort_values(["lang", "bits"]).groupby("lang", group_keys=False).sample(frac=1.0, random_state=7)
            .reset_index(drop=True))


def train(docs: DataFrame, learn: Column, params: LanguageParams = LanguageParams()) -> LanguageModel:
    """Fit on the rows for which ``learn`` holds, from their text and lang alone."""
    sample = labelled_sample(docs, learn, params)
    languages = tuple(sorted(sample["lang"].unique()))
    if not languages:
        return LanguageModel((), np.zeros((params.slots, 0), np.float32), np.zeros((0, 0), np.float32), params)
    bits = np.frombuffer(b"".join(sample["bits"]), np.uint8).reshape(len(sample), -1)
    rows = unit_rows(np.unpackbits(bits, axis=1))
    each = max(1, params.landmarks // len(languages))
    chosen = sample.groupby("lang").head(each).index.to_numpy()
    marks = rows[chosen]
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    good = values > 1e-6 * values.max()
    nystroem = vectors[:, good] / np.sqrt(values[good])
    features = (rows @ marks.T).astype(np.float64) @ nystroem
    targets = (sample["lang"].to_numpy()[:, None] == np.array(languages)[None, :]).astype(np.float64)
    # each language weighs the same, and so do its rows
    weight = (1.0 / sample.groupby("lang")["lang"].transform("size").to_numpy())[:, None]
    gram = features.T @ (features * weight) + params.ridge * np.eye(features.shape[1]) / len(rows)
    solved = np.linalg.solve(gram, features.T @ (targets * weight))
    return LanguageModel(languages, np.ascontiguousarray(marks.T), (nystroem @ solved).astype(np.float32), params)


def predict(texts: list[str | None], model: LanguageModel) -> tuple[list[str], np.ndarray]:
    """Language and score (0 to 1) of each text."""
    langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    at = [i for i, text in enumerate(texts) if has_letter(text)] if model.languages else []
    if at:
        raw = unit_rows(presence([texts[i] for i in at], model.params)) @ model.landmarks @ model.weights
        best = raw.argmax(axis=1)
        scores[at] = np.clip(raw[np.arange(len(at)), best], 0.0, 1.0)
        for i, k in zip(at, best):
            langs[i] = model.languages[k]
    return langs, scores


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; columns of these names are replaced."""
    kept = docs.drop("lang_pred", "score")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shared("language", dict)  # keeps nothing, but lets other operators' memos go
        for part in frames(batches, model.params.rows_per_block):
            langs, scores = predict([t if isinstance(t, str) else None for t in part["text"]], model)
            yield part.assign(lang_pred=langs, score=scores)

    return kept.mapInPandas(score, f"{schema}, lang_pred string, score double")
