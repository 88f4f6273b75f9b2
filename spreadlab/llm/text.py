"""Small helpers the text operators share: words, hashes, table access."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MEMO_ENTRIES = 300_000  # per generation of a memo in a Python worker


class Memo:
    """Bounded memo of values computed many at a time.

    Two generations: when the younger is full it becomes the older, and entries
    still in use come back from there.  What is forgotten is computed again.
    """

    def __init__(self, compute: Callable[[list], Iterable], entries: int = MEMO_ENTRIES) -> None:
        self.compute, self.entries = compute, entries
        self.young: dict = {}
        self.old: dict = {}

    def holding(self, keys: set) -> dict:
        """A mapping that has every one of ``keys``."""
        missing = keys.difference(self.young)
        if missing:
            if len(self.young) + len(missing) > self.entries:
                self.old, self.young, missing = self.young, {}, keys
            old, young = self.old, self.young
            new = []
            for key in missing:
                if key in old:
                    young[key] = old[key]
                else:
                    new.append(key)
            young.update(zip(new, self.compute(new)))
        return self.young


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words(text: str | None) -> list[bytes]:
    """A-Z lower-cased, cut at ASCII white space (space, tab to carriage return)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


_slot: dict = {}


def shared(key: object, build: Callable[[], object]):
    """An object of this Python worker that serves all tasks of an operator.

    A worker holds one: what another operator left behind is let go first, so
    memos of several operators never add up.
    """
    if key not in _slot:
        _slot.clear()
        _slot[key] = build()
    return _slot[key]


class WordHashes:
    """64-bit hashes of words with a bounded memo."""

    def __init__(self, entries: int = MEMO_ENTRIES) -> None:
        self.memo = Memo(lambda new: map(xxhash.xxh64_intdigest, new), entries)

    def __call__(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.memo.holding(set(tokens)).__getitem__, tokens), np.uint64, len(tokens))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values, so that low and high bits are even."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def combined(hashes: np.ndarray, offsets: tuple[int, ...], seed: int = 0) -> np.ndarray:
    """Order-sensitive hash of the words at ``offsets`` from every position.

    A sum of word hashes times an odd number per place, scrambled once.
    """
    count = len(hashes) - offsets[-1]
    if count <= 0:
        return np.empty(0, np.uint64)
    factors = mixed(np.arange(1, len(offsets) + 1, dtype=np.uint64) + np.uint64(seed * 64)) | np.uint64(1)
    out = hashes[:count] * factors[0]
    for offset, factor in zip(offsets[1:], factors[1:]):
        out += hashes[offset:offset + count] * factor
    return mixed(out)


def is_set(text: Column) -> Column:
    """The text, with NULL as the empty text."""
    return F.coalesce(text.cast("string"), F.lit(""))


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``."""
    return F.crc32(doc_id.cast("string")) % F.lit(modulus)


def frames(batches: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """The batches cut to at most ``rows`` rows, which bounds dense scratch arrays."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.iloc[at:at + rows]


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Rows per batch handed to Python while the block runs; long rows need small batches."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def join_small(left: DataFrame, small: DataFrame, keys: list[str], rows: int, how: str = "left",
               broadcast_rows: int = 1_000_000) -> DataFrame:
    """Join with a table of ``rows`` counted narrow rows: sent to all tasks when few, else by shuffling both sides."""
    return left.join(F.broadcast(small) if rows <= broadcast_rows else small, keys, how)
