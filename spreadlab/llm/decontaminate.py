"""Finding benchmark passages in documents with spaced seeds.

A seed is a fixed mask over consecutive words; the words at its open positions
are hashed, the others are ignored.  Hashes of documents and of benchmark items
are joined, and each hit says at which shift an item may lie over a document.
Around the hit the shifted words are compared one by one, and the longest
stretch in which a share of ``identity`` agrees is kept.  A document is contaminated by
an item when that stretch has at least ``min_words`` words (or the whole item,
if shorter).

Documents first pass a bit table (a Bloom filter of bounded size) built from
the benchmark's seed hashes, in the tasks; it lets all true hits and few others
through.  Passing positions that lie together form a region, which carries its
words and those around it once; the regions' seeds are joined with the
benchmark's, and every (region, item, shift) is verified once.

Words are lower-cased runs of letters and digits (and of everything beyond
ASCII), so ASCII punctuation and case do not matter.

Edge cases: NULL and empty texts, and texts or items shorter than
``shortest`` words, match nothing; rows with one id count as one document or item;
without items nothing is reported.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spreadlab.llm.text import combined, mixed, shared
from spreadlab.session import staged

TOKEN = re.compile(rb"[a-z0-9\x80-\xff]+")


@dataclass(frozen=True)
class SeedParams:
    # fixed masks: offsets of the words that count
    masks: tuple[tuple[int, ...], ...] = ((0, 1, 2, 3, 4, 5), (0, 1, 3, 6, 7, 9), (0, 2, 3, 5, 8, 10), (0, 1, 4, 5, 7, 8))
    min_words: int = 12
    shortest: int = 8
    identity: float = 0.8
    reach: int = 64       # words kept on either side of a region
    join_gap: int = 32    # passing positions this near belong to one region
    max_filter_bits: int = 27  # 2**27 bits (16 MB) at most; a larger benchmark only lets more false hits through


def tokens(text: str | None) -> list[bytes]:
    return TOKEN.findall(text.lower().encode("utf-8", "surrogatepass")) if text else []


TOKEN_BYTE = np.zeros(256, bool)
TOKEN_BYTE[list(b"abcdefghijklmnopqrstuvwxyz0123456789") + list(range(0x80, 0x100))] = True
BYTE = mixed(np.arange(1, 257, dtype=np.uint64))  # a 64-bit number per byte
FACTOR = 0x9E3779B97F4A7C15
TOGETHER = 1 << 17  # characters of texts that are hashed at once


def hashed_words(bodies: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``tokens`` of all texts, one text after the other, and where each text's begin (the end of the last besides).

    A word's hash is a sum of numbers per byte times powers of an odd factor, a difference of running
    sums over all texts, so no word becomes an object.
    """
    raw = [body.lower().encode("utf-8", "surrogatepass") if body else b"" for body in bodies]
    joined = np.frombuffer(b"\n" + b"\n".join(raw) + b"\n", np.uint8)
    inside = TOKEN_BYTE[joined]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    hashes, a = np.empty(len(starts), np.uint64), 0
    while a < len(starts):  # once, but for very long texts
        low = starts[a]
        b = max(a + 1, int(np.searchsorted(ends, low + 2 * TOGETHER, side="right")))
        span = joined[low:ends[b - 1]]
        sums = np.zeros(len(span) + 1, np.uint64)
        np.cumsum(BYTE[span] * _powers(FACTOR, len(span)), out=sums[1:])
        at, end = starts[a:b] - low, ends[a:b] - low
        hashes[a:b] = (sums[end] - sums[at]) * _powers(pow(FACTOR, -1, 1 << 64), len(span))[at] + (end - at).astype(np.uint64)
        a = b
    first = np.cumsum([1, *(len(x) + 1 for x in raw)])
    return mixed(hashes), np.searchsorted(starts, first)


_kept: dict[int, np.ndarray] = {}


def _powers(factor: int, n: int) -> np.ndarray:
    """Powers of an odd factor modulo 2**64, kept for the usual number of bytes."""
    found = _kept.get(factor)
    if found is None or len(found) < n:
        found = np.full(max(n, 2 * TOGETHER), factor, np.uint64)
        found[0] = 1
        found = np.cumprod(found)
        if n <= 2 * TOGETHER:
            _kept[factor] = found
    return found[:n]


def together(batch: pd.DataFrame) -> Iterator[tuple[np.ndarray, list[str | None]]]:
    """ids and bodies of a batch, cut to some ``TOGETHER`` characters."""
    bodies, ids = batch["body"].tolist(), batch["id"].to_numpy()
    group = np.cumsum([len(x) if x else 0 for x in bodies]) // TOGETHER
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(bodies)]
    for a, b in zip(cuts, cuts[1:]):
        if a < b:
            yield ids[a:b], bodies[a:b]


def item_words(items: DataFrame, item_id: str, text: str, params: SeedParams) -> DataFrame:
    """uid, item_id, words (hashes) of the items long enough."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for ids, bodies in together(batch):
                h, first = hashed_words(bodies)
                rows = [(item, h[a:b].view(np.int64)) for item, a, b in zip(ids, first, first[1:]) if b - a >= params.shortest]
                yield pd.DataFrame(rows, columns=["item_id", "i_words"])

    source = items.select(F.col(item_id).cast("long").alias("id"), F.col(text).cast("string").alias("body"))
    return source.mapInPandas(cut, "item_id long, i_words array<long>").withColumn("i_uid", F.monotonically_increasing_id())


def seed_table(items: DataFrame, params: SeedParams) -> DataFrame:
    """seed, i_uid, i_at of every position and mask of the items."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uid, h in zip(batch["i_uid"], batch["i_words"]):
                for number, mask in enumerate(params.masks):
                    seeds = combined(np.asarray(h).view(np.uint64), mask, number).view(np.int64)
                    yield pd.DataFrame({"seed": seeds, "i_uid": uid, "i_at": np.arange(len(seeds), dtype=np.int32)})

    return items.select("i_uid", "i_words").mapInPandas(cut, "seed long, i_uid long, i_at int")


SHIFTS = (0, 18, 37)  # three slots are cut from one seed


def bit_table(seeds: DataFrame, bits: int) -> bytes:
    """Bloom filter of ``2**bits`` bits; at most ``2**bits / 64`` words are collected, whatever the number of seeds."""
    slots = F.explode(F.array(*[F.shiftrightunsigned("seed", n).bitwiseAND(F.lit((1 << bits) - 1)) for n in SHIFTS]))
    rows = (seeds.select(slots.alias("slot"))
            .groupBy(F.shiftright("slot", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")).alias("mask")).toPandas())
    out = np.zeros((1 << bits) // 64, np.int64)
    out[rows["word"].to_numpy(np.int64)] = rows["mask"].to_numpy(np.int64)
    return out.tobytes()


def passing(seeds: np.ndarray, table: np.ndarray, bits: int) -> np.ndarray:
    """Positions whose seed the bit table lets through."""
    at, low = None, np.uint64((1 << bits) - 1)
    for shift in SHIFTS:
        some = seeds if at is None else seeds[at]
        slot = (some >> np.uint64(shift)) & low
        hit = np.flatnonzero((table[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1)
        at = hit if at is None else at[hit]
    return at


def regions(docs: DataFrame, doc_id: str, text: str, table: bytes, bits: int, params: SeedParams) -> DataFrame:
    """doc_id, d_words, seeds, places: the stretches of documents that hold passing seeds."""
    def found(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, place and seed of everything that passes, in the order of places; places count over all texts."""
        owners, places, values = [], [], []
        for number, mask in enumerate(params.masks):
            seeds = combined(h, mask, number)
            at = passing(seeds, packed, bits)
            owner = np.searchsorted(first, at, side="right") - 1
            own = (at + mask[-1] < first[owner + 1]) & (first[owner + 1] - first[owner] >= params.shortest)
            owners.append(owner[own])
            places.append(at[own])
            values.append(seeds[at[own]])
        at = np.concatenate(places)
        order = np.argsort(at, kind="stable")
        return np.concatenate(owners)[order], at[order], np.concatenate(values)[order].view(np.int64)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shared("passages", dict)  # keeps nothing, but lets other operators' memos go
        for batch in batches:
            rows = []
            for ids, bodies in together(batch):
                h, first = hashed_words(bodies)
                owner, at, seeds = found(h, first)
                if not len(at):
                    continue
                ends = np.flatnonzero((np.diff(at) > params.join_gap) | (np.diff(owner) > 0)) + 1
                for part in np.split(np.arange(len(at)), ends):
                    k = owner[part[0]]
                    start = max(first[k], at[part[0]] - params.reach)
                    rows.append((ids[k], h[start:min(first[k + 1], at[part[-1]] + params.reach)].view(np.int64), seeds[part],
                                 (at[part] - start).astype(np.int32)))
            yield pd.DataFrame(rows, columns=["doc_id", "d_words", "seeds", "places"])

    packed = np.frombuffer(table, np.uint8)
    source = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("body"))
    return source.mapInPandas(scan, "doc_id long, d_words array<long>, seeds array<long>, places array<int>")


def best_stretch(doc: np.ndarray, item: np.ndarray, shift: int, identity: float) -> tuple[int, int]:
    """Length and matches of the longest stretch with that share of equal words, item word k over document word k + shift.

    Words count 1 - identity when equal and -identity when not, so a stretch
    qualifies when its sum is not negative; words that differ are cut off its ends.
    """
    low, high = max(0, -shift), min(len(item), len(doc) - shift)
    same = doc[low + shift:high + shift] == item[low:high]
    sums = np.concatenate(([0.0], np.cumsum(same - identity)))
    least, most = np.minimum.accumulate(sums).tolist(), (np.maximum.accumulate(sums[::-1])[::-1] + 1e-9).tolist()
    start = end = i = j = 0
    while j < len(sums):
        if least[i] <= most[j]:
            if j - i > end - start:
                start, end = i, j
            j += 1
        else:
            i += 1
    equal = np.flatnonzero(same[start:end])
    return (int(equal[-1] - equal[0] + 1), len(equal)) if len(equal) else (0, 0)


def contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id",
                 text: str = "text", params: SeedParams = SeedParams()) -> DataFrame:
    """doc_id, item_id, words, matches: the best overlap of every contaminated pair."""
    cut = staged(item_words(items, item_id, text, params), "items")
    seeds = staged(seed_table(cut, params), "seeds")
    # 128 bits a seed and more, so that few others pass
    bits = min(params.max_filter_bits, max(20, (128 * seeds.count()).bit_length()))
    found = staged(regions(docs, doc_id, text, bit_table(seeds, bits), bits, params)
                   .withColumn("d_uid", F.monotonically_increasing_id()), "regions")
    hits = found.select("d_uid", F.explode(F.arrays_zip("seeds", "places")).alias("s")).select(
        "d_uid", F.col("s.seeds").alias("seed"), F.col("s.places").alias("place"))
    aligned = hits.join(seeds, "seed").select("d_uid", "i_uid", (F.col("place") - F.col("i_at")).alias("shift")).distinct()

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, item, d_words, i_words, shift in zip(
                    batch["doc_id"], batch["item_id"], batch["d_words"], batch["i_words"], batch["shift"]):
                length, matches = best_stretch(np.asarray(d_words), np.asarray(i_words), shift, params.identity)
                if length >= min(params.min_words, len(i_words)) and matches >= params.identity * length:
                    rows.append((doc, item, length, matches))
            yield pd.DataFrame(rows, columns=["doc_id", "item_id", "words", "matches"])

    pairs = (aligned.join(found.select("d_uid", "doc_id", "d_words"), "d_uid").join(cut, "i_uid")
             .select("doc_id", "item_id", "d_words", "i_words", "shift"))
    best = (pairs.mapInPandas(verify, "doc_id long, item_id long, words int, matches int")
            .groupBy("doc_id", "item_id").agg(F.max(F.struct("words", "matches")).alias("best")))
    return best.select("doc_id", "item_id", F.col("best.words").alias("words"), F.col("best.matches").alias("matches"))
