"""Ranked lexical search over a length-stratified index.

Terms are runs of ASCII letters, digits and all characters beyond ASCII, with
A-Z lower-cased.  A document's normaliser m depends on its number of terms n
alone, so documents of equal m form a stratum in which a term's impact depends
only on its frequency tf: it is computed once per stratum and tf.

``build_index`` counts terms, then writes one row per stratum, or per part of
a frequent one: its documents in the order of their ids, its terms, and for
each term postings grouped by falling tf.  ``search`` compares items with
shards of the index.  In a shard a stratum's bound for an item is the sum of the
weights times the impact of each term's highest tf; strata are visited from the
highest bound on, and visiting ends when the bound is below the item's k-th
score.  Winners of the shards are merged.  Few items are sent to where the index
lies; beyond a counted bound blocks of items and shards of the index are brought
together by a shuffle.

Terms are 64-bit hashes in the index.  All arithmetic but the weights' logarithm
is in 64-bit integers.

Edge cases: NULL and empty texts have no terms and are in no stratum.  A
document without an id counts in the statistics but is never returned; rows of
one id are documents of their own, and so are rows of one item.  Items without
terms, or whose terms no document has, give no rows; so do empty tables.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spreadlab.llm.text import Memo, frames, join_small, shared
from spreadlab.session import staged

# every byte that is no part of a term becomes a space, A-Z become a-z
TERM_BYTES = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()
NOBODY = 2 ** 63 - 1  # stands for a missing id in the index


@dataclass(frozen=True)
class RankingParams:
    k: int = 10
    percent: int = 75               # share of the length in the normaliser
    one: int = 1_000_000_000        # impact of endless repetition, times 1000
    per_m: int = 8
    weight_scale: int = 1000
    stratum_postings: int = 131_072  # of one index row; a frequent m has several
    shard_postings: int = 1_000_000
    item_block: int = 512
    broadcast_rows: int = 500_000   # terms of items that are sent to all tasks, of some 32 bytes each


@dataclass(frozen=True)
class Index:
    strata: DataFrame               # one row per stratum part
    documents: int                  # N: documents with a term
    terms: int                      # L: their terms with repeats
    postings: int


def terms(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(TERM_BYTES).split() if text else []


def hashed(words: set[bytes]) -> dict[bytes, int]:
    """Signed 64-bit hashes; the worker's memo holds ordinary words only, so its size is bounded."""
    memo = shared("ranking", lambda: Memo(lambda new: [signed(w) for w in new])).holding({w for w in words if len(w) <= 64})
    return {w: memo[w] if len(w) <= 64 else signed(w) for w in words}


def signed(word: bytes) -> int:
    value = xxhash.xxh64_intdigest(word)
    return value - (1 << 64) if value >> 63 else value


def count_terms(docs: DataFrame, key: str, text: str) -> DataFrame:
    """row, id, n, term, tf: the distinct hashed terms of each text that has some, with their counts."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at:at + 256]
                counted = [Counter(terms(t)) for t in part["body"]]
                known = hashed(set().union(*counted))
                yield part[["row", "id"]].assign(
                    n=[c.total() for c in counted], term=[[known[w] for w in c] for c in counted],
                    tf=[list(c.values()) for c in counted]).loc[[bool(c) for c in counted]]

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(key).cast("long"), F.lit(NOBODY)).alias("id"),
                       F.col(text).cast("string").alias("body"))
    return rows.mapInPandas(run, "row long, id long, n long, term array<long>, tf array<int>")


STRATUM = ("m long, part long, ids array<long>, term array<long>, df array<int>, first array<int>, "
           "tf array<int>, start array<int>, at array<int>")


def stratum(m: int, part: int, rows: pd.DataFrame) -> pd.DataFrame:
    """One index row: documents by id, terms ascending, and per term groups of falling tf with their documents."""
    rows = rows.sort_values("id", kind="stable")
    sizes = rows["term"].map(len).to_numpy()
    term, tf = np.concatenate(rows["term"].tolist()).astype(np.int64), np.concatenate(rows["tf"].tolist()).astype(np.int32)
    at = np.repeat(np.arange(len(rows), dtype=np.int32), sizes)
    order = np.lexsort((at, -tf, term))
    term, tf, at = term[order], tf[order], at[order]
    new_term = np.r_[True, term[1:] != term[:-1]]
    start = np.flatnonzero(new_term | np.r_[True, tf[1:] != tf[:-1]])
    places = np.flatnonzero(new_term)
    return pd.DataFrame({
        "m": [m], "part": [part], "ids": [rows["id"].to_numpy(np.int64)], "term": [term[places]],
        "df": [np.diff(np.r_[places, len(term)]).astype(np.int32)], "first": [np.searchsorted(start, places).astype(np.int32)],
        "tf": [tf[start]], "start": [start.astype(np.int32)], "at": [at]})


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", params: RankingParams = RankingParams()) -> Index:
    """The index over all documents, written to the shared folder."""
    counted = staged(count_terms(docs, doc_id, text), "term-counts")
    total = counted.agg(F.count("*").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms"),
                        F.coalesce(F.sum(F.size("term")), F.lit(0)).alias("postings")).first()
    m = F.lit(100 - params.percent) + F.expr(f"({params.percent}L * n * {total['n']}L) div {max(1, total['terms'])}L")
    rows = counted.withColumn("m", m.cast("long"))
    # a stratum of many postings is dealt to parts, as many as its size asks for
    sizes = rows.groupBy("m").agg(F.sum(F.size("term")).alias("size"))
    parts = F.ceil(F.col("size") / params.stratum_postings)
    dealt = join_small(rows, sizes, ["m"], sizes.count(), "inner").withColumn("part", F.pmod(F.xxhash64("row"), parts))
    strata = dealt.select("m", "part", "id", "term", "tf").groupBy("m", "part").applyInPandas(
        lambda key, group: stratum(*key, group), STRATUM)
    return Index(staged(strata, "strata"), total["n"], total["terms"], total["postings"])


def weighted_items(items: DataFrame, index: Index, params: RankingParams) -> DataFrame:
    """row, id, term, weight: the terms of each item, the weight times the term's repeats in the item."""
    asked = items.select("row", "id", F.explode(F.arrays_zip("term", "tf")).alias("x")).select("row", "id", "x.term", "x.tf")
    wanted = asked.select("term").distinct()
    held = index.strata.select(F.explode(F.arrays_zip("term", "df")).alias("x")).select("x.term", "x.df")
    df = join_small(held, wanted, ["term"], wanted.count(), "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(F.lit(float(params.weight_scale)) * F.log(
        F.lit(2 * index.documents + 2).cast("double") / (2 * F.col("df") + 1).cast("double")))
    return asked.join(df, "term").select("row", "id", "term", (weight * F.col("tf")).alias("weight"))


class Stratum:
    """One row of the index, seen by the terms a block of items asks for."""

    def __init__(self, row, wanted: np.ndarray, params: RankingParams) -> None:
        self.ids, self.at = row.ids, row.at
        place = np.minimum(np.searchsorted(row.term, wanted), len(row.term) - 1)
        held = row.term[place] == wanted
        place = place[held]
        self.slot = np.full(len(wanted), -1, np.int32)  # from a wanted term to its postings
        self.slot[held] = np.arange(len(place), dtype=np.int32)
        tfs, which = np.unique(row.tf, return_inverse=True)  # the impact of a tf is computed once
        tfs = tfs.astype(np.int64)
        impact = ((params.one * tfs) // (1000 * tfs + params.per_m * row.m))[which]
        self.gain = np.repeat(impact, np.diff(np.r_[row.start, len(row.at)]))
        self.highest = impact[row.first[place]]  # the groups of a term fall in tf
        begin = np.r_[row.start[row.first], len(row.at)]
        self.begin, self.end = begin[place], begin[place + 1]

    def bounds(self, place: np.ndarray, weights: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """The score no document of the stratum exceeds, for each item."""
        slot = self.slot[place]
        most = np.zeros(len(place), np.int64)
        most[slot >= 0] = weights[slot >= 0] * self.highest[slot[slot >= 0]]
        return np.add.reduceat(most, begin)

    def scores(self, place: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Dense scores of the documents for one item."""
        out = np.zeros(len(self.ids), np.int64)
        slots = self.slot[place]
        for slot, weight in zip(slots[slots >= 0], weights[slots >= 0]):
            low, high = self.begin[slot], self.end[slot]
            out[self.at[low:high]] += weight * self.gain[low:high]
        out[self.ids == NOBODY] = 0
        return out


def search_shard(shard: pd.DataFrame, items: pd.DataFrame, params: RankingParams) -> pd.DataFrame:
    """The k best documents of a shard for each item of a block."""
    if not len(shard) or not len(items):
        return pd.DataFrame({"row": [], "item_id": [], "doc_id": [], "score": []}).astype("int64")
    items = items.sort_values(["row", "term"])
    wanted, place = np.unique(items["term"].to_numpy(np.int64), return_inverse=True)
    weights = items["weight"].to_numpy(np.int64)
    begin = np.flatnonzero(np.r_[True, np.diff(items["row"].to_numpy(np.int64)) != 0])
    strata = [Stratum(row, wanted, params) for row in shard.itertuples()]
    bounds = np.array([s.bounds(place, weights, begin) for s in strata])
    out = []
    for i, (low, high) in enumerate(zip(begin, np.r_[begin[1:], len(items)])):
        best, ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for s in np.argsort(-bounds[:, i], kind="stable"):
            bar = max(1, best[-1]) if len(best) == params.k else 1  # equal scores may still win by their id
            if bounds[s, i] < bar:
                break
            scores = strata[s].scores(place[low:high], weights[low:high])
            able = np.flatnonzero(scores >= bar)
            if len(able) > params.k:
                able = able[scores[able] >= np.partition(scores[able], len(able) - params.k)[len(able) - params.k]]
            best, ids = np.r_[best, scores[able]], np.r_[ids, strata[s].ids[able]]
            order = np.lexsort((ids, -best))[:params.k]
            best, ids = best[order], ids[order]
        out.append(pd.DataFrame({"row": items["row"].iloc[low], "item_id": items["id"].iloc[low], "doc_id": ids, "score": best}))
    return pd.concat(out, ignore_index=True)


def search(index: Index, items: DataFrame, item_id: str = "item_id", text: str = "text",
           params: RankingParams = RankingParams()) -> DataFrame:
    """item_id, rank, doc_id, score: the k documents of highest score above 0 for each item."""
    asking = staged(count_terms(items, item_id, text), "items")
    weighted = staged(weighted_items(asking, index, params).where("weight > 0"), "weighted-items")
    few = weighted.count() <= params.broadcast_rows
    found = _search_in_place(index, weighted, params) if few else _search_by_shards(index, asking, weighted, params)
    order = Window.partitionBy("row").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= params.k).select(
        F.nullif("item_id", F.lit(NOBODY)).alias("item_id"), "rank", "doc_id", "score")


FOUND = "row long, item_id long, doc_id long, score long"


def _search_in_place(index: Index, weighted: DataFrame, params: RankingParams) -> DataFrame:
    """All items in every task, which reads its part of the index and searches it shard by shard."""
    sent = index.strata.sparkSession.sparkContext.broadcast(weighted.toPandas())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items, held, postings = sent.value, [], 0
        for batch in frames(batches, 64):
            held.append(batch)
            postings += int(batch["at"].map(len).sum())
            if postings >= params.shard_postings:
                yield search_shard(pd.concat(held, ignore_index=True), items, params)
                held, postings = [], 0
        if held:
            yield search_shard(pd.concat(held, ignore_index=True), items, params)

    return index.strata.mapInPandas(run, FOUND)


def _search_by_shards(index: Index, asking: DataFrame, weighted: DataFrame, params: RankingParams) -> DataFrame:
    """Every block of items beside every shard of the index."""
    blocks = max(1, -(-asking.count() // params.item_block))
    shards = max(1, -(-index.postings // params.shard_postings))
    items = weighted.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    strata = index.strata.withColumn("shard", F.pmod(F.xxhash64("m", "part"), F.lit(shards)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    return strata.groupBy("shard", "block").cogroup(items.groupBy("shard", "block")).applyInPandas(
        lambda shard, some: search_shard(shard, some, params), FOUND)


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
docs AS (SELECT row, doc_id, terms, len(terms) AS n FROM d WHERE len(terms) > 0),
stats AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM docs),
normed AS (SELECT row, doc_id, terms, 100 - 75 + ((75 * n * n_docs) // n_terms) AS m FROM docs, stats),
tfs AS (SELECT row, doc_id, m, term, count(*) AS tf FROM (SELECT row, doc_id, m, unnest(terms) AS term FROM normed) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM tfs, stats GROUP BY term, n_docs),
i AS (
  SELECT row_number() OVER () AS item_row, item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM benchmark),
asked AS (SELECT item_row, item_id, term, count(*) AS q FROM (SELECT item_row, item_id, unnest(terms) AS term FROM i) GROUP BY ALL),
scored AS (
  SELECT item_row, item_id, row, doc_id, CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN tfs USING (term) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_row ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 AND doc_id IS NOT NULL QUALIFY rank <= 10
"""
