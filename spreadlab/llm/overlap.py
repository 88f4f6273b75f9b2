"""Exact Jaccard self-join of documents on word shingles, by T-occurrence search.

Two documents link when their sets of shingles have a Jaccard similarity of at
least ``percent``.  A document of n shingles shares at least
need(n) = ceil(percent * n / 100) of them with any partner, so it misses at
most lead(n) - 1 = n - need(n).

1.  Every document's shingles are hashed and sorted; documents with equal sets
    form a class, and only one document of a class goes on.
2.  The window of a document is its smallest hashes.  Below the lesser of two
    documents' window ends both windows are complete, so a linked pair shares
    at least window - lead + 1 hashes of the document whose window ends first.
    Windows are turned into inverted lists.  A list of more than ``long_list``
    documents is long; no task ever collects more of it than is needed to know that.
3.  A document with h long lists among its window shares at least
    T = window - lead + 1 - h of its *short* lists with each partner.  Where
    T >= 1 the short lists are merged and partners that occur T times are kept
    (the T - 1 longest of them are not merged but probed by binary search,
    which is the DivideSkip rule).  Documents with T < 1 are *heavy*.
4.  A heavy document's partner shares a short list (found with T = 1) or at
    least window - lead + 1 long lists.  Documents with so many long lists are
    *rich*: copies of large families.  Rich documents that share one of their
    first lead long lists belong to one family; a family is cut into blocks, and in every pair of
    blocks each document's T-occurrence search runs over the lists of the
    block, all lists of its whole set now, which gives the exact overlap.  Of
    the links found a pair of blocks returns a spanning forest.
5.  Candidates of step 3 are verified on the whole sets.  The first candidates
    of each document go first; afterwards only candidates between different
    components are looked at.

Edge cases: a text with fewer words than a shingle has its whole sequence as
one shingle; NULL, empty and blank texts have no shingle, link with nothing and
are their own component; repeated rows are equal sets; rows with one id count
for the smallest id of their components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spreadlab.llm.text import WordHashes, arrow_batches, combined, join_small, shared, words
from spreadlab.session import scratch_path, staged

HASH_BITS = 48  # of a stored shingle; the set's size and its class come from all 64 bits
MARK_BITS = 12  # low bits of an id that are places in a bitmap; the others name the bitmap
MOST_BITMAPS = 16_384  # of half a kilobyte each that are sent to all tasks


@dataclass(frozen=True)
class JoinParams:
    words: int = 5
    percent: int = 80
    long_list: int = 64   # documents on a list; longer ones are long
    full_window: int = 160  # sets up to this size are window as a whole
    first_pairs: int = 2  # candidates of a document that are verified first
    block: int = 512      # rich documents of a block
    batch_rows: int = 1000  # rows a Python task holds at a time

    def need(self, n: Column) -> Column:
        return F.floor((n * self.percent + 99) / 100)

    def lead(self, n: Column) -> Column:
        return n - self.need(n) + 1

    def window(self, n: Column) -> Column:
        return F.least(n, F.greatest(F.lit(self.full_window), F.floor(self.lead(n) * 3 / 2) + 8))

    def at_least_long(self, n: Column) -> Column:
        """Long lists shared by a pair that shares no short one: window - lead + 1 of the other, whatever its size.

        Over sizes of a partner the value falls between ``full_window`` and the size where windows grow
        again and rises elsewhere, so the least is at an end of the range or at that size.
        """
        def shared(m: Column) -> Column:
            return self.window(m) - self.lead(m) + 1

        low, high = F.floor(n * self.percent / 100), F.floor(n * 100 / self.percent) + 1
        turn = int((self.full_window - 8) / 1.5 * 100 / max(1, 100 - self.percent))
        inner = [F.greatest(low, F.least(high, F.lit(turn + d))) for d in (-16, 0, 16)]
        return F.greatest(F.lit(1), F.least(*[shared(m) for m in (low, high, *inner)]) - 4)


def shingles(tokens: list[bytes], size: int, hashed: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    if not tokens:
        return np.empty(0, np.uint64)
    if len(tokens) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(tokens))], np.uint64)
    return np.unique(combined(hashed(tokens), tuple(range(size))))


def shingle_sets(docs: DataFrame, doc_id: str, text: str, params: JoinParams) -> DataFrame:
    """doc_id, n, k1, k2 (hashes of the whole set) and grams, the sorted shortened hashes."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashed = shared("few hashes", lambda: WordHashes(100_000))  # as this job needs its memory for sets
        for batch in batches:
            for at in range(0, len(batch), 512):
                part, rows = batch.iloc[at:at + 512], []
                for doc, body in zip(part["id"], part["body"]):
                    h = shingles(words(body), params.words, hashed)
                    data = h.tobytes()
                    rows.append((doc, len(h), xxhash.xxh64_intdigest(data, 1) - (1 << 63), xxhash.xxh64_intdigest(data, 2) - (1 << 63),
                                 np.unique(h >> np.uint64(64 - HASH_BITS)).view(np.int64)))
                yield pd.DataFrame(rows, columns=["doc_id", "n", "k1", "k2", "grams"])

    source = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("body"))
    return source.mapInPandas(run, "doc_id long, n long, k1 long, k2 long, grams array<long>")


def occurring(lists: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    """The documents on at least ``least`` of the sorted lists, and on how many (DivideSkip).

    The ``least - 1`` longest lists, but at most half of all, are set aside: a
    document on ``least`` lists is on at least one of the others.  These are merged
    with counts; only what may still reach the number is probed in the long ones.
    """
    ordered = sorted(lists, key=len)
    aside = min(least - 1, len(ordered) // 2)
    merged = np.sort(np.concatenate(ordered[:len(ordered) - aside]), kind="stable")
    starts = np.flatnonzero(np.r_[True, merged[1:] != merged[:-1]])
    docs, counts = merged[starts], np.diff(np.r_[starts, len(merged)])
    for left, long in zip(range(aside, 0, -1), ordered[len(ordered) - aside:]):
        alive = counts + left >= least
        docs, counts = docs[alive], counts[alive]
        if not len(docs):
            return docs, counts
        at = np.searchsorted(long, docs)
        counts = counts + (long[np.minimum(at, len(long) - 1)] == docs)
    return docs[counts >= least], counts[counts >= least]


def block_links(rows: pd.DataFrame, one: int, two: int, params: JoinParams) -> list[tuple[int, int]]:
    """A spanning forest of the links between the documents of two blocks (or within one, when they are the same).

    ``rows`` has c, own (the block) and grams.
    """
    rows = rows.sort_values("c")
    ids, own, sets = rows["c"].to_numpy(), rows["own"].to_numpy(), [np.asarray(g) for g in rows["grams"]]
    sizes = np.array([len(g) for g in sets])
    indexed = np.flatnonzero(own == two)
    grams = np.concatenate([sets[k] for k in indexed] or [np.empty(0, np.int64)])
    order = np.argsort(grams, kind="stable")
    grams, owners = grams[order], np.repeat(indexed, sizes[indexed])[order]
    above = list(range(len(ids)))  # a forest over the documents seen so far

    def root(k: int) -> int:
        while above[k] != k:
            above[k] = above[above[k]]
            k = above[k]
        return k

    links = []
    for k in np.flatnonzero(own == one):
        starts, ends = np.searchsorted(grams, sets[k], "left"), np.searchsorted(grams, sets[k], "right")
        lists = [owners[i:j] for i, j in zip(starts, ends) if j > i]
        least = -(-params.percent * sizes[k] // 100)
        if len(lists) < least:
            continue
        found, shared = occurring(lists, least)
        close = (found != k) & (100 * shared >= params.percent * (sizes[k] + sizes[found] - shared))
        for other in found[close]:
            a, b = root(k), root(other)
            if a != b:
                above[max(a, b)] = min(a, b)
                links.append((int(min(ids[k], ids[other])), int(max(ids[k], ids[other]))))
    return links


def rich_links(posts: DataFrame, sets: DataFrame, params: JoinParams) -> DataFrame:
    """(a, b): links of the rich documents (c) on their long lists (gram), family by family, in blocks."""
    hubs = posts.groupBy("gram").agg(F.min("c").alias("b"))
    families = components(posts.join(hubs, "gram").where("c <> b").select(F.col("c").alias("a"), "b").distinct())
    blocks = families.groupBy("root").agg(F.ceil(F.count("*") / params.block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int")
    placed = (families.join(blocks, "root").withColumn("own", own)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("root", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "own", "c"))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(block_links(rows, key[1], key[2], params), columns=["a", "b"])

    return placed.join(sets, "c").groupBy("root", "one", "two").applyInPandas(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """c, root of every end of an edge (a, b): the least id reachable.  Labels spread and jump until nothing changes."""
    both = staged(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = staged(both.groupBy(F.col("a").alias("c")).agg(F.min("b").alias("m"))
                    .select("c", F.least("c", "m").alias("root")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("c", "b"), "b").groupBy(F.col("a").alias("c"))
                .agg(F.min("root").alias("m")))
        spread = labels.join(near, "c").select("c", F.least("root", "m").alias("up"), F.col("root").alias("was"))
        jump = labels.select(F.col("c").alias("up"), F.col("root").alias("above"))
        after = staged(spread.join(jump, "up").select("c", F.least("up", "above").alias("root"), "was"), "labels")
        labels = after.select("c", "root")
        if not after.where("root <> was").limit(1).count():
            return labels


def verified(pairs: DataFrame, sets: DataFrame, params: JoinParams) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough; ``sets`` has c and grams."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for one, two in zip(batch["x"], batch["y"]):
                both = np.sort(np.concatenate((one, two)), kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= params.percent * (len(both) - shared))
            yield batch.loc[keep, ["a", "b"]]

    return (pairs.select("a", "b")
            .join(sets.select(F.col("c").alias("a"), F.col("grams").alias("x")), "a")
            .join(sets.select(F.col("c").alias("b"), F.col("grams").alias("y")), "b")
            .mapInPandas(run, "a long, b long"))


def _ordered(one: str, two: str) -> list[Column]:
    return [F.least(one, two).alias("a"), F.greatest(one, two).alias("b")]


def bitmaps(ids: DataFrame, c: str = "c") -> DataFrame:
    """of, bits: the ids as bitmaps, so the driver holds a bit for each document instead of a row of a hash table."""
    low = (1 << MARK_BITS) - 1
    return ids.groupBy(F.shiftright(c, MARK_BITS).alias("of")).agg(
        F.substring(F.bitmap_construct_agg(F.col(c).bitwiseAND(low)), 1, 1 << (MARK_BITS - 3)).alias("bits"))


def marked(df: DataFrame, c: str, ids: DataFrame, keep: bool) -> DataFrame:
    """The rows whose id ``c`` (not NULL) is one of ``ids``, or the others; ``ids`` has bitmaps."""
    at = F.col(c).bitwiseAND((1 << MARK_BITS) - 1).cast("int")
    byte = F.conv(F.hex(F.substring("bits", F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
    there = F.coalesce(F.call_function("getbit", byte, at.bitwiseAND(7)) == 1, F.lit(False))
    found = join_small(df.withColumn("of", F.shiftright(c, MARK_BITS)), ids, ["of"], ids.count(),
                       "inner" if keep else "left", MOST_BITMAPS)
    return found.where(there if keep else ~there).select(*df.columns)


def link_classes(sets: DataFrame, params: JoinParams) -> DataFrame | None:
    """c, root of the classes that link with another class; ``sets`` has c, n, grams, one row per class."""
    n = F.col("n")
    posts = sets.select("c", F.explode(F.slice("grams", F.lit(1), params.window(n).cast("int"))).alias("gram"))
    # at most long_list + 1 documents of a list pass: within each task first, then over all
    ranked = posts.withColumn("k", F.row_number().over(Window.partitionBy("gram").orderBy("c")))
    lists = staged(ranked.where(F.col("k") <= params.long_list + 1).groupBy("gram")
                   .agg(F.array_sort(F.collect_list("c")).alias("docs")).where(F.size("docs") > 1), "lists")
    long = staged(lists.where(F.size("docs") > params.long_list).select("gram"), "long")
    long_count = long.count()
    on_long = join_small(posts, long, ["gram"], long_count, "inner")
    # a document's long lists, at most its window
    hot = on_long.groupBy("c").agg(F.sort_array(F.collect_list("gram")).alias("hot"))
    counted = sets.select("c", "n", F.least(params.window(n), F.size("grams")).alias("w"), params.lead(n).alias("lead"))
    counted = counted.join(hot, "c", "left").withColumn("h", F.coalesce(F.size("hot"), F.lit(0)))
    counted = staged(counted.withColumn("t", F.col("w") - F.col("lead") + 1 - F.col("h")), "counted")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for c, least, docs in zip(batch["c"], batch["t"], batch["docs"]):
                least = max(1, int(least))
                if len(docs) >= least:
                    found, _ = occurring([np.asarray(d) for d in docs], least)
                    rows.append(pd.DataFrame({"c": c, "d": found[found != c]}))
            yield pd.concat(rows) if rows else pd.DataFrame({"c": [], "d": []}).astype("int64")

    short = lists.where(F.size("docs") <= params.long_list)
    asked = (short.select(F.explode("docs").alias("c"), "docs").groupBy("c").agg(F.collect_list("docs").alias("docs"))
             .join(counted.select("c", "t"), "c"))
    sizes = counted.select(F.col("c").alias("b"), F.col("n").alias("m"))
    similar = (F.col("n") >= params.need(F.col("m"))) & (F.col("m") >= params.need(F.col("n")))
    candidates = staged(
        asked.mapInPandas(search, "c long, d long").select(*_ordered("c", "d")).distinct()
        .join(counted.select(F.col("c").alias("a"), "n"), "a").join(sizes, "b").where(similar)
        .select("a", "b"), "candidates")
    # any choice of first pairs is right, as the rest follows; the least ids make one document the hub of a family
    first = (candidates.withColumn("k", F.row_number().over(Window.partitionBy("b").orderBy("a")))
             .where(F.col("k") <= params.first_pairs).select("a", "b"))

    rich = None
    if long_count and counted.where("t < 1 AND h > 0").limit(1).count():
        # below both windows' ends a pair misses at most lead - 1 of either side's long lists,
        # so of those it shares one is among the first lead of both
        rich = staged(counted.where(F.col("h") >= params.at_least_long(n)).select(
            "c", F.explode(F.slice("hot", F.lit(1), F.col("lead").cast("int"))).alias("gram")), "rich")
    ends = candidates.select(F.explode(F.array("a", "b")).alias("c"))
    ends = staged(bitmaps(ends if rich is None else ends.union(rich.select("c"))), "ends")
    if ends.isEmpty():
        return None
    whole = staged(marked(sets.select("c", "grams"), "c", ends, True), "whole")
    links = verified(first, whole, params)
    if rich is not None:
        links = links.union(rich_links(rich, whole, params))
    links = staged(links, "links")
    labels = components(links)
    rest = candidates
    for end in ("a", "b"):  # only the pairs between different components
        rest = (rest.join(labels.select(F.col("c").alias(end), F.col("root").alias(f"r{end}")), end, "left")
                .withColumn(f"r{end}", F.coalesce(f"r{end}", end)))
    more = staged(verified(rest.where("ra <> rb"), whole, params), "links")
    if not more.limit(1).count():
        return labels
    return components(links.union(more))


def similar_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                      params: JoinParams = JoinParams()) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    spark = docs.sparkSession
    with arrow_batches(spark, params.batch_rows):
        rows, classes = _classes(docs, doc_id, text, params)
    keys = ["k1", "k2", "n"]
    return rows.join(classes, keys, "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def _classes(docs: DataFrame, doc_id: str, text: str, params: JoinParams) -> tuple[DataFrame, DataFrame]:
    """The rows with their class keys, and the component of every class."""
    spark = docs.sparkSession
    path = scratch_path(spark, "sets")
    sets = shingle_sets(docs, doc_id, text, params).withColumn("uid", F.monotonically_increasing_id())
    sets.write.option("compression", "zstd").parquet(path)
    sets = spark.read.schema(sets.schema).parquet(path)
    keys = ["k1", "k2", "n"]
    heads = sets.where("n > 0").groupBy(*keys).agg(F.min("uid").alias("c"), F.min("doc_id").alias("least"))
    classes = staged(heads, "classes")
    rows = sets.select("uid", "doc_id", *keys)
    copies = staged(bitmaps(rows.join(classes.select(*keys, "c"), keys).where("uid <> c"), "uid"), "copies")
    single = marked(sets.where("n > 0"), "uid", copies, False).withColumnRenamed("uid", "c")
    labels = link_classes(single, params)
    if labels is None:
        return rows, classes.select(*keys, F.col("least").alias("component_id"))
    rooted = classes.join(labels, "c", "left").withColumn("root", F.coalesce("root", "c"))
    lowest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows, rooted.join(lowest, "root").select(*keys, "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", params: JoinParams = JoinParams()) -> DataFrame:
    """``docs`` with one document of every component, that of the smallest id."""
    found = similar_documents(docs, doc_id, text, params)
    gone = (found.groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
            .where("doc_id <> component_id").select(F.col("doc_id").alias(doc_id)))
    gone = staged(gone, "gone")
    return join_small(docs, gone, [doc_id], gone.count(), "left_anti")
