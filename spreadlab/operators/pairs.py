"""All-pairs statistics of series on their common dates.

The result has one row for every pair by definition, so the work is n²/2 pairs
however it is arranged; n is bounded by the caller's top-series step, or the
pairs by a column both sides must share.  Pairs
are formed block-wise: every series is assigned to one of B blocks and sent to
the B block pairs it takes part in, an equality join on the block pair.  This
moves n·B rows (a series is one row with its lookback values) instead of
n²/2·dates and spreads the pairs over B(B+1)/2 even tasks whatever the dates look
like.  Statistics need no pair as a row: the series of two blocks are two
matrices, and a series is compared with all its partners at once.  Where only
the most extreme pairs are asked for, each block pair keeps that many.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spreadlab.functions.scalars import quoted

_TILE = 512  # partners whose differences are held at once, so that these stay in a core's cache
_CHUNK = 64  # series whose sums are one matrix product
_BATCH = 65_536  # pairs given away at once
_TASKS = 4_096  # the most tasks that block pairs are dealt over
_RANGE = 1_000_000  # pairs that a task sorts, so that it does so in memory
_RANGES = 8_192  # the most ranges a report is sorted in
_SAMPLE = 200_000  # pairs from which the ranges are estimated


def percentile_of_score(below: Column, at_or_below: Column, n: Column) -> Column:
    """Rank percentile: mean of strict and weak share, one more if it occurs."""
    tied = F.when(at_or_below > below, 1).otherwise(0)
    return (below + at_or_below + tied) * 50.0 / n


def z_score(last: Column, mean: Column, std: Column) -> Column:
    """Standard score, 0 when the deviation is not positive (or undefined)."""
    return F.when(std > 0, (last - mean) / std).otherwise(F.lit(0.0))


def block_count(df: DataFrame, n_series: int | None = None) -> int:
    """Blocks needed so that the block pairs fill the shuffle partitions.

    With a counted number of series a block holds 16 to 512 of them.
    """
    wanted = math.ceil(math.sqrt(4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    if n_series is not None:
        wanted = max(min(wanted, math.ceil(n_series / 16)), math.ceil(n_series / 512))
    return max(2, wanted)


def block_pairs(series: DataFrame, security: str, columns: list[str], blocks: int,
                within: str | None = None) -> DataFrame:
    """Pairs ``security_1 < security_2`` with both sides' ``columns``.

    Each unordered pair is produced exactly once: by the pair of its two
    blocks, or within the diagonal pair when both are in one block.  The rows
    stay partitioned by ``block_pair``.  ``within`` names a column on which both
    sides must agree; it is part of the join key, so other pairs are never formed.
    """
    parts = blocks * (blocks + 1) // 2
    own = F.pmod(F.xxhash64(quoted(security)), F.lit(blocks)).cast("int")
    spread = (series.withColumn("_own", own)
              .withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
              .withColumn("block_pair", F.least("_own", "_other") * blocks + F.greatest("_own", "_other")))

    def side(n):
        return spread.select("block_pair", *([quoted(within).alias("_within")] if within else []),
                             F.col("_own").alias(f"_own_{n}"), *[quoted(c).alias(f"{c}_{n}") for c in (security, *columns)]
                             ).repartition(parts, "block_pair")

    diagonal = F.col("block_pair") % (blocks + 1) == 0
    keys = ["block_pair", *(["_within"] if within else [])]
    return (side(1).join(side(2).hint("shuffle_hash"), keys)
            .filter((quoted(f"{security}_1") < quoted(f"{security}_2"))
                    & (diagonal | (F.col("_own_1") != F.col("_own_2"))))
            .drop("_own_1", "_own_2", "_within"))


def _matrix(arrays: pd.Series) -> np.ndarray:
    """One row per array, missing values and those beyond its end as NaN."""
    out = np.full((len(arrays), max([*map(len, arrays), 0])), np.nan)
    for row, values in zip(out, arrays):
        row[:len(values)] = np.asarray(values, np.float64)
    return out


def _moments(values: np.ndarray, one: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number, mean and deviation of the differences between one series and the others, difference by difference."""
    diff = values[one] - values[others]
    there = ~np.isnan(diff)
    n = there.sum(axis=1)
    some = n > 0
    mean, std = np.full(len(others), np.nan), np.full(len(others), np.nan)
    mean[some] = np.where(there, diff, 0.0)[some].sum(axis=1) / n[some]
    spread = np.where(there, diff - mean[:, None], 0.0)
    more = n > 1
    std[more] = np.sqrt(np.einsum("ij,ij->i", spread, spread)[more] / (n[more] - 1))
    return n, mean, std


class _Side:
    """Some series of a block pair, sorted: their rows, values by date, and the parts of sums of differences."""

    def __init__(self, matrix: np.ndarray, at: np.ndarray):
        values = matrix[at]
        self.at, self.by_date = at, np.ascontiguousarray(values.T)
        there = ~np.isnan(values)
        # differences lose nothing when each series is moved by a number of its own, which is added to the mean
        with np.errstate(all="ignore"):
            self.centre = np.where(there, values, 0.0).sum(axis=1) / np.maximum(there.sum(axis=1), 1)
            moved = np.where(there, values - self.centre[:, None], 0.0)
            self.odd = ~np.isfinite(moved).all(axis=1)
            moved[self.odd] = 0.0
            self.moved, self.squares, self.there = moved, moved * moved, there.astype(np.float64)


def _products(a: _Side, ones: slice, b: _Side, others: slice) -> tuple[np.ndarray, ...]:
    """Number, mean and deviation of the differences for ones x others as matrix products, and where these are unsure.

    The sum of squares is a difference itself; where less than a thousandth of its terms is left (nearly
    parallel series), or terms leave the range of numbers, ``_moments`` has to decide.
    """
    x, y, p, q = a.moved[ones], b.moved[others], a.there[ones], b.there[others]
    n = p @ q.T
    total = x @ q.T - p @ y.T
    terms = a.squares[ones] @ q.T + p @ b.squares[others].T
    left = terms - 2 * (x @ y.T) - total * total / n
    mean = total / n + (a.centre[ones][:, None] - b.centre[others])
    std = np.where(n > 1, np.sqrt(left / (n - 1)), np.nan)
    unsure = (~(left >= 1e-3 * terms) | ~(terms > 1e-200) | ~np.isfinite(terms)
              | ~np.isfinite(mean) | a.odd[ones][:, None] | b.odd[others])
    return n.astype(np.int64), mean, std, unsure & ((n > 0) | a.odd[ones][:, None] | b.odd[others])


def _ranks(value: np.ndarray, last: float, by_date: np.ndarray, lasts: np.ndarray) -> dict[str, np.ndarray]:
    """Extremes of the difference between one series and the others, and how many lie below the last one."""
    width = by_date.shape[1]
    low, high, below, upto = np.empty(width), np.empty(width), np.empty(width, np.int64), np.empty(width, np.int64)
    last_diff, short = last - lasts, np.uint16 if len(by_date) < 65_536 else np.int64
    for start in range(0, width, _TILE):
        tile = slice(start, start + _TILE)
        diff = value[:, None] - by_date[:, tile]
        np.fmin.reduce(diff, axis=0, out=low[tile])
        np.fmax.reduce(diff, axis=0, out=high[tile])
        # comparisons with NaN are false, as they should be
        below[tile] = (diff < last_diff[tile]).view(np.uint8).sum(axis=0, dtype=short)
        upto[tile] = (diff <= last_diff[tile]).view(np.uint8).sum(axis=0, dtype=short)
    return {"last_diff": last_diff, "min_diff": low, "max_diff": high, "below": below, "at_or_below": upto}


def _scores(found: dict[str, np.ndarray]) -> np.ndarray:
    """Absolute z scores, as ``z_score`` defines them."""
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(found["std"] > 0, np.abs((found["last_diff"] - found["mean"]) / found["std"]), 0.0)


def _partners(rows: pd.DataFrame, security: str, matrix: np.ndarray, within: bool):
    """For sorted rows of a block pair: sides to compare, and the range of partners of each series of the first.

    Partners come later in the order, share the group and have another name.
    """
    names, own = rows[security].to_numpy(), rows["_own"].to_numpy()
    if rows["_one"].iloc[0] != rows["_two"].iloc[0]:  # two blocks of one group
        first, second = np.flatnonzero(own == rows["_one"].iloc[0]), np.flatnonzero(own == rows["_two"].iloc[0])
        one, two = _Side(matrix, first), _Side(matrix, second)
        for a, b in ((one, two), (two, one)):
            yield a, b, np.searchsorted(names[b.at], names[a.at], side="right"), np.full(len(a.at), len(b.at))
        return
    new_group = np.zeros(len(rows), bool)
    if within:
        labels = rows["_within"].to_numpy()
        new_group[1:] = labels[1:] != labels[:-1]
    new_name = new_group.copy()
    new_name[1:] |= names[1:] != names[:-1]

    def following(new):
        """The position of the next True after each."""
        at = np.append(np.flatnonzero(new), len(new))
        return at[np.searchsorted(at, np.arange(len(new)), side="right")]

    side = _Side(matrix, np.arange(len(rows)))
    yield side, side, following(new_name), following(new_group)


def block_statistics(rows: pd.DataFrame, security: str, values: str, last: str, carried: tuple[str, ...],
                     within: bool, n: int | None = None, above: float | None = None,
                     texts: tuple[str, ...] = ()) -> Iterator[pd.DataFrame]:
    """All pairs of one block pair, or its ``n`` most extreme ones, those whose absolute score exceeds ``above``.

    Pairs are given away in batches, so memory holds the series of two blocks and one batch.
    """
    rows = rows.sort_values(["_within", security] if within else security, kind="stable", ignore_index=True)
    matrix, latest, names = _matrix(rows[values]), rows[last].to_numpy(np.float64), rows[security].to_numpy()
    # texts are repeated for many pairs; Arrow does that without an object each
    columns = {c: pa.array(rows[c], pa.large_string()) if c in texts else rows[c].to_numpy() for c in (security, *carried)}
    if not matrix.shape[1]:
        return

    def frame(pairs):
        out = pairs.drop(columns=["_one", "_two"])
        for c, column in columns.items():
            for k, at in ((1, pairs["_one"].to_numpy()), (2, pairs["_two"].to_numpy())):
                out[f"{c}_{k}"] = (pd.Series(pd.arrays.ArrowExtensionArray(column.take(pa.array(at))), index=out.index)
                                   if c in texts else column[at])
        return out

    def gathered(parts):
        return pd.DataFrame({c: np.concatenate([p[c] for p in parts]) for c in parts[0]})

    parts, held, kept = [], 0, None
    for a, b, starts, ends in _partners(rows, security, matrix, within):
        lasts = latest[b.at]
        for chunk in range(0, len(a.at), _CHUNK):
            ones = np.arange(chunk, min(chunk + _CHUNK, len(a.at)))
            ones = ones[starts[ones] < ends[ones]]
            if not len(ones):
                continue
            lowest, highest = starts[ones].min(), ends[ones].max()
            top = slice(ones[0], ones[-1] + 1)
            with np.errstate(all="ignore"):
                count, mean, std, unsure = _products(a, top, b, slice(lowest, highest))
            for i in ones:
                others, cut = slice(starts[i], ends[i]), (i - ones[0], slice(starts[i] - lowest, ends[i] - lowest))
                with np.errstate(all="ignore"):
                    found = _ranks(a.by_date[:, i], latest[a.at[i]], b.by_date[:, others], lasts[others])
                    found |= {"n_common": count[cut], "mean": mean[cut], "std": std[cut]}
                    again = np.flatnonzero(unsure[cut])
                    if len(again):
                        for c, exact in zip(("n_common", "mean", "std"), _moments(matrix, a.at[i], b.at[others][again])):
                            found[c][again] = exact
                keep = found["n_common"] > 0
                if above is not None:
                    keep &= _scores(found) > above
                found |= {"_one": np.full(len(keep), a.at[i]), "_two": b.at[others]}
                parts.append({c: column[keep] for c, column in found.items()})
                held += len(parts[-1]["_one"])
                if held > _BATCH:
                    pairs, parts, held = gathered(parts), [], 0
                    if n is None:
                        yield frame(pairs)
                    else:
                        kept = _most(pd.concat([kept, pairs], ignore_index=True), names, n)
    if parts:
        pairs = gathered(parts)
        if n is not None:
            pairs = _most(pd.concat([kept, pairs], ignore_index=True), names, n)
        yield frame(pairs)
    elif kept is not None:
        yield frame(kept)


def _places(pairs: pd.DataFrame, security: str, ranges: list[tuple]) -> np.ndarray:
    """In which range of the report (most extreme first, then by names) each pair falls; ``ranges`` are its ordered ends."""
    found = {c: pairs[c].to_numpy(np.float64) for c in ("std", "last_diff", "mean")}
    score = _scores(found)
    # in the report a score that is not a number comes first, a missing one last
    missing = np.isnan(score) & (np.isnan(found["last_diff"]) | np.isnan(found["mean"]))
    key = np.where(missing, np.inf, np.where(np.isnan(score), -np.inf, -score))
    ends = np.array([r[0] for r in ranges], np.float64)
    place, beyond = np.searchsorted(ends, key, "left"), np.searchsorted(ends, key, "right")
    place[missing] = len(ends)
    tied = np.flatnonzero((place < beyond) & np.isfinite(key))
    names = zip(pairs[f"{security}_1"].iloc[tied], pairs[f"{security}_2"].iloc[tied])
    for at, name in zip(tied, names):
        place[at] = bisect_left(ranges, name, place[at], beyond[at], key=lambda r: r[1:])
    return place.astype(np.int32)


def _most(pairs: pd.DataFrame, names: np.ndarray, n: int) -> pd.DataFrame:
    score = _scores({c: pairs[c].to_numpy() for c in ("std", "last_diff", "mean")})
    order = np.lexsort((names[pairs["_two"]].astype(str), names[pairs["_one"]].astype(str), -score))
    return pairs.iloc[order[:n]]


def pair_statistics(series: DataFrame, security: str, values: str, last: str,
                    carried: tuple[str, ...] = (), blocks: int | None = None,
                    within: str | None = None, n: int | None = None, above: float | None = None,
                    ranges: list[tuple] | None = None) -> DataFrame:
    """Statistics of the aligned difference for all pairs of ``series``.

    ``series`` has one row per security with an array ``values``, aligned over
    all series.  Positions where a side is missing (or NaN) do not count, pairs without
    a common position are absent; rows without a name, or without a group where ``within``
    names one, have no pairs.  ``blocks`` is the number of blocks all series are dealt over; with ``within`` a
    group larger than such a block is dealt over its own ones.  With ``n`` a block pair returns its ``n`` most extreme pairs only,
    with ``above`` the pairs beyond that absolute score, so the others are never written or shuffled.
    With ``ranges`` (``report_ranges``) each pair has its ``place``, the number of its range.
    """
    fields = {f.name: f.dataType for f in series.schema.fields}
    present = series.filter(quoted(security).isNotNull())
    if within:
        present = present.filter(quoted(within).isNotNull())
    dealt = present.select(*[quoted(c) for c in dict.fromkeys((security, values, last, *carried))],
                           *([quoted(within).cast("string").alias("_within")] if within else []))
    if within:
        dealt, cells = _dealt_within(dealt, security, blocks)
    else:
        blocks = blocks or block_count(series)
        cells = blocks * (blocks + 1) // 2
        dealt = dealt.select("*", F.lit(None).cast("string").alias("_split"), F.lit(blocks).alias("_blocks"),
                             F.pmod(F.xxhash64(quoted(security)), F.lit(blocks)).cast("int").alias("_own"))
    other = F.col("_other")
    # a bundle of whole groups has no other block; the comparison takes long and its input is small, so the tasks are fixed
    key = ["_split", "_one", "_two"]
    spread = (dealt.withColumn("_other", F.explode(F.when(F.col("_blocks") > 0, F.sequence(F.lit(0), F.col("_blocks") - 1))
                                                   .otherwise(F.array("_own"))))
              .withColumns({"_one": F.least("_own", other), "_two": F.greatest("_own", other)}).drop("_other", "_blocks")
              .repartition(min(max(cells, 1), _TASKS), *key))
    numbers = {"last_diff": "double", "n_common": "long", "mean": "double", "std": "double", "min_diff": "double",
               "max_diff": "double", "below": "long", "at_or_below": "long"}
    schema = T.StructType([T.StructField(f"{c}_{k}", fields[c]) for c in (security, *carried) for k in (1, 2)])
    for name, kind in numbers.items():
        schema = schema.add(name, kind)
    if ranges is not None:
        schema = schema.add("place", "integer")
    names = schema.names
    texts = tuple(c for c in (security, *carried) if isinstance(fields[c], T.StringType))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches), ignore_index=True)
        for found in block_statistics(rows, security, values, last, carried, bool(within), n, above, texts):
            if ranges is not None:
                found["place"] = _places(found, security, ranges)
            yield found[names]

    return spread.groupBy(*key).applyInPandas(compare, schema)


def pair_count(series: DataFrame, within: str | None = None) -> int:
    """At most so many pairs there are: of all series, or of those that share ``within``."""
    sizes = series.filter(quoted(within).isNotNull()).groupBy(quoted(within)) if within else series.groupBy()
    sizes = sizes.agg(F.count(F.lit(1)).cast("double").alias("n"))
    return int(sizes.agg(F.sum(F.col("n") * (F.col("n") - 1) / 2)).first()[0] or 0)


def report_ranges(series: DataFrame, security: str, values: str, last: str, within: str | None, pairs: int) -> list[tuple]:
    """Ends (negative absolute score, names) that divide the ``pairs``, most extreme first, into ranges of about equal size.

    Estimated from the pairs of some series; any ends give the right order, as they decide only which task sorts a pair.
    """
    wanted = max(math.ceil(pairs / _RANGE), int(series.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    share = min(1.0, math.sqrt(_SAMPLE / max(pairs, 1)))
    some = series.filter(F.pmod(F.xxhash64(quoted(security), F.lit("ranges")), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    found = pair_statistics(some, security, values, last, within=within)
    score = -F.abs(z_score(F.col("last_diff"), F.col("mean"), F.col("std")))
    rows = found.select(score.alias("k"), f"{security}_1", f"{security}_2").filter("k IS NOT NULL AND NOT isnan(k)").toPandas()
    rows = rows[np.isfinite(rows["k"])].sort_values(list(rows.columns), kind="stable")
    at = np.unique(np.linspace(0, len(rows), min(wanted, _RANGES) + 1)[1:-1].astype(int)) if len(rows) else []
    return sorted(set(rows.iloc[at].itertuples(index=False, name=None)))


def _dealt_within(series: DataFrame, security: str, blocks: int | None) -> tuple[DataFrame, int]:
    """Each series with its block: of its own group, if that is larger than a block, otherwise of a bundle of groups.

    A series is copied to the blocks of its group only, and each block pair is full of pairs of the group.
    Also the number of block pairs.
    """
    # one row per group
    sizes = series.groupBy("_within").agg(F.count(F.lit(1)).alias("_size"))
    rows, squares = sizes.agg(F.sum("_size"), F.sum(F.col("_size").cast("double") * F.col("_size"))).first()
    if not rows:
        return series.select("*", F.lit(None).cast("string").alias("_split"), F.lit(0).alias("_blocks"), F.lit(0).alias("_own")), 1
    if blocks:
        size = math.ceil(rows / blocks)
    else:
        wanted = int(series.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        # the pairs of fewer than 512 series take less time than starting a task
        size = min(max(math.ceil(math.sqrt(squares / (2 * wanted))), 512), 2048)
    bundles = math.ceil(rows / size)
    large = F.col("_size") > size
    sizes = sizes.select("_within", large.alias("_large"), F.when(large, F.ceil(F.col("_size") / size)).otherwise(0).cast("int").alias("_blocks"))
    dealt = series.join(sizes, "_within").select(
        *series.columns, F.when(F.col("_large"), F.col("_within")).alias("_split"), "_blocks",
        F.when(F.col("_large"), F.pmod(F.xxhash64(quoted(security)), F.col("_blocks")))
        .otherwise(F.pmod(F.xxhash64("_within"), F.lit(bundles))).cast("int").alias("_own"))
    return dealt, bundles + math.ceil(squares / (2 * size ** 2))
