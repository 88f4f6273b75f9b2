"""Exact quantiles by bracketing: a mergeable sketch, a counting pass, and a sort of what is left in doubt.

A first pass sketches the values (``percentile_approx``, a bounded summary per
task that merges).  Two of its cut points around a rank enclose the value in
question.  A second pass counts exactly how many values lie below and up to the
bracket, which also proves that the bracket holds the rank.  Only values inside
an open bracket, some four in ten thousand, are then shuffled and ranked by
ranges.  A bracket that does not hold its rank is opened to all values, so the
result is exact whatever the sketch said.

Grouped quantiles bracket only groups too large for one aggregation buffer;
all others are an ordinary exact aggregate.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spreadlab.functions.scalars import quoted
from spreadlab.session import staged

ACCURACY = 10_000            # a cut point of the sketch is off by at most this share of the ranks
MARGIN = 2.0 / ACCURACY      # distance of the cut points from the rank they enclose
GROUP_ROWS = 50_000          # values of a group that one aggregation buffer may hold


@dataclass(frozen=True)
class Bracket:
    """An interval of values that should hold the value of a rank; an end that is None is open."""

    column: str
    rank: int
    low: float | None
    high: float | None

    def below(self) -> Column:
        return F.lit(False) if self.low is None else F.col(self.column) < self.low

    def inside(self) -> Column:
        c = F.col(self.column)
        inside = c.isNotNull()
        inside = inside if self.low is None else inside & (c >= self.low)
        return inside if self.high is None else inside & (c <= self.high)


def cuts(value: Column, probabilities: Sequence[float], accuracy: int = ACCURACY) -> Column:
    """Array with two cut points per probability, on either side of it."""
    around = [min(1.0, max(0.0, p + d)) for p in probabilities for d in (-2.0 / accuracy, 2.0 / accuracy)]
    return F.percentile_approx(value, around, accuracy)


def ranks_of(n: int, probabilities: Sequence[float]) -> list[tuple[int, int]]:
    """0-based ranks on both sides of each quantile's place among ``n`` values."""
    places = [p * (n - 1) for p in probabilities]
    return [(math.floor(x), math.ceil(x)) for x in places]


def column_quantiles(df: DataFrame, columns: Sequence[str], probabilities: dict[str, float]) -> DataFrame:
    """column_name and the linearly interpolated quantiles of the non-NULL values of each column.

    All columns share the passes: two aggregates of one row each and a filtered scan; only those
    rows and the values found (two per column and probability) reach the driver.  NaN is greater
    than any number.  A column without values gives no row.  ``df`` is read up to three times, so
    what is costly to compute should be written first.
    """
    wanted = list(probabilities.values())
    names = [f"c{i}" for i in range(len(columns))]
    numbers = df.select(*[quoted(c).cast("double").alias(n) for c, n in zip(columns, names)])
    finite = numbers.select(*[F.when(~F.isnan(n), F.col(n)).alias(n) for n in names])
    sketch = numbers.agg(*[F.count(n).alias(f"n_{n}") for n in names],
                         *[F.count_if(F.isnan(n)).alias(f"nan_{n}") for n in names],
                         *[cuts(F.when(~F.isnan(n), F.col(n)), wanted).alias(f"cuts_{n}") for n in names]).first()
    totals = {n: sketch[f"n_{n}"] for n in names}
    numeric = {n: totals[n] - sketch[f"nan_{n}"] for n in names}
    asked = {n: ranks_of(totals[n], wanted) for n in names if totals[n]}
    brackets = {Bracket(n, rank, *sketch[f"cuts_{n}"][2 * i:2 * i + 2])
                for n in asked for i, pair in enumerate(asked[n]) for rank in pair if rank < numeric[n]}
    found = dict(_values_in(finite, sorted(brackets, key=lambda b: (b.column, b.rank))))

    def value(n: str, rank: int) -> float:
        return found[n, rank] if rank < numeric[n] else math.nan

    rows = []
    for column, n in zip(columns, names):
        if n in asked:
            row = [column]
            for p, (low, high) in zip(wanted, asked[n]):
                least, most = value(n, low), value(n, high)
                row.append(least if least == most else least + (most - least) * (p * (totals[n] - 1) - low))
            rows.append(tuple(row))
    schema = "column_name string" + "".join(f", `{name}` double" for name in probabilities)
    return df.sparkSession.createDataFrame(rows, schema)


def _values_in(df: DataFrame, brackets: Sequence[Bracket]) -> list[tuple[tuple[str, int], float]]:
    """The value of each bracket's rank, by exact counts and the values inside."""
    # several ranks may share a bracket's ends, and counting once is enough
    if not brackets:
        return []
    counts = df.agg(*[c for i, b in enumerate(brackets) for c in (
        F.count_if(b.below()).alias(f"below{i}"), F.count_if(b.inside()).alias(f"in{i}"))]).first()
    found, doubtful, starts = [], [], []
    for i, b in enumerate(brackets):
        below, within = counts[f"below{i}"], counts[f"in{i}"]
        if not below <= b.rank < below + within:
            b, below = Bracket(b.column, b.rank, None, None), 0
        if b.low is not None and b.low == b.high:
            found.append(((b.column, b.rank), float(b.low)))
        else:
            doubtful.append(b)
            starts.append(below)
    if doubtful:
        # rows with a value in doubt are few; only of them a row per column is made
        any_of = F.lit(False)
        for b in {replace(b, rank=0) for b in doubtful}:
            any_of = any_of | b.inside()
        columns = list(dict.fromkeys(b.column for b in doubtful))
        ends = F.broadcast(df.sparkSession.createDataFrame(
            [(b.column, k, b.low, b.high) for k, b in enumerate(doubtful)], "_c string, _k int, _low double, _high double"))
        kept = (df.filter(any_of).select(*columns).unpivot([], columns, "_c", "_v").filter("_v IS NOT NULL").join(ends, "_c")
                .filter((F.col("_low").isNull() | (F.col("_v") >= F.col("_low"))) & (F.col("_high").isNull() | (F.col("_v") <= F.col("_high"))))
                .groupBy("_k", "_v").agg(F.count(F.lit(1)).alias("_n")))
        places = df.sparkSession.createDataFrame(
            [(k, b.rank - start) for k, (b, start) in enumerate(zip(doubtful, starts))], "_k int, _rank long")
        for r in values_at(kept, ["_k"], places).collect():
            found.append(((doubtful[r["_k"]].column, doubtful[r["_k"]].rank), r["_v"]))
    return found


def values_at(histogram: DataFrame, keys: Sequence[str], places: DataFrame) -> DataFrame:
    """Rows of ``places`` with ``_v``, the value at 0-based ``_rank`` of their group.

    ``histogram`` has the keys, ``_v`` and its number ``_n``.  It is dealt to ranges of group and
    value; each range counts its own ranks and only the ranges' totals are accumulated per
    group, so no task sees more than its range, however large one group is.
    """
    columns = [quoted(k) for k in keys]
    ranged = staged(histogram.repartitionByRange(*columns, "_v").withColumn("_range", F.spark_partition_id()), "quantile-ranges")
    in_group = Window.partitionBy(*columns).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = (ranged.groupBy(*columns, "_range").agg(F.sum("_n").alias("_size"))
              .withColumn("_before", F.coalesce(F.sum("_size").over(in_group), F.lit(0))))
    # a place is looked up in the one range that holds it
    looked = places.join(totals, list(keys)).filter(
        (F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_size")))
    here = Window.partitionBy(*columns, "_range").orderBy("_v")
    ranked = ranged.withColumn("_end", F.sum("_n").over(here)).withColumn("_start", F.col("_end") - F.col("_n"))
    at = F.col("_rank") - F.col("_before")
    return looked.join(ranked, [*keys, "_range"]).filter((F.col("_start") <= at) & (at < F.col("_end"))).select(
        *[quoted(c) for c in places.columns], "_v")


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, probabilities: dict[str, float],
                    group_rows: int = GROUP_ROWS) -> DataFrame:
    """Linearly interpolated quantiles of the non-NULL values per group.

    ``probabilities`` maps output column names to probabilities in [0, 1].
    Groups of at most ``group_rows`` values are one exact aggregate each; larger
    ones, which are few, are bracketed.
    """
    keys = [quoted(k) for k in by]
    rows = df.select(*keys, quoted(value).cast("double").alias("_v")).filter("_v IS NOT NULL")
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_total")).filter(F.col("_total") > group_rows)
    large = staged(sizes.withColumn("_g", F.monotonically_increasing_id()), "large-groups")
    n_large = large.count()
    if not n_large:
        return _small_groups(rows, keys, probabilities)
    same = F.lit(True)
    for k in by:
        same = same & F.col("l." + _escaped(k)).eqNullSafe(F.col("r." + _escaped(k)))
    # at most one group in group_rows rows: sent to all tasks while few, joined by key beyond
    few = _few(large, n_large).alias("r")
    small = _small_groups(rows.alias("l").join(few, same, "left_anti"), keys, probabilities)
    grouped = rows.alias("l").join(few, same).select("_g", "_total", "_v")
    quantiles = _large_groups(grouped, n_large, list(probabilities.values())).join(large, "_g")
    return small.unionByName(quantiles.select(*keys, *[F.col(f"_q{i}").alias(name) for i, name in enumerate(probabilities)]))


def _escaped(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _few(table: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(table) if rows <= 100_000 else table


def _small_groups(rows: DataFrame, keys: Sequence[Column], probabilities: dict[str, float]) -> DataFrame:
    exact = F.percentile("_v", list(probabilities.values()))
    return rows.groupBy(*keys).agg(exact.alias("_q")).select(
        *keys, *[F.col("_q")[i].alias(name) for i, name in enumerate(probabilities)])


def _large_groups(grouped: DataFrame, n_groups: int, wanted: Sequence[float]) -> DataFrame:
    """_g and ``_q0`` and so on, from rows of ``_g``, its size ``_total`` and ``_v``."""
    finite = F.when(~F.isnan("_v"), F.col("_v"))
    place = [F.lit(p) * (F.col("_total") - 1) for p in wanted]
    ranks = [f(x).cast("long") for x in place for f in (F.floor, F.ceil)]

    def end(k: int, side: int) -> Column:
        """An end of the bracket of rank k; ranks beyond the numbers are NaN, which is above them all."""
        return F.when(ranks[k] >= F.col("_numbers"), F.lit(math.nan)).otherwise(F.col("_cuts")[2 * (k // 2) + side])

    sketched = staged(grouped.groupBy("_g", "_total").agg(cuts(finite, wanted).alias("_cuts"), F.count(finite).alias("_numbers")).select(
        "_g", "_total", *[c for k in range(len(ranks)) for c in (
            ranks[k].alias(f"_rank{k}"), end(k, 0).alias(f"_low{k}"), end(k, 1).alias(f"_high{k}"))]), "group-sketches")
    seen = grouped.select("_g", "_v").join(_few(sketched, n_groups), "_g")
    inside = [(F.col("_v") >= F.col(f"_low{k}")) & (F.col("_v") <= F.col(f"_high{k}")) for k in range(len(ranks))]
    counts = seen.groupBy("_g").agg(*[c for k in range(len(ranks)) for c in (
        F.count_if(F.col("_v") < F.col(f"_low{k}")).alias(f"_below{k}"), F.count_if(inside[k]).alias(f"_in{k}"))])
    held = [F.coalesce((F.col(f"_below{k}") <= F.col(f"_rank{k}")) & (F.col(f"_rank{k}") < F.col(f"_below{k}") + F.col(f"_in{k}")), F.lit(False))
            for k in range(len(ranks))]
    # one row per group and rank; a bracket that misses its rank is opened to all values
    known = staged(sketched.join(counts, "_g").select("_g", F.inline(F.array(*[F.struct(
        F.lit(k).alias("_k"), F.col(f"_low{k}").alias("_low"), F.col(f"_high{k}").alias("_high"), (~held[k]).alias("_open"),
        (F.col(f"_rank{k}") - F.when(held[k], F.col(f"_below{k}")).otherwise(0)).alias("_rank"))
        for k in range(len(ranks))]))), "group-brackets")
    closed = ~F.col("_open") & F.col("_low").eqNullSafe(F.col("_high"))
    direct = known.filter(closed).select("_g", "_k", F.col("_low").alias("_v"))
    doubtful = known.filter(~closed)
    within = F.col("_open") | ((F.col("_v") >= F.col("_low")) & (F.col("_v") <= F.col("_high")))
    kept = (grouped.select("_g", "_v").join(_few(doubtful, len(ranks) * n_groups), "_g").filter(within)
            .groupBy("_g", "_k", "_v").agg(F.count(F.lit(1)).alias("_n")))
    ranked = values_at(kept, ["_g", "_k"], doubtful.select("_g", "_k", "_rank")).select("_g", "_k", "_v")
    wide = ranked.unionByName(direct).groupBy("_g").agg(*[
        F.max(F.when(F.col("_k") == k, F.col("_v"))).alias(f"_v{k}") for k in range(len(ranks))]).join(sketched.select("_g", "_total"), "_g")
    return wide.select("_g", *[(F.col(f"_v{2 * i}") + (F.col(f"_v{2 * i + 1}") - F.col(f"_v{2 * i}")) * (x - F.floor(x))).alias(f"_q{i}")
                               for i, x in enumerate(place)])
