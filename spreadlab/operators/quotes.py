"""Dealer quotes: period-over-period changes and best levels."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spreadlab.functions.scalars import quoted
from spreadlab.operators.dedup import rank_key
from spreadlab.operators.snapshots import as_of_columns
from spreadlab.params import MonitorParams


@dataclass(frozen=True)
class QuoteColumns:
    """Column names of a quote table; ``order`` decides which quote is last."""

    date: str = "Date"
    cusip: str = "CUSIP"
    dealer: str = "Dealer"
    order: tuple[str, ...] = ("Time",)
    bid: str = "Bid Spread"
    ask: str = "Ask Spread"
    bid_size: str = "Bid Size"
    ask_size: str = "Ask Size"
    labels: tuple[str, ...] = ()

    @property
    def measures(self) -> tuple[str, ...]:
        return (self.bid, self.ask, self.bid_size, self.ask_size)


def quotes_with_changes(quotes: DataFrame, cols: QuoteColumns, params: MonitorParams) -> DataFrame:
    """Quotes of the latest date with their change since each period's as-of date.

    One pass: the rows of the latest date and of the as-of dates are aggregated
    once per (identifier, dealer), taking the last non-NULL value of a measure
    per date.  The dates are scalar subqueries on the date column, so the scan
    reads only those few days of a date-partitioned table, and the aggregate is
    partial before its only shuffle.
    """
    at = as_of_columns(quotes, cols.date, params.periods)
    day = quoted(cols.date)
    wanted = day == at["latest"]
    for period in params.periods:
        wanted = wanted | (day == at[period])

    def last_on(column: str, date: Column) -> Column:
        c = quoted(column)
        return F.max_by(c, F.when((day == date) & c.isNotNull(), rank_key(cols.order, column)))

    aggregates = [F.max(day == at["latest"]).alias("_current")]
    aggregates += [last_on(c, at["latest"]).alias(c) for c in (*cols.measures, *cols.labels)]
    for period in params.periods:
        aggregates.append(last_on(cols.bid, at[period]).alias(f"_{period}_bid"))
        if period in params.size_periods:
            aggregates.append(last_on(cols.bid_size, at[period]).alias(f"_{period}_bid_size"))
            aggregates.append(last_on(cols.ask_size, at[period]).alias(f"_{period}_ask_size"))

    per_key = (quotes.filter(wanted & quoted(cols.cusip).isNotNull() & quoted(cols.dealer).isNotNull())
               .groupBy(quoted(cols.cusip), quoted(cols.dealer)).agg(*aggregates)
               .filter(F.col("_current")))
    changes = []
    for period in params.periods:
        changes.append((quoted(cols.bid) - F.col(f"_{period}_bid")).alias(period))
        if period in params.size_periods:
            changes.append((quoted(cols.bid_size) - F.col(f"_{period}_bid_size")).alias(f"{period} Chg Bid Size"))
            changes.append((quoted(cols.ask_size) - F.col(f"_{period}_ask_size")).alias(f"{period} Chg Ask Size"))
    names = (cols.cusip, cols.dealer, *cols.measures, *cols.labels)
    return per_key.select(*[quoted(c) for c in names], *changes)


def _best_side(spread: str, size: str, dealer: str, min_size: float, side: str) -> Column:
    eligible = (quoted(size) >= min_size) & quoted(spread).isNotNull()
    sign = 1 if side == "min" else -1
    rank = F.struct((quoted(spread) * sign).alias("s"), (-quoted(size)).alias("z"), quoted(dealer).alias("d"))
    level = F.struct(quoted(spread).alias("spread"), quoted(dealer).alias("dealer"), quoted(size).alias("size"))
    return F.min_by(level, F.when(eligible, rank))


def best_levels(quotes: DataFrame, cols: QuoteColumns, params: MonitorParams) -> DataFrame:
    """Best bid and offer per identifier among quotes of sufficient size.

    The best level is the smallest spread; ties go to the larger size, then to
    the dealer name.  ``Bid/Offer`` is NULL unless both sides exist.
    """
    sides = quotes.groupBy(quoted(cols.cusip)).agg(
        _best_side(cols.bid, cols.bid_size, cols.dealer, params.min_size, "min").alias("_b"),
        _best_side(cols.ask, cols.ask_size, cols.dealer, params.min_size, params.offer_side).alias("_o"))
    return sides.select(
        quoted(cols.cusip),
        F.col("_b.spread").alias("Best Bid"), F.col("_o.spread").alias("Best Offer"),
        (F.col("_b.spread") - F.col("_o.spread")).alias("Bid/Offer"),
        F.col("_b.dealer").alias("Dealer @ Best Bid"), F.col("_o.dealer").alias("Dealer @ Best Offer"),
        F.col("_b.size").alias("Size @ Best Bid"), F.col("_o.size").alias("Size @ Best Offer"))


def without_negatives(df: DataFrame, columns: Sequence[str], keep_missing: bool = True) -> DataFrame:
    """Drop rows with a negative value; missing values are kept or dropped too."""
    for name in columns:
        if name in df.columns:
            c = quoted(name)
            df = df.filter(c.isNull() | (c >= 0)) if keep_missing else df.filter(c >= 0)
    return df


def roll_up(df: DataFrame, keys: Sequence[str], rules: dict[str, Sequence[str]],
            order: Sequence[str]) -> DataFrame:
    """Mean, sum and first-non-NULL per key from a rule map; absent columns skip."""
    present = set(df.columns)
    build = {
        "mean": lambda c: F.avg(quoted(c)),
        "sum": lambda c: F.coalesce(F.sum(quoted(c)), F.lit(0.0)),
        "first": lambda c: F.min_by(quoted(c), F.when(quoted(c).isNotNull(), rank_key(order, c))),
    }
    aggregates = [build[rule](c).alias(c) for rule, names in rules.items() for c in names if c in present]
    return df.na.drop(subset=list(keys)).groupBy(*[quoted(k) for k in keys]).agg(*aggregates)
