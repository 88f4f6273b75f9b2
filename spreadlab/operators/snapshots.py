"""Filters and lookups along the date column.

Dates of the whole table enter a filter as scalar subqueries, so a table that
is partitioned by date is pruned before it is read and nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spreadlab.functions.dates import is_business_day, reference_date
from spreadlab.functions.scalars import quoted
from spreadlab.session import checkpointed


def latest_date(df: DataFrame, date: str) -> Column:
    """Scalar subquery with the greatest date of the table."""
    return df.agg(F.max(quoted(date)).alias("d")).scalar()


def latest_snapshot(df: DataFrame, date: str) -> DataFrame:
    return df.filter(quoted(date) == latest_date(df, date))


def between_dates(df: DataFrame, date: str, start, end) -> DataFrame:
    """Closed range; either end may be open (None)."""
    if start is not None:
        df = df.filter(quoted(date) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(quoted(date) <= F.lit(end).cast("date"))
    return df


def in_year(df: DataFrame, date: str, year: int) -> DataFrame:
    """One calendar year, written as a range so that scans prune."""
    return between_dates(df, date, f"{year:04d}-01-01", f"{year:04d}-12-31")


def business_days(df: DataFrame, date: str) -> DataFrame:
    return df.filter(is_business_day(quoted(date)))


def calendar(df: DataFrame, date: str, descending: bool = False) -> DataFrame:
    """Distinct dates with their 0-based position.

    The sorted array has one element per calendar day that occurs, a few
    thousand at most however many rows the table has.
    """
    days = df.agg(F.sort_array(F.collect_set(quoted(date)), asc=not descending).alias("days"))
    return days.select(F.posexplode("days").alias("position", date))


def every_nth_date(df: DataFrame, date: str, step: int) -> DataFrame:
    """Rows of every ``step``-th distinct date, starting with the first."""
    if step <= 1:
        return df
    kept = calendar(df, date).filter(F.col("position") % step == 0).select(quoted(date))
    return df.join(kept, date, "left_semi")


def last_dates(df: DataFrame, date: str, n: int) -> DataFrame:
    """The ``n`` latest distinct dates (a distributed top-n, no global sort)."""
    return df.select(quoted(date)).distinct().orderBy(quoted(date).desc()).limit(n)


def _dates(df: DataFrame, date: str) -> DataFrame:
    """The distinct dates, kept: one pass over the table, a calendar of rows."""
    return checkpointed(df.select(quoted(date)).distinct())


def reference_dates(df: DataFrame, date: str, periods: Sequence[str]) -> DataFrame:
    """One row per period: reference day and the as-of date of the table.

    The as-of date is the greatest stored date not after the reference day; it
    is global, not per key, and NULL when the history is too short.
    """
    days = _dates(df, date)
    latest = latest_date(days, date)
    found = days.agg(*[
        F.max(F.when(quoted(date) <= reference_date(latest, p), quoted(date))).alias(f"a{i}")
        for i, p in enumerate(periods)])
    rows = F.array(*[
        F.struct(F.lit(p).alias("period"), reference_date(latest, p).alias("ref_date"),
                 F.col(f"a{i}").alias("as_of_date"))
        for i, p in enumerate(periods)])
    return found.select(F.inline(rows))


def as_of_columns(df: DataFrame, date: str, periods: Sequence[str]) -> dict[str, Column]:
    """Latest date (key ``latest``) and as-of date per period as subqueries."""
    days = _dates(df, date)
    latest = latest_date(days, date)
    found = days.agg(
        F.max(quoted(date)).alias("latest"),
        *[F.max(F.when(quoted(date) <= reference_date(latest, p), quoted(date))).alias(p)
          for p in periods])
    row = found.select(F.struct("*").alias("row")).scalar()
    return {name: row.getField(name) for name in ("latest", *periods)}
