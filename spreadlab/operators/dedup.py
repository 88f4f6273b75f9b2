"""One row per key.

``keep_last``/``keep_first`` take a whole row and are written as a filter on
``row_number``: Spark limits every group to one row before the shuffle, so a
key that holds a large share of the table costs one row per task.  The
column-wise forms are aggregates with map-side partial results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spreadlab.functions.scalars import quoted


def _total_order(df: DataFrame, keys: Sequence[str], order: Sequence[str], descending: bool) -> list[Column]:
    """Given order first, then all other columns, so that ties cannot occur."""
    named = [*order, *(c for c in df.columns if c not in keys and c not in order)]
    return [quoted(c).desc_nulls_last() if descending else quoted(c).asc_nulls_last() for c in named]


def _first_row(df: DataFrame, keys: Sequence[str], order: list[Column]) -> DataFrame:
    window = Window.partitionBy(*[quoted(k) for k in keys]).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") == 1).drop("_rn")


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` columns per key."""
    return _first_row(df, keys, _total_order(df, keys, order, descending=True))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the smallest ``order`` columns per key."""
    return _first_row(df, keys, _total_order(df, keys, order, descending=False))


def rank_key(order: Sequence[str], *taken: str) -> Column:
    """One comparable value: the order columns, then the columns that are taken.

    Rows that tie on both give the same result, so it never depends on the
    order in which rows arrive.
    """
    names = [*order, *(c for c in taken if c not in order)]
    return quoted(names[0]) if len(names) == 1 else F.struct(*[quoted(c) for c in names])


def last_non_null(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  columns: Sequence[str] | None = None) -> DataFrame:
    """Last non-NULL value of every column per key; may mix source rows.

    Rows with a NULL key are dropped; of equally late values the greatest is taken.
    """
    columns = columns or [c for c in df.columns if c not in keys and c not in order]
    return (df.na.drop(subset=list(keys)).groupBy(*[quoted(k) for k in keys])
            .agg(*[F.max_by(quoted(c), F.when(quoted(c).isNotNull(), rank_key(order, c))).alias(c) for c in columns]))


def first_non_null(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   columns: Sequence[str] | None = None) -> DataFrame:
    """First non-NULL value of every column per key; of equally early ones the smallest.  May mix source rows."""
    columns = columns or [c for c in df.columns if c not in keys and c not in order]
    return (df.na.drop(subset=list(keys)).groupBy(*[quoted(k) for k in keys])
            .agg(*[F.min_by(quoted(c), F.when(quoted(c).isNotNull(), rank_key(order, c))).alias(c) for c in columns]))


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return (df.groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def unique_lookup(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Reference table with a checked unique key.

    The check runs inside the plan: reading a value of a repeated key fails the
    query, so no separate job is needed and nothing wrong is returned.
    """
    grouped = df.filter(quoted(key).isNotNull()).groupBy(quoted(key)).agg(
        F.count(F.lit(1)).alias("_n"), *[F.min(quoted(c)).alias(c) for c in columns])
    message = F.concat(F.lit(f"{key} is not unique: "), quoted(key).cast("string"))
    return grouped.select(quoted(key), *[
        F.when(F.col("_n") == 1, quoted(c)).otherwise(F.raise_error(message)).alias(c)
        for c in columns])
