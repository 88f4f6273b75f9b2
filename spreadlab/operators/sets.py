"""Set operations on rows and key lists."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns absent in a part are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def union_distinct(parts: Sequence[DataFrame]) -> DataFrame:
    return union_all(parts).distinct()


def key_overlap(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.intersect(right)


def key_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.subtract(right)


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()
