"""Equality joins against a reference side.

No join carries a broadcast hint: reference sides grow with the data, and the
optimizer broadcasts them only below its own size threshold.  On the large
path adaptive execution splits partitions of a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spreadlab.functions.scalars import quoted
from spreadlab.operators.dedup import rank_key, unique_lookup


def many_to_one(df: DataFrame, dim: DataFrame, key: str, columns: Sequence[str],
                indicator: str | None = None) -> DataFrame:
    """Left lookup; fails when the reference key is not unique."""
    reference = unique_lookup(dim, key, columns)
    if indicator:
        reference = reference.withColumn(indicator, F.lit(True))
    joined = df.join(reference, key, "left")
    if indicator:
        joined = joined.withColumn(indicator, F.coalesce(F.col(indicator), F.lit(False)))
    return joined


def last_value_mapping(df: DataFrame, key: str, value: str, order: Sequence[str]) -> DataFrame:
    """One value per key; of several the last in ``order`` wins."""
    return df.groupBy(quoted(key)).agg(F.max_by(quoted(value), F.when(quoted(value).isNotNull(), rank_key(order, value))).alias(value))


def map_both_sides(pairs: DataFrame, mapping: DataFrame, key: str, value: str,
                   left: str, right: str, left_out: str, right_out: str) -> DataFrame:
    """Attach the mapped value of both sides of a pair."""
    def side(column, out):
        return mapping.select(quoted(key).alias(column), quoted(value).alias(out))
    return pairs.join(side(left, left_out), left, "left").join(side(right, right_out), right, "left")


def with_match_status(df: DataFrame, reference: DataFrame, key: str, reference_key: str | None = None,
                      status: str = "universe_match_status") -> DataFrame:
    """``matched`` or ``unmatched`` depending on presence in the reference."""
    known = (reference.select(quoted(reference_key or key).alias(key)).na.drop().distinct()
             .withColumn("_known", F.lit(True)))
    return (df.join(known, key, "left")
            .withColumn(status, F.when(F.col("_known"), "matched").otherwise("unmatched"))
            .drop("_known"))


def only_in(df: DataFrame, reference: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Semi join: rows whose key occurs in the reference."""
    return df.join(reference.select(*[quoted(k) for k in keys]), list(keys), "left_semi")


def not_in(df: DataFrame, reference: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Anti join: rows whose key does not occur in the reference."""
    return df.join(reference.select(*[quoted(k) for k in keys]), list(keys), "left_anti")
