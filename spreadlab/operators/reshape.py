"""Wide and long forms."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spreadlab.functions.scalars import quoted


def wide_to_long(df: DataFrame, date: str, name: str = "Security", value: str = "GSpread") -> DataFrame:
    """One row per date and value column."""
    columns = [c for c in df.columns if c != date]
    return df.unpivot([quoted(date)], [quoted(c) for c in columns], name, value)


def long_to_wide(df: DataFrame, date: str, security: str, value: str, columns: Sequence[str]) -> DataFrame:
    """Small export form: one column per listed security."""
    return df.groupBy(quoted(date)).pivot(security, list(columns)).agg(F.max(quoted(value)))


def without_matching_columns(df: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """Drop the columns whose name contains one of the patterns."""
    return df.select(*[quoted(c) for c in df.columns if not any(p in c for p in patterns)])


def without_repeated_headers(df: DataFrame) -> DataFrame:
    """Drop ``X.1``, ``X.2``, … where a column ``X`` exists: later copies of a repeated header."""
    present = set(df.columns)
    repeated = {c for c in df.columns if (base := re.sub(r"\.\d+$", "", c)) != c and base in present}
    return df.select(*[quoted(c) for c in df.columns if c not in repeated])


def rename_positions(df: DataFrame, names: dict[str, str], on_duplicate: str = "keep_first") -> DataFrame:
    """Rename columns where the new names may collide.

    ``keep_first`` keeps the first of equal names, ``drop_all`` none of them,
    ``fail`` refuses.
    """
    target = [names.get(c, c) for c in df.columns]
    counts = Counter(target)
    if on_duplicate == "fail" and max(counts.values()) > 1:
        raise ValueError(f"duplicate columns: {', '.join(sorted(c for c, n in counts.items() if n > 1))}")
    kept, seen = [], set()
    for position, name in enumerate(target):
        if counts[name] > 1 and (on_duplicate == "drop_all" or name in seen):
            continue
        seen.add(name)
        kept.append((position, name))
    return df.select(*[quoted(df.columns[i]).alias(name) for i, name in kept])
