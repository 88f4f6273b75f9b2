"""The predicate language: ``predicate(column, operator, *values) -> Column``.

Every predicate yields TRUE or FALSE, never NULL, so it can be negated and
combined freely.  A missing value fails every test except ``!=``, ``not_in``,
``is_null`` and ``pair_not_equal``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _false_on_null(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def _text(c: Column) -> Column:
    return c.cast("string")


_OPERATORS = {
    "==": lambda c, v: _false_on_null(c == F.lit(v)),
    "!=": lambda c, v: ~c.eqNullSafe(F.lit(v)),
    "in": lambda c, vs: _false_on_null(c.isin(list(vs))),
    "not_in": lambda c, vs: ~_false_on_null(c.isin(list(vs))),
    "contains": lambda c, v: _false_on_null(_text(c).contains(v)),
    "startswith": lambda c, v: _false_on_null(_text(c).startswith(v)),
    ">": lambda c, v: _false_on_null(c > F.lit(v)),
    "<": lambda c, v: _false_on_null(c < F.lit(v)),
    ">=": lambda c, v: _false_on_null(c >= F.lit(v)),
    "<=": lambda c, v: _false_on_null(c <= F.lit(v)),
    "between": lambda c, a, b: _false_on_null(c.between(F.lit(a), F.lit(b))),
    "not_between": lambda c, a, b: _false_on_null(~c.between(F.lit(a), F.lit(b))),
    "abs_>": lambda c, v: _false_on_null(F.abs(c) > F.lit(v)),
    "abs_<": lambda c, v: _false_on_null(F.abs(c) < F.lit(v)),
    "is_null": lambda c: c.isNull(),
    "not_null": lambda c: c.isNotNull(),
    "pair_equal": lambda c, other: _false_on_null(c == F.col(other)),
    "pair_not_equal": lambda c, other: ~c.eqNullSafe(F.col(other)),
}

OPERATORS = tuple(_OPERATORS)


def predicate(column: str | Column, operator: str, *values) -> Column:
    """Boolean column for one condition."""
    if operator not in _OPERATORS:
        raise ValueError(f"unknown operator {operator!r}; one of {', '.join(OPERATORS)}")
    c = F.col(column) if isinstance(column, str) else column
    return _OPERATORS[operator](c, *values)


def matching(df: DataFrame, *conditions: tuple) -> DataFrame:
    """Rows that satisfy all ``(column, operator, *values)`` conditions."""
    tests = [predicate(*condition) for condition in conditions]
    return df.filter(reduce(lambda a, b: a & b, tests)) if tests else df
