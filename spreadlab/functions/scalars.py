"""Cleaning expressions on single columns and projections over many."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spreadlab.params import Bins, IdentifierOverride, OutlierRule

# Single-character fractions and their plain spelling.
FRACTIONS = {"⅛": "1/8", "⅜": "3/8", "⅝": "5/8", "⅞": "7/8", "⅓": "1/3", "⅔": "2/3",
             "¼": "1/4", "¾": "3/4", "½": "1/2"}


NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
DAY_AND_CLOCK = r"^(\d{1,2}/\d{1,2}/(?:\d{4}|\d{2})|\d{1,2}-[A-Za-z]{3}-(?:\d{4}|\d{2}))(\s+(\d{1,2}:\d{2}(?::\d{2})?))?$"
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
CENTURY_PIVOT = 69  # two-digit years from here on are 19yy


def quoted(name: str) -> Column:
    """Column by its literal name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def to_double(c: Column) -> Column:
    """Number of a text, NULL where it is none.

    Only plain decimal and exponent notation counts: not NaN, infinities, or
    the type suffixes and hexadecimal forms a cast would read.
    """
    return F.when(c.cast("string").rlike(NUMBER), c.try_cast("double"))


def to_timestamp(c: Column) -> Column:
    """Timestamp of a text in ISO form or a usual vendor form, NULL where it is none.

    Vendor forms: month/day/year with two or four digits of the year and
    day-month-year with the month's English name, each with a time of day or without.
    """
    text = F.trim(c.cast("string"))
    # day and clock are put in ISO order, which the plain cast reads without formatter exceptions
    day = F.regexp_extract(text, DAY_AND_CLOCK, 1)
    clock = F.regexp_extract(text, DAY_AND_CLOCK, 3)
    slashed = F.when(day.contains("/"), F.split(day, "/"))
    dashed = F.when(day.rlike("-[A-Za-z]"), F.split(day, "-"))
    month = F.lpad((F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(F.get(dashed, F.lit(1))))).cast("string"), 2, "0")

    def iso(year: Column, month_text: Column, day_text: Column) -> Column:
        full = F.when(F.length(year) == 4, year).otherwise(
            F.concat(F.when(year.try_cast("int") < CENTURY_PIVOT, "20").otherwise("19"), year))
        date = F.concat(full, F.lit("-"), F.lpad(month_text, 2, "0"), F.lit("-"), F.lpad(day_text, 2, "0"))
        return F.concat_ws(" ", date, F.nullif(clock, F.lit(""))).try_cast("timestamp")

    return F.coalesce(c.try_cast("timestamp"),
                      iso(F.get(slashed, F.lit(2)), F.get(slashed, F.lit(0)), F.get(slashed, F.lit(1))),
                      iso(F.get(dashed, F.lit(2)), month, F.get(dashed, F.lit(0))))


def nan_to_null(c: Column) -> Column:
    return F.when(F.isnan(c), None).otherwise(c)


def nan_to_null_all(df: DataFrame) -> DataFrame:
    """NULL for every NaN, also inside arrays, structs and map values."""
    def clean(field):
        c = quoted(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return nan_to_null(c).alias(field.name)
        return clean_nested(c, field.dataType).alias(field.name)
    return df.select(*[clean(f) for f in df.schema.fields])


def clean_nested(c: Column, kind: T.DataType) -> Column:
    """NULL for every NaN inside numbers, arrays, structs and map values, at any depth."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return nan_to_null(c)
    if not _holds_floats(kind):
        return c
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: clean_nested(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(c, lambda _, v: clean_nested(v, kind.valueType))
    return F.when(c.isNotNull(), F.struct(*[clean_nested(c[f.name], f.dataType).alias(f.name) for f in kind.fields]))


def _holds_floats(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _holds_floats(kind.elementType)
    if isinstance(kind, T.MapType):
        return _holds_floats(kind.valueType)
    if isinstance(kind, T.StructType):
        return any(_holds_floats(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.DoubleType, T.FloatType))


def plain_fractions(c: Column) -> Column:
    for sign, spelled in FRACTIONS.items():
        c = F.replace(c, F.lit(sign), F.lit(spelled))
    return c


def clamp_outliers(c: Column, rule: OutlierRule = OutlierRule()) -> Column:
    """NULL beyond the outer limit, clamped to the inner one otherwise."""
    clamped = F.greatest(F.least(c, F.lit(rule.clamp)), F.lit(-rule.clamp))
    return F.when(F.abs(c) <= rule.drop_beyond, clamped)


def bucket_label(c: Column, bins: Bins) -> Column:
    label = None
    for upper, text in zip(bins.edges[1:], bins.labels):
        below = F.lit(True) if upper == float("inf") else c < upper
        label = F.when(below, text) if label is None else label.when(below, text)
    return F.when(c >= bins.edges[0], label)


def bucket_order(c: Column, bins: Bins) -> Column:
    """Position of the bin, for sorting by bucket."""
    passed = [F.when(c >= edge, 1).otherwise(0) for edge in bins.edges[1:-1]]
    return F.when(c >= bins.edges[0], sum(passed, F.lit(0)))


def percentage(part: Column, whole: Column) -> Column:
    """``part/whole`` in percent; NULL when the whole is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100


def blank(c: Column) -> Column:
    text = c.cast("string")
    return text.isNull() | (F.trim(text) == "")


def keep_columns(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in list order."""
    present = set(df.columns)
    return df.select(*[quoted(c) for c in keep if c in present])


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    dropped = set(names)
    return df.select(*[quoted(c) for c in df.columns if c not in dropped])


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema`` in its order, absent ones as NULL."""
    present = set(df.columns)
    return df.select(*[
        (quoted(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields])


def first_column(df: DataFrame, name: str) -> DataFrame:
    return df.select(quoted(name), *[quoted(c) for c in df.columns if c != name])


def text_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Cast to text; NULL stays NULL."""
    present = set(df.columns)
    return df.withColumns({n: quoted(n).cast("string") for n in names if n in present})


def apply_overrides(df: DataFrame, overrides: Sequence[IdentifierOverride], identifier: str = "CUSIP",
                    name: str = "SECURITY") -> DataFrame:
    """Fixed identifiers and names for special rows, rule after rule."""
    for rule in overrides:
        if rule.column not in df.columns:
            continue
        hit = F.coalesce(quoted(rule.column) == rule.equals, F.lit(False))
        changed = {identifier: F.when(hit, F.lit(rule.identifier)).otherwise(quoted(identifier).cast("string"))}
        if rule.name is not None:
            changed[name] = F.when(hit, F.lit(rule.name)).otherwise(quoted(name))
        df = df.withColumns(changed)
    return df


def with_lineage(df: DataFrame, source_file: Column, file_date: Column | None = None,
                 loaded_at: Column | None = None) -> DataFrame:
    return df.withColumns({
        "source_file": source_file,
        "file_date": file_date if file_date is not None else F.lit(None).cast("date"),
        "loaded_timestamp": loaded_at if loaded_at is not None else F.current_timestamp(),
    })
