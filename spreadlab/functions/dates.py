"""Calendar expressions: parsing, features and reference dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DATE_FEATURES = ("Year", "Month", "Quarter", "DayOfWeek", "DayName", "MonthName",
                 "IsBusinessDay", "IsMonthEnd", "IsQuarterEnd", "IsYearEnd")


def _full_year(short_year: Column, pivot: int) -> Column:
    """Four-digit text of a two-digit year; from ``pivot`` on it is 19yy."""
    return F.concat(F.when(short_year.try_cast("int") < pivot, "20").otherwise("19"), short_year)


def century_date(text: Column, pivot: int = 69) -> Column:
    """Date from ``MM.DD.YY`` inside a text; years from ``pivot`` on are 19yy.

    NULL where the text holds no such group or the group is no calendar day.
    """
    found = F.nullif(F.regexp_extract(text, r"\d{2}\.\d{2}\.\d{2}", 0), F.lit(""))
    return F.concat_ws("-", _full_year(F.right(found, F.lit(2)), pivot),
                       F.left(found, F.lit(2)), F.substring(found, 4, 2)).try_cast("date")


def parse_date(c: Column, fmt: str, pivot: int = 69) -> Column:
    """Date by one format of day, month and year, NULL where it does not fit.

    The parts are checked by shape and put in ISO order, which the plain cast
    reads; a formatter would raise and catch an exception per misfit.  For a
    two-digit year the strptime pivot applies (69 and later are 19yy), which
    differs from the ``yy`` letter of Spark.
    """
    separator = next(ch for ch in fmt if not ch.isalpha())
    fields = fmt.split(separator)
    shapes = {"yyyy": r"\d{4}", "yy": r"\d{2}", "MM": r"\d{1,2}", "dd": r"\d{1,2}"}
    if not set(fields) <= set(shapes) or len(fields) != 3:
        raise ValueError(f"unsupported date format {fmt!r}")
    text = F.trim(c.cast("string"))
    shape = "^" + f"[{separator}]".join(shapes[f] for f in fields) + "$"
    parts = F.when(text.rlike(shape), F.split(text, f"[{separator}]"))
    part = {f: F.get(parts, F.lit(i)) for i, f in enumerate(fields)}
    year = part["yyyy"] if "yyyy" in part else _full_year(part["yy"], pivot)
    return F.concat(year, F.lit("-"), part["MM"], F.lit("-"), part["dd"]).try_cast("date")


def parse_with_first_fitting(df: DataFrame, column: str, formats: Sequence[str],
                             target: str | None = None) -> DataFrame:
    """Parse a whole column with the first format that fits at least one value.

    One aggregate counts the fits of all formats; its single row is a scalar
    subquery, so the choice is made inside the plan.
    """
    fits = df.agg(*[F.count(parse_date(F.col(column), f)).alias(f"f{i}") for i, f in enumerate(formats)])
    choice = F.lit(len(formats))
    for i in reversed(range(len(formats))):
        choice = F.when(F.col(f"f{i}") > 0, F.lit(i)).otherwise(choice)
    chosen = fits.select(choice.alias("choice")).scalar()
    parsed = F.lit(None).cast("date")
    for i in reversed(range(len(formats))):
        parsed = F.when(chosen == i, parse_date(F.col(column), formats[i])).otherwise(parsed)
    return df.withColumn(target or column, parsed)


def clock_text(c: Column) -> Column:
    """``HH:mm`` text of a time given as text, NULL where it is not a time."""
    text = F.trim(c.cast("string"))
    shape = F.when(text.rlike(r"^([01]?\d|2[0-3]):[0-5]?\d(:[0-5]?\d)?$"), F.split(text, ":"))
    two_digits = lambda i: F.lpad(F.get(shape, F.lit(i)), 2, "0")
    return F.concat(two_digits(0), F.lit(":"), two_digits(1))


def iso_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def is_business_day(c: Column) -> Column:
    """Monday to Friday; there is no holiday calendar."""
    return F.weekday(c) < 5


def date_features(c: Column) -> list[Column]:
    """The ten calendar features, in the order of ``DATE_FEATURES``."""
    quarter_end = F.last_day(c) == c
    return [
        F.year(c).alias("Year"),
        F.month(c).alias("Month"),
        F.quarter(c).alias("Quarter"),
        F.weekday(c).alias("DayOfWeek"),
        F.date_format(c, "EEEE").alias("DayName"),
        F.date_format(c, "MMMM").alias("MonthName"),
        is_business_day(c).alias("IsBusinessDay"),
        (F.last_day(c) == c).alias("IsMonthEnd"),
        (quarter_end & (F.month(c) % 3 == 0)).alias("IsQuarterEnd"),
        (quarter_end & (F.month(c) == 12)).alias("IsYearEnd"),
    ]


def reference_date(c: Column, period: str) -> Column:
    """The day a period change looks back to."""
    if period == "DoD":
        return F.date_sub(c, 1)
    if period == "WoW":
        return F.date_sub(c, 7)
    if period == "MTD":
        return F.date_sub(F.trunc(c, "MM"), 1)
    if period == "QTD":
        return F.date_sub(F.trunc(c, "QUARTER"), 1)
    if period == "YTD":
        return F.date_sub(F.trunc(c, "YEAR"), 1)
    if period == "1YR":
        return F.add_months(c, -12)
    raise ValueError(f"unknown period {period!r}")
