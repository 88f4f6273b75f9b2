"""Table and column profiles as DataFrames.

Statistics of all columns come from one aggregate whose single row is unfolded
to one row per column, so a profile scans its table once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spreadlab.functions.scalars import blank, quoted, to_double
from spreadlab.operators.quantiles import column_quantiles, exact_quantiles
from spreadlab.session import staged

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
FIVE_NUMBERS = {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def per_column(df: DataFrame, columns: Sequence[str], statistics: dict[str, Callable[[Column], Column]],
               extra: dict[str, Column] | None = None) -> DataFrame:
    """One row per column with the given aggregates, from a single aggregate row.

    ``extra`` aggregates (of the whole table) are repeated on every row.
    """
    extra = extra or {}
    row = df.agg(
        *[build(quoted(c)).alias(f"{i}_{name}") for i, c in enumerate(columns)
          for name, build in statistics.items()],
        *[c.alias(f"x_{name}") for name, c in extra.items()])
    unfolded = F.array(*[
        F.struct(F.lit(c).alias("column_name"),
                 *[F.col(f"{i}_{name}").alias(name) for name in statistics],
                 *[F.col(f"x_{name}").alias(name) for name in extra])
        for i, c in enumerate(columns)])
    return row.select(F.inline(unfolded))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column: count and percentage of the rows."""
    counts = per_column(df, columns or df.columns,
                        {"null_count": lambda c: F.count_if(c.isNull())},
                        {"total_rows": F.count(F.lit(1))})
    return counts.withColumn("null_pct", F.try_divide(F.col("null_count") * 100.0, F.col("total_rows")))


def columns_above_null_share(df: DataFrame, pct: float = 50.0) -> DataFrame:
    return null_counts(df).filter(F.col("null_pct") > pct)


def overall_missing(df: DataFrame, max_pct: float = 95.0) -> DataFrame:
    """Share of missing cells in the whole table, with the threshold verdict."""
    cells = null_counts(df).agg(
        F.sum("null_count").alias("missing_cells"), F.sum("total_rows").alias("cells"))
    share = F.try_divide(F.col("missing_cells") * 100.0, F.col("cells"))
    return cells.withColumn("missing_pct", share).withColumn(
        "passed", F.coalesce(F.col("missing_pct") <= max_pct, F.lit(True)))


def blank_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values that are NULL or empty after trimming, per column."""
    return per_column(df, columns, {"blank_count": lambda c: F.count_if(blank(c))})


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, minimum, exact quartiles and maximum per column."""
    # written once: the passes over it compare each number many times, and a text would be read for every comparison
    numbers = staged(df.select(*[to_double(quoted(c)).alias(c) for c in columns]), "numbers")
    basic = per_column(numbers, columns, {
        "n": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max})
    return basic.join(column_quantiles(numbers, columns, QUARTILES), "column_name", "left")


def five_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Minimum, quartiles and maximum of each column that has values, all from the same passes."""
    return column_quantiles(df, columns, FIVE_NUMBERS)


def numeric_statistics(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Minimum, maximum, mean, deviation and distinct count per numeric column."""
    columns = list(columns or numeric_columns(df))
    basic = per_column(df, columns, {
        "min": lambda c: F.min(c).cast("double"), "max": lambda c: F.max(c).cast("double"),
        "mean": F.avg, "std": F.stddev_samp})
    return basic.join(distinct_counts(df, columns), "column_name", "left")


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per (column, value), collapsed before the shuffle."""
    texts = df.select(*[quoted(c).cast("string").alias(c) for c in columns])
    return (texts.unpivot([], list(columns), "column_name", "value")
            .filter(F.col("value").isNotNull())
            .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n")))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    present = value_counts(df, columns).groupBy("column_name").agg(F.count(F.lit(1)).alias("unique_count"))
    return present


def categorical_distribution(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Value counts with share of all rows and distinct count per column."""
    # one scan: the counts, with those of missing values, are kept and read for the totals
    texts = df.select(*[quoted(c).cast("string").alias(c) for c in columns])
    counts = staged(texts.unpivot([], list(columns), "column_name", "value")
                    .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n")), "value-counts")
    totals = counts.groupBy("column_name").agg(F.sum("n").alias("_total"), F.count("value").alias("unique_count"))
    return (counts.filter(F.col("value").isNotNull()).join(totals, "column_name")
            .withColumn("pct", F.col("n") * 100.0 / F.col("_total"))
            .select("column_name", "value", "n", "pct", "unique_count"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of equal rows.

    Rows are first grouped by a 128-bit hash, so only two numbers a row are
    shuffled; whole rows are compared where a hash occurs more than once.
    """
    columns = [quoted(c) for c in df.columns]
    keyed = df.select(*columns, F.xxhash64(*columns).alias("_h1"), F.xxhash64(F.lit(1), *columns).alias("_h2"))
    repeated = keyed.groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_h1", "_h2")
    groups = keyed.join(repeated, ["_h1", "_h2"], "left_semi").groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))


def dated_counts(df: DataFrame, date: str) -> DataFrame:
    return df.filter(quoted(date).isNotNull()).groupBy(quoted(date)).agg(F.count(F.lit(1)).alias("n_records"))


def date_coverage(df: DataFrame, date: str) -> DataFrame:
    """Distinct dates, range, span and dated rows, from the per-date counts."""
    span = F.datediff(F.max(quoted(date)), F.min(quoted(date)))
    return dated_counts(df, date).agg(
        F.count(F.lit(1)).alias("unique_dates"), F.min(quoted(date)).alias("min_date"),
        F.max(quoted(date)).alias("max_date"), span.cast("bigint").alias("span_days"),
        F.round(span / 365.25, 1).alias("span_years"), F.coalesce(F.sum("n_records"), F.lit(0)).alias("n_records"))


def records_per_date(df: DataFrame, date: str) -> DataFrame:
    return dated_counts(df, date).agg(F.min("n_records").alias("min_records"),
                                      F.max("n_records").alias("max_records"),
                                      F.avg("n_records").alias("avg_records"))


def year_distribution(df: DataFrame, date: str) -> DataFrame:
    """Rows per year split into business days and weekends."""
    weekday = F.weekday(quoted(date)) < 5
    return (df.filter(quoted(date).isNotNull()).groupBy(F.year(quoted(date)).alias("year"))
            .agg(F.count(F.lit(1)).alias("n_records"),
                 F.count_if(weekday).alias("business_days"), F.count_if(~weekday).alias("weekend_days"))
            .withColumns({"business_pct": F.col("business_days") * 100.0 / F.col("n_records"),
                          "weekend_pct": F.col("weekend_days") * 100.0 / F.col("n_records")}))


def recent_months(df: DataFrame, date: str, months: int = 12) -> DataFrame:
    """Rows per month for the last months before the latest date."""
    latest = df.agg(F.max(quoted(date)).alias("d")).scalar()
    return (df.filter(quoted(date) >= F.add_months(latest, -months))
            .groupBy(F.trunc(quoted(date), "MM").alias("month")).agg(F.count(F.lit(1)).alias("n_records"))
            .orderBy(F.col("month").desc()).limit(months))


def edge_dates(df: DataFrame, date: str, n: int = 5) -> DataFrame:
    """The first and last ``n`` dates with their row counts."""
    counts = dated_counts(df, date)
    first = counts.orderBy(quoted(date)).limit(n).withColumn("edge", F.lit("first"))
    last = counts.orderBy(quoted(date).desc()).limit(n).withColumn("edge", F.lit("last"))
    return first.unionByName(last)


def head_and_tail(df: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    """First and last ``n`` rows in an explicit order."""
    head = df.orderBy(*[quoted(c).asc_nulls_last() for c in order]).limit(n).withColumn("part", F.lit("head"))
    tail = df.orderBy(*[quoted(c).desc_nulls_first() for c in order]).limit(n).withColumn("part", F.lit("tail"))
    return head.unionByName(tail)


def top_values(df: DataFrame, columns: Sequence[str], n: int = 3) -> DataFrame:
    """The ``n`` most frequent values per column."""
    window = Window.partitionBy("column_name").orderBy(F.col("n").desc(), "value")
    return (value_counts(df, columns).withColumn("rank", F.row_number().over(window))
            .filter(F.col("rank") <= n))


def most_missing_columns(df: DataFrame, n: int = 5) -> DataFrame:
    return (null_counts(df).filter(F.col("null_count") > 0)
            .orderBy(F.col("null_count").desc(), "column_name").limit(n))


def monthly(df: DataFrame, date: str, value: str, method: str, by: Sequence[str] = ()) -> DataFrame:
    """Resample to month ends: last, first, mean or median of the non-NULL values.

    Grouped per ``by``; an empty ``by`` resamples the table as one series.
    """
    keys = [*[quoted(c) for c in by], F.last_day(quoted(date)).alias("month_end")]
    if method == "median":
        months = df.select(*keys, quoted(value))
        return exact_quantiles(months, [*by, "month_end"], value, {value: 0.5})
    order = F.when(quoted(value).isNotNull(), F.struct(quoted(date), quoted(value)))
    build = {"last": lambda: F.max_by(quoted(value), order), "first": lambda: F.min_by(quoted(value), order),
             "mean": lambda: F.avg(quoted(value))}
    if method not in build:
        raise ValueError(f"unknown resample method {method!r}")
    return df.groupBy(*keys).agg(build[method]().alias(value))
