"""Data-quality checks; every check returns rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spreadlab.functions.dates import parse_date
from spreadlab.functions.scalars import quoted, to_double
from spreadlab.operators.dedup import duplicate_groups
from spreadlab.operators.profiling import (
    distinct_counts, duplicate_rows, numeric_columns, per_column)
from spreadlab.params import QualityParams

CLOCK_PATTERN = r"^([01]?\d|2[0-3]):[0-5]\d$"


def non_numeric_rows(df: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Rows whose value in a numeric column is no number: key, column, value."""
    texts = df.select(*[quoted(k) for k in keys], *[quoted(c).cast("string").alias(f"_{c}") for c in columns])
    offending = F.filter(
        F.array(*[F.struct(F.lit(c).alias("column_name"), quoted(f"_{c}").alias("value")) for c in columns]),
        lambda x: x["value"].isNotNull() & to_double(x["value"]).isNull())
    return texts.select(*[quoted(k) for k in keys], F.inline(offending))


def negative_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    counts = per_column(df, present, {"negative_count": lambda c: F.count_if(c < 0)})
    return counts.withColumn("passed", F.col("negative_count") == 0)


def _date_time_counts(df: DataFrame, date: str | None, time: str | None, today: Column) -> dict[str, Column]:
    checks: dict[str, Column] = {}
    if date in df.columns:
        checks["null_dates"] = F.count_if(quoted(date).isNull())
        checks["future_dates"] = F.count_if(quoted(date).try_cast("date") > today)
    if time in df.columns:
        checks["null_times"] = F.count_if(quoted(time).isNull())
        checks["invalid_times"] = F.count_if(~quoted(time).rlike(CLOCK_PATTERN))
    return checks


def date_time_checks(df: DataFrame, date: str | None, time: str | None, today: Column) -> DataFrame:
    """NULL and future dates, NULL and malformed times: one row per check."""
    checks = _date_time_counts(df, date, time, today)
    row = df.agg(*[c.alias(n) for n, c in checks.items()])
    return row.unpivot([], list(checks), "check_type", "n")


def required_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Presence and filled rows of each required column."""
    present = [c for c in required if c in df.columns]
    row = df.agg(F.count(F.lit(1)).alias("total"), *[F.count(quoted(c)).alias(f"n_{i}") for i, c in enumerate(present)])
    unfolded = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(c in present).alias("present"),
                 (F.col(f"n_{present.index(c)}") if c in present else F.lit(0).cast("bigint")).alias("filled_rows"))
        for c in required])
    return row.select(F.inline(unfolded))


def assert_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return df


def date_format_verdict(df: DataFrame, column: str, params: QualityParams = QualityParams()) -> DataFrame:
    """Share of values each format parses and the verdict per format."""
    total = F.count(F.lit(1))
    row = df.agg(total.alias("total"), *[
        F.count(parse_date(quoted(column), f)).alias(f"f{i}") for i, f in enumerate(params.date_formats)])
    unfolded = F.array(*[F.struct(F.lit(f).alias("date_format"), F.col(f"f{i}").alias("parsed"), F.col("total"))
                         for i, f in enumerate(params.date_formats)])
    share = F.try_divide(F.col("parsed").cast("double"), F.col("total"))
    verdict = (F.when(share > params.date_valid_share, "valid")
               .when(F.coalesce(share, F.lit(0.0)) < params.date_invalid_share, "invalid").otherwise("partial"))
    return row.select(F.inline(unfolded)).withColumns({"share": share, "verdict": verdict})


def quality_report(df: DataFrame, non_negative: Sequence[str], date: str | None, time: str | None,
                   today: Column, params: QualityParams = QualityParams()) -> DataFrame:
    """All checks of a table as (check, column, value, result) rows.

    Counts, missing values, statistics, signs and dates come from one aggregate
    row; repeated rows and distinct values need a grouping each.
    """
    numbers = numeric_columns(df)
    signed = [c for c in non_negative if c in df.columns]
    aggregates: list[Column] = [F.count(F.lit(1)).alias("rows")]
    entries: list[tuple[str, str | None, Column, Column | str]] = [
        ("total_rows", None, F.col("rows"), "info"), ("total_columns", None, F.lit(len(df.columns)), "info")]

    def measure(check: str, column: str | None, value: Column, result, finish=lambda c: c) -> None:
        name = f"m{len(aggregates)}"
        aggregates.append(value.alias(name))
        done = finish(F.col(name))
        entries.append((check, column, done, result(done) if callable(result) else result))

    flagged = lambda verdict: lambda c: F.when(c > 0, verdict).otherwise("passed")
    for c in df.columns:
        measure("null_pct", c, F.count_if(quoted(c).isNull()),
                lambda pct: F.when(pct > params.null_warning_pct, "warning").otherwise("passed"),
                finish=lambda k: F.try_divide(k * 100.0, F.col("rows")))
    for c in numbers:
        for check, build in (("min", F.min), ("max", F.max), ("mean", F.avg), ("std", F.stddev_samp)):
            measure(check, c, build(quoted(c)), "info")
    for c in signed:
        measure("negative_values", c, F.count_if(quoted(c) < 0), flagged("failed"))
    for check, value in _date_time_counts(df, date, time, today).items():
        measure(check, None, value, flagged("warning"))

    text = lambda v: (F.lit(v) if isinstance(v, str) or v is None else v).cast("string")
    rows = df.agg(*aggregates).select(F.inline(F.array(*[
        F.struct(F.lit(check).alias("check_type"), text(column).alias("column_name"),
                 (F.round(value, 2) if check == "null_pct" else value).cast("double").alias("check_value"),
                 text(result).alias("check_result"))
        for check, column, value, result in entries])))
    repeated = duplicate_rows(df).select(
        F.lit("duplicate_rows").alias("check_type"), F.lit(None).cast("string").alias("column_name"),
        F.col("duplicate_rows").cast("double").alias("check_value"),
        F.when(F.col("duplicate_rows") > 0, "warning").otherwise("passed").alias("check_result"))
    report = rows.unionByName(repeated)
    if numbers:
        report = report.unionByName(distinct_counts(df, numbers).select(
            F.lit("unique_count").alias("check_type"), "column_name",
            F.col("unique_count").cast("double").alias("check_value"), F.lit("info").alias("check_result")))
    return report


def validation_passed(report: DataFrame) -> DataFrame:
    """False when a check failed (warnings do not count)."""
    return report.agg((F.count_if(F.col("check_result") == "failed") == 0).alias("validation_passed"),
                      F.count_if(F.col("check_result") == "warning").alias("warnings"))


def date_like_columns(df: DataFrame, params: QualityParams = QualityParams()) -> list[str]:
    return [c for c in df.columns if any(hint in c for hint in params.name_hints)]


def time_series_columns(df: DataFrame, params: QualityParams = QualityParams()) -> DataFrame | None:
    """Range and distinct dates of every column named like a date."""
    names = date_like_columns(df, params)
    if not names:
        return None

    def as_date(name: str) -> Column:
        text = isinstance(df.schema[name].dataType, T.StringType)
        return (F.coalesce(*[parse_date(quoted(name), f) for f in params.date_formats]) if text else quoted(name)).cast("date")

    # one scan: rows per (column, day), then the ranges
    days = (df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), as_date(c).alias("d")) for c in names])))
            .groupBy("column_name", "d").agg(F.count("d").alias("n")))
    return days.groupBy("column_name").agg(
        F.min("d").alias("start_date"), F.max("d").alias("end_date"), F.sum("n").alias("total_dates"),
        F.count("d").alias("unique_dates"))


def table_profile(df: DataFrame, table: str, params: QualityParams = QualityParams()) -> DataFrame:
    """Per column: type, rows, missing values and numeric statistics."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    numbers = numeric_columns(df)
    as_number = lambda f: (lambda c: f(c).cast("double"))
    row = df.agg(F.count(F.lit(1)).alias("total_rows"),
                 *[F.count_if(quoted(c).isNull()).alias(f"null_{i}") for i, c in enumerate(df.columns)],
                 *[as_number(f)(quoted(c)).alias(f"{n}_{i}") for i, c in enumerate(df.columns) if c in numbers
                   for n, f in (("min", F.min), ("max", F.max), ("mean", F.avg), ("std", F.stddev_samp))])
    missing = F.lit(None).cast("double")
    unfolded = F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"),
                 F.lit(types[c]).alias("data_type"), F.col("total_rows"), F.col(f"null_{i}").alias("null_count"),
                 *[(F.col(f"{n}_{i}") if c in numbers else missing).alias(n) for n in ("min", "max", "mean", "std")])
        for i, c in enumerate(df.columns)])
    return row.select(F.inline(unfolded))


def all_tables_summary(tables: dict[str, DataFrame], params: QualityParams = QualityParams()) -> DataFrame:
    """Rows, tables and time-series tables over all given tables."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).withColumns({
        "is_time_series": F.lit(bool(date_like_columns(df, params)))}) for df in tables.values()]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.agg(F.sum("n_rows").alias("total_rows"), F.count(F.lit(1)).alias("tables_analyzed"),
                     F.count_if("is_time_series").alias("time_series_tables"))


def reference_contract(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Violations of a lookup table: repeated keys, or the table being empty.

    An empty result means the contract holds.
    """
    assert_columns(df, [key, *columns])
    repeated = duplicate_groups(df.filter(quoted(key).isNotNull()), [key]).select(
        F.lit("duplicate_key").alias("violation"), quoted(key).cast("string").alias("key"), F.col("n_rows"))
    empty = (df.agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") == 0)
             .select(F.lit("empty_table").alias("violation"), F.lit(None).cast("string").alias("key"), "n_rows"))
    return repeated.unionByName(empty)

