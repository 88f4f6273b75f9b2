"""Reconciliation report over all tables, as (section, table, metric, value) rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spreadlab.operators.orphans import latest_orphans, orphan_summary, orphan_totals, orphans
from spreadlab.operators.profiling import describe, duplicate_rows, null_counts, numeric_columns
from spreadlab.operators.quality import date_like_columns, table_profile, time_series_columns
from spreadlab.operators.snapshots import latest_snapshot


def _rows(df: DataFrame, section: str, table: str | None, metrics: list[str]) -> DataFrame:
    name = F.lit(table) if table else F.col("table_name")
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    return df.select(F.lit(section).alias("section"), name.alias("table_name"), F.inline(cells))


def table_facts(df: DataFrame, table: str) -> DataFrame:
    """Rows, columns, missing cells, repeated rows and date columns of a table."""
    missing = null_counts(df).agg(F.max("total_rows").alias("total_rows"), F.sum("null_count").alias("missing_cells"))
    facts = missing.withColumns({
        "total_columns": F.lit(len(df.columns)), "date_columns": F.lit(len(date_like_columns(df))),
        "duplicate_rows": duplicate_rows(df).scalar()})
    return _rows(facts, "profile", table, ["total_rows", "total_columns", "missing_cells", "date_columns", "duplicate_rows"])


def reconciliation(tables: dict[str, tuple[DataFrame, str | None]], universe: DataFrame,
                   universe_date: str | None, universe_column: str = "CUSIP") -> DataFrame:
    """Profile of every table, then orphans against all and the latest universe."""
    parts = [table_facts(df, name) for name, (df, _) in tables.items()]
    plain = {name: df for name, (df, _) in tables.items()}
    for section, found in (
            ("orphans_all_dates", orphans(plain, universe, universe_column)),
            ("orphans_latest_date", latest_orphans(tables, universe, universe_date, universe_column))):
        parts.append(_rows(orphan_summary(found), section, None, ["total_instances", "unique_cusips"]))
    return reduce(lambda a, b: a.unionByName(b), parts)


def table_report(df: DataFrame, table: str) -> DataFrame:
    """The whole profile of a table as (table_name, column_name, metric, value) rows.

    Rows, missing values, extremes, mean and deviation per column; exact
    quartiles of the numbers; range and number of days of the date columns (as
    days since 1970); repeated rows under a NULL column name.
    """
    def unfolded(part: DataFrame, metrics: list[str]) -> DataFrame:
        cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
        return part.select(F.lit(table).alias("table_name"), "column_name", F.inline(cells))

    numbers = numeric_columns(df)
    parts = [unfolded(table_profile(df, table), ["total_rows", "null_count", "min", "max", "mean", "std"]),
             unfolded(duplicate_rows(df).withColumn("column_name", F.lit(None).cast("string")), ["duplicate_rows"])]
    if numbers:
        parts.append(unfolded(describe(df, numbers), ["q25", "q50", "q75"]))
    ranges = time_series_columns(df)
    if ranges is not None:
        days = ranges.withColumns({c: F.unix_date(c) for c in ("start_date", "end_date")})
        parts.append(unfolded(days, ["start_date", "end_date", "total_dates", "unique_dates"]))
    return reduce(lambda a, b: a.unionByName(b), parts).filter(F.col("value").isNotNull())


def orphan_report(tables: dict[str, tuple[DataFrame, str | None]], universe: DataFrame,
                  universe_date: str | None, universe_column: str = "CUSIP") -> DataFrame:
    """The orphans one by one and in total, against the whole and the latest universe."""
    plain = {name: df for name, (df, _) in tables.items()}
    members = latest_snapshot(universe, universe_date) if universe_date else universe
    parts = []
    for section, found, known in (("all_dates", orphans(plain, universe, universe_column), universe),
                                  ("latest_date", latest_orphans(tables, universe, universe_date, universe_column), members)):
        parts.append(found.select(F.lit(section).alias("section"), "table_name", "cusip", "security_name",
                                  F.col("instances").cast("long").alias("instances")))
        totals = orphan_totals(found, plain, known, universe_column)
        parts.append(totals.select(
            F.lit(section).alias("section"), F.lit("(total)").alias("table_name"),
            F.col("unique_orphaned_cusips").cast("string").alias("cusip"),
            F.col("universe_cusips").cast("string").alias("security_name"),
            F.col("total_orphaned_instances").cast("long").alias("instances")))
    return reduce(lambda a, b: a.unionByName(b), parts)
