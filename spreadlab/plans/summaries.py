"""Summaries that follow a stored table: partial aggregates per date, replaced together with their date.

A load knows which dates it touched.  It reads those alone and replaces their
rows in two small tables beside the stored one: one row of counts per date, and
the distinct identifiers of each date.  Counts, match rates, freshness, coverage
and date profiles of the whole history are merged from them, so neither a load
nor a report reads the history.  A load that broke before its summaries were
written is repeated and replaces them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spreadlab.functions.scalars import quoted
from spreadlab.session import exists, staged
from spreadlab.sinks.tables import overwrite, replace_dates, stored_dates, stored_table
from spreadlab.sources.files import read_parquet

PER_DATE = T.StructType([T.StructField("date", T.DateType()), T.StructField("n_rows", T.LongType()),
                         T.StructField("n_matched", T.LongType())])
IDENTIFIERS = T.StructType([T.StructField("date", T.DateType()), T.StructField("identifier", T.StringType()),
                            T.StructField("n_rows", T.LongType())])


def _beside(path: str, what: str) -> str:
    return f"{path.rstrip('/')}-{what}"


def per_date(spark: SparkSession, path: str) -> DataFrame:
    """Rows and matched rows of each stored date."""
    return read_parquet(spark, _beside(path, "dates"), PER_DATE)


def identifiers(spark: SparkSession, path: str) -> DataFrame:
    """The identifiers of each stored date, with their rows; rows without identifier count under NULL."""
    return read_parquet(spark, _beside(path, "identifiers"), IDENTIFIERS)


def _partials(rows: DataFrame, date: str | None, identifier: str | None, status: str | None) -> DataFrame:
    """Rows and matched rows per date and identifier; one aggregate serves both tables."""
    day = quoted(date).cast("date") if date else F.lit(None).cast("date")
    matched = F.count_if(quoted(status) == "matched") if status and status in rows.columns else F.lit(0).cast("long")
    name = quoted(identifier).cast("string") if identifier else F.lit(None).cast("string")
    return rows.groupBy(day.alias("date"), name.alias("identifier")).agg(
        F.count(F.lit(1)).alias("n_rows"), matched.alias("n_matched"))


def follow(batch: DataFrame, path: str, date: str | None, identifier: str | None = None, whole: bool = False,
           status: str | None = "universe_match_status") -> None:
    """Replace the summaries of the dates in ``batch``, from the rows now stored for them.

    With ``whole``, or when the table has no summaries yet, all of them are written anew.
    """
    spark = batch.sparkSession
    anew = whole or date is None or not exists(spark, _beside(path, "dates"))
    rows = stored_table(spark, path, batch.schema) if anew else stored_dates(batch, path, date)
    partial = staged(_partials(rows, date, identifier, status), "partials")
    counts = partial.groupBy("date").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_matched").alias("n_matched"))
    write = overwrite if anew else replace_dates
    # the identifiers first, so that a date that is counted has its identifiers
    write(partial.select("date", "identifier", "n_rows"), _beside(path, "identifiers"), "date")
    write(counts, _beside(path, "dates"), "date")


def stored_rows(spark: SparkSession, path: str) -> Column:
    """Scalar subquery with the rows of the table."""
    return per_date(spark, path).agg(F.coalesce(F.sum("n_rows"), F.lit(0))).scalar()


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def totals(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """table_name, total_cusips, matched_cusips, latest_date, first_date, n_dates, min, max and mean rows of a date."""
    return _union([per_date(spark, path).agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum("n_matched"), F.lit(0)).alias("n_matched"),
        F.min("date").alias("first_date"), F.max("date").alias("latest_date"), F.count("date").alias("n_dates"),
        F.min("n_rows").alias("min_records"), F.max("n_rows").alias("max_records"), F.avg("n_rows").alias("avg_records"))
        .withColumn("table_name", F.lit(name)) for name, path in paths.items()])


def match_summary(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Per table: identifiers, matched, unmatched, rate and reference date; as ``history.match_summary`` of the whole tables."""
    return totals(spark, paths).select(
        "table_name", F.col("n_rows").alias("total_cusips"), F.col("n_matched").alias("matched_cusips"),
        (F.col("n_rows") - F.col("n_matched")).alias("unmatched_cusips"),
        F.try_divide(F.col("n_matched") * 100.0, "n_rows").alias("match_rate_percent"), F.col("latest_date").alias("reference_date"))


def row_counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Rows per table with the share of all rows."""
    counts = totals(spark, paths).select("table_name", "n_rows")
    every = counts.agg(F.sum("n_rows").alias("n")).scalar()
    return counts.withColumn("share_pct", F.try_divide(F.col("n_rows") * 100.0, every))


def freshness(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    return totals(spark, paths).select("table_name", "latest_date")


def date_coverage(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Distinct dates, range and rows of a date."""
    return totals(spark, paths).select("table_name", "n_dates", "first_date", "latest_date", "min_records", "max_records", "avg_records")


def identifier_coverage(spark: SparkSession, paths: dict[str, str], universe: str) -> DataFrame:
    """Distinct identifiers per table and as percentage of the universe table's, from the identifiers of each date."""
    count = F.count_distinct("identifier")
    n_universe = identifiers(spark, universe).agg(count.alias("n")).scalar()
    return _union([identifiers(spark, path).agg(count.alias("unique_cusips")).withColumn("table_name", F.lit(name))
                   for name, path in paths.items()]).withColumn(
        "coverage_pct", F.try_divide(F.col("unique_cusips") * 100.0, n_universe))
