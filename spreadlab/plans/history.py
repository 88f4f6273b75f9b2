"""History loads: cleaned feeds into dated tables with match flags.

Every load returns a one-row DataFrame with what it did.  The update decision
is one small row; it is the only thing read back to choose the write path.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spreadlab import schemas
from spreadlab.functions.identifiers import standardized_columns, standardized_or_original
from spreadlab.functions.scalars import quoted, with_lineage
from spreadlab.operators.dedup import keep_last, last_non_null
from spreadlab.operators.lookups import with_match_status
from spreadlab.operators.quotes import roll_up
from spreadlab.operators.snapshots import latest_snapshot
from spreadlab.params import MONITOR_ROLLUP
from spreadlab.plans import summaries
from spreadlab.plans.feeds import clean_universe_spreads, declared, log_checks  # noqa: F401  (part of the loads' surface)
from spreadlab.session import exists, scratch_scope, staged
from spreadlab.sinks.tables import (
    insert_absent, insert_new_dates, overwrite, replace_dates, track_unmatched, update_decision, upsert)


def _loaded(df: DataFrame, source: str, date: str | None, now: Column | None) -> DataFrame:
    return with_lineage(df, F.lit(source), quoted(date) if date else None, now)


def standardized(df: DataFrame, cusip: str) -> DataFrame:
    """Rows with ``cusip_standardized``, falling back to the original text."""
    names = [c for c in df.columns if c != cusip]
    with_status = standardized_columns(df, cusip)
    return with_status.select(
        quoted(cusip), *[quoted(c) for c in names],
        standardized_or_original(F.col("cusip_standardized"), quoted(cusip).cast("string")).alias("cusip_standardized"),
        "standardization_status")


def _summary(spark: SparkSession, path: str, name: str, update_type: str, reason: str) -> DataFrame:
    """One row of what a load did; the rows stored are known from the summaries."""
    stored = spark.range(1).select(summaries.stored_rows(spark, path).alias("n")).first().n
    return spark.createDataFrame([(name, update_type, reason, stored)],
                                 "table_name string, update_type string, reason string, stored_rows long")


def _load(df: DataFrame, path: str, keys: Sequence[str], date: str | None, order: Sequence[str],
          force: bool, name: str, new_dates_only: bool = False) -> DataFrame:
    """Write a batch and the summaries of its dates.  Only ``force`` (or an undated feed) replaces dates the batch does not bring.

    The stored dates are taken from the summaries; of the stored rows only those of the batch's dates are read.
    """
    spark = df.sparkSession
    with scratch_scope(spark):
        # the only copy of the batch: it is read for the decision and for the write
        df = staged(df, name)
        whole = force or date is None
        if not whole and exists(spark, path) and summaries.per_date(spark, path).isEmpty():
            summaries.follow(df, path, date, "cusip_standardized", whole=True)  # a table from before there were summaries
        made = update_decision(_stored_days(spark, path, date), df, date, force).first()
        reason = made.reason
        if whole or not made.existing_dates:
            overwrite(keep_last(df, keys, order), path, date)
        elif made.update_type == "full_refresh":
            # a reloaded date replaces the stored one; all other dates stay
            replace_dates(keep_last(df, keys, order), path, date)
        elif new_dates_only:
            skipped = insert_new_dates(df, path, date, is_staged=True)
            reason += f"; {skipped} rows of stored dates skipped" if skipped else ""
        else:
            upsert(df, path, keys, date, order, is_staged=True)
        summaries.follow(df, path, date, "cusip_standardized", whole=whole)
        return _summary(spark, path, name, made.update_type, reason)


def _stored_days(spark: SparkSession, path: str, date: str | None) -> DataFrame:
    """The stored dates under the name of the feed's date column."""
    days = summaries.per_date(spark, path)
    return days.withColumnRenamed("date", date) if date else days


def load_universe(feed: DataFrame, path: str, date: str = "Date", cusip: str = "CUSIP", spread: str = "G Sprd",
                  order: Sequence[str] = (), source: str = "universe", force: bool = False,
                  now: Column | None = None) -> DataFrame:
    """Outlier rule, standardized identifiers, decision, write."""
    rows = _loaded(standardized(clean_universe_spreads(feed, spread), cusip), source, date, now)
    return _load(rows, path, [date, cusip, "cusip_standardized"], date, order, force, "universe_historical")


def load_portfolio(feed: DataFrame, path: str, universe: DataFrame, all_dates_path: str, last_date_path: str,
                   date: str = "Date", cusip: str = "CUSIP", name: str = "SECURITY",
                   universe_date: str | None = "Date", order: Sequence[str] = (), source: str = "portfolio",
                   force: bool = False, now: Column | None = None, today: Column | None = None) -> DataFrame:
    """Standardize, flag against the current universe, track the unmatched, write."""
    members = latest_snapshot(universe, universe_date) if universe_date else universe
    rows = with_match_status(_loaded(standardized(feed, cusip), source, date, now), members, "cusip_standardized")
    with scratch_scope(feed.sparkSession):
        track_unmatched(unmatched_rows(rows, "portfolio_historical", cusip, name, date, source, today),
                        all_dates_path, last_date_path)
    return _load(rows, path, [date, cusip, "cusip_standardized"], date, order, force, "portfolio_historical")


def unmatched_rows(rows: DataFrame, table_name: str, cusip: str, name: str, date: str | None, source: str,
                   today: Column | None = None) -> DataFrame:
    today = today if today is not None else F.current_date()
    return rows.filter(F.col("universe_match_status") == "unmatched").select(
        F.lit(table_name).alias("source_table"),
        (quoted(date) if date else F.lit(None)).cast("date").alias("date"),
        quoted(cusip).cast("string").alias("cusip_original"), "cusip_standardized",
        quoted(name).cast("string").alias("security_name"),
        today.alias("universe_match_attempted_date"), F.lit(source).alias("source_file"))


def load_quotes(feed: DataFrame, path: str, date: str = "Date", cusip: str = "CUSIP", dealer: str = "Dealer",
                order: Sequence[str] = ("Time",), source: str = "quotes", force: bool = False,
                now: Column | None = None, late: str = "skip") -> DataFrame:
    """Standardize, one row per (date, identifier, dealer), add new dates only.

    Quotes of stored dates are skipped and counted in ``reason``, or merged by key with ``late="merge"``.
    """
    keys = [date, "cusip_standardized", dealer]
    rows = standardized(feed, cusip).filter(quoted(date).isNotNull())
    # the newest non-NULL value of every column
    newest = last_non_null(rows, keys, order)
    return _load(_loaded(newest, source, date, now), path, keys, date, (), force,
                 "combined_runs_historical", new_dates_only=late == "skip")


def load_monitor(report: DataFrame, path: str, rules: dict[str, Sequence[str]] = MONITOR_ROLLUP,
                 cusip: str = "CUSIP", security: str = "Security", order: Sequence[str] = ("Dealer",),
                 source: str = "run_monitor", now: Column | None = None) -> DataFrame:
    """Roll the monitor up per identifier and replace the table."""
    rows = standardized(report, cusip).withColumn("cusip_original", quoted(cusip).cast("string"))
    rolled = _loaded(roll_up(rows, ["cusip_standardized", "cusip_original", security], rules, order), source, None, now)
    return _replace(rolled, path, "run_monitor")


def load_spreads(history: DataFrame, path: str, cusip: str = "CUSIP", date: str = "DATE",
                 source: str = "gspread", now: Column | None = None) -> DataFrame:
    """Standardize the spread history and replace the table."""
    return _replace(_loaded(standardized(history, cusip), source, date, now), path, "gspread_long", date)


def _replace(df: DataFrame, path: str, name: str, date: str | None = None) -> DataFrame:
    overwrite(df, path, date)
    summaries.follow(df, path, date, "cusip_standardized", whole=True)
    return _summary(df.sparkSession, path, name, "full_refresh", "forced_full_refresh")


def current_view(history: DataFrame, date: str) -> DataFrame:
    """Rows of the maximum date of a history table."""
    return latest_snapshot(history, date)


def match_summary(tables: dict[str, tuple[DataFrame, str | None]],
                  status: str = "universe_match_status") -> DataFrame:
    """Per table: identifiers, matched, unmatched, rate, band, reference date."""
    parts = []
    for name, (df, date) in tables.items():
        matched = F.count_if(quoted(status) == "matched")
        total = F.count(F.lit(1))
        parts.append(df.agg(total.alias("total_cusips"), matched.alias("matched_cusips"),
                            (total - matched).alias("unmatched_cusips"),
                            F.try_divide(matched * 100.0, total).alias("match_rate_percent"),
                            (F.max(quoted(date)) if date else F.lit(None)).cast("date").alias("reference_date"))
                     .withColumn("table_name", F.lit(name)))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.withColumn("band", match_band(F.col("match_rate_percent")))


def match_band(rate: Column) -> Column:
    """Health of a match rate in percent."""
    return (F.when(rate >= 98, "excellent").when(rate >= 95, "good")
            .when(rate >= 90, "warning").when(rate.isNotNull(), "critical"))


def quality_dashboard(log: DataFrame) -> DataFrame:
    """Per table: checks, passed, failed, warnings, pass rate, last check."""
    result = F.col("check_result")
    return log.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("total_checks"), F.count_if(result == "passed").alias("checks_passed"),
        F.count_if(result == "failed").alias("checks_failed"), F.count_if(result == "warning").alias("checks_warning"),
        F.try_divide(F.count_if(result == "passed") * 100.0, F.count(F.lit(1))).alias("pass_rate_percent"),
        F.max("checked_at").alias("last_check_time"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table with the share of all rows."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("table_name", F.lit(name))
             for name, df in tables.items()]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    # one row per table, counted once and unfolded with its total
    counted = union.agg(F.sum("n_rows").alias("total"), F.collect_list(F.struct("table_name", "n_rows")).alias("t"))
    return counted.select("total", F.inline("t")).select(
        "table_name", "n_rows", F.try_divide(F.col("n_rows") * 100.0, F.col("total")).alias("share_pct"))


def identifier_coverage(tables: dict[str, tuple[DataFrame, str]], universe: DataFrame, column: str) -> DataFrame:
    """Distinct identifiers per table and as percentage of the universe."""
    n_universe = universe.agg(F.count_distinct(quoted(column)).alias("n")).scalar()
    parts = [df.agg(F.count_distinct(quoted(c)).alias("unique_cusips")).withColumn("table_name", F.lit(name))
             for name, (df, c) in tables.items()]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.withColumn("coverage_pct", F.try_divide(F.col("unique_cusips") * 100.0, n_universe))


def freshness(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Latest date per table."""
    parts = [df.agg(F.max(quoted(date)).cast("date").alias("latest_date")).withColumn("table_name", F.lit(name))
             for name, (df, date) in tables.items()]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def unmatched_by_table(unmatched: DataFrame) -> DataFrame:
    return unmatched.groupBy("source_table").agg(F.count(F.lit(1)).alias("unmatched_count"))


def recent_unmatched(unmatched: DataFrame, n: int = 10, order: str = "universe_match_attempted_date") -> DataFrame:
    """The most recent unmatched identifiers."""
    return unmatched.orderBy(quoted(order).desc(), "source_table", "cusip_original").limit(n).select(
        "source_table", "cusip_original", "cusip_standardized", "security_name")


@dataclass(frozen=True)
class HistoryPaths:
    """The stored tables of the history, below one folder."""

    root: str

    def table(self, name: str) -> str:
        return f"{self.root}/{name}"

    @property
    def log(self) -> str:
        return f"{self.root}/processing_log"


def load_all(universe: DataFrame, portfolio: DataFrame, quotes: DataFrame, monitor: DataFrame, spreads: DataFrame,
             paths: HistoryPaths, operation_id: str, quote_order: Sequence[str] = ("Time",),
             portfolio_order: Sequence[str] = (), monitor_order: Sequence[str] = ("Dealer",), force: bool = False,
             now: Column | None = None, today: Column | None = None) -> DataFrame:
    """The five loads, the universe first because the portfolio is flagged against it; one row each.

    ``monitor`` is the report of the run monitor.  The rows also go to the
    processing log, once per operation, so a repeated operation adds nothing.
    """
    spark = universe.sparkSession
    done = [load_universe(universe, paths.table("universe_historical"), force=force, now=now)]
    members = spark.read.parquet(paths.table("universe_historical"))
    done.append(load_portfolio(portfolio, paths.table("portfolio_historical"), members, paths.table("unmatched_all_dates"),
                               paths.table("unmatched_last_date"), order=portfolio_order, force=force, now=now, today=today))
    done.append(load_quotes(quotes, paths.table("combined_runs_historical"), order=quote_order, force=force, now=now))
    done.append(load_monitor(monitor, paths.table("run_monitor"), order=monitor_order, now=now))
    done.append(load_spreads(spreads, paths.table("gspread_long"), now=now))
    report = reduce(lambda a, b: a.unionByName(b), done)
    at = now if now is not None else F.current_timestamp()
    log = report.select(
        F.lit(operation_id).alias("operation_id"), "table_name", "update_type", "reason",
        F.lit("completed").alias("processing_status"), F.col("stored_rows").alias("rows_stored"),
        at.cast("timestamp_ntz").alias("finished_at"))
    insert_absent(declared(log, schemas.PROCESSING_LOG), paths.log, ["operation_id", "table_name"])
    return report


def load_summary(matches: DataFrame, quality: DataFrame | None, counts: DataFrame, unmatched: DataFrame) -> DataFrame:
    """Match summary, quality dashboard, row counts and unmatched identifiers as (section, table_name, metric, value)."""
    def rows(df: DataFrame, section: str, name: str, metrics: Sequence[str]) -> DataFrame:
        cells = F.array(*[F.struct(F.lit(m).alias("metric"), quoted(m).cast("double").alias("value")) for m in metrics])
        return df.select(F.lit(section).alias("section"), quoted(name).alias("table_name"), F.inline(cells))

    parts = [rows(matches, "match", "table_name", ["total_cusips", "matched_cusips", "unmatched_cusips", "match_rate_percent"]),
             rows(counts, "rows", "table_name", ["n_rows", "share_pct"]),
             rows(unmatched_by_table(unmatched), "unmatched", "source_table", ["unmatched_count"])]
    if quality is not None:
        parts.append(rows(quality, "quality", "table_name", ["total_checks", "checks_passed", "checks_failed",
                                                             "checks_warning", "pass_rate_percent"]))
    return reduce(lambda a, b: a.unionByName(b), parts)
