"""Feed builds: raw dated files to one clean table per feed."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spreadlab import schemas
from spreadlab.functions.dates import clock_text, parse_with_first_fitting
from spreadlab.functions.scalars import (
    apply_overrides, bucket_label, clamp_outliers, drop_columns, first_column, keep_columns, quoted,
    text_columns, to_double, to_timestamp)
from spreadlab.operators.dedup import keep_first, keep_last
from spreadlab.operators.lookups import many_to_one
from spreadlab.operators.mapping import map_names
from spreadlab.operators.quotes import without_negatives
from spreadlab.operators.quality import quality_report
from spreadlab.operators.reshape import wide_to_long, without_matching_columns, without_repeated_headers
from spreadlab.operators.snapshots import latest_snapshot
from spreadlab.params import (
    PORTFOLIO_FEED, PORTFOLIO_OVERRIDES, QUOTE_DATE_FORMATS, QUOTE_KEY, QUOTE_NON_NEGATIVE,
    QUOTE_NOT_NULL, UNIVERSE_FEED, FeedParams, IdentifierOverride, MappingParams)
from spreadlab.session import staged
from spreadlab.sinks.buckets import Buckets, stored_buckets
from spreadlab.sinks.tables import append, insert_absent, merge_latest, overwrite, replace_dates
from spreadlab.sources.files import (
    dated_files, file_inventory, new_or_changed, read_by_name, read_dated_folder, read_parquet, save_state, saved_state)


def build_universe(raw: DataFrame, feed: FeedParams = UNIVERSE_FEED, keys: Sequence[str] = ("Date", "CUSIP"),
                   order: Sequence[str] = ()) -> DataFrame:
    """Universe rows: key present, one per (date, identifier), bucketed, typed."""
    present = set(raw.columns)
    rows = keep_last(raw.na.drop(subset=[c for c in feed.required if c in present]), keys, order)
    rows = rows.withColumns({b.target: bucket_label(to_double(quoted(b.source)), b)
                             for b in feed.bins if b.source in present})
    typed = {c: to_double(quoted(c)) for c in feed.doubles if c in present}
    typed |= {c: to_timestamp(quoted(c)) for c in feed.timestamps if c in present}
    rows = rows.withColumns(typed) if typed else rows
    return first_column(keep_columns(rows, feed.keep), keys[0])


def build_portfolio(raw: DataFrame, feed: FeedParams = PORTFOLIO_FEED,
                    overrides: Sequence[IdentifierOverride] = PORTFOLIO_OVERRIDES,
                    date: str = "Date", cusip: str = "CUSIP", name: str = "SECURITY") -> DataFrame:
    """Position rows: named, without dropped columns, special identifiers set."""
    rows = drop_columns(raw.na.drop(subset=[c for c in feed.required if c in raw.columns]), feed.drop)
    rows = apply_overrides(rows, overrides, cusip, name)
    rows = text_columns(rows, [cusip])
    present = set(rows.columns)
    typed = {c: to_double(quoted(c)) for c in feed.doubles if c in present}
    typed |= {c: to_timestamp(quoted(c)).cast("date") for c in feed.timestamps if c in present}
    rows = rows.withColumns(typed) if typed else rows
    return first_column(rows, date)


def build_quotes(raw: DataFrame, date: str = "Date", time: str = "Time", keys: Sequence[str] = QUOTE_KEY,
                 non_negative: Sequence[str] = QUOTE_NON_NEGATIVE, not_null: Sequence[str] = QUOTE_NOT_NULL,
                 order: Sequence[str] = ("Time",), formats: Sequence[str] = QUOTE_DATE_FORMATS,
                 parse: bool = True) -> DataFrame:
    """Quote rows: parsed, non-negative, complete, latest per key."""
    rows = raw
    if parse:
        rows = parse_with_first_fitting(rows, date, formats).withColumn(time, clock_text(quoted(time)))
    rows = without_negatives(rows, non_negative, keep_missing=True)
    rows = rows.na.drop(subset=[c for c in not_null if c in rows.columns])
    return keep_last(rows, keys, order)


def build_spread_history(wide: DataFrame, universe: DataFrame, date: str = "DATE",
                         security: str = "Security", cusip: str = "CUSIP", universe_date: str | None = "Date",
                         params: MappingParams = MappingParams(),
                         exclude: Sequence[str] = ("Unnamed",)) -> DataFrame:
    """Long spread history with identifiers, names mapped to the universe.

    The wide table has one column per bond, so its column names are metadata of
    the plan; their mapping to universe names is computed as a table and joined.
    """
    wide = without_repeated_headers(without_matching_columns(wide, exclude))
    long = wide_to_long(wide, date, "_vendor_name", "GSpread")
    return map_history(long, universe, date, security, cusip, universe_date, params)


def map_history(long: DataFrame, universe: DataFrame, date: str, security: str, cusip: str,
                universe_date: str | None, params: MappingParams = MappingParams(),
                vendor: str = "_vendor_name") -> DataFrame:
    """Map vendor names to universe names and attach the identifier.

    Rows without an identifier are dropped.  Without ``universe_date`` a
    repeated security fails.  A vendor name that maps to a name
    another column already has keeps only the first column's rows, which the
    one-to-one mapping guarantees.
    """
    current = universe
    if universe_date:
        # on one date a security may be listed several times, the first listing counts
        current = keep_first(latest_snapshot(universe, universe_date).na.drop(subset=[security]), [security], [cusip])
    names = map_names(long.select(F.col(vendor).alias("name")), current.select(quoted(security).alias("name")), params)
    mapped = (long.join(names.select(F.col("source").alias(vendor), F.coalesce("target", "source").alias(security)),
                        vendor).drop(vendor))
    return many_to_one(mapped, current, security, [cusip]).filter(quoted(cusip).isNotNull()).select(
        quoted(cusip), quoted(date), quoted(security), "GSpread")


def clean_universe_spreads(df: DataFrame, column: str = "G Sprd") -> DataFrame:
    return df.withColumn(column, clamp_outliers(quoted(column))) if column in df.columns else df


def log_checks(report: DataFrame, table_name: str, path: str, checked_at: Column | None = None, run_id: str | None = None) -> None:
    """Append the rows of a quality report to the check log; a run that is repeated under its ``run_id`` adds nothing."""
    at = checked_at if checked_at is not None else F.current_timestamp()
    rows = report.select(F.lit(table_name).alias("table_name"), "check_type", "column_name", "check_result",
                         "check_value", at.cast("timestamp_ntz").alias("checked_at"), F.lit(run_id).cast("string").alias("run_id"))
    if run_id is None:
        append(rows, path)
    else:
        insert_absent(rows, path, ["table_name", "run_id"])


def run_of(files: DataFrame) -> str:
    """Name of a run that is the same whenever the same versions of the same files are processed."""
    found = files.agg(F.bit_xor(F.xxhash64("path", "modified", "size")).alias("h"), F.count(F.lit(1)).alias("n")).first()
    return f"{found['h'] or 0:x}-{found['n']}"


@dataclass(frozen=True)
class FeedPaths:
    """Where a feed is read from and what its build keeps."""

    folder: str       # the vendor's files
    table: str        # the clean table, partitioned by date
    state: str        # a log of the files that are in the table, by version and run
    quality_log: str  # the checks of every build


def refresh_feed(spark: SparkSession, paths: FeedPaths, name: str, build: Callable[[DataFrame], DataFrame],
                 schema: T.StructType, date: str = "Date", keys: Sequence[str] = (), order: Sequence[str] = (),
                 fmt: str = "csv", dated_by: str | None = "file_name", checked: Sequence[str] = (),
                 full: bool = False, now: Column | None = None, buckets: int | None = None,
                 pivot: int = 69, on_undated: str = "skip") -> DataFrame:
    """From the folder to the stored table: new files, clean, check, write, remember.

    A feed dated by its files replaces the dates of new files, for which all
    files of such a date are read; a feed with its own dates is merged by
    ``keys``, the greatest ``order`` wins.  The state is saved last, so a run
    that breaks is repeated with the same files and the same result, and its
    checks are logged once.  ``pivot`` and ``on_undated`` are as for ``dated_files``;
    the state holds the files that were read, so a skipped one is met again.
    Columns of the declared ``schema`` take its types; others stay as they are.
    Returns one row: files and rows of this run, and rows stored.
    """
    inventory = file_inventory(spark, paths.folder, f"*.{fmt}")
    if dated_by:
        inventory = dated_files(inventory, pivot, on_undated, dated_by)
    inventory = staged(inventory, f"{name}-files")
    state = None if full else saved_state(spark, paths.state)
    fresh = new_or_changed(inventory, state)
    n_files = fresh.count()
    rows = None
    if n_files and dated_by:
        raw = read_dated_folder(spark, paths.folder, fmt, pivot, on_undated, state, date, dated_by, whole_dates=True)
        rows = raw if raw is None else staged(declared(build(raw), schema), name)
    elif n_files:
        raw = read_by_name(spark, [r.path for r in fresh.select("path").collect()], fmt)
        rows = staged(declared(build(raw), schema), name)
    n_rows = 0
    today = (now if now is not None else F.current_timestamp()).cast("date")
    if rows is not None:
        n_rows = rows.count()
        log_checks(quality_report(rows, [c for c in checked if c in rows.columns], date, None, today), name, paths.quality_log, now,
                   run_of(fresh))
        if full:
            wanted = Buckets(buckets, tuple(k for k in keys if k != date)) if buckets and keys else None
            overwrite(rows, paths.table, date, buckets=stored_buckets(spark, paths.table, date) or wanted)
        elif keys:
            merge_latest(rows, paths.table, keys, order, date, buckets)
        else:
            replace_dates(rows, paths.table, date)
        save_state(fresh, paths.state, run_of(fresh))
    stored = read_parquet(spark, paths.table, schema).agg(F.count(F.lit(1)).alias("n")).scalar()
    return spark.range(1).select(F.lit(name).alias("feed"), F.lit(n_files).cast("long").alias("new_files"),
                                 F.lit(n_rows).cast("long").alias("rows_written"), stored.alias("rows_stored"))


def declared(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of the declared schema in its types, a conversion that fails gives NULL."""
    types = {f.name: f.dataType for f in schema.fields}
    return df.select(*[quoted(f.name).try_cast(types[f.name]).alias(f.name)
                       if f.name in types and f.dataType != types[f.name] else quoted(f.name) for f in df.schema.fields])


def refresh_universe(spark: SparkSession, paths: FeedPaths, dated_by: str = "file_name", fmt: str = "csv",
                     full: bool = False, now: Column | None = None) -> DataFrame:
    """Universe files to the universe table; of repeated identifiers of a date one row stays, files without a date wait."""
    return refresh_feed(spark, paths, "universe", build_universe, schemas.UNIVERSE, fmt=fmt, dated_by=dated_by,
                        checked=UNIVERSE_FEED.doubles, full=full, now=now, pivot=UNIVERSE_FEED.pivot)


def refresh_portfolio(spark: SparkSession, paths: FeedPaths, dated_by: str = "file_name", fmt: str = "csv",
                      full: bool = False, now: Column | None = None) -> DataFrame:
    """Position files to the portfolio table; years below 50 are of this century, and a file without a date fails."""
    build = lambda raw: build_portfolio(raw).drop("source_file")
    return refresh_feed(spark, paths, "portfolio", build, schemas.PORTFOLIO, fmt=fmt, dated_by=dated_by,
                        checked=PORTFOLIO_FEED.doubles, full=full, now=now, pivot=PORTFOLIO_FEED.pivot, on_undated="fail")


def refresh_quotes(spark: SparkSession, paths: FeedPaths, fmt: str = "csv", order: Sequence[str] = ("Time",),
                   keys: Sequence[str] = QUOTE_KEY, full: bool = False, now: Column | None = None,
                   buckets: int | None = None) -> DataFrame:
    """Quote files, which bring their own dates, merged into the quote table.

    ``buckets`` divides the dates of a new table, so that a late quote rewrites its bucket and not its day.
    """
    def build(raw: DataFrame) -> DataFrame:
        numbers = [f.name for f in schemas.QUOTES.fields if isinstance(f.dataType, T.DoubleType) and f.name in raw.columns]
        typed = raw.withColumns({c: to_double(quoted(c)) for c in numbers}) if numbers else raw
        return build_quotes(typed, keys=keys, order=order).drop("source_file")
    return refresh_feed(spark, paths, "quotes", build, schemas.QUOTES, keys=keys, order=order, fmt=fmt, dated_by=None,
                        checked=("Bid Spread", "Ask Spread", *QUOTE_NON_NEGATIVE), full=full, now=now, buckets=buckets)
