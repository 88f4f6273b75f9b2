"""Maintenance of Parquet tables: overwrite, merge, upsert, append.

Dated tables are partitioned by their date, and below it by key buckets where
their layout says so (``sinks/buckets.py``).  A merge reads and rewrites only
the partitions its new rows fall in (dynamic partition overwrite).  Rewritten
rows are staged in the scratch folder first, so a table is never read while it
is replaced, and a failed task repeats without touching the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spreadlab.functions.dates import clock_text
from spreadlab.functions.scalars import nan_to_null_all, quoted
from spreadlab.operators.dedup import keep_last
from spreadlab.session import staged
from spreadlab.sinks.buckets import Buckets, emptied, stored_buckets, stored_with_bucket, touched, without_bucket
from spreadlab.sources.files import read_parquet


def overwrite(df: DataFrame, path: str, date: str | None = None, sort: Sequence[str] = (),
              buckets: Buckets | None = None) -> None:
    """Replace the whole table, with or without buckets whatever it had before."""
    _write(df, path, "overwrite", date, sort, buckets, dynamic=False)


def append(df: DataFrame, path: str, date: str | None = None, sort: Sequence[str] = ()) -> None:
    buckets = stored_buckets(df.sparkSession, path, date) if date else None
    _write(df, path, "append", date, sort, buckets, dynamic=False)


def replace_dates(df: DataFrame, path: str, date: str, sort: Sequence[str] = (), buckets: Buckets | None = None) -> None:
    """Replace exactly the dates that occur in ``df``; other dates stay.

    A stored table keeps its layout; ``buckets`` are those of a new one.  Buckets of a
    replaced date that get no row are removed after the others are written, so a run
    that breaks in between leaves stale rows until it is repeated.
    """
    stored = stored_buckets(df.sparkSession, path, date)
    gone = []
    if stored:
        df = staged(df, "dates")
        gone = emptied(stored_with_bucket(df.sparkSession, path, stored, df.schema), df, stored, date)
    _write(df, path, "overwrite", date, sort, _layout(df.sparkSession, path, date, stored, buckets), dynamic=True)
    for name in gone:
        folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.sparkSession._jvm.java.net.URI(name))
        folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def _layout(spark: SparkSession, path: str, date: str, stored: Buckets | None, wanted: Buckets | None) -> Buckets | None:
    """The stored table's layout, the wanted one where there is no table yet."""
    if stored or not wanted:
        return stored
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    dated = system.exists(root) and any(s.getPath().getName().startswith(f"{date}=") for s in system.listStatus(root))
    return None if dated else wanted


def _write(df, path, mode, date, sort, buckets, dynamic):
    levels = [date] if date else []
    if date and buckets:
        df = df.withColumn(buckets.column, buckets.of_row())
        levels.append(buckets.column)
    if date:
        # balanced files per partition: a heavy one is split, small ones are merged
        df = df.hint("rebalance", *[quoted(c) for c in levels])
    if sort:
        df = df.sortWithinPartitions(*[quoted(c) for c in levels + list(sort)])
    writer = df.write.mode(mode)
    if date:
        writer = writer.partitionBy(*levels)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def rebucket(spark: SparkSession, path: str, date: str, schema: T.StructType, buckets: Buckets | None) -> None:
    """Rewrite a stored table with other buckets, or without any."""
    overwrite(staged(stored_table(spark, path, schema), "rebucket"), path, date, buckets=buckets)


def write_csv(df: DataFrame, path: str, decimals: int | None = None) -> None:
    """CSV with a header; floats optionally with a fixed number of decimals."""
    if decimals is not None:
        def fixed(field):
            c = quoted(field.name)
            if not isinstance(field.dataType, (T.DoubleType, T.FloatType)):
                return c
            return F.when(c.isNotNull(), F.format_string(f"%.{decimals}f", c)).alias(field.name)
        df = df.select(*[fixed(f) for f in df.schema.fields])
    df.write.mode("overwrite").option("header", True).csv(path)


def table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The stored table, empty when it does not exist yet."""
    return read_parquet(spark, path, schema)


def stored_table(spark: SparkSession, path: str, like: T.StructType) -> DataFrame:
    """The stored table with all its columns, also those ``like`` lacks; empty when it does not exist yet.

    Columns of ``like`` come first and in its types, so that partition values are not guessed.
    """
    try:
        known = without_bucket(spark.read.option("mergeSchema", True).parquet(path)).schema
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        known = T.StructType([])
    return read_parquet(spark, path, T.StructType(like.fields + [f for f in known.fields if f.name not in like.names]))


def _widened(new: DataFrame, stored: DataFrame) -> DataFrame:
    """``new`` with the stored columns it lacks, as NULL."""
    return new.unionByName(stored.limit(0), allowMissingColumns=True)


def merge_latest(new: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], date: str,
                 buckets: int | None = None) -> None:
    """Merge rows by key; of several rows the greatest ``order`` wins.

    ``buckets`` divides the dates of a table that does not exist yet; a stored one keeps its layout.
    """
    new = staged(new, "batch")
    layout = _merge_layout(new, path, keys, date, buckets)
    stored = _stored_touched(new, path, date, layout, keys)
    merged = keep_last(stored.unionByName(new, allowMissingColumns=True), keys, order)
    _write(staged(merged, "merge"), path, "overwrite", date, [k for k in keys if k != date], layout, dynamic=True)


def _merge_layout(new: DataFrame, path: str, keys: Sequence[str], date: str, buckets: int | None) -> Buckets | None:
    by = tuple(k for k in keys if k != date)
    wanted = Buckets(buckets, by) if buckets and by else None
    return _layout(new.sparkSession, path, date, stored_buckets(new.sparkSession, path, date), wanted)


def _stored_touched(new: DataFrame, path: str, date: str, layout: Buckets | None, keys: Sequence[str]) -> DataFrame:
    """Stored rows, with all stored columns, of the partitions that ``new`` may change."""
    if layout is None:
        return stored_dates(new, path, date)
    _require_date(new, date)
    like = stored_table(new.sparkSession, path, new.schema).schema
    return without_bucket(touched(stored_with_bucket(new.sparkSession, path, layout, like), new, layout, date, keys))


def upsert(new: DataFrame, path: str, keys: Sequence[str], date: str | None = None,
           order: Sequence[str] = (), is_staged: bool = False, buckets: int | None = None) -> None:
    """Insert or replace by key: a new row beats the stored one.

    Among several new rows of a key the greatest ``order`` wins.  ``buckets`` as for ``merge_latest``.
    """
    new = new if is_staged else staged(new, "batch")
    layout = _merge_layout(new, path, keys, date, buckets) if date else None
    stored = _stored_touched(new, path, date, layout, keys) if date else stored_table(new.sparkSession, path, new.schema)
    both = (stored.withColumn("_new", F.lit(0))
            .unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True))
    merged = staged(keep_last(both, keys, ["_new", *order]).drop("_new"), "upsert")
    if date:
        _write(merged, path, "overwrite", date, [k for k in keys if k != date], layout, dynamic=True)
    else:
        overwrite(merged, path)


def stored_dates(new: DataFrame, path: str, date: str) -> DataFrame:
    """Stored rows, with all stored columns, of the dates that occur in ``new``; a NULL date is one of them.

    The dates (one per calendar day at most) are a scalar subquery on the
    partition column, so only their partitions are read (all are listed); a
    join on the date would scan the whole table.
    """
    _require_date(new, date)
    stored = stored_table(new.sparkSession, path, new.schema)
    days = new.agg(F.collect_set(quoted(date))).scalar()
    undated = new.agg(F.coalesce(F.bool_or(quoted(date).isNull()), F.lit(False))).scalar()
    return stored.filter(F.array_contains(days, quoted(date)) | (quoted(date).isNull() & undated))


def _require_date(new: DataFrame, date: str) -> None:
    if not isinstance(new.schema[date].dataType, (T.DateType, T.StringType)):
        raise ValueError(f"{date} must be a date, as every distinct value is a partition")


def insert_absent(new: DataFrame, path: str, keys: Sequence[str], date: str | None = None) -> None:
    """Append the rows whose key is not stored yet."""
    new = staged(new, "batch")
    by_date = date is not None and date in keys
    layout = stored_buckets(new.sparkSession, path, date) if by_date else None
    stored = _stored_touched(new, path, date, layout, keys) if by_date else stored_table(new.sparkSession, path, new.schema)
    fresh = new.join(stored.select(*[quoted(k) for k in keys]), list(keys), "left_anti")
    fresh = _widened(fresh.select(*[quoted(c) for c in new.columns]), stored)
    append(staged(fresh, "insert-absent"), path, date)


def _rows_by_date(new: DataFrame, path: str, date: str) -> tuple[DataFrame, DataFrame]:
    """The new rows of dates not stored yet, and the others."""
    stored = stored_dates(new, path, date).select(quoted(date).alias("_d")).distinct()
    columns = [quoted(c) for c in new.columns]
    found = F.col("_known")
    known = new.join(stored.withColumn("_known", F.lit(True)), quoted(date).eqNullSafe(F.col("_d")), "left")
    return known.filter(found.isNull()).select(*columns), known.filter(found).select(*columns)


def insert_new_dates(new: DataFrame, path: str, date: str, is_staged: bool = False) -> int:
    """Append the rows of dates that are not stored yet; the number of other rows, which are left out."""
    new = new if is_staged else staged(new, "batch")
    fresh, late = _rows_by_date(new, path, date)
    fresh = _widened(fresh, stored_table(new.sparkSession, path, new.schema))
    skipped = late.count()
    # the stored dates are read before the append is committed, so the rows need no copy of their own
    append(fresh, path, date)
    return skipped


def update_decision(stored: DataFrame, new: DataFrame, date: str | None, force: bool = False,
                    min_overlap: float = 0.5) -> DataFrame:
    """Full refresh or incremental update, with the reason, as one row.

    Incremental only when stored data exists and the dates of the new rows
    overlap it not at all or by less than ``min_overlap``.  This is a report
    on two tables: it may be acted on literally only when ``new`` is the whole
    feed.  The loads of ``plans/history.py`` replace the dates they bring and
    nothing else, unless forced.
    """
    if date is None or date not in new.columns:
        counts = stored.agg(F.count(F.lit(1)).alias("existing_dates")).withColumns(
            {"new_dates": F.lit(0).cast("bigint"), "overlapping_dates": F.lit(0).cast("bigint")})
        dated = False
    else:
        sides = (stored.select(quoted(date).alias("d")).distinct().withColumn("_old", F.lit(True))
                 .join(new.select(quoted(date).alias("d")).distinct().withColumn("_new", F.lit(True)),
                       "d", "full_outer"))
        counts = sides.agg(F.count("_old").alias("existing_dates"), F.count("_new").alias("new_dates"),
                           F.count_if(F.col("_old") & F.col("_new")).alias("overlapping_dates"))
        dated = True
    overlap, fresh = F.col("overlapping_dates"), F.col("new_dates")
    reason = F.when(F.col("existing_dates") == 0, "empty_table_requires_full_refresh")
    reason = reason.when(F.lit(force), "forced_full_refresh")
    if dated:
        reason = (reason.when(overlap == 0, "no_date_overlap_detected")
                  .when(overlap < fresh * min_overlap, "minimal_date_overlap")
                  .otherwise("significant_date_overlap_requires_full_refresh"))
    else:
        reason = reason.otherwise("default_full_refresh")
    incremental = reason.isin("no_date_overlap_detected", "minimal_date_overlap")
    return counts.select(F.when(incremental, "incremental").otherwise("full_refresh").alias("update_type"),
                         reason.alias("reason"), "existing_dates", "new_dates", "overlapping_dates")


def track_unmatched(unmatched: DataFrame, all_dates_path: str, last_date_path: str) -> None:
    """Write to the all-dates log and replace by key in the last-date table; a repeated attempt changes nothing.

    The log is partitioned by the date of the attempt: an attempt replaces its
    own source table's rows of that day.  The other table is partitioned by its source table.
    """
    unmatched = staged(unmatched, "unmatched")
    keys = ["source_table", "universe_match_attempted_date"]
    kept = stored_dates(unmatched, all_dates_path, keys[1]).join(unmatched.select(*keys).distinct(), keys, "left_anti")
    replace_dates(staged(unmatched.unionByName(kept, allowMissingColumns=True), "unmatched-log"), all_dates_path, keys[1])
    upsert(unmatched.drop("date"), last_date_path, ["source_table", "cusip_original"], "source_table",
           ["universe_match_attempted_date"])


def schema_gap(df: DataFrame, target: Sequence[str]) -> dict[str, list[str]]:
    """Column names missing on either side (both empty when compatible)."""
    have, want = list(df.columns), list(target)
    return {"missing_in_data": [c for c in want if c not in have],
            "missing_in_target": [c for c in have if c not in want]}


def require_compatible(df: DataFrame, target: Sequence[str]) -> DataFrame:
    gap = schema_gap(df, target)
    if any(gap.values()):
        raise ValueError(f"schema not compatible: {gap}")
    return df


# Column spellings of the export target.
EXPORT_NAMES = {"Bid Yield To Convention": "Bid Yield to Convention",
                "Ask Yield To Convention": "Ask Yield to Convention"}


def prepare_export(df: DataFrame, date: str = "Date", time: str = "Time",
                   names: dict[str, str] | None = None) -> DataFrame:
    """Rename, dates and times as text, NaN as NULL."""
    df = nan_to_null_all(df.withColumnsRenamed(EXPORT_NAMES if names is None else names))
    if date in df.columns:
        df = df.withColumn(date, F.date_format(quoted(date), "yyyy-MM-dd"))
    if time in df.columns:
        df = df.withColumn(time, F.coalesce(clock_text(quoted(time).cast("string")), quoted(time).cast("string")))
    return df
