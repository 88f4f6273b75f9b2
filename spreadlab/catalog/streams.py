"""Queries for the file streams, run to completion and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from spreadlab.catalog import query
from spreadlab.catalog.sinks import _COLS, _LATEST, COLS, KEY, MIDDLE
from spreadlab.session import scratch_path
from spreadlab.sources.files import read_parquet
from spreadlab.streaming.ingest import append_new_files, file_stream, merge_new_files, replace_new_dates


def _feed(t, *batches):
    """Append the batches to a folder one after another, yielding in between."""
    folder = scratch_path(t.spark, "stream-files")
    for rows in batches:
        rows.hint("rebalance").write.mode("append").parquet(folder)
        yield folder


@query("st_01_new_files_only", "quotes", f"SELECT {_COLS} FROM quotes")
def _(t):
    rows = t.quotes.select(*COLS)
    early = F.col("quote_date") < MIDDLE
    target, checkpoint = scratch_path(t.spark, "stream-copy"), scratch_path(t.spark, "stream-state")
    for folder in _feed(t, rows.filter(early), rows.filter(~early)):
        append_new_files(file_stream(t.spark, folder, rows.schema), target, checkpoint)
    return t.spark.read.parquet(target)


@query("st_02_merge_latest", "quotes", _LATEST)
def _(t):
    rows = t.quotes.select(*COLS)
    late = F.col("bid_size") >= 50
    target, checkpoint = scratch_path(t.spark, "stream-merge"), scratch_path(t.spark, "stream-state")
    for folder in _feed(t, rows.filter(late), rows.filter(~late)):
        merge_new_files(file_stream(t.spark, folder, rows.schema), target, checkpoint, KEY, ["event_id"], "quote_date")
    return t.spark.read.parquet(target).select(*COLS)


@query("st_02_merge_in_buckets", "quotes", _LATEST)
def _(t):
    """As above, every batch rewriting only the buckets of its keys."""
    rows = t.quotes.select(*COLS)
    late = F.col("bid_size") >= 50
    target, checkpoint = scratch_path(t.spark, "stream-buckets"), scratch_path(t.spark, "stream-state")
    for folder in _feed(t, rows.filter(late), rows.filter(~late)):
        merge_new_files(file_stream(t.spark, folder, rows.schema), target, checkpoint, KEY, ["event_id"], "quote_date", buckets=4)
    return read_parquet(t.spark, target).select(*COLS)


@query("st_03_replace_late_dates", "quotes", f"""
    SELECT event_id, quote_date, cusip, dealer, bid_spread,
           CASE WHEN quote_date < DATE '{MIDDLE}' THEN -1 ELSE bid_size END AS bid_size FROM quotes""")
def _(t):
    rows = t.quotes.select(*COLS)
    stale = rows.withColumn("bid_size", F.lit(-1))
    target, checkpoint = scratch_path(t.spark, "stream-replace"), scratch_path(t.spark, "stream-state")
    for folder in _feed(t, stale, rows.filter(F.col("quote_date") >= MIDDLE)):
        replace_new_dates(file_stream(t.spark, folder, rows.schema), target, checkpoint, "quote_date")
    return t.spark.read.parquet(target).select(*COLS)


@query("st_03_split_date", "quotes", f"""
    SELECT event_id, quote_date, cusip, dealer, bid_spread,
           CASE WHEN quote_date < DATE '{MIDDLE}' THEN -1 ELSE bid_size END AS bid_size FROM quotes""")
def _(t):
    """Every date lies in several files, and every file is a batch of its own."""
    rows = t.quotes.select(*COLS)
    target, checkpoint = scratch_path(t.spark, "stream-split"), scratch_path(t.spark, "stream-state")
    folder = scratch_path(t.spark, "stream-files")
    for batch in (rows.withColumn("bid_size", F.lit(-1)), rows.filter(F.col("quote_date") >= MIDDLE)):
        batch.repartition(3, "event_id").write.mode("append").parquet(folder)
        stream = file_stream(t.spark, folder, rows.schema, max_files=1)
        replace_new_dates(stream, target, checkpoint, "quote_date")
    return t.spark.read.parquet(target).select(*COLS)
