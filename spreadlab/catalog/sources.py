"""Queries for the sources."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from spreadlab.catalog import query
from spreadlab.functions.dates import century_date
from spreadlab.session import scratch_path
from spreadlab.sinks.tables import overwrite, write_csv
from spreadlab.sources.files import (
    file_inventory, new_or_changed, read_any, read_by_name, read_csv, read_dated_folder, read_parquet,
    reject_date_column)

_EVENTS = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
                        T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType())])


@query("src_01_parquet_scan", check="SELECT event_id, user_id, event_type, value FROM events")
def _(t):
    stored = read_parquet(t.spark, f"{t.folder}/events.parquet", _EVENTS)
    absent = read_parquet(t.spark, f"{t.folder}/no_such_table.parquet", _EVENTS)
    return stored.unionByName(absent)


@query("src_02_csv_scan", "positions", "SELECT pos_id, pos_date, cusip, status, value FROM positions")
def _(t):
    path = scratch_path(t.spark, "positions-csv")
    write_csv(t.positions.select("pos_id", "pos_date", "cusip", "status", "value"), path)
    schema = "pos_id bigint, pos_date date, cusip bigint, status string, value double"
    return read_csv(t.spark, path, T._parse_datatype_string(schema), encoding="UTF-8")


@query("src_03_format_by_extension", check="""
    SELECT 'customer' AS feed, c_custkey AS id, c_acctbal AS balance FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, s_acctbal FROM supplier""")
def _(t):
    as_csv, as_parquet = scratch_path(t.spark, "customer") + ".csv", scratch_path(t.spark, "supplier")
    write_csv(t.table("customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance")), as_csv)
    overwrite(t.table("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance")), as_parquet)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("balance", T.DoubleType())])
    read = lambda name, path: read_any(t.spark, path, schema).select(F.lit(name).alias("feed"), "id", "balance")
    return read("customer", as_csv).unionByName(read("supplier", as_parquet))


def _dated_quote_folder(t):
    """Quotes as one folder per day, named like the vendor's files."""
    folder = scratch_path(t.spark, "quote-files")
    batch = F.concat(F.lit("RUNS "), F.date_format("quote_date", "MM.dd.yy"))
    (t.quotes.select("event_id", "cusip", "dealer", "bid_spread", batch.alias("batch"))
     .hint("rebalance", "batch").write.partitionBy("batch").parquet(folder))
    return folder


@query("src_04_dated_files", "quotes", 'SELECT quote_date AS "Date", event_id, cusip, dealer, bid_spread FROM quotes')
def _(t):
    feed = read_dated_folder(t.spark, _dated_quote_folder(t), "parquet", dated_by="path")
    return feed.drop("source_file")


@query("src_05_two_digit_years", "positions", """
    SELECT pos_id, name_text, TRY_CAST(CASE WHEN yy < 69 THEN 2000 + yy ELSE 1900 + yy END || md AS DATE) AS pivot_69,
           TRY_CAST(CASE WHEN yy < 50 THEN 2000 + yy ELSE 1900 + yy END || md AS DATE) AS pivot_50
    FROM (SELECT pos_id, pos_id % 100 AS yy, strftime(pos_date, '-%m-%d') AS md,
                 'API ' || strftime(pos_date, '%m.%d.') || lpad(CAST(pos_id % 100 AS VARCHAR), 2, '0') || '.xlsx' AS name_text
          FROM positions)""")
def _(t):
    short_year = F.lpad((F.col("pos_id") % 100).cast("string"), 2, "0")
    text = F.concat(F.lit("API "), F.date_format("pos_date", "MM.dd."), short_year, F.lit(".xlsx"))
    return t.positions.select("pos_id", text.alias("name_text")).select(
        "pos_id", "name_text", century_date(F.col("name_text"), 69).alias("pivot_69"),
        century_date(F.col("name_text"), 50).alias("pivot_50"))


@query("src_06_new_or_changed_files", "positions",
       "SELECT pos_id, value FROM positions WHERE status <> 'F'")
def _(t):
    folder = scratch_path(t.spark, "position-files")
    t.positions.select("pos_id", "value", "status").write.partitionBy("status").parquet(folder)
    inventory = file_inventory(t.spark, folder, "*.parquet")
    processed = inventory.filter(F.col("path").contains("status=F"))
    fresh = new_or_changed(inventory, processed)
    return read_by_name(t.spark, [r.path for r in fresh.select("path").collect()], "parquet").select("pos_id", "value")


@query("src_07_full_refresh", "quotes", 'SELECT quote_date AS "Date", event_id, cusip FROM quotes')
def _(t):
    target = scratch_path(t.spark, "refreshed")
    overwrite(read_dated_folder(t.spark, _dated_quote_folder(t), "parquet", state=None, dated_by="path"), target)
    return read_parquet(t.spark, target).select("Date", "event_id", "cusip")


@query("src_08_reject_date_column", "positions", """
    SELECT sec_type, count(*) AS n_rows, TRUE AS dated_feed_rejected FROM positions GROUP BY 1""")
def _(t):
    feed = t.positions.drop("pos_date")
    reject_date_column(feed.columns)
    try:
        reject_date_column(feed.withColumn("date", F.lit(None)).columns)
        rejected = False
    except ValueError:
        rejected = True
    return feed.groupBy("sec_type").agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "dated_feed_rejected", F.lit(rejected))
