"""Queries for the sinks: write, maintain, read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from spreadlab.catalog import query
from spreadlab.functions.identifiers import normalized
from spreadlab.operators.dedup import keep_last
from spreadlab.operators.lookups import with_match_status
from spreadlab.plans.history import unmatched_rows
from spreadlab.session import scratch_path
from spreadlab.sinks.buckets import Buckets
from spreadlab.sinks.tables import (
    insert_absent, insert_new_dates, merge_latest, overwrite, prepare_export, rebucket, replace_dates, schema_gap, table,
    track_unmatched, update_decision, upsert, write_csv)

KEY = ["quote_date", "cusip", "dealer"]
COLS = ["event_id", "quote_date", "cusip", "dealer", "bid_spread", "bid_size"]
_COLS = ", ".join(COLS)
MIDDLE = "2024-01-16"

# latest quote per key, as SQL
_LATEST = f"""SELECT {_COLS} FROM quotes QUALIFY row_number() OVER (
    PARTITION BY quote_date, cusip, dealer ORDER BY event_id DESC) = 1"""


def _quotes(t):
    return t.quotes.select(*COLS)


def _target(t, label):
    return scratch_path(t.spark, label)


@query("snk_01_parquet_overwrite", "quotes", f"SELECT {_COLS} FROM quotes")
def _(t):
    path = _target(t, "overwrite")
    overwrite(_quotes(t).withColumn("bid_size", F.lit(-1)), path)
    overwrite(_quotes(t), path, date="quote_date", sort=["cusip"])
    return table(t.spark, path, _quotes(t).schema)


@query("snk_02_csv_export", "quotes", """
    SELECT CAST(event_id AS VARCHAR) AS event_id, printf('%.4f', bid_price) AS bid_price FROM quotes""")
def _(t):
    path = _target(t, "export-csv")
    write_csv(t.quotes.select("event_id", "bid_price"), path, decimals=4)
    return t.spark.read.option("header", True).csv(path)


@query("snk_03_merge_keep_latest", "quotes", _LATEST)
def _(t):
    path = _target(t, "merge")
    late = F.col("bid_size") >= 50
    merge_latest(_quotes(t).filter(late), path, KEY, ["event_id"], "quote_date")
    merge_latest(_quotes(t).filter(~late), path, KEY, ["event_id"], "quote_date")
    return table(t.spark, path, _quotes(t).schema).select(*COLS)


@query("snk_04_replace_dates", "quotes", f"""
    SELECT event_id, quote_date, cusip, dealer, bid_spread,
           CASE WHEN quote_date < DATE '{MIDDLE}' THEN -1 ELSE bid_size END AS bid_size FROM quotes""")
def _(t):
    path = _target(t, "replace")
    replace_dates(_quotes(t).withColumn("bid_size", F.lit(-1)), path, "quote_date")
    replace_dates(_quotes(t).filter(F.col("quote_date") >= MIDDLE), path, "quote_date")
    return table(t.spark, path, _quotes(t).schema).select(*COLS)


@query("snk_05_keyed_upsert", "quotes", f"""
    WITH stored AS (SELECT * FROM ({_LATEST})), fresh AS (
      SELECT * FROM quotes WHERE quote_date >= DATE '{MIDDLE}' AND dealer = 'click'
      QUALIFY row_number() OVER (PARTITION BY quote_date, cusip, dealer ORDER BY event_id DESC) = 1)
    SELECT s.event_id, quote_date, cusip, dealer, s.bid_spread,
           CASE WHEN f.event_id IS NULL THEN s.bid_size ELSE 1000 + f.bid_size END AS bid_size
    FROM stored s LEFT JOIN fresh f USING (quote_date, cusip, dealer)""")
def _(t):
    path = _target(t, "upsert")
    upsert(_quotes(t), path, KEY, "quote_date", ["event_id"])
    changed = _quotes(t).filter((F.col("quote_date") >= MIDDLE) & (F.col("dealer") == "click"))
    upsert(changed.withColumn("bid_size", F.col("bid_size") + 1000), path, KEY, "quote_date", ["event_id"])
    return table(t.spark, path, _quotes(t).schema).select(*COLS)


@query("snk_06_insert_if_absent", "quotes", f"""
    SELECT event_id, quote_date, cusip, dealer, bid_spread,
           CASE WHEN dealer = 'click' THEN bid_size ELSE 1000 + bid_size END AS bid_size FROM ({_LATEST})""")
def _(t):
    path = _target(t, "insert")
    quotes = keep_last(_quotes(t), KEY, ["event_id"])
    overwrite(quotes.filter(F.col("dealer") == "click"), path, "quote_date")
    insert_absent(quotes.withColumn("bid_size", F.col("bid_size") + 1000), path, KEY, "quote_date")
    return table(t.spark, path, _quotes(t).schema).select(*COLS)


@query("snk_07_insert_new_dates", "quotes", f"""
    SELECT event_id, quote_date, cusip, dealer, bid_spread,
           CASE WHEN quote_date < DATE '{MIDDLE}' THEN bid_size ELSE 1000 + bid_size END AS bid_size FROM quotes""")
def _(t):
    path = _target(t, "insert-dates")
    overwrite(_quotes(t).filter(F.col("quote_date") < MIDDLE), path, "quote_date")
    insert_new_dates(_quotes(t).withColumn("bid_size", F.col("bid_size") + 1000), path, "quote_date")
    return table(t.spark, path, _quotes(t).schema).select(*COLS)


@query("snk_08_full_refresh", "positions", "SELECT pos_id, value FROM positions")
def _(t):
    path = _target(t, "full")
    rows = t.positions.select("pos_id", "value")
    overwrite(rows.withColumn("value", F.lit(0.0)), path)
    overwrite(rows, path)
    return table(t.spark, path, rows.schema)


@query("snk_09_update_decision", "positions", """
    WITH cases AS (
      SELECT * FROM (VALUES ('empty', DATE '1900-01-01', DATE '1900-01-01', FALSE),
        ('forced', DATE '2100-01-01', DATE '1900-01-01', TRUE),
        ('disjoint', DATE '1998-01-01', DATE '1998-01-01', FALSE),
        ('little overlap', DATE '1998-03-01', DATE '1998-01-01', FALSE),
        ('much overlap', DATE '2000-01-01', DATE '1998-01-01', FALSE)) v(scenario, old_until, new_from, force)),
    days AS (SELECT DISTINCT pos_date FROM positions),
    counts AS (
      SELECT scenario, force, CAST(count(*) FILTER (pos_date < old_until) AS BIGINT) AS existing_dates,
             CAST(count(*) FILTER (pos_date >= new_from) AS BIGINT) AS new_dates,
             CAST(count(*) FILTER (pos_date < old_until AND pos_date >= new_from) AS BIGINT) AS overlapping_dates
      FROM cases, days GROUP BY 1, 2),
    reasons AS (SELECT *, CASE WHEN existing_dates = 0 THEN 'empty_table_requires_full_refresh'
        WHEN force THEN 'forced_full_refresh' WHEN overlapping_dates = 0 THEN 'no_date_overlap_detected'
        WHEN overlapping_dates < new_dates * 0.5 THEN 'minimal_date_overlap'
        ELSE 'significant_date_overlap_requires_full_refresh' END AS reason FROM counts)
    SELECT scenario, CASE WHEN reason IN ('no_date_overlap_detected', 'minimal_date_overlap')
        THEN 'incremental' ELSE 'full_refresh' END AS update_type, reason, existing_dates, new_dates, overlapping_dates
    FROM reasons""")
def _(t):
    cases = [("empty", "1900-01-01", "1900-01-01", False), ("forced", "2100-01-01", "1900-01-01", True),
             ("disjoint", "1998-01-01", "1998-01-01", False), ("little overlap", "1998-03-01", "1998-01-01", False),
             ("much overlap", "2000-01-01", "1998-01-01", False)]
    result = None
    for name, old_until, new_from, force in cases:
        old = t.positions.filter(F.col("pos_date") < F.lit(old_until).cast("date"))
        new = t.positions.filter(F.col("pos_date") >= F.lit(new_from).cast("date"))
        row = update_decision(old, new, "pos_date", force).withColumn("scenario", F.lit(name))
        result = row if result is None else result.unionByName(row)
    return result


@query("snk_10_track_unmatched", "quotes universe_dim", """
    WITH missing AS (SELECT CAST(cusip AS VARCHAR) AS c, security FROM quotes q
                     WHERE NOT EXISTS (SELECT 1 FROM universe_dim u WHERE u.cusip = q.cusip))
    SELECT 'quotes' AS source_table, c AS cusip_original, c AS cusip_standardized, security AS security_name,
           DATE '2024-02-01' AS universe_match_attempted_date, 2 * count(*) AS logged_rows
    FROM missing GROUP BY c, security""")
def _(t):
    every, last = _target(t, "unmatched-all"), _target(t, "unmatched-last")
    rows = with_match_status(t.quotes, t.universe_dim, "cusip").withColumn(
        "cusip_standardized", normalized(F.col("cusip")))
    for day in ("2024-01-31", "2024-02-01"):
        track_unmatched(unmatched_rows(rows, "quotes", "cusip", "security", "quote_date", "events",
                                       F.lit(day).cast("date")), every, last)
    logged = t.spark.read.parquet(every).groupBy("source_table", "cusip_original").agg(
        F.count(F.lit(1)).alias("logged_rows"))
    return t.spark.read.parquet(last).join(logged, ["source_table", "cusip_original"]).select(
        "source_table", "cusip_original", "cusip_standardized", "security_name",
        "universe_match_attempted_date", "logged_rows")


@query("snk_11_schema_compatibility", "quotes", """
    SELECT side, column_name, (SELECT count(*) FROM quotes) AS n_rows
    FROM (VALUES ('missing_in_data', 'keyword'), ('missing_in_target', 'bid_size')) v(side, column_name)""")
def _(t):
    target = [c for c in COLS if c != "bid_size"] + ["keyword"]
    gap = F.array(*[F.struct(F.lit(side).alias("side"), F.lit(c).alias("column_name"))
                    for side, names in schema_gap(_quotes(t), target).items() for c in names])
    return _quotes(t).agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.inline(gap))


@query("snk_12_prepare_export", "quotes", """
    SELECT event_id, strftime(quote_date, '%Y-%m-%d') AS "Date", quote_time AS "Time",
           bid_spread AS "Bid Yield to Convention" FROM quotes""")
def _(t):
    raw = t.quotes.select("event_id", F.col("quote_date").alias("Date"),
                          F.concat("quote_time", F.lit(":00")).alias("Time"),
                          F.coalesce("bid_spread", F.lit(float("nan"))).alias("Bid Yield To Convention"))
    return prepare_export(raw)


@query("snk_03_narrower_batch", "quotes", f"""
    SELECT event_id, quote_date, cusip, dealer, bid_spread, CASE WHEN again THEN NULL ELSE bid_size END AS bid_size
    FROM (SELECT {_COLS}, quote_date >= DATE '{MIDDLE}' AND event_id % 2 = 1 AS again FROM ({_LATEST}))""")
def _(t):
    """A batch without a stored column replaces its own rows; the column of all other rows stays."""
    path = _target(t, "narrow-merge")
    latest = keep_last(_quotes(t), KEY, ["event_id"])
    merge_latest(latest, path, KEY, ["event_id"], "quote_date")
    batch = latest.filter((F.col("quote_date") >= MIDDLE) & (F.col("event_id") % 2 == 1)).drop("bid_size")
    upsert(batch, path, KEY, "quote_date", ["event_id"])
    return t.spark.read.parquet(path).select(*COLS)


@query("snk_05_missing_dates", "quotes", f"""
    SELECT event_id, d AS quote_date, cusip, dealer, bid_spread, CASE WHEN event_id % 20 = 0 THEN bid_size + 1000 ELSE bid_size END AS bid_size
    FROM (SELECT *, CASE WHEN event_id % 10 = 0 THEN NULL ELSE quote_date END AS d FROM quotes)""")
def _(t):
    """Rows without a date are a partition of their own and merged like the others."""
    path = _target(t, "undated")
    rows = _quotes(t).withColumn("quote_date", F.when(F.col("event_id") % 10 != 0, F.col("quote_date")))
    upsert(rows, path, ["event_id"], "quote_date")
    upsert(rows.filter(F.col("event_id") % 20 == 0).withColumn("bid_size", F.col("bid_size") + 1000), path, ["event_id"], "quote_date")
    return t.spark.read.parquet(path).select(*COLS)


@query("snk_03_merge_in_buckets", "quotes", _LATEST)
def _(t):
    """The merge of a table whose dates are divided by the key; each batch rewrites the buckets it falls in."""
    path = _target(t, "bucket-merge")
    late = F.col("bid_size") >= 50
    merge_latest(_quotes(t).filter(late), path, KEY, ["event_id"], "quote_date", buckets=4)
    merge_latest(_quotes(t).filter(~late), path, KEY, ["event_id"], "quote_date")
    return table(t.spark, path, _quotes(t).schema).select(*COLS)


@query("snk_04_replace_dates_in_buckets", "quotes", f"""
    SELECT event_id, quote_date, cusip, dealer, bid_spread, bid_size FROM quotes
    WHERE quote_date < DATE '{MIDDLE}' OR dealer = 'click'""")
def _(t):
    """Buckets that the new rows of a date leave empty go as well."""
    path = _target(t, "bucket-replace")
    replace_dates(_quotes(t), path, "quote_date", buckets=Buckets(4, ("dealer",)))
    replace_dates(_quotes(t).filter((F.col("quote_date") >= MIDDLE) & (F.col("dealer") == "click")), path, "quote_date")
    return table(t.spark, path, _quotes(t).schema).select(*COLS)


@query("snk_05_upsert_in_buckets", "quotes", f"""
    SELECT event_id, d AS quote_date, cusip, dealer, bid_spread, CASE WHEN event_id % 20 = 0 THEN bid_size + 1000 ELSE bid_size END AS bid_size
    FROM (SELECT *, CASE WHEN event_id % 10 = 0 THEN NULL ELSE quote_date END AS d FROM quotes)""")
def _(t):
    """A table in the plain layout, given buckets later; rows without a date are divided like the others."""
    path = _target(t, "bucket-upsert")
    rows = _quotes(t).withColumn("quote_date", F.when(F.col("event_id") % 10 != 0, F.col("quote_date")))
    upsert(rows.filter("event_id % 3 > 0"), path, ["event_id"], "quote_date")
    rebucket(t.spark, path, "quote_date", rows.schema, Buckets(4, ("event_id",)))
    upsert(rows.filter("event_id % 3 = 0"), path, ["event_id"], "quote_date")
    upsert(rows.filter("event_id % 20 = 0").withColumn("bid_size", F.col("bid_size") + 1000), path, ["event_id"], "quote_date")
    return table(t.spark, path, rows.schema).select(*COLS)
