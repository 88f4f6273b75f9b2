"""Queries for the data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from spreadlab.catalog import query, rounded
from spreadlab.operators import quality
from spreadlab.operators.dedup import duplicate_groups
from spreadlab.operators.profiling import columns_above_null_share

_TODAY = "2024-01-25"


@query("dq_01_non_numeric_rows", "messy", """
    SELECT l_orderkey, l_linenumber, column_name, value FROM (
      SELECT l_orderkey, l_linenumber, 'tax_text' AS column_name, tax_text AS value FROM messy UNION ALL
      SELECT l_orderkey, l_linenumber, 'mark', mark FROM messy)
    WHERE value IS NOT NULL AND TRY_CAST(value AS DOUBLE) IS NULL""")
def _(t):
    return quality.non_numeric_rows(t.messy, ["tax_text", "mark"], ["l_orderkey", "l_linenumber"])


@query("dq_02_negative_check", "quotes", """
    SELECT 'bid_price' AS column_name, count(*) FILTER (bid_price < 0) AS negative_count,
           count(*) FILTER (bid_price < 0) = 0 AS passed FROM quotes
    UNION ALL SELECT 'bid_size', count(*) FILTER (bid_size < 0), count(*) FILTER (bid_size < 0) = 0 FROM quotes""")
def _(t):
    return quality.negative_counts(t.quotes, ["bid_price", "bid_size", "absent"])


_TIMED = """SELECT event_id, bid_spread, CASE WHEN bid_size % 10 = 3 THEN NULL ELSE quote_date END AS "Date",
    CASE bid_size % 10 WHEN 4 THEN NULL WHEN 5 THEN '25:99' ELSE quote_time END AS "Time" FROM quotes"""


def _timed(t):
    last = F.col("bid_size") % 10
    return t.quotes.select(
        "event_id", "bid_spread", F.when(last != 3, F.col("quote_date")).alias("Date"),
        F.when(last == 5, "25:99").when(last != 4, F.col("quote_time")).alias("Time"))


@query("dq_03_date_time_checks", "quotes", f"""
    WITH q AS ({_TIMED}) SELECT 'null_dates' AS check_type, count(*) FILTER ("Date" IS NULL) AS n FROM q
    UNION ALL SELECT 'future_dates', count(*) FILTER ("Date" > DATE '{_TODAY}') FROM q
    UNION ALL SELECT 'null_times', count(*) FILTER ("Time" IS NULL) FROM q
    UNION ALL SELECT 'invalid_times', count(*) FILTER (NOT regexp_matches("Time", '^([01]?\\d|2[0-3]):[0-5]\\d$')) FROM q""")
def _(t):
    return quality.date_time_checks(_timed(t), "Date", "Time", F.lit(_TODAY).cast("date"))


@query("dq_04_required_columns", "quotes", """
    SELECT 'cusip' AS column_name, TRUE AS present, count(cusip) AS filled_rows FROM quotes UNION ALL
    SELECT 'bid_spread', TRUE, count(bid_spread) FROM quotes UNION ALL SELECT 'Keyword', FALSE, 0""")
def _(t):
    return quality.required_columns(t.quotes, ["cusip", "bid_spread", "Keyword"])


@query("dq_05_quality_report", "quotes", f"""
    WITH q AS ({_TIMED}), n AS (SELECT count(*) AS rows FROM q),
    nulls AS (SELECT 'event_id' AS c, count(*) - count(event_id) AS k FROM q UNION ALL
              SELECT 'bid_spread', count(*) - count(bid_spread) FROM q UNION ALL
              SELECT 'Date', count(*) - count("Date") FROM q UNION ALL SELECT 'Time', count(*) - count("Time") FROM q),
    stats AS (SELECT unnest([
        {{'t': 'min', 'c': 'event_id', 'v': CAST(min(event_id) AS DOUBLE)}}, {{'t': 'max', 'c': 'event_id', 'v': CAST(max(event_id) AS DOUBLE)}},
        {{'t': 'mean', 'c': 'event_id', 'v': avg(event_id)}}, {{'t': 'std', 'c': 'event_id', 'v': stddev_samp(event_id)}},
        {{'t': 'unique_count', 'c': 'event_id', 'v': CAST(count(DISTINCT event_id) AS DOUBLE)}},
        {{'t': 'min', 'c': 'bid_spread', 'v': min(bid_spread)}}, {{'t': 'max', 'c': 'bid_spread', 'v': max(bid_spread)}},
        {{'t': 'mean', 'c': 'bid_spread', 'v': avg(bid_spread)}}, {{'t': 'std', 'c': 'bid_spread', 'v': stddev_samp(bid_spread)}},
        {{'t': 'unique_count', 'c': 'bid_spread', 'v': CAST(count(DISTINCT bid_spread) AS DOUBLE)}}], recursive := true) FROM q)
    SELECT 'total_rows' AS check_type, CAST(NULL AS VARCHAR) AS column_name, CAST(rows AS DOUBLE) AS check_value, 'info' AS check_result FROM n
    UNION ALL SELECT 'total_columns', NULL, 4.0, 'info'
    UNION ALL SELECT 'null_pct', c, round(k * 100.0 / rows, 2), CASE WHEN k * 100.0 / rows > 50 THEN 'warning' ELSE 'passed' END FROM nulls, n
    UNION ALL SELECT 'duplicate_rows', NULL, 0.0, 'passed'
    UNION ALL SELECT t, c, round(v + 1.37e-9, 6), 'info' FROM stats
    UNION ALL SELECT 'negative_values', 'bid_spread', CAST(count(*) FILTER (bid_spread < 0) AS DOUBLE),
        CASE WHEN count(*) FILTER (bid_spread < 0) = 0 THEN 'passed' ELSE 'failed' END FROM q
    UNION ALL SELECT k, NULL, CAST(v AS DOUBLE), CASE WHEN v > 0 THEN 'warning' ELSE 'passed' END FROM (
        SELECT 'null_dates' AS k, count(*) FILTER ("Date" IS NULL) AS v FROM q
        UNION ALL SELECT 'future_dates', count(*) FILTER ("Date" > DATE '{_TODAY}') FROM q
        UNION ALL SELECT 'null_times', count(*) FILTER ("Time" IS NULL) FROM q
        UNION ALL SELECT 'invalid_times', count(*) FILTER ("Time" = '25:99') FROM q)""")
def _(t):
    report = quality.quality_report(_timed(t), ["bid_spread"], "Date", "Time", F.lit(_TODAY).cast("date"))
    return report.withColumn("check_value", rounded("check_value"))


@query("dq_05_validation_passed", "quotes", f"""
    WITH q AS ({_TIMED}) SELECT count(*) FILTER (bid_spread < 0) = 0 AS validation_passed,
      CAST((count(*) FILTER ("Date" IS NULL) > 0)::INT + (count(*) FILTER ("Date" > DATE '{_TODAY}') > 0)::INT
           + (count(*) FILTER ("Time" IS NULL) > 0)::INT + (count(*) FILTER ("Time" = '25:99') > 0)::INT AS BIGINT) AS warnings
    FROM q""")
def _(t):
    return quality.validation_passed(
        quality.quality_report(_timed(t), ["bid_spread"], "Date", "Time", F.lit(_TODAY).cast("date")))


def _profile_sql(column, kind, numeric):
    stats = (f"CAST(min({column}) AS DOUBLE) AS min, CAST(max({column}) AS DOUBLE) AS max, round(avg({column}) + 1.37e-9, 6) AS mean, "
             f"round(stddev_samp({column}) + 1.37e-9, 6) AS std") if numeric else \
        "CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max, CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std"
    return (f"SELECT 'messy' AS table_name, '{column}' AS column_name, '{kind}' AS data_type, count(*) AS total_rows, "
            f"count(*) - count({column}) AS null_count, {stats} FROM messy")


_MESSY = (("l_orderkey", "bigint", True), ("l_partkey", "bigint", True), ("l_suppkey", "bigint", True), ("l_linenumber", "int", True),
          ("l_quantity", "double", True), ("l_extendedprice", "double", True), ("discount", "double", True), ("tax_text", "string", False),
          ("mark", "string", False), ("l_returnflag", "string", False), ("ship_date", "date", False))


@query("dq_06_table_profile", "messy", " UNION ALL ".join(_profile_sql(*x) for x in _MESSY))
def _(t):
    """All columns of the table."""
    return quality.table_profile(t.messy, "messy").withColumns({"mean": rounded("mean"), "std": rounded("std")})


@query("dq_07_time_series_columns", "positions messy", """
    SELECT 'pos_date' AS column_name, min(pos_date) AS start_date, max(pos_date) AS end_date, count(*) AS total_dates,
           count(DISTINCT pos_date) AS unique_dates FROM positions UNION ALL
    SELECT 'text_date', min(ship_date), max(ship_date), count(ship_date), count(DISTINCT ship_date) FROM messy""")
def _(t):
    text = F.when(F.col("l_linenumber") % 2 == 0, F.date_format("ship_date", "yyyy-MM-dd")).otherwise(
        F.date_format("ship_date", "MM/dd/yyyy"))
    return quality.time_series_columns(t.positions).unionByName(
        quality.time_series_columns(t.messy.select(text.alias("text_date"), "mark")))


@query("dq_08_duplicate_groups", "quotes", """
    SELECT quote_date, cusip, dealer, count(*) AS n_rows FROM quotes GROUP BY 1, 2, 3 HAVING count(*) > 1""")
def _(t):
    return duplicate_groups(t.quotes, ["quote_date", "cusip", "dealer"])


@query("dq_09_reference_contract", "universe_dim", """
    SELECT 'duplicate_key' AS violation, security AS key, count(*) AS n_rows FROM universe_dim
    GROUP BY security HAVING count(*) > 1""")
def _(t):
    return quality.reference_contract(t.universe_dim, "security", ["cusip"])


@query("dq_10_mostly_missing_columns", "messy", """
    SELECT 'mark' AS column_name, count(*) - count(mark) AS null_count, count(*) AS total_rows,
           round((count(*) - count(mark)) * 100.0 / count(*) + 1.37e-9, 6) AS null_pct FROM messy HAVING (count(*) - count(mark)) * 2 > count(*)""")
def _(t):
    return columns_above_null_share(t.messy, 50.0).withColumn("null_pct", rounded("null_pct"))


@query("dq_11_all_tables_summary", "positions quotes universe_dim", """
    SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS tables_analyzed, count(*) FILTER (dated) AS time_series_tables FROM (
      SELECT count(*) AS n, TRUE AS dated FROM positions UNION ALL SELECT count(*), TRUE FROM quotes
      UNION ALL SELECT count(*), FALSE FROM universe_dim)""")
def _(t):
    return quality.all_tables_summary({"positions": t.positions, "quotes": t.quotes, "universe": t.universe_dim})
