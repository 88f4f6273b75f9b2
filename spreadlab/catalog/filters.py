"""Queries for the predicate language and the table filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from spreadlab.catalog import query
from spreadlab.functions.predicates import matching
from spreadlab.operators import snapshots
from spreadlab.operators.lookups import with_match_status
from spreadlab.operators.panel import dense_dates, eligible_series, forward_filled, last_per_cell, series_metrics
from spreadlab.operators.quotes import without_negatives
from spreadlab.operators.reshape import without_matching_columns, without_repeated_headers
from spreadlab.params import PairParams
from spreadlab.session import scratch_path
from spreadlab.sinks.tables import overwrite
from spreadlab.sources.partitions import stored_snapshot
from spreadlab.fixtures import PANEL_ORDER

_PREDICATES = [
    # key, view, output columns, condition, SQL condition
    ("flt_01_equal", "messy", ("mark", "==", "O"), "mark = 'O'"),
    ("flt_02_not_equal", "messy", ("mark", "!=", "O"), "mark IS DISTINCT FROM 'O'"),
    ("flt_03_in", "messy", ("mark", "in", ["O", "X"]), "mark IN ('O', 'X')"),
    ("flt_04_not_in", "messy", ("mark", "not_in", ["O", "X"]), "NOT coalesce(mark IN ('O', 'X'), FALSE)"),
    ("flt_05_contains", "messy", ("tax_text", "contains", "/a"), "contains(tax_text, '/a')"),
    ("flt_06_startswith", "messy", ("tax_text", "startswith", "0.0"), "starts_with(tax_text, '0.0')"),
    ("flt_07_greater", "messy", ("discount", ">", 0.05), "discount > 0.05"),
    ("flt_08_less", "messy", ("discount", "<", 0.05), "discount < 0.05"),
    ("flt_09_greater_equal", "messy", ("discount", ">=", 0.05), "discount >= 0.05"),
    ("flt_10_less_equal", "messy", ("discount", "<=", 0.05), "discount <= 0.05"),
    ("flt_11_between", "messy", ("discount", "between", 0.02, 0.05), "discount BETWEEN 0.02 AND 0.05"),
    ("flt_12_not_between", "messy", ("discount", "not_between", 0.02, 0.05), "discount NOT BETWEEN 0.02 AND 0.05"),
    ("flt_13_abs_greater", "positions", ("quantity", "abs_>", 200000.0), "abs(quantity) > 200000"),
    ("flt_14_abs_less", "positions", ("quantity", "abs_<", 200000.0), "abs(quantity) < 200000"),
    ("flt_15_is_null", "messy", ("discount", "is_null"), "discount IS NULL"),
    ("flt_16_not_null", "messy", ("discount", "not_null"), "discount IS NOT NULL"),
    ("flt_17_pair_equal", "messy", ("mark", "pair_equal", "l_returnflag2"), "mark = l_returnflag2"),
    ("flt_18_pair_not_equal", "messy", ("mark", "pair_not_equal", "l_returnflag2"), "mark IS DISTINCT FROM l_returnflag2"),
]
_OUT = {"messy": ["l_orderkey", "l_linenumber", "l_extendedprice", "discount", "tax_text", "mark"],
        "positions": ["pos_id", "quantity"]}


def _register(key, view, condition, where):
    out = _OUT[view]
    other = "CASE WHEN l_returnflag = 'N' THEN NULL WHEN l_returnflag = 'A' THEN 'O' ELSE 'F' END AS l_returnflag2"
    source = f"(SELECT *, {other} FROM messy)" if view == "messy" else view

    @query(key, view, f"SELECT {', '.join(out)} FROM {source} WHERE {where}")
    def _(t):
        rows = getattr(t, view)
        if view == "messy":
            rows = rows.withColumn("l_returnflag2", F.when(F.col("l_returnflag") == "A", "O")
                                   .when(F.col("l_returnflag") == "R", "F"))
        return matching(rows, condition).select(*out)


for _entry in _PREDICATES:
    _register(*_entry)


@query("flt_19_non_negative_or_missing", "quotes", """
    SELECT event_id, bid_price, ask_price FROM quotes
    WHERE (bid_price IS NULL OR bid_price >= 0) AND (ask_price IS NULL OR ask_price >= 0)""")
def _(t):
    return without_negatives(t.quotes, ["bid_price", "ask_price"], keep_missing=True).select(
        "event_id", "bid_price", "ask_price")


@query("flt_20_non_negative", "quotes", """
    SELECT event_id, bid_price, ask_price FROM quotes WHERE bid_price >= 0 AND ask_price >= 0""")
def _(t):
    return without_negatives(t.quotes, ["bid_price", "ask_price"], keep_missing=False).select(
        "event_id", "bid_price", "ask_price")


@query("flt_21_key_not_null", "messy", """
    SELECT l_orderkey, l_linenumber, discount, mark FROM messy WHERE discount IS NOT NULL AND mark IS NOT NULL""")
def _(t):
    return t.messy.na.drop(subset=["discount", "mark"]).select("l_orderkey", "l_linenumber", "discount", "mark")


@query("flt_22_date_range", "positions", """
    SELECT pos_id, pos_date FROM positions WHERE pos_date BETWEEN DATE '1996-02-01' AND DATE '1998-03-31'""")
def _(t):
    return snapshots.between_dates(t.positions, "pos_date", "1996-02-01", "1998-03-31").select("pos_id", "pos_date")


@query("flt_23_one_year", "positions", "SELECT pos_id, pos_date FROM positions WHERE year(pos_date) = 1997")
def _(t):
    return snapshots.in_year(t.positions, "pos_date", 1997).select("pos_id", "pos_date")


@query("flt_24_business_days", "positions", "SELECT pos_id, pos_date FROM positions WHERE isodow(pos_date) <= 5")
def _(t):
    return snapshots.business_days(t.positions, "pos_date").select("pos_id", "pos_date")


@query("flt_25_latest_snapshot", "positions", """
    SELECT pos_id, pos_date, cusip, value FROM positions WHERE pos_date = (SELECT max(pos_date) FROM positions)""")
def _(t):
    return snapshots.latest_snapshot(t.positions, "pos_date").select("pos_id", "pos_date", "cusip", "value")


@query("flt_25_latest_partition", "positions", """
    SELECT pos_id, CAST(date_trunc('month', pos_date) AS DATE) AS month, cusip, value FROM positions
    WHERE date_trunc('month', pos_date) = (SELECT date_trunc('month', max(pos_date)) FROM positions)""")
def _(t):
    """The latest date of a stored table, from its folders; one partition is read."""
    rows = t.positions.select("pos_id", F.trunc("pos_date", "MM").alias("month"), "cusip", "value")
    path = scratch_path(t.spark, "positions-by-month")
    overwrite(rows, path, "month")
    return stored_snapshot(t.spark, path, "month", rows.schema).select(rows.columns)


@query("flt_26_by_identifier", "positions", "SELECT pos_date, pos_id, value FROM positions WHERE cusip = 42")
def _(t):
    return matching(t.positions, ("cusip", "==", 42)).select("pos_date", "pos_id", "value")


@query("flt_27_every_nth_date", "panel", """
    SELECT obs_date, security, g_spread FROM (SELECT *, dense_rank() OVER (ORDER BY obs_date) AS r FROM panel)
    WHERE (r - 1) % 5 = 0""")
def _(t):
    return snapshots.every_nth_date(t.panel, "obs_date", 5)


# the limited forward fill, written with a full grid and a window
FILLED = """
    cells AS (SELECT obs_date, security, arg_max(g_spread, (l_orderkey, l_linenumber, l_extendedprice)) AS g_spread
              FROM history WHERE g_spread IS NOT NULL GROUP BY 1, 2),
    grid AS (SELECT obs_date, security FROM (SELECT DISTINCT obs_date FROM cells), (SELECT DISTINCT security FROM cells)),
    filled AS (SELECT obs_date, security, last_value(g_spread IGNORE NULLS) OVER (
                 PARTITION BY security ORDER BY obs_date ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS g_spread
               FROM grid LEFT JOIN cells USING (obs_date, security))"""


def filled_history(t):
    cells = last_per_cell(t.history, "obs_date", "security", "g_spread", PANEL_ORDER)
    return forward_filled(cells, "obs_date", "security", "g_spread", 5)


@query("flt_28_dense_dates", "history", f"""
    WITH {FILLED} SELECT obs_date, count(g_spread) AS n_values FROM filled GROUP BY 1
    HAVING count(g_spread) >= 0.97 * (SELECT count(DISTINCT security) FROM cells)""")
def _(t):
    n_series = t.history.filter(F.col("g_spread").isNotNull()).agg(F.count_distinct("security").alias("n")).scalar()
    return dense_dates(filled_history(t), "obs_date", n_series, 0.97)


@query("flt_29_liquid_series", "history", """
    WITH m AS (SELECT security, count(*) AS total_obs, min(obs_date) AS first_date, max(obs_date) AS last_date,
                      count(g_spread) AS value_count FROM history GROUP BY 1),
    l AS (SELECT max(obs_date) AS d FROM history)
    SELECT security, total_obs, first_date, last_date, value_count FROM m, l
    WHERE first_date <= d - 252 AND last_date >= d - 7 AND total_obs >= 590 AND value_count / total_obs >= 0.85""")
def _(t):
    metrics = series_metrics(t.history, "obs_date", "security", "g_spread")
    params = PairParams(min_observations=590, recency_days=7, min_coverage=0.85)
    return eligible_series(metrics, snapshots.latest_date(t.history, "obs_date"), params).drop("volatility")


@query("flt_30_size_threshold", "quotes", """
    SELECT event_id, bid_size, bid_spread FROM quotes WHERE bid_size >= 20 AND bid_spread IS NOT NULL""")
def _(t):
    return matching(t.quotes, ("bid_size", ">=", 20), ("bid_spread", "not_null")).select(
        "event_id", "bid_size", "bid_spread")


@query("flt_32_matched_only", "quotes universe_dim", """
    SELECT event_id, cusip FROM quotes WHERE cusip IN (SELECT cusip FROM universe_dim)""")
def _(t):
    flagged = with_match_status(t.quotes.select("event_id", "cusip"), t.universe_dim, "cusip")
    return matching(flagged, ("universe_match_status", "==", "matched")).select("event_id", "cusip")


@query("flt_33_columns_by_pattern", "quotes", "SELECT event_id, cusip, bid_size FROM quotes")
def _(t):
    raw = t.quotes.select("event_id", "cusip", "bid_size", F.lit(1).alias("Unnamed: 0"), F.lit(2).alias("bid_size.1"))
    return without_repeated_headers(without_matching_columns(raw, ["Unnamed"]))
