"""Queries for ordered computations, sorting, sets and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from spreadlab.catalog import query, rounded
from spreadlab.catalog.aggregates import PAIRS, pair_table
from spreadlab.catalog.filters import FILLED, filled_history
from spreadlab.catalog.sinks import _COLS, _LATEST, COLS, KEY
from spreadlab.operators import dedup, profiling, reshape, sets, snapshots
from spreadlab.operators.panel import (
    first_dates, forward_filled_grid, last_per_cell, series_metrics, top_series)
from spreadlab.params import QUOTE_WIDE_KEY
from spreadlab.plans.pair_zscores import most_extreme
from spreadlab.fixtures import PANEL_ORDER


@query("win_01_limited_forward_fill", "history", f"WITH {FILLED} SELECT obs_date, security, g_spread FROM filled")
def _(t):
    cells = last_per_cell(t.history, "obs_date", "security", "g_spread", PANEL_ORDER)
    return forward_filled_grid(cells, "obs_date", "security", "g_spread", 5)


@query("win_02_keep_last_by_time", "quotes", _LATEST)
def _(t):
    return dedup.keep_last(t.quotes.select(*COLS), KEY, ["event_id"])


@query("win_03_keep_last_wide_key", "messy", """
    SELECT l_suppkey, l_linenumber, l_returnflag, max(ship_date) AS ship_date FROM messy GROUP BY 1, 2, 3""")
def _(t):
    last = dedup.keep_last(t.messy, ["l_suppkey", "l_linenumber", "l_returnflag"], ["ship_date"])
    return last.select("l_suppkey", "l_linenumber", "l_returnflag", "ship_date")


@query("win_03_keep_last_quote_key", "quotes", """
    SELECT quote_date AS "Date", quote_time AS "Time", dealer AS "Dealer", security AS "Security", bid_price AS "Bid Price",
           ask_price AS "Ask Price", max(event_id) AS event_id, arg_max(bid_spread, event_id) FILTER (event_id IS NOT NULL) AS bid_spread
    FROM (SELECT * EXCLUDE (bid_spread), coalesce(bid_spread, -1) AS bid_spread FROM quotes) GROUP BY ALL""")
def _(t):
    """The wide key of the quote feed; the kept row shows by its number and its spread."""
    names = {"quote_date": "Date", "quote_time": "Time", "dealer": "Dealer", "security": "Security", "bid_price": "Bid Price",
             "ask_price": "Ask Price", "bid_size": "Bid Size", "ask_size": "Ask Size"}
    feed = t.quotes.withColumnsRenamed(names).withColumn("bid_spread", F.coalesce("bid_spread", F.lit(-1.0)))
    keys = [c for c in QUOTE_WIDE_KEY if c in feed.columns and not c.endswith("Size")]
    return dedup.keep_last(feed, keys, ["event_id"]).select(*keys, "event_id", "bid_spread")


@query("win_04_keep_first", "universe_dim", """
    SELECT security, cusip, ticker FROM universe_dim QUALIFY row_number() OVER (PARTITION BY security ORDER BY cusip) = 1""")
def _(t):
    return dedup.keep_first(t.universe_dim, ["security"], ["cusip"]).select("security", "cusip", "ticker")


@query("win_05_last_n_dates", "panel", """
    SELECT * FROM panel WHERE obs_date IN (SELECT DISTINCT obs_date FROM panel ORDER BY 1 DESC LIMIT 52)""")
def _(t):
    return t.panel.join(snapshots.last_dates(t.panel, "obs_date", 52), "obs_date", "left_semi")


@query("win_06_last_value_in_lookback", "history", f"""
    WITH {FILLED} SELECT security, arg_max(g_spread, obs_date) AS last_value FROM cells
    WHERE obs_date IN (SELECT DISTINCT obs_date FROM cells ORDER BY 1 DESC LIMIT 52) GROUP BY 1""")
def _(t):
    cells = last_per_cell(t.history, "obs_date", "security", "g_spread", PANEL_ORDER)
    recent = cells.join(snapshots.last_dates(cells, "obs_date", 52), "obs_date", "left_semi")
    return recent.groupBy("security").agg(F.max_by("g_spread", "obs_date").alias("last_value"))


@query("win_07_starts_before_lookback", "history", f"""
    WITH {FILLED}, s AS (SELECT min(obs_date) AS d FROM (SELECT DISTINCT obs_date FROM cells ORDER BY 1 DESC LIMIT 355))
    SELECT security, min(obs_date) AS first_date FROM filled WHERE g_spread IS NOT NULL GROUP BY 1
    HAVING min(obs_date) <= (SELECT d FROM s)""")
def _(t):
    filled = filled_history(t)
    start = snapshots.last_dates(filled, "obs_date", 355).agg(F.min("obs_date").alias("d")).scalar()
    return first_dates(filled, "obs_date", "security").filter(F.col("first_date") <= start)


@query("srt_01_nulls_last", "quotes", """
    SELECT event_id, bid_spread FROM quotes ORDER BY bid_spread ASC NULLS LAST, event_id""")
def _(t):
    return t.quotes.select("event_id", "bid_spread").orderBy(F.col("bid_spread").asc_nulls_last(), "event_id")


@query("srt_02_most_extreme", "panel", f"""
    WITH {PAIRS} SELECT security_1, security_2, round(z + 1.37e-9, 6) AS z, round(last + 1.37e-9, 6) AS last FROM scores
    ORDER BY abs(z) DESC, 1, 2 LIMIT 30""")
def _(t):
    return most_extreme(pair_table(t), 30).select(
        F.col("Security_1").alias("security_1"), F.col("Security_2").alias("security_2"),
        rounded("Z_Score").alias("z"), rounded("Last_Spread").alias("last"))


@query("srt_03_top_series", "history", """
    SELECT security, count(*) AS total_obs, count(g_spread) AS value_count FROM history GROUP BY 1
    ORDER BY count(g_spread) DESC, security LIMIT 20""")
def _(t):
    metrics = series_metrics(t.history, "obs_date", "security", "g_spread")
    return top_series(metrics, "security", 20).select(
        "security", "total_obs", "value_count")


@query("srt_04_edge_dates", "positions", """
    WITH c AS (SELECT pos_date, count(*) AS n_records FROM positions GROUP BY 1)
    (SELECT pos_date, n_records, 'first' AS edge FROM c ORDER BY 1 LIMIT 5) UNION ALL
    (SELECT pos_date, n_records, 'last' FROM c ORDER BY 1 DESC LIMIT 5)""")
def _(t):
    return profiling.edge_dates(t.positions, "pos_date")


@query("srt_04_head_and_tail", "positions", """
    (SELECT pos_id, value, 'head' AS part FROM positions ORDER BY value, pos_id LIMIT 10) UNION ALL
    (SELECT pos_id, value, 'tail' FROM positions ORDER BY value DESC, pos_id DESC LIMIT 10)""")
def _(t):
    return profiling.head_and_tail(t.positions.select("pos_id", "value"), ["value", "pos_id"])


@query("srt_05_top_values", "messy", """
    SELECT * FROM (
      SELECT 'l_returnflag' AS column_name, l_returnflag AS value, count(*) AS n FROM messy GROUP BY 2 UNION ALL
      SELECT 'tax_text', tax_text, count(*) FROM messy WHERE tax_text IS NOT NULL GROUP BY 2 UNION ALL
      SELECT 'l_linenumber', CAST(l_linenumber AS VARCHAR), count(*) FROM messy GROUP BY l_linenumber)
    QUALIFY row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) <= 3""")
def _(t):
    return profiling.top_values(t.messy, ["l_returnflag", "tax_text", "l_linenumber"]).drop("rank")


@query("srt_05_most_missing_columns", "messy", """
    SELECT * FROM (SELECT 'discount' AS column_name, count(*) - count(discount) AS null_count FROM messy UNION ALL
      SELECT 'tax_text', count(*) - count(tax_text) FROM messy UNION ALL
      SELECT 'mark', count(*) - count(mark) FROM messy) WHERE null_count > 0 ORDER BY 2 DESC, 1 LIMIT 5""")
def _(t):
    return profiling.most_missing_columns(t.messy).select("column_name", "null_count")


@query("srt_06_multi_key_sort", "quotes", f"SELECT {_COLS} FROM quotes ORDER BY quote_date, cusip, dealer, event_id")
def _(t):
    return t.quotes.select(*COLS).orderBy("quote_date", "cusip", "dealer", "event_id")


@query("set_01_union_all", "positions quotes", """
    SELECT pos_date AS d, cusip, value, CAST(NULL AS VARCHAR) AS dealer FROM positions
    UNION ALL SELECT quote_date, cusip, NULL, dealer FROM quotes""")
def _(t):
    return sets.union_all([t.positions.select(F.col("pos_date").alias("d"), "cusip", "value"),
                           t.quotes.select("dealer", F.col("quote_date").alias("d"), "cusip")])


@query("set_02_union_distinct", "positions quotes", "SELECT cusip FROM positions UNION SELECT cusip FROM quotes")
def _(t):
    return sets.union_distinct([t.positions.select("cusip"), t.quotes.select("cusip")])


@query("set_03_overlap_and_difference", "positions universe_dim", """
    SELECT 'both' AS side, cusip FROM (SELECT cusip FROM positions INTERSECT SELECT cusip FROM universe_dim)
    UNION ALL SELECT 'only positions', cusip FROM (SELECT cusip FROM positions EXCEPT SELECT cusip FROM universe_dim)
    UNION ALL SELECT 'only universe', cusip FROM (SELECT cusip FROM universe_dim EXCEPT SELECT cusip FROM positions)""")
def _(t):
    a, b = t.positions.select("cusip"), t.universe_dim.select("cusip")
    named = lambda side, df: df.select(F.lit(side).alias("side"), "cusip")
    return sets.union_all([named("both", sets.key_overlap(a, b)), named("only positions", sets.key_difference(a, b)),
                           named("only universe", sets.key_difference(b, a))])


@query("set_04_distinct_rows", "messy", "SELECT DISTINCT * FROM messy")
def _(t):
    return sets.distinct_rows(t.messy)


_WIDE = tuple(f"Brand#{i}" for i in range(1, 26))  # every brand of the table


def _all_brands(t):
    """Names of the panel's columns; a wide table's columns are its schema."""
    return [r.p_brand for r in t.table("part").select("p_brand").distinct().orderBy("p_brand").collect()]


@query("rsh_01_wide_to_long", "panel", """
    SELECT d.obs_date AS "DATE", s.security AS "Security", p.g_spread AS "GSpread"
    FROM (SELECT DISTINCT obs_date FROM panel) d CROSS JOIN (SELECT DISTINCT p_brand AS security FROM part) s
    LEFT JOIN panel p ON p.obs_date = d.obs_date AND p.security = s.security""")
def _(t):
    wide = reshape.long_to_wide(t.panel, "obs_date", "security", "g_spread", _all_brands(t))
    return reshape.wide_to_long(wide.withColumnRenamed("obs_date", "DATE"), "DATE")


@query("rsh_02_long_to_wide", "panel", "SELECT obs_date, " + ", ".join(
    f"max(g_spread) FILTER (security = '{b}') AS \"{b}\"" for b in _WIDE) + " FROM panel GROUP BY 1")
def _(t):
    return reshape.long_to_wide(t.panel, "obs_date", "security", "g_spread", _WIDE)


@query("rsh_03_duplicate_names", "quotes", """
    SELECT event_id, bid_spread AS spread, bid_size AS size FROM quotes""")
def _(t):
    rows = t.quotes.select("event_id", "bid_spread", "ask_spread", "bid_size", "ask_size")
    return reshape.rename_positions(rows, {"bid_spread": "spread", "ask_spread": "spread", "bid_size": "size",
                                           "ask_size": "size"}, on_duplicate="keep_first")
