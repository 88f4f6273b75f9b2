"""Queries for the end-to-end jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from spreadlab.catalog import query, rounded, views
from spreadlab.catalog.joins import MAPPING
from spreadlab.fixtures import PANEL_ORDER
from spreadlab.operators.quotes import QuoteColumns
from spreadlab.operators.reshape import long_to_wide
from spreadlab.params import MonitorParams, PairParams
from spreadlab.plans import feeds, history
from spreadlab.plans.pair_zscores import Panel, pair_funnel, pair_zscores
from spreadlab.plans.reconciliation import orphan_report, reconciliation, table_report
from spreadlab.plans.run_monitor import run_monitor
from spreadlab.session import scratch_path, staged

HISTORY = Panel("obs_date", "security", "cusip", "g_spread", PANEL_ORDER)

_SELECTED = """
    obs AS (SELECT * FROM history WHERE g_spread IS NOT NULL),
    latest AS (SELECT max(obs_date) AS d FROM obs),
    chosen AS (SELECT security FROM (SELECT security, count(*) AS n, min(obs_date) AS f, max(obs_date) AS l FROM obs GROUP BY 1), latest
               WHERE f <= d - 252 AND n >= 200 AND l >= d - 30 ORDER BY n DESC, security LIMIT 200),
    cells AS (SELECT obs_date, security, arg_max(g_spread, (l_orderkey, l_linenumber, l_extendedprice)) AS g_spread
              FROM obs WHERE security IN (SELECT security FROM chosen) GROUP BY 1, 2),
    cusips AS (SELECT security, arg_max(cusip, (obs_date, l_orderkey, l_linenumber, l_extendedprice)) AS cusip FROM obs GROUP BY 1),
    grid AS (SELECT obs_date, security FROM (SELECT DISTINCT obs_date FROM cells), (SELECT DISTINCT security FROM cells)),
    filled AS MATERIALIZED (SELECT obs_date, security, last_value(g_spread IGNORE NULLS) OVER (
                 PARTITION BY security ORDER BY obs_date ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS g_spread
               FROM grid LEFT JOIN cells USING (obs_date, security)),
    kept AS MATERIALIZED (SELECT obs_date FROM filled GROUP BY 1 HAVING count(g_spread) >= 0.7 * (SELECT count(*) FROM chosen)),
    lookback AS MATERIALIZED (SELECT obs_date FROM kept ORDER BY 1 DESC LIMIT 252),
    starts AS (SELECT security, min(obs_date) <= (SELECT min(obs_date) FROM lookback) AS early
               FROM filled JOIN kept USING (obs_date) WHERE g_spread IS NOT NULL GROUP BY 1),
    vals AS MATERIALIZED (SELECT obs_date, security, g_spread FROM filled JOIN lookback USING (obs_date) WHERE g_spread IS NOT NULL),
    lasts AS (SELECT security, arg_max(g_spread, obs_date) AS v FROM vals GROUP BY 1)"""


_PAIR_SCORES = f"""
    WITH {_SELECTED},
    ready AS (SELECT security, v, cusip FROM lasts JOIN starts USING (security) JOIN cusips USING (security) WHERE early),
    diffs AS (SELECT a.security AS s1, b.security AS s2, a.g_spread - b.g_spread AS d, x.v - y.v AS last, x.cusip AS c1, y.cusip AS c2
              FROM vals a JOIN vals b ON a.obs_date = b.obs_date AND a.security < b.security
              JOIN ready x ON x.security = a.security JOIN ready y ON y.security = b.security),
    stats AS (SELECT s1, s2, c1, c2, last, count(*) AS n, avg(d) AS mean, stddev_samp(d) AS std, min(d) AS lo, max(d) AS hi,
                     count(*) FILTER (d < last) AS below, count(*) FILTER (d <= last) AS upto FROM diffs GROUP BY ALL)
    SELECT s1 AS "Security_1", c1 AS "CUSIP_1", s2 AS "Security_2", c2 AS "CUSIP_2", round(last + 1.37e-9, 6) AS "Last_Spread",
           round(CASE WHEN std > 0 THEN (last - mean) / std ELSE 0 END + 1.37e-9, 6) AS "Z_Score", round(hi + 1.37e-9, 6) AS "Max", round(lo + 1.37e-9, 6) AS "Min",
           round(last - hi + 1.37e-9, 6) AS "Last_vs_Max", round(last - lo + 1.37e-9, 6) AS "Last_vs_Min",
           round((below + upto + CASE WHEN upto > below THEN 1 ELSE 0 END) * 50.0 / n + 1.37e-9, 6) AS "Percentile" FROM stats"""


def _report(pairs):
    return pairs.withColumns({c: rounded(c) for c in (
        "Last_Spread", "Z_Score", "Max", "Min", "Last_vs_Max", "Last_vs_Min", "Percentile")})


@query("job_01_pair_zscores", "history", _PAIR_SCORES)
def _(t):
    return _report(pair_zscores(t.history, HISTORY, PairParams(max_series=200)))


_MOST = "abs(CASE WHEN std > 0 THEN (last - mean) / std ELSE 0 END)"


@query("job_01_most_extreme_pairs", "history", f"{_PAIR_SCORES} ORDER BY {_MOST} DESC, s1, s2 LIMIT 50")
def _(t):
    """The first pairs of the report; each block pair keeps as many, so the others are not shuffled."""
    return _report(pair_zscores(t.history, HISTORY, PairParams(max_series=200), n=50))


@query("job_01_pairs_beyond_threshold", "history", f"{_PAIR_SCORES} WHERE {_MOST} > 1.25")
def _(t):
    return _report(pair_zscores(t.history, HISTORY, PairParams(max_series=200), above=1.25))


@query("job_01_pairs_within_group", "history", f"""
    WITH {_SELECTED.replace(' LIMIT 200', '')},
    ready AS (SELECT security, v, cusip, CAST(cusip AS BIGINT) % 7 AS grp FROM lasts JOIN starts USING (security) JOIN cusips USING (security) WHERE early),
    diffs AS (SELECT a.security AS s1, b.security AS s2, a.g_spread - b.g_spread AS d, x.v - y.v AS last
              FROM vals a JOIN vals b ON a.obs_date = b.obs_date AND a.security < b.security
              JOIN ready x ON x.security = a.security JOIN ready y ON y.security = b.security AND x.grp = y.grp),
    stats AS (SELECT s1, s2, last, count(*) AS n, avg(d) AS mean, stddev_samp(d) AS std FROM diffs GROUP BY ALL)
    SELECT s1 AS "Security_1", s2 AS "Security_2", round(last + 1.37e-9, 6) AS "Last_Spread",
           round(CASE WHEN std > 0 THEN (last - mean) / std ELSE 0 END + 1.37e-9, 6) AS "Z_Score" FROM stats""")
def _(t):
    """All eligible series, none left out, paired within their group only."""
    cols = Panel("obs_date", "security", "cusip", "g_spread", PANEL_ORDER, group="grp")
    grouped = t.history.withColumn("grp", (F.col("cusip").cast("long") % 7))
    pairs = pair_zscores(grouped, cols)
    return pairs.select("Security_1", "Security_2", rounded("Last_Spread").alias("Last_Spread"), rounded("Z_Score").alias("Z_Score"))


@query("agg_27_pair_funnel", "history", f"""
    WITH {_SELECTED.replace('n >= 200', 'n >= 100')},
    flags AS (SELECT g.security, coalesce(s.early, FALSE) AS early, l.security IS NOT NULL AS recent
              FROM (SELECT DISTINCT security FROM grid) g LEFT JOIN starts s USING (security) LEFT JOIN lasts l USING (security)),
    pairs AS (SELECT a.early AND b.early AS ok_start, a.recent AND b.recent AS ok_recent,
                     EXISTS (SELECT 1 FROM vals x JOIN vals y USING (obs_date) WHERE x.security = a.security AND y.security = b.security) AS ok_common
              FROM flags a JOIN flags b ON a.security < b.security)
    SELECT count(*) AS pairs_attempted, count(*) FILTER (NOT ok_start) AS failed_start_date,
           count(*) FILTER (ok_start AND NOT ok_recent) AS failed_recent_data,
           count(*) FILTER (ok_start AND ok_recent AND NOT ok_common) AS failed_no_common_dates,
           count(*) FILTER (ok_start AND ok_recent AND ok_common) AS pairs_kept,
           (SELECT count(*) FROM (SELECT 1 FROM obs, latest GROUP BY security, d HAVING min(obs_date) <= d - 252 AND count(*) >= 100
                                  AND max(obs_date) >= d - 30)) - (SELECT count(*) FROM flags) AS series_left_out FROM pairs""")
def _(t):
    return pair_funnel(t.history, HISTORY, PairParams(min_observations=100, max_series=200))


QUOTES = QuoteColumns("quote_date", "cusip", "dealer", ("event_id",), "bid_spread", "ask_spread", "bid_size",
                      "ask_size", labels=("security", "ask_price"))
MONTHS = QuoteColumns("quote_date", "cusip", "dealer", ("quote_date",), "bid_spread", "ask_spread", "bid_size", "ask_size")


def _monitor_sql(deduped, min_size, security, keyword, g_spread):
    """The monitor over quotes unique per (quote_date, cusip, dealer)."""
    periods = {"DoD": "d - INTERVAL 1 DAY", "WoW": "d - INTERVAL 7 DAY", "MTD": "date_trunc('month', d) - INTERVAL 1 DAY",
               "QTD": "date_trunc('quarter', d) - INTERVAL 1 DAY", "YTD": "date_trunc('year', d) - INTERVAL 1 DAY",
               "1YR": "d - INTERVAL 1 YEAR"}
    joins, changes = "", ""
    for p, ref in periods.items():
        joins += f"""
        LEFT JOIN (SELECT cusip, dealer, bid_spread, bid_size, ask_size FROM uq WHERE quote_date = (
          SELECT max(quote_date) FROM uq, latest WHERE quote_date <= CAST({ref} AS DATE))) h{p} USING (cusip, dealer)"""
        changes += f', round(n.bid_spread - h{p}.bid_spread + 1.37e-9, 6) AS "{p}"'
        if p in ("DoD", "MTD"):
            changes += f', n.bid_size - h{p}.bid_size AS "{p} Chg Bid Size", n.ask_size - h{p}.ask_size AS "{p} Chg Ask Size"'
    return f"""
    WITH uq AS MATERIALIZED ({deduped}), latest AS (SELECT max(quote_date) AS d FROM uq),
    now AS (SELECT * FROM uq WHERE quote_date = (SELECT d FROM latest)),
    bb AS (SELECT cusip, bid_spread, dealer, bid_size FROM now WHERE bid_size >= {min_size} AND bid_spread IS NOT NULL
           QUALIFY row_number() OVER (PARTITION BY cusip ORDER BY bid_spread, bid_size DESC, dealer) = 1),
    bo AS (SELECT cusip, ask_spread, dealer, ask_size FROM now WHERE ask_size >= {min_size} AND ask_spread IS NOT NULL
           QUALIFY row_number() OVER (PARTITION BY cusip ORDER BY ask_spread, ask_size DESC, dealer) = 1)
    SELECT {security} AS "Security", n.bid_spread AS "Bid Spread", round(n.ask_spread + 1.37e-9, 6) AS "Ask Spread", n.bid_size AS "Bid Size",
           n.ask_size AS "Ask Size"{changes}, bb.bid_spread AS "Best Bid", round(bo.ask_spread + 1.37e-9, 6) AS "Best Offer",
           round(bb.bid_spread - bo.ask_spread + 1.37e-9, 6) AS "Bid/Offer", bb.dealer AS "Dealer @ Best Bid", bo.dealer AS "Dealer @ Best Offer",
           bb.bid_size AS "Size @ Best Bid", bo.ask_size AS "Size @ Best Offer", n.cusip AS "CUSIP", n.dealer AS "Dealer",
           {g_spread} AS "G Spread", {keyword} AS "Keyword"
    FROM now n {joins} LEFT JOIN bb USING (cusip) LEFT JOIN bo USING (cusip)"""


_ROUNDED = ("Ask Spread", "DoD", "WoW", "MTD", "QTD", "YTD", "1YR", "Best Offer", "Bid/Offer")


def _rounded(report):
    return report.withColumns({c: rounded(F.col(f"`{c}`")) for c in _ROUNDED})


@query("job_02_run_monitor", "quotes", _monitor_sql("""
    SELECT quote_date, cusip, dealer, arg_max(bid_spread, event_id) FILTER (bid_spread IS NOT NULL) AS bid_spread,
           arg_max(ask_spread, event_id) FILTER (ask_spread IS NOT NULL) AS ask_spread, arg_max(bid_size, event_id) AS bid_size,
           arg_max(ask_size, event_id) AS ask_size, arg_max(security, event_id) AS security,
           arg_max(ask_price, event_id) FILTER (ask_price IS NOT NULL) AS ask_price FROM quotes GROUP BY 1, 2, 3""",
    20, "n.security", "CAST(NULL AS VARCHAR)", "n.ask_price"))
def _(t):
    return _rounded(run_monitor(t.quotes, QUOTES, MonitorParams(min_size=20),
                                rename={"security": "Security", "ask_price": "G Spread"}))


@query("job_02_run_monitor_long_periods", "month_quotes", _monitor_sql(
    "SELECT * FROM month_quotes", 25, "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)", "CAST(NULL AS DOUBLE)"))
def _(t):
    return _rounded(run_monitor(t.month_quotes, MONTHS, MonitorParams(min_size=25)))


def _raw_universe(t):
    """Vendor rows: several per month and identifier, some keys and numbers missing."""
    part = t.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand", "p_size")
    number = F.when(F.col("l_linenumber") == 2, "n/a").otherwise(F.col("l_quantity").cast("int").cast("string"))
    return t.table("lineitem").join(part, "l_partkey").select(
        F.trunc("l_shipdate", "MM").alias("Date"),
        F.when(F.col("l_linenumber") != 6, F.col("l_partkey").cast("string")).alias("CUSIP"),
        F.col("p_name").alias("Security"), F.col("p_brand").alias("Ticker"), number.alias("G Sprd"),
        F.col("p_size").cast("string").alias("Yrs (Mat)"), (F.col("p_size") / 8).cast("string").alias("Yrs Since Issue"),
        F.col("l_orderkey").alias("row_a"), F.col("l_linenumber").alias("row_b"), F.col("l_extendedprice").alias("row_c"))


@query("job_03_universe_build", "", """
    WITH rows AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS d, CAST(l_partkey AS VARCHAR) AS c, l.*, p.*
                  FROM lineitem l JOIN part p ON l_partkey = p_partkey WHERE l_linenumber <> 6
                  QUALIFY row_number() OVER (PARTITION BY d, c ORDER BY l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC,
                                             l_quantity DESC) = 1)
    SELECT d AS "Date", c AS "CUSIP", p_name AS "Security", p_brand AS "Ticker",
           CASE WHEN l_linenumber = 2 THEN NULL ELSE l_quantity END AS "G Sprd", p_size / 8 AS "Yrs Since Issue",
           CAST(p_size AS DOUBLE) AS "Yrs (Mat)",
           CASE WHEN p_size / 8 < 0.25 THEN '0-0.25' WHEN p_size / 8 < 0.5 THEN '0.25-0.50' WHEN p_size / 8 < 1 THEN '0.50-1'
                WHEN p_size / 8 < 2 THEN '1-2' WHEN p_size / 8 < 3 THEN '2-3' WHEN p_size / 8 < 5 THEN '3-5'
                WHEN p_size / 8 < 7 THEN '5-7' ELSE '>7' END AS "Yrs Since Issue Bucket",
           CASE WHEN p_size < 2.1 THEN '1-2.1' WHEN p_size < 3.1 THEN '2.1-3.1' WHEN p_size < 4.1 THEN '3.1-4.1'
                WHEN p_size < 5.1 THEN '4.1-5.1' WHEN p_size < 7.1 THEN '5.1-7.1' WHEN p_size < 10.1 THEN '7.1-10.1'
                WHEN p_size < 25.1 THEN '10.1-25.1' ELSE '>25.1' END AS "Yrs (Mat) Bucket"
    FROM rows""")
def _(t):
    return feeds.build_universe(_raw_universe(t), order=["row_a", "row_b", "row_c", "G Sprd"])


def _as_files(df, folder, file_date, fmt="csv"):
    """One folder per date, named like the vendor's files."""
    batch = F.concat(F.lit("API "), F.date_format(file_date, "MM.dd.yy"))
    df.withColumn("batch", batch).drop(file_date).hint("rebalance", "batch").write.mode("append").option(
        "header", True).partitionBy("batch").csv(folder)


def _feed_paths(t, name):
    root = scratch_path(t.spark, name)
    return feeds.FeedPaths(*[f"{root}/{part}" for part in ("files", "table", "state", "log")])


@query("job_03_universe_refresh", "", """
    WITH u AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS d, l_partkey AS c, min(l_quantity) AS q FROM lineitem GROUP BY 1, 2)
    SELECT d AS "Date", CAST(c AS VARCHAR) AS "CUSIP", p_name || CASE WHEN late THEN ' late' ELSE '' END AS "Security",
           p_brand AS "Ticker", CASE WHEN late THEN q + 1000 ELSE q END AS "G Sprd", CAST(p_size AS DOUBLE) AS "Yrs (Mat)"
    FROM (SELECT *, FALSE AS late FROM u UNION ALL SELECT d, -c, q, TRUE FROM u WHERE d = (SELECT max(d) FROM u) AND c % 2 = 0)
    JOIN part ON p_partkey = abs(c)""")
def _(t):
    """All files, then once more with one more file for the last date, then once more without a change."""
    part = t.table("part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("Security"),
                                  F.col("p_brand").alias("Ticker"), F.col("p_size").alias("Yrs (Mat)"))
    # read for the files, the last date and the late file
    rows = staged(t.table("lineitem").groupBy(F.trunc("l_shipdate", "MM").alias("d"), "l_partkey")
                  .agg(F.min("l_quantity").alias("G Sprd")).join(part, "l_partkey").withColumnRenamed("l_partkey", "CUSIP"), "universe-rows")
    paths = _feed_paths(t, "universe-refresh")
    _as_files(rows, paths.folder, "d")
    feeds.refresh_universe(t.spark, paths, dated_by="path", now=views._now())
    late = rows.filter((F.col("d") == rows.agg(F.max("d").alias("d")).scalar()) & (F.col("CUSIP") % 2 == 0))
    _as_files(late.withColumn("G Sprd", F.col("G Sprd") + 1000).withColumn("CUSIP", -F.col("CUSIP"))
              .withColumn("Security", F.concat("Security", F.lit(" late"))), paths.folder, "d")
    for _ in range(2):
        feeds.refresh_universe(t.spark, paths, dated_by="path", now=views._now())
    return t.spark.read.parquet(paths.table).select("Date", "CUSIP", "Security", "Ticker", "G Sprd", "Yrs (Mat)")


@query("job_04_portfolio_refresh", "positions", """
    SELECT CAST(date_trunc('month', pos_date) AS DATE) AS "Date", 'BOND ' || cusip AS "SECURITY", CAST(cusip AS VARCHAR) AS "CUSIP",
           quantity AS "QUANTITY", CAST(pos_date + INTERVAL 400 DAY AS DATE) AS "MATURITY DATE" FROM positions""")
def _(t):
    """Positions with vendor dates; the maturity becomes a date."""
    rows = t.positions.select(F.trunc("pos_date", "MM").alias("file_date"), F.concat(F.lit("BOND "), F.col("cusip").cast("string")).alias("SECURITY"),
                              F.col("cusip").alias("CUSIP"), F.col("quantity").alias("QUANTITY"), F.lit("x").alias("OWNER"),
                              F.date_format(F.date_add("pos_date", 400), "MM/dd/yyyy").alias("MATURITY DATE"))
    paths = _feed_paths(t, "portfolio-refresh")
    _as_files(rows.filter("file_date < '1995-01-01'"), paths.folder, "file_date")
    feeds.refresh_portfolio(t.spark, paths, dated_by="path", now=views._now())
    _as_files(rows.filter("file_date >= '1995-01-01'"), paths.folder, "file_date")
    feeds.refresh_portfolio(t.spark, paths, dated_by="path", now=views._now())
    return t.spark.read.parquet(paths.table).select("Date", "SECURITY", "CUSIP", "QUANTITY", "MATURITY DATE")


@query("job_05_quote_refresh", "quotes", """
    SELECT quote_date AS "Date", quote_time AS "Time", CAST(cusip AS VARCHAR) AS "CUSIP", dealer AS "Dealer",
           bid_spread AS "Bid Spread", CAST(bid_size AS DOUBLE) AS "Bid Size" FROM quotes
    WHERE bid_spread IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY quote_date, cusip, dealer ORDER BY quote_time DESC, event_id DESC) = 1""")
def _(t):
    """Two runs of new files, merged by key; the later quote wins whichever file it comes in."""
    rows = t.quotes.select(
        F.date_format("quote_date", "MM/dd/yy").alias("Date"), F.col("quote_time").alias("Time"), F.col("cusip").alias("CUSIP"),
        F.col("dealer").alias("Dealer"), F.col("bid_spread").alias("Bid Spread"), F.col("bid_size").alias("Bid Size"),
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("event_id"))
    paths = _feed_paths(t, "quote-refresh")
    for part in (F.col("Bid Size") >= 50, F.col("Bid Size") < 50):
        rows.filter(part).write.mode("append").option("header", True).csv(paths.folder)
        feeds.refresh_quotes(t.spark, paths, order=("Time", "event_id"), now=views._now())
    return t.spark.read.parquet(paths.table).select("Date", "Time", "CUSIP", "Dealer", "Bid Spread", "Bid Size")


@query("job_04_portfolio_build", "positions", """
    SELECT pos_date AS "Date", pos_id AS "ID", CASE WHEN sec_type = '5-LOW' THEN 'CDX' WHEN status = 'P' THEN 'CASH CAD'
             ELSE 'BOND ' || cusip END AS "SECURITY",
           CASE WHEN sec_type = '5-LOW' THEN '460' WHEN status = 'P' THEN '123' ELSE CAST(cusip AS VARCHAR) END AS "CUSIP",
           CASE WHEN sec_type = '5-LOW' THEN 'CDX' ELSE 'BOND' END AS "SECURITY TYPE", quantity AS "QUANTITY",
           CASE WHEN cusip % 11 = 0 THEN NULL ELSE value END AS "PRICE"
    FROM positions WHERE cusip % 13 <> 0""")
def _(t):
    named = (F.when(F.col("cusip") % 13 == 0, None).when(F.col("status") == "P", "CASH CAD")
             .otherwise(F.concat(F.lit("BOND "), F.col("cusip").cast("string"))))
    raw = t.positions.select(
        "pos_date", F.col("pos_id").alias("ID"), named.alias("SECURITY"), F.col("cusip").alias("CUSIP"),
        F.when(F.col("sec_type") == "5-LOW", "CDX").otherwise("BOND").alias("SECURITY TYPE"),
        F.col("quantity").alias("QUANTITY"),
        F.when(F.col("cusip") % 11 == 0, "missing").otherwise(F.col("value").cast("string")).alias("PRICE"),
        F.lit("x").alias("OWNER"), F.lit(1).alias("Unnamed: 0"))
    return feeds.build_portfolio(raw.withColumnRenamed("pos_date", "Date"))


@query("job_05_quote_build", "quotes", """
    SELECT quote_date AS "Date", quote_time AS "Time", cusip AS "CUSIP", dealer AS "Dealer", event_id,
           bid_spread AS "Bid Spread", bid_price AS "Bid Price", ask_price AS "Ask Price" FROM quotes
    WHERE (bid_price IS NULL OR bid_price >= 0) AND (ask_price IS NULL OR ask_price >= 0) AND bid_spread IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY quote_date, cusip, dealer ORDER BY quote_time DESC, event_id DESC) = 1""")
def _(t):
    raw = t.quotes.select(
        F.date_format("quote_date", "MM/dd/yy").alias("Date"), F.concat(F.lit(" "), "quote_time").alias("Time"),
        F.col("cusip").alias("CUSIP"), F.col("dealer").alias("Dealer"), "event_id", F.col("bid_spread").alias("Bid Spread"),
        F.col("bid_price").alias("Bid Price"), F.col("ask_price").alias("Ask Price"))
    return feeds.build_quotes(raw, order=["Time", "event_id"])


_ALTERED = """CASE length(p_name) % 4 WHEN 0 THEN p_name
    WHEN 1 THEN split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 1)
    WHEN 2 THEN left(p_name, 3) || substr(p_name, 5) ELSE p_name || ' ' || left(p_name, 2) END"""


@query("job_06_spread_history_build", "names_a names_b", f"""
    WITH {MAPPING},
    prices AS (SELECT CAST(date_trunc('week', l_shipdate) AS DATE) AS d, p_name, max(l_extendedprice) AS v
               FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
    days AS (SELECT DISTINCT d FROM prices),
    universe AS (SELECT {_ALTERED} AS security, CAST(min(p_partkey) AS VARCHAR) AS cusip FROM part GROUP BY 1)
    SELECT u.cusip AS "CUSIP", days.d AS "DATE", u.security AS "Security", prices.v AS "GSpread"
    FROM mapping m JOIN universe u ON u.security = m.target CROSS JOIN days
    LEFT JOIN prices ON prices.d = days.d AND prices.p_name = m.source""")
def _(t):
    part = t.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    prices = (t.table("lineitem").join(part, "l_partkey")
              .groupBy(F.date_trunc("week", "l_shipdate").cast("date").alias("DATE"), "p_name")
              .agg(F.max("l_extendedprice").alias("v")))
    # the vendor's wide file: its column names are its header
    header = [r.name for r in t.names_a.orderBy("name").collect()]
    wide = long_to_wide(prices, "DATE", "p_name", "v", header).withColumn("Unnamed: 0", F.lit(0.0))
    universe = t.table("part").groupBy(t.altered_name().alias("Security")).agg(
        F.min("p_partkey").cast("string").alias("CUSIP"))
    return feeds.build_spread_history(wide, universe, universe_date=None)


def _recon_tables(t):
    return {
        "portfolio": (t.positions.select(F.col("pos_date").alias("Date"), F.col("cusip").alias("CUSIP"),
                                         F.col("sec_type").alias("SECURITY")), "Date"),
        "runs": (t.quotes.select(F.col("quote_date").alias("Date"), F.col("cusip").alias("CUSIP"),
                                 F.col("security").alias("Security"), F.col("bid_spread").alias("Bid Spread")), "Date"),
    }


_NUMBERS = ("pos_id", "cusip", "value", "quantity")


def _profile_sql():
    n = "(SELECT count(*) FROM p)"
    rows = [f"SELECT '{c}' AS column_name, 'total_rows' AS metric, CAST({n} AS DOUBLE) AS value" for c in (*_NUMBERS, "pos_Date", "status", "sec_type")]
    rows += [f"SELECT '{c}', 'null_count', CAST(count(*) FILTER ({c} IS NULL) AS DOUBLE) FROM p" for c in (*_NUMBERS, "pos_Date", "status", "sec_type")]
    for c in _NUMBERS:
        rows += [f"SELECT '{c}', '{m}', {e} FROM p" for m, e in {
            "min": f"CAST(min({c}) AS DOUBLE)", "max": f"CAST(max({c}) AS DOUBLE)", "mean": f"round(avg({c}), 3)", "std": f"round(stddev_samp({c}), 3)",
            "q25": f"round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 3)", "q50": f"round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 3)",
            "q75": f"round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 3)"}.items()]
    day = "CAST(date_diff('day', DATE '1970-01-01', {}) AS DOUBLE)"
    rows += [f"SELECT 'pos_Date', 'start_date', {day.format('min(pos_Date)')} FROM p", f"SELECT 'pos_Date', 'end_date', {day.format('max(pos_Date)')} FROM p",
             "SELECT 'pos_Date', 'total_dates', CAST(count(pos_Date) AS DOUBLE) FROM p", "SELECT 'pos_Date', 'unique_dates', CAST(count(DISTINCT pos_Date) AS DOUBLE) FROM p",
             "SELECT NULL, 'duplicate_rows', CAST((SELECT count(*) FROM p) - (SELECT count(*) FROM (SELECT DISTINCT * FROM p)) AS DOUBLE)"]
    return ("WITH p AS (SELECT pos_id, cusip, value, quantity, pos_date AS pos_Date, status, sec_type FROM positions) "
            "SELECT 'portfolio' AS table_name, * FROM (" + " UNION ALL ".join(rows) + ")")


@query("job_07_table_report", "positions", _profile_sql())
def _(t):
    rows = t.positions.select(*_NUMBERS, F.col("pos_date").alias("pos_Date"), "status", "sec_type")
    report = table_report(rows, "portfolio")
    rough = F.col("metric").isin("mean", "std", "q25", "q50", "q75")
    return report.withColumn("value", F.when(rough, F.round("value", 3)).otherwise(F.col("value")))


@query("job_07_orphan_report", "positions quotes universe", """
    WITH u AS (SELECT DISTINCT CAST(cusip AS VARCHAR) AS c FROM universe),
    now AS (SELECT DISTINCT CAST(cusip AS VARCHAR) AS c FROM universe WHERE uni_date = (SELECT max(uni_date) FROM universe)),
    ids AS (SELECT 'portfolio' AS t, CAST(cusip AS VARCHAR) AS c, sec_type AS s, pos_date = (SELECT max(pos_date) FROM positions) AS cur FROM positions
            UNION ALL SELECT 'runs', CAST(cusip AS VARCHAR), security, quote_date = (SELECT max(quote_date) FROM quotes) FROM quotes),
    found AS (
      SELECT 'all_dates' AS section, t AS table_name, c AS cusip, min(s) AS security_name, count(*) AS instances FROM ids WHERE c NOT IN (SELECT c FROM u) GROUP BY t, c
      UNION ALL SELECT 'latest_date', t, c, min(s), count(*) FROM ids WHERE cur AND c NOT IN (SELECT c FROM now) GROUP BY t, c)
    SELECT section, table_name, cusip, security_name, instances FROM found
    UNION ALL SELECT 'all_dates', '(total)', CAST(count(DISTINCT cusip) AS VARCHAR), (SELECT CAST(count(*) AS VARCHAR) FROM u), CAST(coalesce(sum(instances), 0) AS BIGINT)
      FROM found WHERE section = 'all_dates'
    UNION ALL SELECT 'latest_date', '(total)', CAST(count(DISTINCT cusip) AS VARCHAR), (SELECT CAST(count(*) AS VARCHAR) FROM now), CAST(coalesce(sum(instances), 0) AS BIGINT)
      FROM found WHERE section = 'latest_date'""")
def _(t):
    return orphan_report(_recon_tables(t), t.universe, "uni_date", "cusip")


@query("job_07_reconciliation", "positions quotes universe", """
    WITH pf AS (SELECT pos_date, cusip, sec_type FROM positions), rn AS (SELECT quote_date, cusip, security, bid_spread FROM quotes),
    ids AS (SELECT 'portfolio' AS t, CAST(cusip AS VARCHAR) AS c, pos_date = (SELECT max(pos_date) FROM pf) AS cur FROM pf
            UNION ALL SELECT 'runs', CAST(cusip AS VARCHAR), quote_date = (SELECT max(quote_date) FROM rn) FROM rn),
    o_all AS (SELECT 'orphans_all_dates' AS section, t, count(*) AS n, count(DISTINCT c) AS k FROM ids
              WHERE c NOT IN (SELECT CAST(cusip AS VARCHAR) FROM universe) GROUP BY t),
    o_now AS (SELECT 'orphans_latest_date' AS section, t, count(*) AS n, count(DISTINCT c) AS k FROM ids
              WHERE cur AND c NOT IN (SELECT CAST(cusip AS VARCHAR) FROM universe WHERE uni_date = (SELECT max(uni_date) FROM universe)) GROUP BY t),
    o AS (SELECT * FROM o_all UNION ALL SELECT * FROM o_now),
    profile AS (
      SELECT 'portfolio' AS t, count(*) AS r, 3 AS c, 0 AS m, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM pf)) AS dup FROM pf
      UNION ALL SELECT 'runs', count(*), 4, count(*) - count(bid_spread), count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM rn)) FROM rn)
    SELECT section, t AS table_name, 'total_instances' AS metric, CAST(n AS DOUBLE) AS value FROM o
    UNION ALL SELECT section, t, 'unique_cusips', CAST(k AS DOUBLE) FROM o
    UNION ALL SELECT 'profile', t, 'total_rows', CAST(r AS DOUBLE) FROM profile
    UNION ALL SELECT 'profile', t, 'total_columns', CAST(c AS DOUBLE) FROM profile
    UNION ALL SELECT 'profile', t, 'missing_cells', CAST(m AS DOUBLE) FROM profile
    UNION ALL SELECT 'profile', t, 'date_columns', 1.0 FROM profile
    UNION ALL SELECT 'profile', t, 'duplicate_rows', CAST(dup AS DOUBLE) FROM profile""")
def _(t):
    return reconciliation(_recon_tables(t), t.universe, "uni_date", "cusip")


_MONITOR_BY_ID = f"""
    SELECT "CUSIP" AS c, "Security" AS s, avg("Bid Spread") AS v, count(*) AS n FROM ({_monitor_sql("""
    SELECT quote_date, cusip, dealer, arg_max(bid_spread, event_id) FILTER (bid_spread IS NOT NULL) AS bid_spread,
           arg_max(ask_spread, event_id) FILTER (ask_spread IS NOT NULL) AS ask_spread, arg_max(bid_size, event_id) AS bid_size,
           arg_max(ask_size, event_id) AS ask_size, arg_max(security, event_id) AS security,
           arg_max(ask_price, event_id) FILTER (ask_price IS NOT NULL) AS ask_price FROM quotes GROUP BY 1, 2, 3""",
    20, "n.security", "CAST(NULL AS VARCHAR)", "n.ask_price")}) GROUP BY 1, 2"""


@query("job_08_history_tables", "universe positions quotes month_quotes", f"""
    SELECT 'universe_historical' AS table_name, uni_date AS d, {views.std_sql('cusip')} AS id, security AS item, NULL::DOUBLE AS v FROM universe
    UNION ALL SELECT 'portfolio_historical', "Date", {views.std_sql('"CUSIP"')},
      CASE WHEN "CUSIP" IN (SELECT cusip FROM universe WHERE uni_date = (SELECT max(uni_date) FROM universe)) THEN 'matched' ELSE 'unmatched' END,
      "QUANTITY" FROM ({views._PORTFOLIO})
    UNION ALL SELECT 'combined_runs_historical', quote_date, {views.std_sql('cusip')}, dealer,
      arg_max(bid_spread, event_id) FILTER (bid_spread IS NOT NULL) FROM quotes GROUP BY quote_date, cusip, dealer
    UNION ALL SELECT 'run_monitor', NULL, {views.std_sql('c')}, s, round(v + 1.37e-9, 6) FROM ({_MONITOR_BY_ID})
    UNION ALL SELECT 'gspread_long', quote_date, {views.std_sql('cusip')}, dealer, bid_spread FROM month_quotes
    UNION ALL SELECT 'processing_log', NULL, 'op 1', name, NULL FROM (VALUES ('universe_historical'), ('portfolio_historical'),
      ('combined_runs_historical'), ('run_monitor'), ('gspread_long')) AS x(name)""")
def _(t):
    """All five tables row by row, after the operation ran twice; the monitor is fed with the run monitor's report."""
    paths = history.HistoryPaths(scratch_path(t.spark, "history-all"))
    report = run_monitor(t.quotes, QUOTES, MonitorParams(min_size=20), rename={"security": "Security", "ask_price": "G Spread"})
    spreads = t.month_quotes.select(F.col("quote_date").alias("DATE"), F.col("cusip").alias("CUSIP"),
                                    F.col("dealer").alias("Security"), F.col("bid_spread").alias("GSpread"))
    for _ in range(2):
        history.load_all(views._universe_feed(t), views._portfolio_feed(t), views._quote_feed(t), report, spreads, paths, "op 1",
                         quote_order=["event_id"], portfolio_order=["pos_id"], now=views._now(), today=F.lit("2024-02-01").cast("date"))

    def rows(name, date, identifier, item, value):
        value = value if value is not None else F.lit(None).cast("double")
        return t.spark.read.parquet(paths.table(name)).select(
            F.lit(name).alias("table_name"), (F.col(date) if date else F.lit(None)).cast("date").alias("d"),
            F.col(identifier).alias("id"), F.col(item).alias("item"), value.alias("v"))
    std = "cusip_standardized"
    parts = [rows("universe_historical", "Date", std, "Security", None),
             rows("portfolio_historical", "Date", std, "universe_match_status", F.col("QUANTITY")),
             rows("combined_runs_historical", "Date", std, "Dealer", F.col("Bid Spread")),
             rows("run_monitor", None, std, "Security", rounded("Bid Spread")),
             rows("gspread_long", "DATE", std, "Security", F.col("GSpread")),
             rows("processing_log", None, "operation_id", "table_name", None)]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("job_08_history_load", "universe positions quotes month_quotes", """
    SELECT 'universe_historical' AS table_name, count(*) AS stored_rows FROM universe
    UNION ALL SELECT 'portfolio_historical', count(*) FROM (SELECT DISTINCT date_trunc('month', pos_date), cusip FROM positions)
    UNION ALL SELECT 'combined_runs_historical', count(*) FROM (SELECT DISTINCT quote_date, cusip, dealer FROM quotes)
    UNION ALL SELECT 'run_monitor', count(DISTINCT cusip) FROM quotes
    UNION ALL SELECT 'gspread_long', count(*) FROM month_quotes""")
def _(t):
    root = scratch_path(t.spark, "history")
    loads = [views.load_universe(t, f"{root}/universe"), views.load_portfolio(t, root), views.load_quotes(t, f"{root}/quotes"),
             views.load_monitor(t, f"{root}/monitor"), views.load_spreads(t, f"{root}/spreads")]
    return reduce(lambda a, b: a.unionByName(b), loads).select("table_name", "stored_rows")


