"""Queries for the aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from spreadlab.catalog import query, rounded
from spreadlab.catalog.filters import FILLED, filled_history
from spreadlab.catalog.joins import MAPPING
from spreadlab.functions.scalars import rename_columns
from spreadlab.operators import profiling
from spreadlab.operators.dedup import first_non_null, keep_last, last_non_null
from spreadlab.operators.lookups import with_match_status
from spreadlab.operators.mapping import map_names, mapping_summary
from spreadlab.operators.pairs import pair_statistics, percentile_of_score, z_score
from spreadlab.operators.panel import series_metrics
from spreadlab.operators.quotes import QuoteColumns, best_levels, quotes_with_changes, roll_up
from spreadlab.operators.snapshots import latest_snapshot
from spreadlab.params import MonitorParams
from spreadlab.plans import history
from spreadlab.plans.pair_zscores import extreme_pairs, pair_summary
from spreadlab.session import checkpointed, scratch_path, staged
from spreadlab.sinks.tables import overwrite
from spreadlab.sources.partitions import stored_freshness

QUOTE_COLUMNS = QuoteColumns("quote_date", "cusip", "dealer", ("event_id",), "bid_spread", "ask_spread",
                             "bid_size", "ask_size")
MONTH_COLUMNS = QuoteColumns("quote_date", "cusip", "dealer", ("quote_date",), "bid_spread", "ask_spread",
                             "bid_size", "ask_size")

# statistics of all brand pairs over their common dates, as SQL
PAIRS = """
    last_values AS (SELECT security, arg_max(g_spread, obs_date) AS v FROM panel GROUP BY 1),
    diffs AS (SELECT a.security AS security_1, b.security AS security_2, a.g_spread - b.g_spread AS d, x.v - y.v AS last
              FROM panel a JOIN panel b ON a.obs_date = b.obs_date AND a.security < b.security
              JOIN last_values x ON x.security = a.security JOIN last_values y ON y.security = b.security),
    stats AS (SELECT security_1, security_2, count(*) AS n, avg(d) AS mean, stddev_samp(d) AS std, min(d) AS lo, max(d) AS hi,
                     any_value(last) AS last, count(*) FILTER (d < last) AS below, count(*) FILTER (d <= last) AS upto
              FROM diffs GROUP BY 1, 2),
    scores AS (SELECT *, CASE WHEN std > 0 THEN (last - mean) / std ELSE 0 END AS z,
                      (below + upto + CASE WHEN upto > below THEN 1 ELSE 0 END) * 50.0 / n AS pct FROM stats)"""


def brand_pairs(t):
    """Statistics of all brand pairs from one aligned row per brand."""
    days = t.panel.agg(F.sort_array(F.collect_set("obs_date")).alias("days"))
    grid = days.select(F.posexplode("days").alias("position", "obs_date"))
    span = grid.agg(F.max("position").alias("n")).scalar()
    cells = t.panel.join(grid, "obs_date")
    per_series = cells.groupBy("security").agg(
        F.max_by("g_spread", "obs_date").alias("last_value"),
        F.map_from_entries(F.collect_list(F.struct("position", "g_spread"))).alias("by_position"))
    series = (per_series.withColumn("positions", F.sequence(F.lit(0), span))
              .select("security", "last_value", F.transform(
                  "positions", lambda p: F.try_element_at("by_position", p)).alias("values")))
    return pair_statistics(checkpointed(series), "security", "values", "last_value")


def brand_scores(t):
    pairs = brand_pairs(t)
    return pairs.select(
        "security_1", "security_2", "n_common", "mean", "std", "min_diff", "max_diff", "last_diff",
        z_score(F.col("last_diff"), F.col("mean"), F.col("std")).alias("z"),
        percentile_of_score(F.col("below"), F.col("at_or_below"), F.col("n_common")).alias("pct"))


def pair_table(t):
    """The brand scores under the column names of the pair table."""
    return rename_columns(brand_scores(t), {
        "security_1": "Security_1", "security_2": "Security_2", "z": "Z_Score", "last_diff": "Last_Spread",
    }).withColumns({"CUSIP_1": F.col("Security_1"), "CUSIP_2": F.col("Security_2")})


@query("agg_01_series_metrics", "history", """
    SELECT security, count(*) AS total_obs, min(obs_date) AS first_date, max(obs_date) AS last_date,
           count(g_spread) AS value_count, round(stddev_samp(g_spread), 4) AS volatility FROM history GROUP BY 1""")
def _(t):
    return series_metrics(t.history, "obs_date", "security", "g_spread").withColumn("volatility", F.round("volatility", 4))


@query("agg_02_pair_statistics", "panel", f"""
    WITH {PAIRS} SELECT security_1, security_2, n AS n_common, round(mean + 1.37e-9, 6) AS mean, round(std + 1.37e-9, 6) AS std,
                        round(lo + 1.37e-9, 6) AS min_diff, round(hi + 1.37e-9, 6) AS max_diff FROM stats""")
def _(t):
    return brand_pairs(t).select("security_1", "security_2", "n_common",
                                 *[rounded(c).alias(c) for c in ("mean", "std", "min_diff", "max_diff")])


@query("agg_03_z_score", "panel", f"WITH {PAIRS} SELECT security_1, security_2, round(z + 1.37e-9, 6) AS z FROM scores")
def _(t):
    return brand_scores(t).select("security_1", "security_2", rounded("z").alias("z"))


@query("agg_04_percentile_of_score", "panel", f"""
    WITH {PAIRS} SELECT security_1, security_2, round(pct + 1.37e-9, 6) AS pct FROM scores""")
def _(t):
    return brand_scores(t).select("security_1", "security_2", rounded("pct").alias("pct"))


@query("agg_05_last_value_per_cell", "history", f"WITH {FILLED} SELECT obs_date, security, g_spread FROM cells")
def _(t):
    return filled_history(t).filter(~F.col("is_filled")).drop("is_filled")


@query("agg_06_last_non_null", "quotes", """
    SELECT quote_date, cusip, dealer, arg_max(bid_spread, event_id) FILTER (bid_spread IS NOT NULL) AS bid_spread,
           arg_max(ask_spread, event_id) FILTER (ask_spread IS NOT NULL) AS ask_spread,
           arg_max(bid_size, event_id) AS bid_size FROM quotes GROUP BY 1, 2, 3""")
def _(t):
    return last_non_null(t.quotes, ["quote_date", "cusip", "dealer"], ["event_id"],
                         ["bid_spread", "ask_spread", "bid_size"])


@query("agg_07_first_non_null", "quotes", """
    SELECT quote_date, cusip, dealer, arg_min(bid_spread, (-epoch_us(ts), event_id)) FILTER (bid_spread IS NOT NULL) AS bid_spread,
           arg_min(ask_price, (-epoch_us(ts), event_id)) FILTER (ask_price IS NOT NULL) AS ask_price
    FROM quotes GROUP BY 1, 2, 3""")
def _(t):
    newest_first = t.quotes.withColumn("_age", -F.unix_micros(F.col("ts").cast("timestamp")))
    return first_non_null(newest_first, ["quote_date", "cusip", "dealer"], ["_age", "event_id"],
                          ["bid_spread", "ask_price"])


@query("agg_06_last_with_ties", "quotes", """
    SELECT quote_date, dealer, arg_max(bid_spread, (quote_time, bid_spread)) FILTER (bid_spread IS NOT NULL) AS bid_spread,
           arg_max(ask_spread, (quote_time, ask_spread)) FILTER (ask_spread IS NOT NULL) AS ask_spread,
           arg_max(bid_size, (quote_time, bid_size)) AS bid_size FROM quotes GROUP BY 1, 2""")
def _(t):
    """Times to the minute tie; of equally late values the greatest is taken."""
    return last_non_null(t.quotes, ["quote_date", "dealer"], ["quote_time"], ["bid_spread", "ask_spread", "bid_size"])


@query("agg_08_monitor_roll_up", "quotes", """
    SELECT cusip, security, round(avg(bid_spread) + 1.37e-9, 6) AS bid_spread, round(avg(ask_spread) + 1.37e-9, 6) AS ask_spread,
           CAST(sum(bid_size) AS DOUBLE) AS bid_size, arg_min(dealer, event_id) AS dealer FROM quotes GROUP BY 1, 2""")
def _(t):
    rules = {"mean": ["bid_spread", "ask_spread", "absent"], "sum": ["bid_size"], "first": ["dealer"]}
    return roll_up(t.quotes, ["cusip", "security"], rules, ["event_id"]).withColumns(
        {"bid_spread": rounded("bid_spread"), "ask_spread": rounded("ask_spread")})


@query("agg_09_best_levels", "quotes", """
    WITH bids AS (SELECT cusip, bid_spread, dealer, bid_size FROM quotes WHERE bid_size >= 20 AND bid_spread IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY cusip ORDER BY bid_spread, bid_size DESC, dealer) = 1),
    offers AS (SELECT cusip, ask_spread, dealer, ask_size FROM quotes WHERE ask_size >= 20 AND ask_spread IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY cusip ORDER BY ask_spread, ask_size DESC, dealer) = 1)
    SELECT cusip, bid_spread AS "Best Bid", round(ask_spread + 1.37e-9, 6) AS "Best Offer",
           round(bid_spread - ask_spread + 1.37e-9, 6) AS "Bid/Offer", b.dealer AS "Dealer @ Best Bid", o.dealer AS "Dealer @ Best Offer",
           bid_size AS "Size @ Best Bid", ask_size AS "Size @ Best Offer"
    FROM (SELECT DISTINCT cusip FROM quotes) LEFT JOIN bids b USING (cusip) LEFT JOIN offers o USING (cusip)""")
def _(t):
    return best_levels(t.quotes, QUOTE_COLUMNS, MonitorParams(min_size=20)).withColumns(
        {"Best Offer": rounded("Best Offer"), "Bid/Offer": rounded("Bid/Offer")})


# all numeric columns, and a text column of numbers
_DESCRIBED = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "discount", "tax_text"]


def _describe_sql(column):
    c = f"TRY_CAST({column} AS DOUBLE)"
    return f"""SELECT '{column}' AS column_name, count({c}) AS n, round(avg({c}) + 1.37e-9, 6) AS mean, round(stddev_samp({c}) + 1.37e-9, 6) AS std,
        CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, round(quantile_cont({c}, 0.25) + 1.37e-9, 6) AS q25, round(quantile_cont({c}, 0.5) + 1.37e-9, 6) AS q50,
        round(quantile_cont({c}, 0.75) + 1.37e-9, 6) AS q75 FROM messy"""


@query("agg_10_describe", "messy", " UNION ALL ".join(_describe_sql(c) for c in _DESCRIBED))
def _(t):
    return profiling.describe(t.messy, _DESCRIBED).withColumns(
        {c: rounded(c) for c in ("mean", "std", "q25", "q50", "q75")})


_PROFILED = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "discount", "tax_text", "mark",
             "l_returnflag", "ship_date"]


@query("agg_11_null_counts", "messy", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, count(*) AS total_rows,
        round((count(*) - count({c})) * 100.0 / count(*) + 1.37e-9, 6) AS null_pct FROM messy""" for c in _PROFILED))
def _(t):
    return profiling.null_counts(t.messy, _PROFILED).withColumn("null_pct", rounded("null_pct"))


@query("agg_12_duplicate_rows", "messy", """
    SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM messy)) AS duplicate_rows FROM messy""")
def _(t):
    return profiling.duplicate_rows(t.messy)


@query("agg_13_categorical_distribution", "messy", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n,
        round(count(*) * 100.0 / (SELECT count(*) FROM messy) + 1.37e-9, 6) AS pct,
        (SELECT count(DISTINCT {c}) FROM messy) AS unique_count FROM messy WHERE {c} IS NOT NULL GROUP BY {c}"""
    for c in ("l_returnflag", "mark", "tax_text")))
def _(t):
    return profiling.categorical_distribution(t.messy, ["l_returnflag", "mark", "tax_text"]).withColumn(
        "pct", rounded("pct"))


_NUMBERS = ["l_suppkey", "l_quantity", "l_extendedprice", "discount"]


@query("agg_14_numeric_statistics", "messy", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, round(avg({c}) + 1.37e-9, 6) AS mean,
        round(stddev_samp({c}) + 1.37e-9, 6) AS std, count(DISTINCT {c}) AS unique_count FROM messy""" for c in _NUMBERS))
def _(t):
    return profiling.numeric_statistics(t.messy, _NUMBERS).withColumns(
        {"mean": rounded("mean"), "std": rounded("std")})


@query("agg_15_date_coverage", "positions", """
    SELECT count(DISTINCT pos_date) AS unique_dates, min(pos_date) AS min_date, max(pos_date) AS max_date,
           CAST(max(pos_date) - min(pos_date) AS BIGINT) AS span_days,
           round((max(pos_date) - min(pos_date)) / 365.25, 1) AS span_years, count(*) AS n_records FROM positions""")
def _(t):
    return profiling.date_coverage(t.positions, "pos_date")


@query("agg_15_records_by_date", "positions", "SELECT pos_date, count(*) AS n_records FROM positions GROUP BY 1")
def _(t):
    return profiling.dated_counts(t.positions, "pos_date")


@query("agg_16_year_distribution", "positions", """
    SELECT CAST(year(pos_date) AS INT) AS year, count(*) AS n_records, count(*) FILTER (isodow(pos_date) <= 5) AS business_days,
           count(*) FILTER (isodow(pos_date) > 5) AS weekend_days,
           round(count(*) FILTER (isodow(pos_date) <= 5) * 100.0 / count(*) + 1.37e-9, 6) AS business_pct,
           round(count(*) FILTER (isodow(pos_date) > 5) * 100.0 / count(*) + 1.37e-9, 6) AS weekend_pct FROM positions GROUP BY 1""")
def _(t):
    return profiling.year_distribution(t.positions, "pos_date").withColumns(
        {"business_pct": rounded("business_pct"), "weekend_pct": rounded("weekend_pct")})


@query("agg_17_recent_months", "positions", """
    SELECT CAST(date_trunc('month', pos_date) AS DATE) AS month, count(*) AS n_records FROM positions
    WHERE pos_date >= (SELECT max(pos_date) - INTERVAL 12 MONTH FROM positions) GROUP BY 1 ORDER BY 1 DESC LIMIT 12""")
def _(t):
    return profiling.recent_months(t.positions, "pos_date")


@query("agg_18_records_per_date", "positions", """
    SELECT min(n) AS min_records, max(n) AS max_records, round(avg(n) + 1.37e-9, 6) AS avg_records
    FROM (SELECT count(*) AS n FROM positions GROUP BY pos_date)""")
def _(t):
    return profiling.records_per_date(t.positions, "pos_date").withColumn("avg_records", rounded("avg_records"))


_PERIODS = {"DoD": "d - INTERVAL 1 DAY", "WoW": "d - INTERVAL 7 DAY", "MTD": "date_trunc('month', d) - INTERVAL 1 DAY",
            "QTD": "date_trunc('quarter', d) - INTERVAL 1 DAY", "YTD": "date_trunc('year', d) - INTERVAL 1 DAY", "1YR": "d - INTERVAL 1 YEAR"}


def _change_sql(table):
    changes = " UNION ALL ".join(f"""
        SELECT '{p}' AS column_name, n.bid_spread - o.bid_spread AS x FROM {table} n JOIN {table} o USING (cusip, dealer)
        WHERE n.quote_date = (SELECT d FROM d)
          AND o.quote_date = (SELECT max(quote_date) FROM {table}, d WHERE quote_date <= CAST({ref} AS DATE))""" for p, ref in _PERIODS.items())
    five = ", ".join(f"round({c} + 1.37e-9, 6) AS {n}" for n, c in (
        ("min", "min(x)"), ("q1", "quantile_cont(x, 0.25)"), ("median", "quantile_cont(x, 0.5)"), ("q3", "quantile_cont(x, 0.75)"), ("max", "max(x)")))
    return f"""
    WITH d AS (SELECT max(quote_date) AS d FROM {table}), c AS ({changes})
    SELECT column_name, {five} FROM c WHERE x IS NOT NULL GROUP BY 1"""


def _changes(quotes):
    """Changes of all periods of the monitor: quotes of one day, written once as they are read three times."""
    params = MonitorParams(size_periods=())
    changes = staged(quotes_with_changes(quotes, MONTH_COLUMNS, params), "changes")
    return profiling.five_numbers(changes, params.periods).select(
        "column_name", *[rounded(c).alias(c) for c in ("min", "q1", "median", "q3", "max")])


@query("agg_19_change_distribution", "month_quotes", _change_sql("month_quotes"))
def _(t):
    return _changes(t.month_quotes)


@query("agg_19_change_distribution_days", "quotes", _change_sql(
    "(SELECT quote_date, cusip, dealer, bid_spread FROM quotes QUALIFY row_number() OVER (PARTITION BY quote_date, cusip, dealer ORDER BY event_id DESC) = 1)"))
def _(t):
    """Daily quotes, the last of a key: the short periods have values, the long ones may have none."""
    return _changes(keep_last(t.quotes, ["quote_date", "cusip", "dealer"], ["event_id"]))


def _register_resample(method, expression):
    @query(f"agg_20_monthly_{method}", "panel", f"""
        SELECT security, last_day(obs_date) AS month_end, {expression} AS g_spread FROM panel GROUP BY 1, 2""")
    def _(t):
        return profiling.monthly(t.panel, "obs_date", "g_spread", method, by=["security"]).withColumn(
            "g_spread", rounded("g_spread"))


for _method, _expression in (
        ("last", "round(arg_max(g_spread, obs_date) + 1.37e-9, 6)"), ("first", "round(arg_min(g_spread, obs_date) + 1.37e-9, 6)"),
        ("mean", "round(avg(g_spread) + 1.37e-9, 6)"), ("median", "round(median(g_spread) + 1.37e-9, 6)")):
    _register_resample(_method, _expression)


def _flagged(t):
    positions = with_match_status(t.positions, t.universe_dim, "cusip")
    quotes = with_match_status(t.quotes, t.universe_dim, "cusip")
    return {"portfolio": (positions, "pos_date"), "runs": (quotes, "quote_date")}


MATCHED = """
    flagged AS (SELECT 'portfolio' AS table_name, cusip, pos_date AS d FROM positions
                UNION ALL SELECT 'runs', cusip, quote_date FROM quotes),
    matches AS (SELECT table_name, count(*) AS total_cusips, count(u.cusip) AS matched_cusips,
                       count(*) - count(u.cusip) AS unmatched_cusips, count(u.cusip) * 100.0 / count(*) AS rate,
                       max(d) AS reference_date
                FROM flagged f LEFT JOIN universe_dim u ON f.cusip = u.cusip GROUP BY 1)"""


@query("agg_21_match_summary", "positions quotes universe_dim", f"""
    WITH {MATCHED} SELECT table_name, total_cusips, matched_cusips, unmatched_cusips, round(rate + 1.37e-9, 6) AS match_rate_percent,
        CASE WHEN rate >= 98 THEN 'excellent' WHEN rate >= 95 THEN 'good' WHEN rate >= 90 THEN 'warning' ELSE 'critical' END AS band
    FROM matches""")
def _(t):
    return history.match_summary(_flagged(t)).drop("reference_date").withColumn(
        "match_rate_percent", rounded("match_rate_percent"))


@query("agg_22_row_counts", "positions quotes universe_dim", """
    WITH c AS (SELECT 'positions' AS table_name, count(*) AS n_rows FROM positions UNION ALL
      SELECT 'quotes', count(*) FROM quotes UNION ALL SELECT 'universe', count(*) FROM universe_dim)
    SELECT table_name, n_rows, round(n_rows * 100.0 / (SELECT sum(n_rows) FROM c) + 1.37e-9, 6) AS share_pct FROM c""")
def _(t):
    return history.row_counts({"positions": t.positions, "quotes": t.quotes, "universe": t.universe_dim}).withColumn(
        "share_pct", rounded("share_pct"))


@query("agg_23_identifier_coverage", "positions quotes universe_dim", """
    WITH u AS (SELECT count(DISTINCT cusip) AS n FROM universe_dim)
    SELECT 'positions' AS table_name, count(DISTINCT cusip) AS unique_cusips,
           round(count(DISTINCT cusip) * 100.0 / (SELECT n FROM u) + 1.37e-9, 6) AS coverage_pct FROM positions
    UNION ALL SELECT 'quotes', count(DISTINCT cusip), round(count(DISTINCT cusip) * 100.0 / (SELECT n FROM u) + 1.37e-9, 6) FROM quotes""")
def _(t):
    return history.identifier_coverage({"positions": (t.positions, "cusip"), "quotes": (t.quotes, "cusip")},
                                       t.universe_dim, "cusip").withColumn("coverage_pct", rounded("coverage_pct"))


@query("agg_24_freshness", "positions quotes universe", """
    SELECT 'positions' AS table_name, max(pos_date) AS latest_date FROM positions UNION ALL
    SELECT 'quotes', max(quote_date) FROM quotes UNION ALL SELECT 'universe', max(uni_date) FROM universe""")
def _(t):
    return history.freshness({"positions": (t.positions, "pos_date"), "quotes": (t.quotes, "quote_date"),
                              "universe": (t.universe, "uni_date")})


@query("agg_24_freshness_of_partitions", "month_quotes universe", """
    SELECT 'quotes' AS table_name, max(quote_date) AS latest_date FROM month_quotes UNION ALL
    SELECT 'universe', max(uni_date) FROM universe""")
def _(t):
    """Latest dates of stored tables, from the names of their folders."""
    root = scratch_path(t.spark, "freshness")
    overwrite(t.month_quotes, f"{root}/quotes", "quote_date")
    overwrite(t.universe, f"{root}/universe", "uni_date")
    return stored_freshness(t.spark, {"quotes": (f"{root}/quotes", "quote_date"), "universe": (f"{root}/universe", "uni_date")})


@query("agg_25_blank_counts", "identifiers", """
    SELECT 'cusip' AS column_name, count(*) FILTER (cusip IS NULL OR trim(cusip) = '') AS blank_count FROM identifiers
    UNION ALL SELECT 'row_id', count(*) FILTER (row_id IS NULL) FROM identifiers""")
def _(t):
    return profiling.blank_counts(t.identifiers, ["cusip", "row_id"])


@query("agg_26_pair_table_summary", "panel", f"""
    WITH {PAIRS} SELECT count(*) AS total_pairs, count(DISTINCT security_1) AS unique_cusips_1,
      count(DISTINCT security_2) AS unique_cusips_2, round(min(z) + 1.37e-9, 6) AS min_zscore, round(max(z) + 1.37e-9, 6) AS max_zscore,
      round(avg(last) + 1.37e-9, 6) AS avg_spread, count(*) FILTER (abs(z) > 1) AS extreme_1, count(*) FILTER (abs(z) > 1.5) AS extreme_1_5
    FROM scores""")
def _(t):
    return pair_summary(pair_table(t), (1.0, 1.5)).withColumns(
        {c: rounded(c) for c in ("min_zscore", "max_zscore", "avg_spread")})


@query("flt_31_extreme_pairs", "panel", f"""
    WITH {PAIRS} SELECT security_1, security_2, round(z + 1.37e-9, 6) AS z FROM scores WHERE abs(z) > 1""")
def _(t):
    return extreme_pairs(pair_table(t), 1.0).select(
        F.col("Security_1").alias("security_1"), F.col("Security_2").alias("security_2"), rounded("Z_Score").alias("z"))


@query("agg_28_mapping_summary", "names_a names_b", f"""
    WITH {MAPPING} SELECT count(*) FILTER (kind = 'exact') AS exact_matches, count(*) FILTER (kind = 'fuzzy') AS fuzzy_matches,
      count(*) FILTER (kind = 'unmapped') AS unmapped, count(*) AS total_names,
      round(count(*) FILTER (kind <> 'unmapped') * 100.0 / count(*) + 1.37e-9, 6) AS match_rate FROM mapping""")
def _(t):
    return mapping_summary(map_names(t.names_a, t.names_b)).withColumn("match_rate", rounded("match_rate"))


def _unmatched(t):
    rows = with_match_status(t.quotes, t.universe_dim, "cusip").withColumn(
        "cusip_standardized", F.col("cusip").cast("string"))
    positions = with_match_status(t.positions, t.universe_dim, "cusip").withColumn(
        "cusip_standardized", F.col("cusip").cast("string"))
    build = lambda df, name, label, date: history.unmatched_rows(df, name, "cusip", label, date, name, F.col(date))
    return build(rows, "runs", "security", "quote_date").unionByName(
        build(positions, "portfolio", "sec_type", "pos_date"))


@query("agg_29_unmatched_by_table", "positions quotes universe_dim", f"""
    WITH {MATCHED} SELECT table_name AS source_table, unmatched_cusips AS unmatched_count FROM matches WHERE unmatched_cusips > 0""")
def _(t):
    return history.unmatched_by_table(_unmatched(t))


@query("agg_29_recent_unmatched", "quotes universe_dim", """
    SELECT 'runs' AS source_table, CAST(cusip AS VARCHAR) AS cusip_original, CAST(cusip AS VARCHAR) AS cusip_standardized,
           security AS security_name FROM quotes WHERE cusip NOT IN (SELECT cusip FROM universe_dim)
    ORDER BY quote_date DESC, 1, 2 LIMIT 10""")
def _(t):
    return history.recent_unmatched(_unmatched(t), 10)


@query("agg_30_overall_missing", "messy", """
    SELECT CAST(missing AS BIGINT) AS missing_cells, cells, round(missing * 100.0 / cells + 1.37e-9, 6) AS missing_pct,
           missing * 100.0 / cells <= 95 AS passed
    FROM (SELECT sum((discount IS NULL)::INT + (tax_text IS NULL)::INT + (mark IS NULL)::INT) AS missing, 11 * count(*) AS cells
          FROM messy)""")
def _(t):
    return profiling.overall_missing(t.messy).withColumn("missing_pct", rounded("missing_pct"))


@query("agg_09_best_levels_latest", "quotes", """
    WITH q AS (SELECT cusip, dealer, arg_max(bid_spread, event_id) FILTER (bid_spread IS NOT NULL) AS bid_spread,
                 arg_max(bid_size, event_id) AS bid_size, arg_max(ask_size, event_id) AS ask_size,
                 arg_max(ask_spread, event_id) FILTER (ask_spread IS NOT NULL) AS ask_spread
               FROM quotes WHERE quote_date = (SELECT max(quote_date) FROM quotes) GROUP BY 1, 2)
    SELECT cusip, min(bid_spread) FILTER (bid_size >= 20) AS "Best Bid",
           round(min(ask_spread) FILTER (ask_size >= 20) + 1.37e-9, 6) AS "Best Offer" FROM q GROUP BY 1""")
def _(t):
    latest = last_non_null(latest_snapshot(t.quotes, "quote_date"), ["cusip", "dealer"], ["event_id"],
                           ["bid_spread", "ask_spread", "bid_size", "ask_size"])
    return best_levels(latest, QUOTE_COLUMNS, MonitorParams(min_size=20)).select("cusip", "Best Bid", rounded("Best Offer").alias("Best Offer"))
