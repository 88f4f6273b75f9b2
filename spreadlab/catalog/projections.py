"""Queries for projections and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from spreadlab.catalog import query, rounded
from spreadlab.functions import dates, scalars
from spreadlab.operators.quality import date_format_verdict
from spreadlab.params import Bins, IdentifierOverride, OutlierRule, QualityParams

_MATURITY = Bins("yrs_mat", "mat_bucket", (0, 0.25, 0.5, 1, 2.1, 3.1, 4.1, 5.1, 7.1, 10.1, 25.1, float("inf")),
                 ("0-0.25", "0.25-0.50", "0.50-1", "1-2.1", "2.1-3.1", "3.1-4.1", "4.1-5.1", "5.1-7.1", "7.1-10.1",
                  "10.1-25.1", ">25.1"))
_AGE = Bins("yrs_issue", "age_bucket", (0, 0.25, 0.5, 1, 2, 3, 5, 7, float("inf")),
            ("0-0.25", "0.25-0.50", "0.50-1", "1-2", "2-3", "3-5", "5-7", ">7"))


def _bucket_sql(column, bins):
    cases = " ".join(f"WHEN {column} < {upper} THEN '{label}'" if upper != float("inf") else f"ELSE '{label}'"
                     for upper, label in zip(bins.edges[1:], bins.labels))
    return f"CASE WHEN {column} >= {bins.edges[0]} THEN CASE {cases} END END"


@query("prj_01_keep_list", "universe_dim", "SELECT ticker, cusip, g_sprd FROM universe_dim")
def _(t):
    return scalars.keep_columns(t.universe_dim, ["ticker", "no_such_column", "cusip", "g_sprd"])


@query("prj_02_drop_list", "positions", "SELECT pos_id, pos_date, cusip, value FROM positions")
def _(t):
    return scalars.drop_columns(t.positions, ["status", "sec_type", "quantity", "no_such_column"])


@query("prj_03_rename_map", "panel", 'SELECT obs_date AS "DATE", security AS "Security", g_spread AS "GSpread" FROM panel')
def _(t):
    return scalars.rename_columns(t.panel, {"obs_date": "DATE", "security": "Security", "g_spread": "GSpread",
                                            "absent": "x"})


@query("prj_04_fixed_order", "quotes", """
    SELECT cusip, quote_date, dealer, bid_spread, CAST(NULL AS VARCHAR) AS keyword, CAST(NULL AS DOUBLE) AS g_spread
    FROM quotes""")
def _(t):
    wanted = T.StructType([T.StructField("quote_date", T.DateType()), T.StructField("cusip", T.LongType()),
                           T.StructField("dealer", T.StringType()), T.StructField("bid_spread", T.DoubleType()),
                           T.StructField("keyword", T.StringType()), T.StructField("g_spread", T.DoubleType())])
    return scalars.first_column(scalars.conform(t.quotes, wanted), "cusip")


@query("prj_05_numeric_coercion", "messy", """
    SELECT l_orderkey, l_linenumber, l_extendedprice, TRY_CAST(tax_text AS DOUBLE) AS tax FROM messy""")
def _(t):
    return t.messy.select("l_orderkey", "l_linenumber", "l_extendedprice",
                          scalars.to_double(F.col("tax_text")).alias("tax"))


@query("prj_06_datetime_coercion", "messy", """
    SELECT l_orderkey, l_linenumber, l_extendedprice,
           CASE WHEN l_linenumber <> 4 THEN CAST(ship_date AS TIMESTAMP) END AS shipped FROM messy""")
def _(t):
    text = F.when(F.col("l_linenumber") != 4, F.date_format("ship_date", "yyyy-MM-dd")).otherwise("not a date")
    return t.messy.select("l_orderkey", "l_linenumber", "l_extendedprice",
                          scalars.to_timestamp(text).cast("timestamp_ntz").alias("shipped"))


@query("prj_07_first_fitting_date_format", "positions", """
    SELECT pos_id, CASE WHEN pos_id % 7 <> 0 THEN pos_date END AS parsed FROM positions""")
def _(t):
    text = (F.when(F.col("pos_id") % 7 != 0, F.concat(F.lit(" "), F.date_format("pos_date", "MM/dd/yyyy"), F.lit(" ")))
            .otherwise(F.lit("n/a")))
    raw = t.positions.select("pos_id", text.alias("parsed"))
    return dates.parse_with_first_fitting(raw, "parsed", ["MM/dd/yy", "yyyy-MM-dd", "MM/dd/yyyy", "dd/MM/yyyy"])


@query("prj_08_date_format_check", "positions", """
    WITH texts AS (SELECT CASE WHEN status = 'F' THEN strftime(pos_date, '%Y-%m-%d')
                               ELSE strftime(pos_date, '%m/%d/%Y') END AS d FROM positions),
    parsed AS (SELECT 'MM/dd/yyyy' AS date_format, count(try_strptime(d, '%m/%d/%Y')) AS parsed, count(*) AS total FROM texts
               UNION ALL SELECT 'yyyy-MM-dd', count(try_strptime(d, '%Y-%m-%d')), count(*) FROM texts
               UNION ALL SELECT 'dd/MM/yyyy', count(try_strptime(d, '%d/%m/%Y')), count(*) FROM texts)
    SELECT date_format, parsed, total, round(parsed / total + 1.37e-9, 6) AS share,
           CASE WHEN parsed / total > 0.8 THEN 'valid' WHEN parsed / total < 0.5 THEN 'invalid' ELSE 'partial' END AS verdict
    FROM parsed""")
def _(t):
    text = (F.when(F.col("status") == "F", F.date_format("pos_date", "yyyy-MM-dd"))
            .otherwise(F.date_format("pos_date", "MM/dd/yyyy")))
    return date_format_verdict(t.positions.select(text.alias("d")), "d", QualityParams()).withColumn(
        "share", rounded("share"))


@query("prj_09_time_parse", "quotes", """
    SELECT event_id, CASE WHEN bid_size % 5 <> 0 THEN quote_time END AS quote_time FROM quotes""")
def _(t):
    plain = F.regexp_replace("quote_time", "^0", "")
    text = (F.when(F.col("bid_size") % 5 == 0, F.concat(F.lit("25:"), plain))
            .when(F.col("bid_size") % 5 == 1, F.concat(F.lit(" "), plain, F.lit(":30"))).otherwise(plain))
    return t.quotes.select("event_id", dates.clock_text(text).alias("quote_time"))


@query("prj_10_date_text", "positions", "SELECT pos_id, strftime(pos_date, '%Y-%m-%d') AS pos_date FROM positions")
def _(t):
    return t.positions.select("pos_id", dates.iso_text(F.col("pos_date")).alias("pos_date"))


@query("prj_11_nan_to_null", "quotes", """
    SELECT event_id, bid_spread, CAST(len(list_filter([bid_spread, ask_spread], lambda x: x IS NULL)) AS BIGINT) AS n_missing
    FROM quotes""")
def _(t):
    nan = F.lit(float("nan"))
    raw = t.quotes.select("event_id", F.coalesce("bid_spread", nan).alias("bid_spread"),
                          F.array(F.coalesce("bid_spread", nan), F.coalesce("ask_spread", nan)).alias("both"))
    return scalars.nan_to_null_all(raw).select(
        "event_id", "bid_spread", F.size(F.filter("both", lambda x: x.isNull())).cast("bigint").alias("n_missing"))


@query("prj_12_plain_fractions", "universe_dim", """
    SELECT cusip, security || ' ' || CAST(CAST(yrs_mat AS INT) AS VARCHAR) ||
           CASE CAST(yrs_mat AS INT) % 4 WHEN 0 THEN ' 1/8' WHEN 1 THEN ' 1/4' WHEN 2 THEN ' 1/2 1/3' ELSE ' 7/8' END AS security
    FROM universe_dim""")
def _(t):
    years = F.col("yrs_mat").cast("int")
    sign = F.when(years % 4 == 0, "⅛").when(years % 4 == 1, "¼").when(years % 4 == 2, "½ ⅓").otherwise("⅞")
    text = F.concat_ws(" ", "security", years.cast("string"), sign)
    return t.universe_dim.select("cusip", scalars.plain_fractions(text).alias("security"))


@query("prj_13_text_cast", "messy", """
    SELECT l_orderkey, l_extendedprice, mark, CAST(l_suppkey AS VARCHAR) AS l_suppkey FROM messy""")
def _(t):
    return scalars.text_columns(t.messy.select("l_orderkey", "l_extendedprice", "mark", "l_suppkey"),
                                ["mark", "l_suppkey"])


@query("prj_14_lineage_columns", check="""
    SELECT o_orderkey, 'orders.parquet' AS source_file, CAST(o_orderdate AS DATE) AS file_date, TRUE AS has_load_time
    FROM orders""")
def _(t):
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    rows = scalars.with_lineage(t.table("orders"), name, F.to_date("o_orderdate"))
    return rows.select("o_orderkey", "source_file", "file_date", F.col("loaded_timestamp").isNotNull().alias("has_load_time"))


@query("prj_15_identifier_overrides", "positions", """
    SELECT pos_id, CASE WHEN sec_type = '5-LOW' THEN 'CDX' WHEN status = 'P' THEN 'CASH CAD' ELSE 'BOND ' || cusip END AS security,
           CASE WHEN sec_type = '5-LOW' THEN '460' WHEN status = 'P' THEN '123' ELSE CAST(cusip AS VARCHAR) END AS cusip
    FROM positions""")
def _(t):
    named = F.when(F.col("status") == "P", "CASH CAD").otherwise(F.concat(F.lit("BOND "), F.col("cusip").cast("string")))
    raw = t.positions.select("pos_id", named.alias("security"), F.col("cusip").cast("string").alias("cusip"), "sec_type")
    rules = (IdentifierOverride("sec_type", "5-LOW", "460", "CDX"), IdentifierOverride("security", "CASH CAD", "123"),
             IdentifierOverride("security", "CASH USD", "789"))
    return scalars.apply_overrides(raw, rules, "cusip", "security").drop("sec_type")


@query("prj_16_outlier_rule", "positions", """
    SELECT pos_id, CASE WHEN s IS NULL OR abs(s) > 10000 THEN NULL ELSE greatest(least(s, 1000), -1000) END AS spread
    FROM (SELECT pos_id, CASE WHEN status = 'P' THEN NULL ELSE quantity / 16 END AS s FROM positions)""")
def _(t):
    spread = F.when(F.col("status") != "P", F.col("quantity") / 16)
    return t.positions.select("pos_id", scalars.clamp_outliers(spread, OutlierRule()).alias("spread"))


@query("prj_17_buckets", "universe_dim", f"""
    SELECT cusip, {_bucket_sql("yrs_mat", _MATURITY)} AS mat_bucket, {_bucket_sql("yrs_issue", _AGE)} AS age_bucket,
           {_bucket_sql("(yrs_mat - 3)", _MATURITY)} AS shifted_bucket
    FROM universe_dim""")
def _(t):
    return t.universe_dim.select(
        "cusip", scalars.bucket_label(F.col("yrs_mat"), _MATURITY).alias("mat_bucket"),
        scalars.bucket_label(F.col("yrs_issue"), _AGE).alias("age_bucket"),
        scalars.bucket_label(F.col("yrs_mat") - 3, _MATURITY).alias("shifted_bucket"))


@query("prj_18_date_features", "positions", """
    SELECT pos_id, CAST(year(pos_date) AS INT) AS "Year", CAST(month(pos_date) AS INT) AS "Month",
           CAST(quarter(pos_date) AS INT) AS "Quarter", CAST(isodow(pos_date) - 1 AS INT) AS "DayOfWeek",
           strftime(pos_date, '%A') AS "DayName", strftime(pos_date, '%B') AS "MonthName",
           isodow(pos_date) < 6 AS "IsBusinessDay", last_day(pos_date) = pos_date AS "IsMonthEnd",
           last_day(pos_date) = pos_date AND month(pos_date) % 3 = 0 AS "IsQuarterEnd",
           month(pos_date) = 12 AND day(pos_date) = 31 AS "IsYearEnd"
    FROM positions""")
def _(t):
    return t.positions.select("pos_id", *dates.date_features(F.col("pos_date")))


@query("prj_19_reference_dates", "positions", """
    SELECT pos_id, CAST(pos_date - INTERVAL 1 DAY AS DATE) AS "DoD", CAST(pos_date - INTERVAL 7 DAY AS DATE) AS "WoW",
           CAST(date_trunc('month', pos_date) - INTERVAL 1 DAY AS DATE) AS "MTD",
           CAST(date_trunc('quarter', pos_date) - INTERVAL 1 DAY AS DATE) AS "QTD",
           CAST(date_trunc('year', pos_date) - INTERVAL 1 DAY AS DATE) AS "YTD",
           CAST(pos_date - INTERVAL 1 YEAR AS DATE) AS "1YR"
    FROM positions""")
def _(t):
    return t.positions.select("pos_id", *[dates.reference_date(F.col("pos_date"), p).alias(p)
                                          for p in ("DoD", "WoW", "MTD", "QTD", "YTD", "1YR")])


@query("prj_20_absolute_key", "positions", "SELECT pos_id, abs(quantity) AS abs_quantity FROM positions")
def _(t):
    return t.positions.select("pos_id", F.abs("quantity").alias("abs_quantity"))


@query("prj_21_extreme_distances", "panel", """
    SELECT security, round(arg_max(g_spread, obs_date) - max(g_spread) + 1.37e-9, 6) AS last_vs_max,
           round(arg_max(g_spread, obs_date) - min(g_spread) + 1.37e-9, 6) AS last_vs_min FROM panel GROUP BY 1""")
def _(t):
    last = F.max_by("g_spread", "obs_date")
    return t.panel.groupBy("security").agg(rounded(last - F.max("g_spread")).alias("last_vs_max"),
                                           rounded(last - F.min("g_spread")).alias("last_vs_min"))


@query("prj_22_percentages", "quotes", """
    SELECT dealer, round(count(bid_spread) * 100.0 / nullif(count(*), 0) + 1.37e-9, 6) AS filled_pct,
           CAST(NULL AS DOUBLE) AS of_nothing_pct FROM quotes GROUP BY 1""")
def _(t):
    counted = t.quotes.groupBy("dealer").agg(F.count("bid_spread").alias("a"), F.count(F.lit(1)).alias("b"))
    return counted.select("dealer", rounded(scalars.percentage(F.col("a"), F.col("b"))).alias("filled_pct"),
                          scalars.percentage(F.col("a"), F.col("b") * 0).alias("of_nothing_pct"))
