"""Queries for the joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from spreadlab.catalog import query, rounded
from spreadlab.catalog.filters import FILLED, filled_history
from spreadlab.operators import lookups, orphans
from spreadlab.operators.mapping import map_names, scored_pairs
from spreadlab.operators.pairs import block_count, block_pairs
from spreadlab.operators.panel import full_grid
from spreadlab.operators.snapshots import latest_snapshot, reference_dates
from spreadlab.fixtures import PANEL_ORDER
from spreadlab.params import MappingParams
from spreadlab.session import scratch_path
from spreadlab.sinks.tables import overwrite
from spreadlab.sources.partitions import stored_calendar

PERIODS = ("DoD", "WoW", "MTD", "QTD", "YTD", "1YR")

# reference days and global as-of dates of the monthly quotes
AS_OF = """
    latest AS (SELECT max(quote_date) AS d FROM month_quotes),
    refs AS (SELECT * FROM (SELECT unnest([
        {'p': 'DoD', 'r': CAST(d - INTERVAL 1 DAY AS DATE)}, {'p': 'WoW', 'r': CAST(d - INTERVAL 7 DAY AS DATE)},
        {'p': 'MTD', 'r': CAST(date_trunc('month', d) - INTERVAL 1 DAY AS DATE)},
        {'p': 'QTD', 'r': CAST(date_trunc('quarter', d) - INTERVAL 1 DAY AS DATE)},
        {'p': 'YTD', 'r': CAST(date_trunc('year', d) - INTERVAL 1 DAY AS DATE)},
        {'p': '1YR', 'r': CAST(d - INTERVAL 1 YEAR AS DATE)}], recursive := true) FROM latest) x(period, ref_date)),
    at_dates AS (SELECT period, ref_date, (SELECT max(quote_date) FROM month_quotes WHERE quote_date <= ref_date) AS as_of_date
             FROM refs)"""


@query("join_01_checked_lookup", "panel_raw universe_dim", """
    WITH dim AS (SELECT ticker AS security, min(CAST(cusip AS VARCHAR)) AS dim_cusip FROM universe_dim
                 WHERE sector <> 'SMALL' AND ticker NOT LIKE '%2' GROUP BY 1)
    SELECT l_orderkey, l_linenumber, l_extendedprice, security, dim_cusip, dim_cusip IS NOT NULL AS matched
    FROM panel_raw LEFT JOIN dim USING (security)""")
def _(t):
    dim = (t.universe_dim.filter((F.col("sector") != "SMALL") & ~F.col("ticker").endswith("2"))
           .groupBy(F.col("ticker").alias("security")).agg(F.min(F.col("cusip").cast("string")).alias("dim_cusip")))
    return lookups.many_to_one(t.panel_raw, dim, "security", ["dim_cusip"], indicator="matched").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "security", "dim_cusip", "matched")


@query("join_02_snapshot_difference", "month_quotes", f"""
    WITH {AS_OF}
    SELECT n.cusip, n.dealer, n.bid_spread, round(n.bid_spread - o.bid_spread + 1.37e-9, 6) AS ytd_change
    FROM month_quotes n LEFT JOIN (SELECT * FROM month_quotes JOIN at_dates ON quote_date = as_of_date AND period = 'YTD') o
      USING (cusip, dealer) WHERE n.quote_date = (SELECT d FROM latest)""")
def _(t):
    at = reference_dates(t.month_quotes, "quote_date", ("YTD",)).select("as_of_date").scalar()
    old = t.month_quotes.filter(F.col("quote_date") == at).select("cusip", "dealer", F.col("bid_spread").alias("_old"))
    now = latest_snapshot(t.month_quotes, "quote_date").select("cusip", "dealer", "bid_spread")
    return now.join(old, ["cusip", "dealer"], "left").select(
        "cusip", "dealer", "bid_spread", rounded(F.col("bid_spread") - F.col("_old")).alias("ytd_change"))


@query("join_03_as_of_dates", "month_quotes", f"WITH {AS_OF} SELECT period, ref_date, as_of_date FROM at_dates")
def _(t):
    return reference_dates(t.month_quotes, "quote_date", PERIODS)


@query("join_03_as_of_partitions", "month_quotes", f"WITH {AS_OF} SELECT period, ref_date, as_of_date FROM at_dates")
def _(t):
    """The as-of dates of a stored table, from the names of its folders."""
    path = scratch_path(t.spark, "quotes-by-month")
    overwrite(t.month_quotes, path, "quote_date")
    return reference_dates(stored_calendar(t.spark, path, "quote_date"), "quote_date", PERIODS)


@query("join_04_all_pairs", "panel", """
    SELECT a.security AS security_1, b.security AS security_2, count(*) AS n_common,
           round(max(a.g_spread - b.g_spread) + 1.37e-9, 6) AS max_diff
    FROM panel a JOIN panel b ON a.obs_date = b.obs_date AND a.security < b.security GROUP BY 1, 2""")
def _(t):
    # one row per series; the block join pairs them, common dates are matched inside each pair
    series = t.panel.groupBy("security").agg(
        F.map_from_entries(F.collect_list(F.struct("obs_date", "g_spread"))).alias("by_date"))
    pairs = block_pairs(series, "security", ["by_date"], block_count(series))
    entries = pairs.select("security_1", "security_2", "by_date_2", F.explode("by_date_1").alias("d", "v"))
    return (entries.withColumn("diff", F.col("v") - F.try_element_at("by_date_2", "d"))
            .filter(F.col("diff").isNotNull()).groupBy("security_1", "security_2")
            .agg(F.count(F.lit(1)).alias("n_common"), rounded(F.max("diff")).alias("max_diff")))


@query("join_05_map_both_sides", "panel_raw", """
    WITH m AS (SELECT security, arg_max(cusip, (obs_date, l_orderkey, l_linenumber, l_extendedprice)) AS cusip
               FROM panel_raw GROUP BY 1),
    p AS (SELECT obs_date, min(security) AS security_1, max(security) AS security_2 FROM panel_raw GROUP BY 1)
    SELECT obs_date, security_1, security_2, m1.cusip AS cusip_1, m2.cusip AS cusip_2
    FROM p LEFT JOIN m m1 ON m1.security = security_1 LEFT JOIN m m2 ON m2.security = security_2""")
def _(t):
    mapping = lookups.last_value_mapping(t.panel_raw, "security", "cusip", ("obs_date", *PANEL_ORDER))
    pairs = t.panel_raw.groupBy("obs_date").agg(F.min("security").alias("security_1"), F.max("security").alias("security_2"))
    return lookups.map_both_sides(pairs, mapping, "security", "cusip", "security_1", "security_2", "cusip_1", "cusip_2")


@query("join_06_match_status", "positions universe_dim", """
    SELECT pos_id, cusip, CASE WHEN cusip IN (SELECT cusip FROM universe_dim) THEN 'matched' ELSE 'unmatched' END
           AS universe_match_status FROM positions""")
def _(t):
    return lookups.with_match_status(t.positions.select("pos_id", "cusip"), t.universe_dim, "cusip")


@query("join_07_semi_join", "panel", """
    SELECT * FROM panel WHERE security IN (SELECT security FROM panel GROUP BY 1 HAVING count(*) >= (
        SELECT avg(n) FROM (SELECT count(*) AS n FROM panel GROUP BY security)))""")
def _(t):
    counts = t.panel.groupBy("security").agg(F.count(F.lit(1)).alias("n"))
    mean = counts.agg(F.avg("n").alias("m")).scalar()
    return lookups.only_in(t.panel, counts.filter(F.col("n") >= mean), ["security"]).select(*t.panel.columns)


def _with_names(t):
    """Positions, quotes and pairs with the column names the reconciliation looks for."""
    return {
        "portfolio": t.positions.select(F.col("pos_date").alias("Date"), F.col("cusip").alias("CUSIP"),
                                        F.col("sec_type").alias("SECURITY")),
        "runs": t.quotes.select(F.col("quote_date").alias("Date"), F.col("cusip").alias("CUSIP"),
                                F.col("security").alias("Security")),
        "pairs": t.table("lineitem").select(F.col("l_partkey").alias("CUSIP_1"), F.col("l_suppkey").alias("CUSIP_2"),
                                            F.col("l_returnflag").alias("Security_1"), F.col("l_linestatus").alias("Security_2")),
    }


_STACKED = """
    ids AS (SELECT 'portfolio' AS table_name, CAST(cusip AS VARCHAR) AS cusip, sec_type AS name FROM positions
            UNION ALL SELECT 'runs', CAST(cusip AS VARCHAR), security FROM quotes
            UNION ALL SELECT 'pairs', CAST(l_partkey AS VARCHAR), l_returnflag FROM lineitem
            UNION ALL SELECT 'pairs', CAST(l_suppkey AS VARCHAR), l_linestatus FROM lineitem),
    found AS (SELECT table_name, cusip, coalesce(min(name), 'Unknown') AS security_name, count(*) AS instances FROM ids
              WHERE cusip NOT IN (SELECT CAST(cusip AS VARCHAR) FROM universe_dim) GROUP BY 1, 2)"""


@query("join_08_orphans", "positions quotes universe_dim", f"WITH {_STACKED} SELECT * FROM found")
def _(t):
    return orphans.orphans(_with_names(t), t.universe_dim, "cusip")


@query("join_08_orphan_summary", "positions quotes universe_dim", f"""
    WITH {_STACKED} SELECT table_name, CAST(sum(instances) AS BIGINT) AS total_instances, count(*) AS unique_cusips
    FROM found GROUP BY 1""")
def _(t):
    return orphans.orphan_summary(orphans.orphans(_with_names(t), t.universe_dim, "cusip"))


@query("join_09_latest_orphans", "positions quotes universe", """
    WITH members AS (SELECT DISTINCT CAST(cusip AS VARCHAR) AS cusip FROM universe
                     WHERE uni_date = (SELECT max(uni_date) FROM universe)),
    ids AS (SELECT 'portfolio' AS table_name, CAST(cusip AS VARCHAR) AS cusip, sec_type AS name FROM positions
            WHERE pos_date = (SELECT max(pos_date) FROM positions)
            UNION ALL SELECT 'runs', CAST(cusip AS VARCHAR), security FROM quotes
            WHERE quote_date = (SELECT max(quote_date) FROM quotes))
    SELECT table_name, cusip, coalesce(min(name), 'Unknown') AS security_name, count(*) AS instances
    FROM ids WHERE cusip NOT IN (SELECT cusip FROM members) GROUP BY 1, 2""")
def _(t):
    tables = _with_names(t)
    return orphans.latest_orphans({n: (tables[n], "Date") for n in ("portfolio", "runs")}, t.universe, "uni_date", "cusip")


@query("join_10_orphans_per_date", "positions universe", """
    SELECT p.m AS uni_date, p.cusip, count(*) AS instances
    FROM (SELECT CAST(date_trunc('month', pos_date) AS DATE) AS m, cusip FROM positions) p
    WHERE NOT EXISTS (SELECT 1 FROM universe u WHERE u.cusip = p.cusip AND u.uni_date = p.m) GROUP BY 1, 2""")
def _(t):
    monthly = t.positions.select(F.trunc("pos_date", "MM").alias("uni_date"), "cusip")
    return orphans.dated_orphans(monthly, t.universe, "cusip", "uni_date", "cusip", "uni_date")


@query("join_11_pair_orphans", "universe_dim", """
    SELECT DISTINCT cusip, security_name FROM (
      SELECT CAST(l_partkey AS VARCHAR) AS cusip, l_returnflag AS security_name FROM lineitem
      UNION ALL SELECT CAST(l_suppkey AS VARCHAR), l_linestatus FROM lineitem)
    WHERE cusip NOT IN (SELECT CAST(cusip AS VARCHAR) FROM universe_dim)""")
def _(t):
    return orphans.pair_orphans(_with_names(t)["pairs"], t.universe_dim, "cusip",
                                {"CUSIP_1": "Security_1", "CUSIP_2": "Security_2"})


def _lcs_sql(a, b):
    """Longest common subsequence length of two short SQL texts, bit-parallel."""
    full = f"((1::BIGINT << length({a})) - 1)"
    mask = (f"list_sum(list_transform(range(0, length({a})), lambda i: CASE WHEN substr({a}, CAST(i AS INT) + 1, 1) = c "
            f"THEN 1::BIGINT << CAST(i AS INT) ELSE 0 END))::BIGINT")
    masks = f"list_transform(string_split({b}, ''), lambda c: {mask})"
    state = f"list_reduce(list_prepend({full}, {masks}), lambda v, m: ((v + (v & m)) | (v - (v & m))) & {full})"
    return f"(length({a}) - bit_count({state}))"


# all names against all names, scored by the three methods
_SCORES = f"""
    pairs AS (SELECT a.name AS source, b.name AS target FROM names_a a, names_b b
              WHERE a.name NOT IN (SELECT name FROM names_b) AND b.name NOT IN (SELECT name FROM names_a)),
    sides AS (SELECT *, CASE WHEN length(source) <= length(target) THEN source ELSE target END AS s,
                     CASE WHEN length(source) <= length(target) THEN target ELSE source END AS l,
                     array_to_string(list_sort(string_split(source, ' ')), ' ') AS ss,
                     array_to_string(list_sort(string_split(target, ' ')), ' ') AS ts FROM pairs),
    windows AS (SELECT source, target, s, unnest(list_transform(range(1 - length(s), length(l)), lambda i:
                     substr(l, CAST(greatest(i, 0) AS INT) + 1, CAST(i + length(s) - greatest(i, 0) AS INT)))) AS w FROM sides
                UNION ALL SELECT source, target, l, unnest(list_transform(range(1 - length(s), length(s)), lambda i:
                     substr(s, CAST(greatest(i, 0) AS INT) + 1, CAST(i + length(l) - greatest(i, 0) AS INT)))) FROM sides
                WHERE length(s) = length(l)),
    best_window AS (SELECT source, target, max(200.0 * {_lcs_sql('s', 'w')} / (length(s) + length(w))) AS p
                    FROM windows GROUP BY 1, 2),
    scored AS (SELECT source, target, 200.0 * {_lcs_sql('source', 'target')} / (length(source) + length(target)) AS r,
                      p, 200.0 * {_lcs_sql('ss', 'ts')} / (length(ss) + length(ts)) AS k
               FROM sides JOIN best_window USING (source, target)),
    cand AS (SELECT source, target, greatest(r, p, k) AS score,
                    CASE WHEN r >= p AND r >= k THEN 'ratio' WHEN p >= k THEN 'partial_ratio' ELSE 'token_sort_ratio' END AS method
             FROM scored WHERE greatest(r, p, k) >= 85)"""


def _rounds_sql(rounds):
    """Mutual-best rounds, unrolled: enough for the names of the fixture."""
    text, before = "", "cand"
    for i in range(rounds):
        text += f""",
    s{i} AS (SELECT * FROM {before} QUALIFY row_number() OVER (PARTITION BY source ORDER BY score DESC, target) = 1),
    t{i} AS (SELECT * FROM {before} QUALIFY row_number() OVER (PARTITION BY target ORDER BY score DESC, source) = 1),
    m{i} AS (SELECT s{i}.* FROM s{i} JOIN t{i} USING (source, target)),
    o{i} AS (SELECT * FROM {before} WHERE source NOT IN (SELECT source FROM m{i}) AND target NOT IN (SELECT target FROM m{i}))"""
        before = f"o{i}"
    matched = " UNION ALL ".join(f"SELECT source, target, score FROM m{i}" for i in range(rounds))
    return text + f""",
    fuzzy AS ({matched}),
    mapping AS (SELECT a.name AS source, coalesce(f.target, b.name) AS target,
                  CASE WHEN b.name IS NOT NULL THEN 100.0 ELSE coalesce(f.score, 0.0) END AS score,
                  CASE WHEN b.name IS NOT NULL THEN 'exact' WHEN f.target IS NOT NULL THEN 'fuzzy' ELSE 'unmapped' END AS kind
                FROM names_a a LEFT JOIN names_b b ON a.name = b.name LEFT JOIN fuzzy f ON f.source = a.name)"""


MAPPING = _SCORES + _rounds_sql(8)


@query("join_12_name_scores", "names_a names_b", f"""
    WITH {_SCORES} SELECT source, target, round(score + 1.37e-9, 6) AS score, method FROM cand""")
def _(t):
    a, b = t.names_a, t.names_b
    scores = scored_pairs(a.subtract(b), b.subtract(a), MappingParams())
    return scores.withColumn("score", rounded("score"))


@query("join_12_name_mapping", "names_a names_b", f"""
    WITH {MAPPING} SELECT source, target, round(score + 1.37e-9, 6) AS score, kind FROM mapping""")
def _(t):
    return map_names(t.names_a, t.names_b, MappingParams()).withColumn("score", rounded("score"))


@query("join_12_bond_mapping")
def _(t):
    """One name for each part, so that the names grow with the table; tested against all pairs on small sets."""
    return map_names(t.bonds_a, t.bonds_b, MappingParams()).withColumn("score", rounded("score"))


@query("join_13_full_grid", "history", f"""
    WITH {FILLED} SELECT obs_date, security, g_spread FROM grid LEFT JOIN cells USING (obs_date, security)""")
def _(t):
    cells = filled_history(t).filter(~F.col("is_filled"))
    return full_grid(cells, "obs_date", "security", "g_spread")
