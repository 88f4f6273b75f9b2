"""Adapter views: the market-data tables expressed over the driver's tables.

Each view exists twice, as a DataFrame (:class:`Tables`) and as SQL text
(``SQL_VIEWS``) for the independent check; both read whole tables.  Missing
values are derived from ordinary columns because the driver's tables have none.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PANEL_ORDER = ("l_orderkey", "l_linenumber", "l_extendedprice")

SQL_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    # name: (views it needs, body)
    "panel_raw": ((), """
        SELECT CAST(date_trunc('week', l_shipdate) AS DATE) AS obs_date, p_brand AS security,
               CAST(l_suppkey AS VARCHAR) AS cusip, l_extendedprice AS g_spread,
               l_orderkey, l_linenumber, l_extendedprice
        FROM lineitem JOIN part ON l_partkey = p_partkey"""),
    "panel": (("panel_raw",), """
        SELECT obs_date, security, max(g_spread) AS g_spread FROM panel_raw GROUP BY 1, 2"""),
    "history": ((), """
        SELECT CAST(date_trunc('week', l_shipdate) AS DATE) AS obs_date, s_name AS security,
               CAST(l_suppkey AS VARCHAR) AS cusip,
               CASE WHEN l_linenumber = 7 THEN NULL ELSE l_extendedprice END AS g_spread,
               l_orderkey, l_linenumber, l_extendedprice
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"""),
    "quotes": ((), """
        SELECT event_id, ts, CAST(ts AS DATE) AS quote_date, strftime(ts, '%H:%M') AS quote_time,
               user_id AS cusip, 'Bond ' || user_id AS security, event_type AS dealer,
               CASE WHEN k % 10 = 0 THEN NULL ELSE value END AS bid_spread,
               CASE WHEN k % 10 = 1 THEN NULL ELSE value * 0.98 END AS ask_spread,
               value - 5 AS bid_price,
               CASE WHEN k % 10 = 2 THEN NULL ELSE value - 4 END AS ask_price,
               k AS bid_size, 99 - k AS ask_size
        FROM (SELECT *, CAST(json_extract(props, '$.k') AS INT) AS k FROM events)"""),
    "month_quotes": ((), """
        SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS quote_date, l_suppkey AS cusip,
               l_returnflag AS dealer, max(l_extendedprice) AS bid_spread,
               min(l_extendedprice) AS ask_spread, max(l_quantity) AS bid_size,
               min(l_quantity) AS ask_size
        FROM lineitem GROUP BY 1, 2, 3"""),
    "universe_dim": ((), """
        SELECT p_partkey AS cusip, p_name AS security, p_brand AS ticker, p_type AS sector,
               CAST(p_size AS DOUBLE) AS yrs_mat, p_size / 8.0 AS yrs_issue,
               p_retailprice AS g_sprd
        FROM part WHERE p_size <= 40"""),
    "universe": (("universe_dim",), """
        SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS uni_date, u.*
        FROM lineitem JOIN universe_dim u ON l_partkey = u.cusip"""),
    "positions": ((), """
        SELECT o_orderkey AS pos_id, CAST(o_orderdate AS DATE) AS pos_date, o_custkey AS cusip,
               o_orderstatus AS status, o_orderpriority AS sec_type, o_totalprice AS value,
               CASE WHEN o_orderstatus = 'F' THEN -o_totalprice ELSE o_totalprice END AS quantity
        FROM orders"""),
    "messy": ((), """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
               CASE WHEN l_linenumber = 3 THEN NULL ELSE l_discount END AS discount,
               CASE WHEN l_linenumber = 5 THEN 'n/a'
                    ELSE CAST(CAST(l_tax AS DECIMAL(4,2)) AS VARCHAR) END AS tax_text,
               CASE WHEN l_returnflag <> 'A' THEN NULL ELSE l_linestatus END AS mark,
               l_returnflag, CAST(l_shipdate AS DATE) AS ship_date
        FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_linestatus = 'O' AND l_linenumber = 1)"""),
    "identifiers": ((), """
        SELECT p_partkey AS row_id,
               CASE p_size % 9
                 WHEN 0 THEN '' WHEN 1 THEN lpad(CAST(p_partkey AS VARCHAR), 8, '0')
                 WHEN 2 THEN lpad(CAST(p_partkey AS VARCHAR), 9, '0')
                 WHEN 3 THEN lpad(CAST(p_partkey AS VARCHAR), 6, '1')
                 WHEN 4 THEN right(lpad(CAST(p_partkey AS VARCHAR), 3, '0'), 3)
                 WHEN 5 THEN 'Cash ' || left(p_name, 3)
                 WHEN 6 THEN '  ' || left(p_name, 2) || lpad(CAST(p_partkey AS VARCHAR), 6, '0') || ' '
                 WHEN 7 THEN 'INVALID!@' || p_size END AS cusip
        FROM part"""),
    "names_a": ((), "SELECT DISTINCT p_name AS name FROM part"),
    "names_b": ((), """
        SELECT DISTINCT CASE length(p_name) % 4
                 WHEN 0 THEN p_name
                 WHEN 1 THEN split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 1)
                 WHEN 2 THEN left(p_name, 3) || substr(p_name, 5)
                 ELSE p_name || ' ' || left(p_name, 2) END AS name
        FROM part"""),
}


def sql(views: str, body: str) -> str:
    """SQL text with the CTEs of ``views`` (and what they need) in front."""
    needed: list[str] = []

    def add(name):
        for parent in SQL_VIEWS[name][0]:
            add(parent)
        if name not in needed:
            needed.append(name)

    for name in views.split():
        add(name)
    body = body.strip()
    if not needed:
        return body
    head = ", ".join(f"{n} AS ({SQL_VIEWS[n][1]})" for n in needed)
    if body.upper().startswith("WITH "):
        return f"WITH {head}, {body[5:]}"
    return f"WITH {head} {body}"


class Tables:
    """The adapter views of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def panel_raw(self) -> DataFrame:
        part = self.table("part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("security"))
        return self.table("lineitem").join(part, "l_partkey").select(
            F.date_trunc("week", "l_shipdate").cast("date").alias("obs_date"), "security",
            F.col("l_suppkey").cast("string").alias("cusip"),
            F.col("l_extendedprice").alias("g_spread"), *PANEL_ORDER)

    @cached_property
    def panel(self) -> DataFrame:
        return self.panel_raw.groupBy("obs_date", "security").agg(F.max("g_spread").alias("g_spread"))

    @cached_property
    def history(self) -> DataFrame:
        supplier = self.table("supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("security"))
        return self.table("lineitem").join(supplier, "l_suppkey").select(
            F.date_trunc("week", "l_shipdate").cast("date").alias("obs_date"), "security",
            F.col("l_suppkey").cast("string").alias("cusip"),
            F.when(F.col("l_linenumber") != 7, F.col("l_extendedprice")).alias("g_spread"),
            *PANEL_ORDER)

    @cached_property
    def quotes(self) -> DataFrame:
        k = F.get_json_object("props", "$.k").cast("int")
        events = self.table("events").withColumn("k", k)
        return events.select(
            "event_id", "ts", F.to_date("ts").alias("quote_date"),
            F.date_format("ts", "HH:mm").alias("quote_time"), F.col("user_id").alias("cusip"),
            F.concat(F.lit("Bond "), F.col("user_id").cast("string")).alias("security"),
            F.col("event_type").alias("dealer"),
            F.when(F.col("k") % 10 != 0, F.col("value")).alias("bid_spread"),
            F.when(F.col("k") % 10 != 1, F.col("value") * 0.98).alias("ask_spread"),
            (F.col("value") - 5).alias("bid_price"),
            F.when(F.col("k") % 10 != 2, F.col("value") - 4).alias("ask_price"),
            F.col("k").alias("bid_size"), (F.lit(99) - F.col("k")).alias("ask_size"))

    @cached_property
    def month_quotes(self) -> DataFrame:
        return (self.table("lineitem")
                .groupBy(F.trunc("l_shipdate", "MM").alias("quote_date"),
                         F.col("l_suppkey").alias("cusip"), F.col("l_returnflag").alias("dealer"))
                .agg(F.max("l_extendedprice").alias("bid_spread"),
                     F.min("l_extendedprice").alias("ask_spread"),
                     F.max("l_quantity").alias("bid_size"), F.min("l_quantity").alias("ask_size")))

    @cached_property
    def universe_dim(self) -> DataFrame:
        """The tradable universe: parts up to size 40, so that orphans exist."""
        return self.table("part").filter(F.col("p_size") <= 40).select(
            F.col("p_partkey").alias("cusip"), F.col("p_name").alias("security"),
            F.col("p_brand").alias("ticker"), F.col("p_type").alias("sector"),
            F.col("p_size").cast("double").alias("yrs_mat"), (F.col("p_size") / 8.0).alias("yrs_issue"),
            F.col("p_retailprice").alias("g_sprd"))

    @cached_property
    def universe(self) -> DataFrame:
        """Dated universe: members that traded in a month."""
        months = self.table("lineitem").select(
            F.trunc("l_shipdate", "MM").alias("uni_date"), F.col("l_partkey").alias("cusip")).distinct()
        return months.join(self.universe_dim, "cusip").select("uni_date", *self.universe_dim.columns)

    @cached_property
    def positions(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("pos_id"), F.to_date("o_orderdate").alias("pos_date"),
            F.col("o_custkey").alias("cusip"), F.col("o_orderstatus").alias("status"),
            F.col("o_orderpriority").alias("sec_type"), F.col("o_totalprice").alias("value"),
            F.when(F.col("o_orderstatus") == "F", -F.col("o_totalprice"))
            .otherwise(F.col("o_totalprice")).alias("quantity"))

    @cached_property
    def messy(self) -> DataFrame:
        """Line items with derived NULLs, text numbers and repeated rows."""
        lines = self.table("lineitem")
        again = lines.filter((F.col("l_linestatus") == "O") & (F.col("l_linenumber") == 1))
        return lines.unionByName(again).select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            F.when(F.col("l_linenumber") != 3, F.col("l_discount")).alias("discount"),
            F.when(F.col("l_linenumber") == 5, "n/a")
            .otherwise(F.col("l_tax").cast("decimal(4,2)").cast("string")).alias("tax_text"),
            F.when(F.col("l_returnflag") == "A", F.col("l_linestatus")).alias("mark"),
            "l_returnflag", F.to_date("l_shipdate").alias("ship_date"))

    @cached_property
    def identifiers(self) -> DataFrame:
        """Identifier texts of every kind, one per part."""
        key = F.col("p_partkey").cast("string")
        kinds = {0: F.lit(""), 1: F.lpad(key, 8, "0"), 2: F.lpad(key, 9, "0"), 3: F.lpad(key, 6, "1"),
                 4: F.right(F.lpad(key, 3, "0"), F.lit(3)),
                 5: F.concat(F.lit("Cash "), F.left(F.col("p_name"), F.lit(3))),
                 6: F.concat(F.lit("  "), F.left(F.col("p_name"), F.lit(2)), F.lpad(key, 6, "0"), F.lit(" ")),
                 7: F.concat(F.lit("INVALID!@"), F.col("p_size").cast("string"))}
        text = F.lit(None).cast("string")
        for kind, form in kinds.items():
            text = F.when(F.col("p_size") % 9 == kind, form).otherwise(text)
        return self.table("part").select(F.col("p_partkey").alias("row_id"), text.alias("cusip"))

    @cached_property
    def names_a(self) -> DataFrame:
        return self.table("part").select(F.col("p_name").alias("name")).distinct()

    @staticmethod
    def altered_name():
        """A part name as another vendor would spell it."""
        name = F.col("p_name")
        kind = F.length(name) % 4
        swapped = F.concat_ws(" ", F.split_part(name, F.lit(" "), F.lit(2)), F.split_part(name, F.lit(" "), F.lit(1)))
        return (F.when(kind == 0, name).when(kind == 1, swapped)
                .when(kind == 2, F.concat(F.left(name, F.lit(3)), F.substring(name, 5, 1000)))
                .otherwise(F.concat(name, F.lit(" "), F.left(name, F.lit(2)))))

    @staticmethod
    def bond_name():
        """A name like those of bonds for each part: issuer, coupon and maturity."""
        key = F.col("p_partkey")
        return F.concat_ws(" ", F.upper("p_name"), (key * 37 % 8000).cast("string"),
                           F.concat_ws("/", F.col("p_size").cast("string"), (key * 7 % 31 + 2025).cast("string")))

    @cached_property
    def bonds_a(self) -> DataFrame:
        return self.table("part").select(self.bond_name().alias("name")).distinct()

    @cached_property
    def bonds_b(self) -> DataFrame:
        """The same bonds as another vendor would spell them: alike, with the maturity first, a letter less, a note, a letter twice."""
        name, kind = F.col("name"), F.col("p_partkey") % 5
        first = F.concat_ws(" ", F.regexp_extract(name, r"(\S+)$", 1), F.regexp_extract(name, r"^(.*) \S+$", 1))
        spelled = (F.when(kind == 0, name).when(kind == 1, first)
                   .when(kind == 2, F.concat(F.left(name, F.lit(3)), F.substring(name, 5, 1000)))
                   .when(kind == 3, F.concat(name, F.lit(" 144A")))
                   .otherwise(F.concat(F.left(name, F.lit(6)), F.substring(name, 6, 1000))))
        return self.table("part").withColumn("name", self.bond_name()).select(spelled.alias("name")).distinct()

    @cached_property
    def names_b(self) -> DataFrame:
        return self.table("part").select(self.altered_name().alias("name")).distinct()
