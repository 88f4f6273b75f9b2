"""Explicit schemas of the feeds and of the derived tables."""

from __future__ import annotations

from pyspark.sql import types as T

from spreadlab.params import PORTFOLIO_FEED, UNIVERSE_FEED

_TYPES = {"s": T.StringType(), "d": T.DoubleType(), "t": T.DateType(), "ts": T.TimestampNTZType(),
          "l": T.LongType(), "b": T.BooleanType()}


def schema(**columns: str) -> T.StructType:
    """``schema(a="s", b="d")`` with s/d/t/ts/l/b as type letters."""
    return T.StructType([T.StructField(name, _TYPES[code]) for name, code in columns.items()])


def _typed(names, doubles, timestamps, dates=("Date",)):
    def pick(name):
        if name in dates:
            return T.DateType()
        if name in doubles:
            return T.DoubleType()
        if name in timestamps:
            return T.TimestampType()
        return T.StringType()

    return T.StructType([T.StructField(n, pick(n)) for n in names])


UNIVERSE = _typed(UNIVERSE_FEED.keep, UNIVERSE_FEED.doubles, UNIVERSE_FEED.timestamps)

PORTFOLIO = _typed(
    ("Date", "SECURITY", "CUSIP", "SECURITY TYPE", *PORTFOLIO_FEED.doubles,
     *PORTFOLIO_FEED.timestamps),
    PORTFOLIO_FEED.doubles, (), ("Date", *PORTFOLIO_FEED.timestamps))

QUOTES = _typed(
    ("Date", "Time", "CUSIP", "Dealer", "Security", "Keyword", "Bid Spread", "Ask Spread",
     "Bid Price", "Ask Price", "Bid Size", "Ask Size", "Bid Yield To Convention",
     "Ask Yield To Convention", "Bid Interpolated Spread to Government"),
    ("Bid Spread", "Ask Spread", "Bid Price", "Ask Price", "Bid Size", "Ask Size",
     "Bid Yield To Convention", "Ask Yield To Convention",
     "Bid Interpolated Spread to Government"), ())

SPREAD_HISTORY = schema(Date="t", Name="s", CUSIP="s", G_Spread_BVAL="d")

PAIR_STATS = schema(Security_1="s", CUSIP_1="s", Security_2="s", CUSIP_2="s", Last_Spread="d",
                    Z_Score="d", Max="d", Min="d", Last_vs_Max="d", Last_vs_Min="d",
                    Percentile="d")

UNMATCHED_ALL_DATES = schema(source_table="s", date="t", cusip_original="s",
                             cusip_standardized="s", security_name="s",
                             universe_match_attempted_date="t", source_file="s")
UNMATCHED_LAST_DATE = schema(source_table="s", cusip_original="s", cusip_standardized="s",
                             security_name="s", universe_match_attempted_date="t",
                             source_file="s")
QUALITY_LOG = schema(table_name="s", check_type="s", column_name="s", check_result="s",
                     check_value="d", checked_at="ts")
PROCESSING_LOG = schema(operation_id="s", table_name="s", update_type="s", reason="s",
                        processing_status="s", rows_stored="l", finished_at="ts")
