"""The run monitor: one row per current quote with changes and best levels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spreadlab.functions.scalars import quoted
from spreadlab.operators.quotes import QuoteColumns, best_levels, quotes_with_changes
from spreadlab.params import MonitorParams
from spreadlab.session import staged

COLUMN_ORDER = (
    "Security", "Bid Spread", "Ask Spread", "Bid Size", "Ask Size",
    "DoD", "WoW", "MTD", "QTD", "YTD", "1YR",
    "DoD Chg Bid Size", "DoD Chg Ask Size", "MTD Chg Bid Size", "MTD Chg Ask Size",
    "Best Bid", "Best Offer", "Bid/Offer", "Dealer @ Best Bid", "Dealer @ Best Offer",
    "Size @ Best Bid", "Size @ Best Offer", "CUSIP", "Dealer", "G Spread", "Keyword",
)
NUMERIC = set(COLUMN_ORDER[1:18]) | {"Size @ Best Bid", "Size @ Best Offer", "G Spread"}


def run_monitor(quotes: DataFrame, cols: QuoteColumns, params: MonitorParams = MonitorParams(),
                rename: dict[str, str] | None = None) -> DataFrame:
    """Report in its fixed column order, sorted by the daily change."""
    # quotes of one day; read for the best levels and for the report
    current = staged(quotes_with_changes(quotes, cols, params), "current-quotes")
    report = current.join(best_levels(current, cols, params), cols.cusip, "left")
    names = {cols.cusip: "CUSIP", cols.dealer: "Dealer", cols.bid: "Bid Spread", cols.ask: "Ask Spread",
             cols.bid_size: "Bid Size", cols.ask_size: "Ask Size", **(rename or {})}
    report = report.withColumnsRenamed(names)
    return sorted_report(in_report_order(report))


def in_report_order(report: DataFrame) -> DataFrame:
    """The report's columns in order, absent ones as NULL."""
    present = set(report.columns)
    missing = lambda c: F.lit(None).cast("double" if c in NUMERIC else "string").alias(c)
    return report.select(*[quoted(c) if c in present else missing(c) for c in COLUMN_ORDER])


def sorted_report(report: DataFrame) -> DataFrame:
    return report.orderBy(F.col("DoD").asc_nulls_last(), "CUSIP", "Dealer")
