"""Parameters of the jobs, with the defaults the analytics were defined with."""

from __future__ import annotations

from dataclasses import dataclass, field

INF = float("inf")


@dataclass(frozen=True)
class Bins:
    """Half-open bins ``[edges[i], edges[i+1])`` with one label each."""

    source: str
    target: str
    edges: tuple[float, ...]
    labels: tuple[str, ...]

    def __post_init__(self):
        if len(self.labels) != len(self.edges) - 1:
            raise ValueError("one label per bin")


# Bin edges and labels of the two maturity features.
ISSUE_AGE_BINS = Bins(
    "Yrs Since Issue", "Yrs Since Issue Bucket",
    (0, 0.25, 0.50, 1, 2, 3, 5, 7, INF),
    ("0-0.25", "0.25-0.50", "0.50-1", "1-2", "2-3", "3-5", "5-7", ">7"),
)
MATURITY_BINS = Bins(
    "Yrs (Mat)", "Yrs (Mat) Bucket",
    (0, 0.25, 0.50, 1, 2.1, 3.1, 4.1, 5.1, 7.1, 10.1, 25.1, INF),
    ("0-0.25", "0.25-0.50", "0.50-1", "1-2.1", "2.1-3.1", "3.1-4.1", "4.1-5.1",
     "5.1-7.1", "7.1-10.1", "10.1-25.1", ">25.1"),
)


@dataclass(frozen=True)
class OutlierRule:
    """Values beyond ``drop_beyond`` become NULL, the rest is clamped."""

    clamp: float = 1000.0
    drop_beyond: float = 10000.0


@dataclass(frozen=True)
class IdentifierOverride:
    """Fixed identifier (and name) for rows where ``column`` equals ``equals``."""

    column: str
    equals: str
    identifier: str
    name: str | None = None


# Identifiers of index and cash positions.
PORTFOLIO_OVERRIDES = (
    IdentifierOverride("SECURITY TYPE", "CDX", "460", "CDX"),
    IdentifierOverride("SECURITY", "CASH CAD", "123"),
    IdentifierOverride("SECURITY", "CASH USD", "789"),
)


@dataclass(frozen=True)
class PairParams:
    """All-pairs spread statistics.

    ``max_series`` is the top-n step, off by default.
    """

    max_series: int | None = None
    lookback_rows: int = 252
    history_days: int = 252
    min_observations: int = 200
    min_coverage: float = 0.7
    recency_days: int = 30
    fill_limit: int = 5
    min_date_coverage: float = 0.7
    date_step: int = 1


@dataclass(frozen=True)
class MonitorParams:
    """Period changes and best levels of dealer quotes."""

    min_size: float = 2_000_000
    offer_side: str = "min"
    periods: tuple[str, ...] = ("DoD", "WoW", "MTD", "QTD", "YTD", "1YR")
    size_periods: tuple[str, ...] = ("DoD", "MTD")


@dataclass(frozen=True)
class MappingParams:
    """Fuzzy name mapping."""

    threshold: float = 85.0
    bands: tuple[float, ...] = (96.0, 91.0)  # scores above the threshold at which the assignment is settled in between
    methods: tuple[str, ...] = ("ratio", "partial_ratio", "token_sort_ratio")


@dataclass(frozen=True)
class QualityParams:
    """Thresholds of the data-quality checks."""

    null_warning_pct: float = 50.0
    max_missing_pct: float = 95.0
    date_valid_share: float = 0.8
    date_invalid_share: float = 0.5
    date_formats: tuple[str, ...] = ("MM/dd/yyyy", "yyyy-MM-dd", "dd/MM/yyyy")
    name_hints: tuple[str, ...] = ("Date", "DATE", "date")


@dataclass(frozen=True)
class FeedParams:
    """Keep, drop and conversion lists of one feed."""

    keep: tuple[str, ...] = ()
    drop: tuple[str, ...] = ()
    doubles: tuple[str, ...] = ()
    timestamps: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    bins: tuple[Bins, ...] = field(default_factory=tuple)
    pivot: int = 69              # two-digit years below it are of this century


# Column lists of the universe feed.
UNIVERSE_FEED = FeedParams(
    keep=(
        "Date", "CUSIP", "Benchmark Cusip", "Custom_Sector", "Marketing Sector", "Notes",
        "Bloomberg Cusip", "Security", "Benchmark", "Make_Whole", "Back End", "Floating Index",
        "Stochastic Duration", "Stochastic Convexity", "Pricing Date", "Pricing Date (Bench)",
        "MTD Return", "QTD Return", "YTD Return", "MTD Bench Return", "QTD Bench Return",
        "YTD Bench Return", "Worst Date", "Yrs (Worst)", "YTC", "Excess MTD", "Excess YTD",
        "CPN TYPE", "Ticker", "G Sprd", "Yrs (Cvn)", "OAS (Mid)", "Currency", "CAD Equiv Swap",
        "G (RBC Crv)", "vs BI", "vs BCE", "Equity Ticker", "YTD Equity", "MTD Equity",
        "Yrs Since Issue", "Risk", "Rating", "Yrs (Mat)", "Z Spread",
        "Yrs Since Issue Bucket", "Yrs (Mat) Bucket",
    ),
    doubles=(
        "Make_Whole", "Back End", "Stochastic Duration", "Stochastic Convexity", "MTD Return",
        "QTD Return", "YTD Return", "MTD Bench Return", "QTD Bench Return", "YTD Bench Return",
        "Yrs (Worst)", "YTC", "Excess MTD", "Excess YTD", "G Sprd", "Yrs (Cvn)", "OAS (Mid)",
        "CAD Equiv Swap", "G (RBC Crv)", "vs BI", "vs BCE", "YTD Equity", "MTD Equity",
        "Yrs Since Issue", "Yrs (Mat)", "Z Spread",
    ),
    timestamps=("Pricing Date", "Pricing Date (Bench)", "Worst Date"),
    required=("CUSIP",),
    bins=(ISSUE_AGE_BINS, MATURITY_BINS),
)

# Column lists of the portfolio feed.
PORTFOLIO_FEED = FeedParams(
    pivot=50,
    drop=(
        "BBG YIELD SPREAD", "CURRENT YIELD", "BBG 1D CHANGE", "CHANGE", "CHANGE PCT",
        "CHANGE BPS NAV", "INDUSTRY", "SECTOR", "OWNER", "DAY PROFIT", "AVERAGE PRICE", "PROFIT",
        "REALIZED", "UNREALIZED", "TOTAL COST SETTLE CCY", "TOTAL COST", "COST PCT NAV",
        "INTEREST", "REALIZED SETTLE CCY", "PAID INTEREST LOCAL CCY", "PAID INTEREST",
        "UNREALIZED SETTLE CCY", "FX EXPOSURE LOCAL CCY", "FX EXPOSURE DISPLAY CCY",
        "FX EXPOSURE PCT NAV", "PREVIOUS PROFIT", "PREVIOUS DAY PRICE", "ACCRUED INTEREST",
        "ANNUALIZED INCOME", "BBG MTD YIELD CHANGE", "Unnamed: 0", "Unnamed: 1",
    ),
    doubles=(
        "MODIFIED DURATION", "QUANTITY", "PRICE", "YIELD TO MAT", "POSITION CR01",
        "VALUE PCT NAV", "POSITION PVBP", "VALUE", "COUPON", "SECURITY PVBP", "SECURITY CR01",
        "PCT OF OUTSTANDING", "FACE VALUE OUTSTANDING",
    ),
    timestamps=("MATURITY DATE", "BENCHMARK MATURITY DATE"),
    required=("SECURITY",),
)

# Column rules of the dealer-quote feed.
QUOTE_KEY = ("Date", "CUSIP", "Dealer")
QUOTE_NON_NEGATIVE = ("Bid Price", "Ask Price", "Bid Size", "Ask Size")
QUOTE_NOT_NULL = ("Date", "CUSIP", "Dealer", "Bid Spread")
QUOTE_WIDE_KEY = (
    "Date", "Time", "Dealer", "Security", "Bid Price", "Ask Price", "Bid Size", "Ask Size",
    "Bid Yield To Convention", "Ask Yield To Convention",
)
QUOTE_DATE_FORMATS = ("MM/dd/yy", "yyyy-MM-dd", "MM/dd/yyyy", "dd/MM/yyyy")

# Roll-up rule of the monitor table per identifier.
MONITOR_ROLLUP = {
    "mean": ("Bid Spread", "Ask Spread", "DoD", "WoW", "MTD", "QTD", "YTD", "1YR",
             "DoD Chg Bid Size", "DoD Chg Ask Size", "MTD Chg Bid Size", "MTD Chg Ask Size",
             "Best Bid", "Best Offer", "Bid/Offer", "G Spread"),
    "sum": ("Bid Size", "Ask Size", "Size @ Best Bid", "Size @ Best Offer"),
    "first": ("Dealer @ Best Bid", "Dealer @ Best Offer", "Keyword"),
}
