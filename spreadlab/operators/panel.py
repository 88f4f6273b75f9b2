"""The date × security panel, kept long: one row per non-empty cell."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spreadlab.functions.scalars import quoted
from spreadlab.operators.dedup import rank_key
from spreadlab.operators.snapshots import calendar, latest_date
from spreadlab.params import PairParams


def series_metrics(df: DataFrame, date: str, security: str, value: str) -> DataFrame:
    """Observation count, first and last date, non-NULL count and volatility."""
    return df.groupBy(quoted(security)).agg(
        F.count(quoted(date)).alias("total_obs"),
        F.min(quoted(date)).alias("first_date"),
        F.max(quoted(date)).alias("last_date"),
        F.count(quoted(value)).alias("value_count"),
        F.stddev_samp(quoted(value)).alias("volatility"))


def eligible_series(metrics: DataFrame, latest, params: PairParams) -> DataFrame:
    """Series with enough history, observations, coverage and recent data."""
    return metrics.filter(
        (F.col("first_date") <= F.date_sub(latest, params.history_days))
        & (F.col("total_obs") >= params.min_observations)
        & (F.col("last_date") >= F.date_sub(latest, params.recency_days))
        & (F.col("value_count") / F.col("total_obs") >= params.min_coverage))


def top_series(metrics: DataFrame, security: str, n: int | None) -> DataFrame:
    """The ``n`` series with the best score, ties by name (distributed top-n); all of them without ``n``."""
    if n is None:
        return metrics
    # observations times their coverage, which is the number of values
    return (metrics.withColumn("score", F.col("value_count").cast("double"))
            .orderBy(F.col("score").desc(), quoted(security)).limit(n))


def liquid_series(df: DataFrame, date: str, security: str, value: str, params: PairParams) -> DataFrame:
    metrics = series_metrics(df, date, security, value)
    return top_series(eligible_series(metrics, latest_date(df, date), params), security, params.max_series)


def last_per_cell(df: DataFrame, date: str, security: str, value: str, order: Sequence[str],
                  carried: Sequence[str] = ()) -> DataFrame:
    """Last non-NULL value per date and security, pre-aggregated per task; of equally late values the greatest."""
    last = F.max_by(F.struct(*[quoted(c) for c in (value, *carried)]), rank_key(order, value, *carried))
    return (df.filter(quoted(value).isNotNull())
            .groupBy(quoted(date), quoted(security)).agg(last.alias("_last"))
            .select(quoted(date), quoted(security), "_last.*"))


def forward_filled(cells: DataFrame, date: str, security: str, value: str, limit: int,
                   carried: Sequence[str] = ()) -> DataFrame:
    """Fill gaps of a series on the date grid, at most ``limit`` grid rows.

    Instead of building every date × security cell, each observation is
    repeated up to the grid position before the next one, so the result (and
    the work) holds non-empty cells only.  ``cells`` is read for the calendar
    and for the values: stage it when it is expensive.
    """
    days = cells.agg(F.sort_array(F.collect_set(quoted(date)))).scalar()
    window = Window.partitionBy(quoted(security)).orderBy("position")
    until = F.least(F.lead("position").over(window) - 1, F.col("position") + limit, F.size(days) - 1)
    kept = [quoted(c) for c in (security, value, *carried)]
    spread = (cells.join(calendar(cells, date), date).withColumn("_until", until)
              .select(*kept, F.col("position").alias("_from"),
                      F.explode(F.sequence("position", "_until")).alias("position")))
    return spread.select(F.get(days, F.col("position")).alias(date), *kept,
                         (F.col("position") > F.col("_from")).alias("is_filled"))


def full_grid(cells: DataFrame, date: str, security: str, value: str) -> DataFrame:
    """Every date × every security, NULL where there is no value.

    The grid is the calendar (one array of days) unfolded per security.
    """
    days = cells.agg(F.sort_array(F.collect_set(quoted(date)))).scalar()
    grid = (cells.select(quoted(security)).distinct()
            .select(quoted(security), F.explode(days).alias(date)))
    return grid.join(cells.select(quoted(date), quoted(security), quoted(value)), [date, security], "left")


def forward_filled_grid(cells: DataFrame, date: str, security: str, value: str, limit: int) -> DataFrame:
    """Every cell of the grid after the limited fill, empty ones as NULL."""
    days = cells.agg(F.sort_array(F.collect_set(quoted(date)))).scalar()
    grid = (cells.select(quoted(security)).distinct()
            .select(quoted(security), F.explode(days).alias(date)))
    filled = forward_filled(cells, date, security, value, limit)
    return grid.join(filled.select(quoted(date), quoted(security), quoted(value)), [date, security], "left")


def dense_dates(filled: DataFrame, date: str, n_series, min_share: float) -> DataFrame:
    """Dates on which at least the given share of the series has a value."""
    return (filled.groupBy(quoted(date)).agg(F.count(F.lit(1)).alias("n_values"))
            .filter(F.col("n_values") >= F.lit(min_share) * n_series))


def first_dates(cells: DataFrame, date: str, security: str) -> DataFrame:
    return cells.groupBy(quoted(security)).agg(F.min(quoted(date)).alias("first_date"))
