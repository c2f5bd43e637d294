"""Data behind each dashboard chart, as lazy DataFrames.

Selections and lookbacks are pushed-down filters applied before anything is
computed; only the caller collects the (aggregated) result.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelake.functions import (
    as_of_date, fmt_billions, fmt_pct, fmt_price, month_text, staleness_class,
)
from pricelake.operators.ranking import total_rank
from pricelake.operators.staging import lookback, select_assets

DAILY_SERVING_COLUMNS = [
    "asset_id", "price_date", "open_usd", "high_usd", "low_usd", "close_usd", "volume_usd",
    "market_cap_usd", "daily_return_pct", "sma_7d", "sma_30d", "annualised_volatility_30d",
    "drawdown_from_ath_pct", "price_vs_sma7_pct",
]
WEEKLY_SERVING_COLUMNS = [
    "asset_id", "week_start", "weekly_return_pct", "weekly_return_stddev",
    "annualised_volatility_weekly", "avg_annualised_volatility_30d", "weekly_volume",
    "avg_market_cap", "trading_days",
]
DIM_SERVING_COLUMNS = [
    "asset_id", "name", "symbol", "category", "genesis_date", "days_since_genesis", "ath_usd",
    "ath_date", "latest_price_date", "latest_close_usd", "latest_market_cap_usd",
    "days_of_data",
]


def daily_prices(fact: DataFrame, as_of, days_back: int = 90) -> DataFrame:
    """Fact rows of the lookback window (PF-4), serving columns."""
    return lookback(fact, "price_date", as_of, days_back).select(*DAILY_SERVING_COLUMNS)


def weekly_volatility(weekly: DataFrame, as_of, days_back: int = 180) -> DataFrame:
    return lookback(weekly, "week_start", as_of, days_back).select(*WEEKLY_SERVING_COLUMNS)


def dim_ranked(dim: DataFrame, n: int | None = None) -> DataFrame:
    """Dimension by latest cap, largest first, missing caps last (top-n if given).

    With ``n`` Spark plans a distributed top-k (TakeOrderedAndProject)."""
    out = dim.select(*DIM_SERVING_COLUMNS).orderBy(
        F.col("latest_market_cap_usd").desc_nulls_last(), F.col("asset_id"))
    return out.limit(n) if n else out


def positions(ranked: DataFrame, by: str) -> DataFrame:
    """(position, asset_id) of a page's rows: largest ``by`` first, missing last,
    over any number of rows (``ranking.total_rank``)."""
    shown = ranked.select("asset_id", by)
    return total_rank(shown, [F.col(by).desc_nulls_last(), F.col("asset_id")]).select("position", "asset_id")


def pipeline_status(raw: DataFrame, as_of, recent_days: int = 7) -> DataFrame:
    """Per asset on raw (not deduplicated) rows: last fetch, row counts, date range."""
    recent = F.col("fetched_date") >= F.date_sub(as_of_date(as_of), recent_days)
    return raw.groupBy("asset_id").agg(
        F.max("fetched_date").alias("last_fetched_date"),
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(recent).cast("bigint").alias("rows_last_7d"),
        F.min("price_date").alias("earliest_date"),
        F.max("price_date").alias("latest_date"),
    )


def staleness(status: DataFrame, as_of) -> DataFrame:
    """One row: last ingest over all assets, total rows, days since, class."""
    g = status.agg(F.max("last_fetched_date").alias("last_ingest"),
                   F.sum("total_rows").cast("bigint").alias("total_raw_rows"))
    days = F.datediff(as_of_date(as_of), F.col("last_ingest"))
    return g.select("last_ingest", "total_raw_rows", days.alias("days_stale"),
                    staleness_class(days).alias("freshness"))


def latest_cards(daily: DataFrame, dim: DataFrame,
                 cols: Sequence[str] = ("price_date", "close_usd", "daily_return_pct",
                                        "market_cap_usd")) -> DataFrame:
    """Per asset, the last non-NULL value of each column by date (column by
    column, like a grouped ``last()`` after a date sort), joined to names."""
    aggs = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("price_date"))).alias(c)
            for c in cols]
    latest = daily.groupBy("asset_id").agg(*aggs)
    names = dim.select("asset_id", "name", "symbol")
    return latest.join(names, "asset_id", "left").orderBy(
        F.col("market_cap_usd").desc_nulls_last(), F.col("asset_id"))


def display_text(cards: DataFrame) -> DataFrame:
    """Card label and value texts."""
    return cards.select(
        "asset_id",
        F.upper(F.coalesce(F.col("symbol"), F.col("asset_id"))).alias("label"),
        fmt_price("close_usd").alias("price_text"),
        fmt_pct("daily_return_pct").alias("return_text"),
        fmt_billions("market_cap_usd").alias("market_cap_text"),
    )


def volume_series(daily: DataFrame, assets=None) -> DataFrame:
    """Non-NULL volumes per asset and day, with the day's stacked total.

    The total is a window over the day, so the daily rows are computed once; a
    day holds one row per asset."""
    v = select_assets(daily, assets).filter(F.col("volume_usd").isNotNull()) \
        .select("asset_id", "price_date", "volume_usd")
    return v.withColumn("day_total_volume", F.sum("volume_usd").over(Window.partitionBy("price_date")))


def vol_series(daily: DataFrame, assets=None) -> DataFrame:
    return (select_assets(daily, assets)
            .filter(F.col("annualised_volatility_30d").isNotNull())
            .select("asset_id", "price_date", "annualised_volatility_30d"))


def candle_frame(daily: DataFrame, asset: str | None = None) -> DataFrame:
    d = daily if asset is None else daily.filter(F.col("asset_id") == asset)
    return d.select("asset_id", "price_date", "open_usd", "high_usd", "low_usd", "close_usd",
                    "sma_7d", "sma_30d")


def drawdown_series(daily: DataFrame, asset: str | None = None) -> DataFrame:
    d = daily if asset is None else daily.filter(F.col("asset_id") == asset)
    return d.select("asset_id", "price_date", "drawdown_from_ath_pct")


def candle_availability(daily: DataFrame) -> DataFrame:
    """Whether an asset has any full o/h/l row (candles) and any SMA value."""
    full = F.col("open_usd").isNotNull() & F.col("high_usd").isNotNull() & \
        F.col("low_usd").isNotNull()
    return daily.groupBy("asset_id").agg(
        F.bool_or(full).alias("has_ohlc"),
        F.bool_or(F.col("sma_7d").isNotNull()).alias("has_sma_7d"),
        F.bool_or(F.col("sma_30d").isNotNull()).alias("has_sma_30d"))


def asset_list(daily: DataFrame) -> DataFrame:
    return daily.select("asset_id").distinct().orderBy("asset_id")


def return_histogram(daily: DataFrame, asset: str | None = None, bins: int = 60) -> DataFrame:
    """Counts of daily returns in ``bins`` equal-width bins per asset.

    Bounds are each asset's min and max, as windows over the rows the features
    already hold together by asset: the rows are computed once, without a join.
    The maximum falls in the last bin; empty bins are omitted."""
    d = daily if asset is None else daily.filter(F.col("asset_id") == asset)
    r = d.filter(F.col("daily_return_pct").isNotNull()).select("asset_id", "daily_return_pct")
    of = Window.partitionBy("asset_id")
    r = r.select("*", F.min("daily_return_pct").over(of).alias("lo"), F.max("daily_return_pct").over(of).alias("hi"))
    x, lo, hi = F.col("daily_return_pct"), F.col("lo"), F.col("hi")
    raw_bin = F.floor(F.try_divide((x - lo) * F.lit(float(bins)), hi - lo)) + 1
    b = F.least(F.coalesce(raw_bin, F.lit(1)), F.lit(bins)).cast("int")
    width = (hi - lo) / F.lit(float(bins))
    return (r.withColumn("bin", b)
            .groupBy("asset_id", "bin", "lo", "hi").agg(F.count(F.lit(1)).alias("n_days"))
            .select("asset_id", "bin",
                    (lo + (F.col("bin") - 1) * width).alias("bin_lo"),
                    (lo + F.col("bin") * width).alias("bin_hi"), "n_days"))


def vol_heatmap(weekly: DataFrame, assets=None) -> DataFrame:
    """Mean 30-day volatility per asset and calendar month of the week start."""
    w = select_assets(weekly, assets)
    return w.groupBy("asset_id", month_text("week_start").alias("month")).agg(
        F.avg("avg_annualised_volatility_30d").alias("avg_annualised_volatility_30d"))


def months_between_text(start: dt.date, end: dt.date) -> list[str]:
    out, y, m = [], start.year, start.month
    while (y, m) <= (end.year, end.month):
        out.append(f"{y:04d}-{m:02d}")
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


def vol_heatmap_wide(weekly: DataFrame, as_of: dt.date, days_back: int = 180) -> DataFrame:
    """Asset x month matrix; the month list is fixed by the window, not by the data."""
    months = months_between_text(as_of - dt.timedelta(days=days_back), as_of)
    long = vol_heatmap(weekly)
    return long.groupBy("asset_id").pivot("month", months).agg(
        F.first("avg_annualised_volatility_30d"))


def risk_return(weekly: DataFrame, dim: DataFrame) -> DataFrame:
    """Mean weekly return, weekly volatility and cap per asset, with its symbol."""
    g = weekly.groupBy("asset_id").agg(
        F.avg("weekly_return_pct").alias("weekly_return"),
        F.avg("annualised_volatility_weekly").alias("volatility"),
        F.avg("avg_market_cap").alias("market_cap"))
    return g.join(dim.select("asset_id", "symbol"), "asset_id", "left")
