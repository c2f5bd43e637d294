"""Marts: daily fact, weekly roll-up, latest value per asset, asset dimension."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelake.functions import as_of_date, pct_change, week_start
from pricelake.operators import features as ft

# The output columns of the marts, in order.
RETURNS_COLUMNS = [
    "asset_id", "price_date", "open_usd", "high_usd", "low_usd", "close_usd",
    "volume_usd", "market_cap_usd", "prev_close_usd", "daily_return_pct",
]
ROLLING_COLUMNS = RETURNS_COLUMNS + [
    "sma_7d", "sma_30d", "return_stddev_7d", "return_stddev_30d", "cummax_close",
    "annualised_volatility_30d",
]
FACT_COLUMNS = ROLLING_COLUMNS + ["drawdown_from_ath_pct", "price_vs_sma7_pct"]
WEEKLY_COLUMNS = [
    "asset_id", "week_start", "weekly_low", "weekly_high", "weekly_avg_close",
    "weekly_volume", "avg_market_cap", "weekly_return_stddev",
    "annualised_volatility_weekly", "avg_annualised_volatility_30d", "trading_days",
    "weekly_return_pct",
]
DIM_COLUMNS = [
    "asset_id", "name", "symbol", "category", "genesis_date", "days_since_genesis",
    "ath_usd", "ath_date", "latest_price_date", "latest_close_usd",
    "latest_market_cap_usd", "days_of_data", "metadata_fetched_at",
]


def daily_returns(staged: DataFrame) -> DataFrame:
    base = staged.select(*RETURNS_COLUMNS[:8])
    return ft.add_returns(base).select(*RETURNS_COLUMNS)


def rolling_metrics(staged: DataFrame, frame: str = "rows") -> DataFrame:
    df = ft.add_rolling(daily_returns(staged), frame=frame)
    return ft.add_annualised_vol(df).select(*ROLLING_COLUMNS)


def fact_daily(staged: DataFrame, frame: str = "rows", hot_rows: int | None = None,
               chunk_rows: int = 1_000_000, segment_days: int = 366) -> DataFrame:
    """One row per (asset, date) with all features (18 columns).

    Window features are partitioned by asset. With ``hot_rows`` set, assets
    holding more than ``hot_rows`` rows are split
    (``features.add_features_split``: chunks of ``chunk_rows`` with a halo),
    the rest stay one chunk; both give the same rows. Rows without an asset
    take the single-partition path.
    """
    if hot_rows is None:
        df = ft.add_deviation(ft.add_drawdown(rolling_metrics(staged, frame)))
        return df.select(*FACT_COLUMNS)
    if frame != "rows":
        raise ValueError("the split path supports row frames only")
    base = staged.select(*RETURNS_COLUMNS[:8])
    unkeyed = fact_daily(base.filter(F.col("asset_id").isNull()))
    split = ft.add_features_split(base.filter(F.col("asset_id").isNotNull()), hot_rows=int(hot_rows),
                                  chunk_rows=chunk_rows, segment_days=segment_days)
    split = ft.add_deviation(ft.add_drawdown(ft.add_annualised_vol(split)))
    return unkeyed.unionByName(split.select(*FACT_COLUMNS))


def weekly_rollup(fact: DataFrame, first_day: str = "sunday") -> DataFrame:
    """Per (asset, week): range, means, volume, return volatility, open/close.

    Open and close are the closes on the first and last date present in the
    week (dates are unique per asset after staging), so a single grouped
    aggregate does the work of an aggregate joined to its own bounds; on a
    fact clustered by asset it adds no exchange.
    """
    d = fact.select("asset_id", "price_date", "close_usd", "daily_return_pct", "volume_usd",
                    "market_cap_usd", "annualised_volatility_30d",
                    week_start("price_date", first_day).alias("week_start"))
    agg = d.groupBy("asset_id", "week_start").agg(
        F.min("close_usd").alias("weekly_low"),
        F.max("close_usd").alias("weekly_high"),
        F.avg("close_usd").alias("weekly_avg_close"),
        F.sum("volume_usd").alias("weekly_volume"),
        F.avg("market_cap_usd").alias("avg_market_cap"),
        F.stddev_samp("daily_return_pct").alias("weekly_return_stddev"),
        F.count(F.lit(1)).alias("trading_days"),
        F.avg("annualised_volatility_30d").alias("avg_annualised_volatility_30d"),
        F.min_by("close_usd", "price_date").alias("week_open"),
        F.max_by("close_usd", "price_date").alias("week_close"),
    )
    return (agg
            .withColumn("annualised_volatility_weekly",
                        F.col("weekly_return_stddev") * F.lit(math.sqrt(52)))
            .withColumn("weekly_return_pct", pct_change("week_close", "week_open"))
            .select(*WEEKLY_COLUMNS))


def weekly_open_close(fact: DataFrame, first_day: str = "sunday",
                      method: str = "agg") -> DataFrame:
    """Close on the first and last date present in each (asset, week).

    ``method="agg"``: ``min_by``/``max_by`` in one grouped aggregate.
    ``method="window"``: the first and last value of the date-ordered week."""
    d = fact.select("asset_id", "price_date", "close_usd",
                    week_start("price_date", first_day).alias("week_start"))
    if method == "window":
        week = Window.partitionBy("asset_id", "week_start").orderBy("price_date")
        whole = week.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        agg = d.select("asset_id", "week_start", F.first("close_usd").over(whole).alias("week_open"),
                       F.last("close_usd").over(whole).alias("week_close"),
                       F.row_number().over(week).alias("__n")).filter("__n = 1").drop("__n")
    else:
        agg = d.groupBy("asset_id", "week_start").agg(
            F.min_by("close_usd", "price_date").alias("week_open"),
            F.max_by("close_usd", "price_date").alias("week_close"))
    return agg.withColumn("weekly_return_pct", pct_change("week_close", "week_open"))


def latest_price(staged: DataFrame) -> DataFrame:
    """Latest date, close and cap at that date (a NULL cap stays NULL), day count
    (rows are unique by asset and date, so days are rows)."""
    return staged.groupBy("asset_id").agg(
        F.max("price_date").alias("latest_price_date"),
        F.max_by("close_usd", "price_date").alias("latest_close_usd"),
        F.max_by("market_cap_usd", "price_date").alias("latest_market_cap_usd"),
        F.count(F.lit(1)).alias("days_of_data"),
    )


def dim_assets(watchlist: DataFrame, metadata: DataFrame, latest: DataFrame, as_of) -> DataFrame:
    """Watchlist drives the rows; metadata and latest price are left-joined.

    No broadcast hint: the watchlist grows with the asset count, so Spark's
    size checks (planner stats, then AQE at runtime) pick the join.
    """
    w = watchlist.select("asset_id", F.col("name").alias("watchlist_name"),
                         F.col("symbol").alias("watchlist_symbol"), "category")
    m = metadata.select("asset_id", "name", "symbol", "genesis_date", "ath_usd", "ath_date",
                        "fetched_at")
    j = w.join(m, "asset_id", "left").join(latest, "asset_id", "left")
    return j.select(
        "asset_id",
        F.coalesce("name", "watchlist_name").alias("name"),
        F.coalesce("symbol", "watchlist_symbol").alias("symbol"),
        "category", "genesis_date",
        F.datediff(as_of_date(as_of), F.col("genesis_date")).alias("days_since_genesis"),
        "ath_usd", "ath_date", "latest_price_date", "latest_close_usd",
        "latest_market_cap_usd", "days_of_data",
        F.col("fetched_at").alias("metadata_fetched_at"),
    )
