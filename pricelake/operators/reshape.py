"""Wide/long reshapes of the close series: pivot, melt, rebased index.

A pivot needs an explicit, bounded column list (the selected assets); without
one Spark would first collect every distinct asset to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def pivot_close(daily: DataFrame, assets: Sequence[str], value: str = "close_usd") -> DataFrame:
    """date x asset matrix of ``value``; (asset, date) is unique after staging,
    so each cell has at most one value (``max`` only picks it)."""
    assets = list(assets)
    return (daily.filter(F.col("asset_id").isin(assets))
            .groupBy("price_date").pivot("asset_id", assets).agg(F.max(value)))


def unpivot_close(wide: DataFrame, value: str = "close_usd") -> DataFrame:
    """Melt back to (price_date, asset_id, value); empty cells become NULL rows."""
    cols = [c for c in wide.columns if c != "price_date"]
    return wide.unpivot("price_date", cols, "asset_id", value)


def rebased_index(daily: DataFrame, assets: Sequence[str], value: str = "close_usd",
                  dense: bool = True) -> DataFrame:
    """value / value on the window's first date * 100, per asset.

    The first date is global (the earliest date of any selected asset); an
    asset without a row on it is NULL throughout. The daily rows are computed
    once: pivoted they are one row per calendar day, whose first row is every
    asset's base. ``dense`` keeps the full date x asset grid (NULL where a day
    is missing).
    """
    assets = list(assets)
    wide = pivot_close(daily, assets, value)
    days = Window.orderBy("price_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    index = [(F.try_divide(F.col(f"`{a}`"), F.first(F.col(f"`{a}`")).over(days)) * F.lit(100.0)).alias(a) for a in assets]
    out = unpivot_close(wide.select("price_date", *index), "index_value")
    if not dense:
        there = unpivot_close(wide, value).filter(F.col(value).isNotNull()).select("price_date", "asset_id")
        out = out.join(there, ["price_date", "asset_id"], "left_semi")
    return out
