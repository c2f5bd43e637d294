"""Per-series window features: returns, moving averages, volatility, drawdown.

Every frame counts rows, not days (a gap in the dates does not shorten a
frame), and every frame is partitioned by the series key only, so all the
features of one series share one exchange and one sort.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelake.functions import pct_change


def series_window(key: str | Sequence[str], order: str):
    keys = [key] if isinstance(key, str) else list(key)
    return Window.partitionBy(*keys).orderBy(order)


def _frame(w, n: int, frame: str, order: str):
    if frame == "rows":
        return w.rowsBetween(-(n - 1), Window.currentRow)
    if frame == "days":
        # calendar-day variant: the order column must be a day number
        return w.rangeBetween(-(n - 1), Window.currentRow)
    raise ValueError(f"unknown frame {frame!r}")


def add_returns(df: DataFrame, key="asset_id", order="price_date", value="close_usd",
                prev="prev_close_usd", ret="daily_return_pct") -> DataFrame:
    """Previous value (lag 1) and percent change; NULL on a series' first row."""
    w = series_window(key, order)
    return (df.withColumn(prev, F.lag(value).over(w))
            .withColumn(ret, pct_change(value, prev)))


def add_rolling(df: DataFrame, key="asset_id", order="price_date", value="close_usd",
                ret="daily_return_pct", windows: Sequence[int] = (7, 30),
                frame: str = "rows", cummax="cummax_close") -> DataFrame:
    """SMA and sample stddev of returns over trailing frames, plus running max.

    Frames shorter than ``n`` rows still yield a value; stddev needs two
    non-NULL returns. ``frame="days"`` switches to calendar-day frames.
    """
    w = series_window(key, order)
    if frame == "days":
        day = F.unix_date(F.col(order))
        keys = [key] if isinstance(key, str) else list(key)
        w = Window.partitionBy(*keys).orderBy(day)
    cols = [F.avg(value).over(_frame(w, n, frame, order)).alias(f"sma_{n}d") for n in windows]
    cols += [F.stddev_samp(ret).over(_frame(w, n, frame, order)).alias(f"return_stddev_{n}d")
             for n in windows]
    cols.append(F.max(value).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
                .alias(cummax))
    return df.select("*", *cols)


def add_annualised_vol(df: DataFrame, col="return_stddev_30d", periods: int = 365,
                       out="annualised_volatility_30d") -> DataFrame:
    return df.withColumn(out, F.col(col) * F.lit(math.sqrt(periods)))


def add_drawdown(df: DataFrame, value="close_usd", cummax="cummax_close",
                 out="drawdown_from_ath_pct") -> DataFrame:
    """Percent below the running maximum (always <= 0)."""
    return df.withColumn(out, pct_change(value, cummax))


def add_deviation(df: DataFrame, value="close_usd", base="sma_7d",
                  out="price_vs_sma7_pct") -> DataFrame:
    return df.withColumn(out, pct_change(value, base))


#: The segment of rows without a date (they sort before all others).
NO_DATE = -(1 << 40)


def add_features_split(df: DataFrame, key: str = "asset_id", order: str = "price_date",
                       value: str = "close_usd", prev: str = "prev_close_usd",
                       ret: str = "daily_return_pct", windows: Sequence[int] = (7, 30),
                       chunk_rows: int = 1_000_000, segment_days: int = 366,
                       cummax: str = "cummax_close", hot_rows: int = 0) -> DataFrame:
    """Same columns as ``add_returns`` + ``add_rolling`` (row frames), computed
    without holding any series of more than ``hot_rows`` rows in one task.

    1. A small table of (key, time segment): its rows and maximum, and from
       those the row count and maximum of the earlier segments and whether the
       series is hot.
    2. Row index and running max per series: those inside (key, segment)
       continue from the earlier segments' count and maximum.
    3. Chunks of ``chunk_rows`` consecutive rows; the last ``max(windows)``
       rows of a chunk are copied (key, date and value) into the next chunk as a
       halo, which is all a row frame of n rows (and the return at its first row)
       needs. A series that is not hot is one chunk.
    4. Windows run per (key, chunk); halo rows are dropped afterwards.
    All rows are exchanged twice, by segment and by chunk. Rows without a key, and
    those of hot series without a date, are dropped.
    Exact: equal to the single-partition computation (tested).
    """
    halo = max(windows)
    if chunk_rows <= halo:
        raise ValueError("chunk_rows must exceed the longest frame")
    seg = F.floor(F.unix_date(F.col(order)) / F.lit(segment_days)).cast("long")
    d = df.withColumn("__seg", F.coalesce(seg, F.lit(NO_DATE).cast("long")))
    series = Window.partitionBy(key)
    earlier = series.orderBy("__seg").rowsBetween(Window.unboundedPreceding, -1)
    segs = d.groupBy(key, "__seg").agg(F.count(F.lit(1)).alias("__n"), F.max(value).alias("__top"))
    segs = segs.withColumn("__hot", F.sum("__n").over(series) > F.lit(int(hot_rows)))
    counted = F.when(~F.col("__hot") | (F.col("__seg") != F.lit(NO_DATE)), F.col("__top"))
    segs = segs.select(key, "__seg", "__hot", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__off"),
                       F.max(counted).over(earlier).alias("__prior"))
    w = Window.partitionBy(key, "__seg").orderBy(order)
    d = d.select("*", (F.row_number().over(w) - 1).alias("__rn"),
                 F.max(value).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("__run_max"))
    d = d.join(segs, [key, "__seg"]).filter(~F.col("__hot") | F.col(order).isNotNull())
    idx = F.col("__off") + F.col("__rn")
    chunk = F.when(F.col("__hot"), F.floor(idx / F.lit(chunk_rows)).cast("long")).otherwise(F.lit(0).cast("long"))
    in_tail = F.col("__hot") & ((idx % F.lit(chunk_rows)) >= F.lit(chunk_rows - halo))
    copies = F.when(in_tail, F.array(F.struct(chunk.alias("c"), F.lit(False).alias("h")),
                                     F.struct((chunk + 1).alias("c"), F.lit(True).alias("h")))) \
        .otherwise(F.array(F.struct(chunk.alias("c"), F.lit(False).alias("h"))))
    d = d.select(*df.columns, F.greatest("__run_max", "__prior").alias(cummax), F.explode(copies).alias("__cp"))
    own = [c if c in (key, order, value) else F.when(~F.col("__cp.h"), F.col(c)).alias(c) for c in [*df.columns, cummax]]
    base = d.select(*own, F.col("__cp.c").alias("__chunk"), F.col("__cp.h").alias("__halo"))
    w = Window.partitionBy(key, "__chunk").orderBy(order)
    lagged = base.withColumn(prev, F.lag(value).over(w))
    lagged = lagged.withColumn(ret, pct_change(value, prev))
    cols = [F.avg(value).over(w.rowsBetween(-(n - 1), Window.currentRow)).alias(f"sma_{n}d")
            for n in windows]
    cols += [F.stddev_samp(ret).over(w.rowsBetween(-(n - 1), Window.currentRow))
             .alias(f"return_stddev_{n}d") for n in windows]
    feats = lagged.select("*", *cols).filter(~F.col("__halo"))
    return feats.select(*df.columns, prev, ret, *[f"sma_{n}d" for n in windows],
                        *[f"return_stddev_{n}d" for n in windows], cummax)
