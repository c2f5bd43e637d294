"""Registered queries: each takes (spark, sf_dir) and returns a lazy DataFrame.

Every query reads the shared tables (through the fixture adapters) whole;
floating columns are rounded for the engine-to-engine check.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pricelake import schemas
from pricelake.operators import dedup, marts, quality, reshape, serving, staging
from pricelake.plans.common import rounded
from pricelake.session import scratch_path
from pricelake.sources import fixtures as fx
from pricelake.sources import layout, payloads, sinks
from pricelake.plans import incremental
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def memo(fn):
    """Share one lazy DataFrame per (session, sf_dir) between queries: a
    DataFrame is an immutable plan, so reuse only saves rebuilding it."""
    cache: dict = {}

    def wrapper(spark, sf):
        key = (id(spark), sf)
        if key not in cache or cache[key][0] is not spark:
            cache[key] = (spark, fn(spark, sf))
        return cache[key][1]
    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper


def register(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


# ---- building blocks over fixture F1 -------------------------------------

@memo
def f1_staged(spark, sf):
    return staging.stage_prices(fx.f1_raw_prices(spark, sf), tiebreak=fx.F1_TIEBREAK)


@memo
def f1_fact(spark, sf):
    return marts.fact_daily(f1_staged(spark, sf))


@memo
def f1_weekly(spark, sf):
    return marts.weekly_rollup(f1_fact(spark, sf))


# ---- staging and features --------------------------------------------------

@register("q_dedup_prices")
def q_dedup_prices(spark, sf):
    raw = fx.f1_raw_prices(spark, sf)
    return rounded(dedup.keep_latest(raw, ["asset_id", "price_date"], ["fetched_at"],
                                     fx.F1_TIEBREAK))


@register("q_stage_prices")
def q_stage_prices(spark, sf):
    return rounded(f1_staged(spark, sf))


@register("q_daily_returns")
def q_daily_returns(spark, sf):
    return rounded(marts.daily_returns(f1_staged(spark, sf)))


@register("q_rolling_metrics")
def q_rolling_metrics(spark, sf):
    return rounded(marts.rolling_metrics(f1_staged(spark, sf)))


@register("q_fact_daily")
def q_fact_daily(spark, sf):
    return rounded(f1_fact(spark, sf))


@register("q_sma")
def q_sma(spark, sf):
    return rounded(f1_fact(spark, sf).select("asset_id", "price_date", "close_usd",
                                             "sma_7d", "sma_30d"))


@register("q_rolling_stddev")
def q_rolling_stddev(spark, sf):
    return rounded(f1_fact(spark, sf).select("asset_id", "price_date", "daily_return_pct",
                                             "return_stddev_7d", "return_stddev_30d"))


@register("q_cummax_drawdown")
def q_cummax_drawdown(spark, sf):
    return rounded(f1_fact(spark, sf).select("asset_id", "price_date", "close_usd",
                                             "cummax_close", "drawdown_from_ath_pct"))


@register("q_annualised_vol")
def q_annualised_vol(spark, sf):
    return rounded(f1_fact(spark, sf).select("asset_id", "price_date", "return_stddev_30d",
                                             "annualised_volatility_30d"))


@register("q_price_vs_sma")
def q_price_vs_sma(spark, sf):
    return rounded(f1_fact(spark, sf).select("asset_id", "price_date", "close_usd", "sma_7d",
                                             "price_vs_sma7_pct"))


# ---- marts -------------------------------------------------------------------

@register("q_weekly_volatility")
def q_weekly_volatility(spark, sf):
    return rounded(f1_weekly(spark, sf))


@register("q_weekly_open_close")
def q_weekly_open_close(spark, sf):
    return rounded(marts.weekly_open_close(f1_fact(spark, sf)))


@register("q_latest_price")
def q_latest_price(spark, sf):
    return rounded(marts.latest_price(f1_staged(spark, sf)))


# ---- dimension (fixture F3) ---------------------------------------------------

@memo
def f3_metadata_raw(spark, sf):
    return payloads.parse_metadata(fx.f3_info_payloads(spark, sf))


@memo
def f3_dim(spark, sf):
    wl = staging.typed(fx.f3_watchlist(spark, sf), schemas.WATCHLIST)
    meta = staging.stage_metadata(f3_metadata_raw(spark, sf))
    latest = marts.latest_price(f1_staged(spark, sf))
    return marts.dim_assets(wl, meta, latest, fx.F1_AS_OF)


@register("q_parse_metadata")
def q_parse_metadata(spark, sf):
    return rounded(f3_metadata_raw(spark, sf))


@register("q_stage_metadata")
def q_stage_metadata(spark, sf):
    return rounded(staging.stage_metadata(f3_metadata_raw(spark, sf)))


@register("q_dim_assets")
def q_dim_assets(spark, sf):
    return rounded(f3_dim(spark, sf))


@register("q_dim_ranked")
def q_dim_ranked(spark, sf):
    # a top-50 report: the limit is the feature
    return rounded(serving.dim_ranked(f3_dim(spark, sf), 50))


# ---- data quality ------------------------------------------------------------

@register("q_dq_not_null")
def q_dq_not_null(spark, sf):
    return rounded(quality.not_null(fx.f1_raw_prices(spark, sf), "volume_usd"))


@register("q_dq_unique")
def q_dq_unique(spark, sf):
    return quality.unique(fx.f1_raw_prices(spark, sf), "asset_id")


@register("q_dq_unique_combo")
def q_dq_unique_combo(spark, sf):
    return quality.unique_combo(fx.f1_raw_prices(spark, sf), ["asset_id", "price_date"])


@register("q_dq_expression")
def q_dq_expression(spark, sf):
    # conditional test: among rows with a low, the low must not exceed the open
    return rounded(quality.expression_is_true(fx.f1_raw_prices(spark, sf),
                                              "low_usd <= open_usd", where="low_usd is not null"))


@register("q_dq_price_positive")
def q_dq_price_positive(spark, sf):
    # on fetched metadata, whose older fetch reports no price yet
    return rounded(quality.expression_is_true(f3_metadata_raw(spark, sf), "ath_usd > 0")
                   .select("asset_id", "fetched_at", "ath_usd"))


F1_AS_OF_TS = "2001-11-05 06:00:00"


@register("q_dq_freshness")
def q_dq_freshness(spark, sf):
    prices = quality.freshness(fx.f1_raw_prices(spark, sf), "fetched_at", F1_AS_OF_TS,
                               source="prices")
    meta = quality.freshness(f3_metadata_raw(spark, sf), "fetched_at", F1_AS_OF_TS,
                             source="asset_metadata")
    return prices.unionByName(meta)


@register("q_dq_summary")
def q_dq_summary(spark, sf):
    """The fact is computed once, by a write that measures its checks and those of
    the layers whose rows it holds; the roll-up and the dimension read it back."""
    checks = quality.declared_checks()
    of_fact = [c for c in checks if quality.FACT_VIEWS.get(c.table, c.table) == "fact_daily"]
    fact, measured = quality.written(f1_fact(spark, sf), scratch_path(spark, f"dq-fact-{uuid.uuid4().hex}"), of_fact)
    meta = f3_metadata_raw(spark, sf)
    staged_meta = staging.stage_metadata(meta)
    wl = staging.typed(fx.f3_watchlist(spark, sf), schemas.WATCHLIST)
    tables = {"raw_prices": fx.f1_raw_prices(spark, sf), "weekly": marts.weekly_rollup(fact), "raw_metadata": meta,
              "stg_metadata": staged_meta,
              "dim_assets": marts.dim_assets(wl, staged_meta, marts.latest_price(fact), fx.F1_AS_OF)}
    return quality.run_suite(tables, [c for c in checks if c not in of_fact], measured=measured)


# ---- serving frames ------------------------------------------------------------

def f1_daily(spark, sf, days_back=90):
    return serving.daily_prices(f1_fact(spark, sf), fx.F1_AS_OF, days_back)


@memo
def f1_weekly_recent(spark, sf):
    return serving.weekly_volatility(f1_weekly(spark, sf), fx.F1_AS_OF, 180)


@register("q_lookback_prices")
def q_lookback_prices(spark, sf):
    return rounded(f1_daily(spark, sf))


@register("q_lookback_weekly")
def q_lookback_weekly(spark, sf):
    return rounded(f1_weekly_recent(spark, sf))


@register("q_pipeline_status")
def q_pipeline_status(spark, sf):
    return serving.pipeline_status(fx.f1_raw_prices(spark, sf), fx.F1_AS_OF)


@register("q_staleness")
def q_staleness(spark, sf):
    return serving.staleness(serving.pipeline_status(fx.f1_raw_prices(spark, sf), fx.F1_AS_OF),
                             fx.F1_AS_OF)


@register("q_latest_cards")
def q_latest_cards(spark, sf):
    return rounded(serving.latest_cards(f1_daily(spark, sf), f3_dim(spark, sf)))


@register("q_display_cards")
def q_display_cards(spark, sf):
    return serving.display_text(serving.latest_cards(f1_daily(spark, sf), f3_dim(spark, sf)))


@register("q_volume_series")
def q_volume_series(spark, sf):
    return rounded(serving.volume_series(f1_daily(spark, sf)))


@register("q_vol_series")
def q_vol_series(spark, sf):
    return rounded(serving.vol_series(f1_daily(spark, sf)))


@register("q_candle_frame")
def q_candle_frame(spark, sf):
    return rounded(serving.candle_frame(f1_daily(spark, sf)))


@register("q_drawdown_series")
def q_drawdown_series(spark, sf):
    return rounded(serving.drawdown_series(f1_daily(spark, sf)))


@register("q_candle_availability")
def q_candle_availability(spark, sf):
    return serving.candle_availability(f1_daily(spark, sf))


@register("q_asset_list")
def q_asset_list(spark, sf):
    return serving.asset_list(f1_daily(spark, sf))


@register("q_return_histogram")
def q_return_histogram(spark, sf):
    return rounded(serving.return_histogram(f1_daily(spark, sf)))


@register("q_vol_heatmap")
def q_vol_heatmap(spark, sf):
    return rounded(serving.vol_heatmap(f1_weekly_recent(spark, sf)))


@register("q_vol_heatmap_wide")
def q_vol_heatmap_wide(spark, sf):
    return rounded(serving.vol_heatmap_wide(f1_weekly_recent(spark, sf), fx.F1_AS_OF, 180))


@register("q_risk_return")
def q_risk_return(spark, sf):
    return rounded(serving.risk_return(f1_weekly_recent(spark, sf), f3_dim(spark, sf)))


# ---- reshapes (fixture F2: one series per event type, every day present) -------

# the chosen assets of the reshapes: a selection, other event types are not shown
F2_ASSETS = ["click", "error", "purchase", "signup", "view"]


@memo
def f2_daily(spark, sf):
    raw = fx.f2_raw_prices(spark, sf, by="event_type")
    fact = marts.fact_daily(staging.stage_prices(raw, tiebreak=fx.F2_TIEBREAK))
    return serving.daily_prices(fact, fx.F2_AS_OF, 90)


@register("q_pivot_close")
def q_pivot_close(spark, sf):
    return rounded(reshape.pivot_close(f2_daily(spark, sf), F2_ASSETS))


@register("q_unpivot_close")
def q_unpivot_close(spark, sf):
    return rounded(reshape.unpivot_close(reshape.pivot_close(f2_daily(spark, sf), F2_ASSETS)))


@register("q_rebased_index")
def q_rebased_index(spark, sf):
    return rounded(reshape.rebased_index(f2_daily(spark, sf), F2_ASSETS))


# ---- payload ingestion (fixture F4: chart and candle payloads from events) -----

@memo
def f4_good_charts(spark, sf):
    good, _ = payloads.split_payloads(fx.f4_chart_payloads(spark, sf), "market_chart")
    return good


@register("q_parse_market_chart")
def q_parse_market_chart(spark, sf):
    return rounded(payloads.parse_market_chart(f4_good_charts(spark, sf)))


@register("q_merge_ohlc")
def q_merge_ohlc(spark, sf):
    return rounded(payloads.merge_ohlc(f4_good_charts(spark, sf),
                                       fx.f4_candle_payloads(spark, sf)))


@register("q_quarantine")
def q_quarantine(spark, sf):
    _, bad_c = payloads.split_payloads(fx.f4_chart_payloads(spark, sf), "market_chart")
    _, bad_k = payloads.split_payloads(fx.f4_candle_payloads(spark, sf), "candles")
    return bad_c.unionByName(bad_k).drop("payload_text")


F4_BATCH_TS = "2024-01-31 06:00:00"


@register("q_batch_stamp")
def q_batch_stamp(spark, sf):
    rows = payloads.parse_market_chart(f4_good_charts(spark, sf))
    return rounded(payloads.stamp_batch(rows, F4_BATCH_TS))


@register("q_batch_counts")
def q_batch_counts(spark, sf):
    rows = payloads.merge_ohlc(f4_good_charts(spark, sf), fx.f4_candle_payloads(spark, sf))
    return sinks.batch_counts(rows)


# ---- run-level selections, append/dedup, dry run ------------------------------

@register("q_batch_window")
def q_batch_window(spark, sf):
    # a full refresh asks for 365 days of history
    return rounded(staging.batch_window(fx.f1_raw_prices(spark, sf), fx.F1_AS_OF,
                                        full_refresh=True))


@register("q_asset_subset")
def q_asset_subset(spark, sf):
    # the chosen assets come as a table: the watchlist of two categories
    wl = fx.f3_watchlist(spark, sf)
    chosen = wl.filter(F.col("category").isin("NATION_1", "NATION_2"))
    return rounded(staging.select_assets(f1_staged(spark, sf), chosen))


@register("q_append_then_dedup")
def q_append_then_dedup(spark, sf):
    raw = fx.f1_raw_prices(spark, sf)
    twice = raw.unionByName(raw)          # the same batch appended twice
    return rounded(staging.stage_prices(twice, tiebreak=fx.F1_TIEBREAK))


@register("q_dry_run_preview")
def q_dry_run_preview(spark, sf):
    raw = fx.f1_raw_prices(spark, sf)
    order = ["asset_id", "price_date", "fetched_at", "src_orderkey", "src_partkey", "close_usd"]
    total = raw.select(F.count(F.lit(1))).scalar()
    return rounded(sinks.preview(raw, order, 3).withColumn("batch_rows", total))


# ---- upsert and incremental slices ------------------------------------------------

F1_SPLIT_TS = "2001-01-01 00:00:00"


def f1_old_new(spark, sf):
    """Staged target from fetches before the split, staged batch from after."""
    raw = fx.f1_raw_prices(spark, sf)
    split = F.lit(F1_SPLIT_TS).cast("timestamp_ntz")
    old = staging.stage_prices(raw.filter(F.col("fetched_at") < split), tiebreak=fx.F1_TIEBREAK)
    new = staging.stage_prices(raw.filter(F.col("fetched_at") >= split),
                               tiebreak=fx.F1_TIEBREAK)
    return old, new


@register("q_upsert")
def q_upsert(spark, sf):
    old, new = f1_old_new(spark, sf)
    return rounded(sinks.upsert(old, new, ["asset_id", "price_date"]))


F1_TARGET_END = "2001-06-30"


def f1_target(spark, sf):
    return f1_fact(spark, sf).filter(F.col("price_date") <= F.lit(F1_TARGET_END).cast("date"))


@register("q_incremental_slice")
def q_incremental_slice(spark, sf):
    return rounded(incremental.incremental_slice(f1_fact(spark, sf), f1_target(spark, sf),
                                                 mode="strict"))


@register("q_incremental_per_asset")
def q_incremental_per_asset(spark, sf):
    return rounded(incremental.incremental_slice(f1_fact(spark, sf), f1_target(spark, sf),
                                                 mode="per_asset", lookback_days=2))


@register("q_incremental_features")
def q_incremental_features(spark, sf):
    """Features of the rows after the stored target, from a 30-row tail. The staged
    rows and the target are stored, as in the daily job, so each is computed once;
    the target is a bucketed copy, whose series are read without an exchange."""
    staged = sinks.staged_copy(spark, f1_staged(spark, sf).select(*marts.RETURNS_COLUMNS[:8]), "incremental-staged")
    end = F.lit(F1_TARGET_END).cast("date")
    name = f"incremental_fact_{uuid.uuid4().hex}"
    stored = layout.write_bucketed(marts.fact_daily(staged.filter(F.col("price_date") <= end)), name,
                                   scratch_path(spark, name), int(spark.conf.get("spark.sql.shuffle.partitions")))
    new = staged.filter(F.col("price_date") > end)
    return rounded(incremental.incremental_features(stored, new))


@register("q_fact_daily_split")
def q_fact_daily_split(spark, sf):
    """The daily fact with every asset above 300 rows on the split path
    (chunks of 100 rows, 64-day segments): must equal ``q_fact_daily``."""
    return rounded(marts.fact_daily(f1_staged(spark, sf), hot_rows=300, chunk_rows=100,
                                    segment_days=64))


@register("q_merge_ohlc_resample")
def q_merge_ohlc_resample(spark, sf):
    """Candle merge with the daily resample: first open, highest high, lowest low."""
    return rounded(payloads.merge_ohlc(f4_good_charts(spark, sf),
                                       fx.f4_candle_payloads(spark, sf), resample="ohlc"))


@register("q_rolling_days")
def q_rolling_days(spark, sf):
    """Calendar-day frames (the last 7 / 30 days, not rows): an option."""
    return rounded(marts.rolling_metrics(f1_staged(spark, sf), frame="days")
                   .select("asset_id", "price_date", "sma_7d", "sma_30d", "return_stddev_7d",
                           "return_stddev_30d"))


# ---- daily window, subset refresh, overlap, one-asset page, default set, order ------

@register("q_batch_window_daily")
def q_batch_window_daily(spark, sf):
    # the daily run asks for two days of history
    return rounded(staging.batch_window(fx.f1_raw_prices(spark, sf), fx.F1_AS_OF, full_refresh=False))


@register("q_refresh_subset")
def q_refresh_subset(spark, sf):
    """A full refresh of two assets: their fetch dates are replaced, all else stays."""
    raw = fx.f1_raw_prices(spark, sf)
    later = F.col("fetched_at") + F.expr("INTERVAL 1 HOUR")
    fresh = raw.filter(F.col("asset_id").isin("1", "2") & (F.col("price_date") >= F.lit("2001-06-01").cast("date"))) \
        .withColumns({"close_usd": F.col("close_usd") * 2, "fetched_at": later, "fetched_date": later.cast("date")})
    return rounded(sinks.upsert(raw, fresh, ["asset_id", "fetched_date"]))


@register("q_incremental_overlap")
def q_incremental_overlap(spark, sf):
    """A batch that overlaps and corrects stored days: four months of it were
    stored with other prices."""
    staged = f1_staged(spark, sf)
    start, end = F.lit("2001-03-01").cast("date"), F.lit(F1_TARGET_END).cast("date")
    wrong = F.when(F.col("price_date") >= start, F.col("close_usd") * 3).otherwise(F.col("close_usd"))
    stored = marts.fact_daily(staged.filter(F.col("price_date") <= end).withColumn("close_usd", wrong))
    return rounded(incremental.incremental_features(stored, staged.filter(F.col("price_date") >= start)))


@register("q_asset_page")
def q_asset_page(spark, sf):
    """One asset's page: its candles and its drawdown."""
    daily = f1_daily(spark, sf)
    return rounded(serving.candle_frame(daily, asset="7").join(
        serving.drawdown_series(daily, asset="7"), ["asset_id", "price_date"]))


@register("q_default_assets")
def q_default_assets(spark, sf):
    # nothing chosen: the default set
    return rounded(staging.select_assets(f1_staged(spark, sf), [], default=["1", "2", "3"]))


@register("q_dim_ranked_order")
def q_dim_ranked_order(spark, sf):
    return serving.positions(serving.dim_ranked(f3_dim(spark, sf), 50), "latest_market_cap_usd")


@register("q_cards_order")
def q_cards_order(spark, sf):
    cards = serving.latest_cards(f1_daily(spark, sf), f3_dim(spark, sf))
    return serving.positions(cards, "market_cap_usd")
