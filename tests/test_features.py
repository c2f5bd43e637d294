"""Values worked out by hand on a three-day payload (closes 8, 10, 9.5), and edge cases."""

import datetime as dt
import math

import pytest
from helpers import CHART, FETCHED, envelope_df, price_rows

from pricelake.operators import marts, staging
from pricelake.sources import payloads as pl

D = dt.date
T = dt.datetime


@pytest.fixture(scope="module")
def fact(spark):
    raw = pl.parse_market_chart(envelope_df(spark, [("kelp", FETCHED, CHART)], None))
    return marts.fact_daily(staging.stage_prices(raw))


def close(a, b, tol=1e-9):
    if a is None or b is None:
        return a is b
    return math.isclose(a, b, rel_tol=tol, abs_tol=tol)


def test_golden_fact(fact):
    rows = sorted(fact.collect(), key=lambda r: r.price_date)
    dev = 30 / math.sqrt(2)              # sample deviation of the returns 25 and -5
    exp = [
        (None, None, 8.0, None, 8.0, None, 0.0, 0.0),
        (8.0, 25.0, 9.0, None, 10.0, None, 0.0, 100 / 9),
        (10.0, -5.0, 27.5 / 3, dev, 10.0, dev * math.sqrt(365), -5.0, 100 * (28.5 / 27.5 - 1)),
    ]
    for r, e in zip(rows, exp):
        got = (r.prev_close_usd, r.daily_return_pct, r.sma_7d, r.return_stddev_30d,
               r.cummax_close, r.annualised_volatility_30d, r.drawdown_from_ath_pct,
               r.price_vs_sma7_pct)
        assert all(close(a, b) for a, b in zip(got, e)), (got, e)
        assert close(r.sma_7d, r.sma_30d)


def test_golden_week(fact):
    w = marts.weekly_rollup(fact).collect()
    assert len(w) == 1
    w = w[0]
    assert w.week_start == D(2024, 3, 3)
    assert (w.weekly_low, w.weekly_high, w.trading_days) == (8.0, 10.0, 3)
    assert close(w.weekly_avg_close, 27.5 / 3)
    assert close(w.weekly_return_stddev, 30 / math.sqrt(2))
    assert close(w.annualised_volatility_weekly, 30 / math.sqrt(2) * math.sqrt(52))
    assert close(w.weekly_return_pct, 18.75)


def test_dedup_tie_later_point_wins(spark):
    f = T(2024, 1, 2, 6)
    raw = price_rows(spark, [("a", D(2024, 1, 1), 1.0, f), ("a", D(2024, 1, 1), 2.0, f)])
    from pyspark.sql import functions as F
    raw = raw.withColumn("source_ts", F.when(F.col("close_usd") == 2.0,
                                             F.lit(T(2024, 1, 1, 12))).otherwise(
        F.lit(T(2024, 1, 1, 1))))
    out = staging.stage_prices(raw).collect()
    assert [r.close_usd for r in out] == [2.0]


def test_newer_fetch_wins(spark):
    raw = price_rows(spark, [("a", D(2024, 1, 1), 1.0, T(2024, 1, 2)),
                             ("a", D(2024, 1, 1), 2.0, T(2024, 1, 3))])
    for method in ("agg", "window"):
        assert [r.close_usd for r in staging.stage_prices(raw, method=method).collect()] == [2.0]


def test_invalid_prices_dropped(spark):
    f = T(2024, 1, 2)
    raw = price_rows(spark, [("a", D(2024, 1, 1), None, f), ("b", D(2024, 1, 1), 0.0, f),
                             ("c", D(2024, 1, 1), -1.0, f), ("d", D(2024, 1, 1), float("nan"), f),
                             ("e", D(2024, 1, 1), 5.0, f)])
    assert [r.asset_id for r in staging.stage_prices(raw).collect()] == ["e"]


def test_gap_lag_crosses_and_frames_count_rows(spark):
    f = T(2024, 2, 1)
    raw = price_rows(spark, [("a", D(2024, 1, 1), 10.0, f), ("a", D(2024, 1, 10), 20.0, f)])
    rows = sorted(marts.fact_daily(staging.stage_prices(raw)).collect(),
                  key=lambda r: r.price_date)
    assert rows[1].prev_close_usd == 10.0 and close(rows[1].daily_return_pct, 100.0)
    assert close(rows[1].sma_7d, 15.0)


def test_day_frames_option(spark):
    f = T(2024, 2, 1)
    raw = price_rows(spark, [("a", D(2024, 1, 1), 10.0, f), ("a", D(2024, 1, 10), 20.0, f)])
    rows = sorted(marts.fact_daily(staging.stage_prices(raw), frame="days").collect(),
                  key=lambda r: r.price_date)
    assert close(rows[1].sma_7d, 20.0) and close(rows[1].sma_30d, 15.0)


def test_week_boundary_and_single_row_week(spark):
    f = T(2024, 2, 1)
    raw = price_rows(spark, [("a", D(2024, 1, 13), 10.0, f), ("a", D(2024, 1, 14), 20.0, f)])
    w = sorted(marts.weekly_rollup(marts.fact_daily(staging.stage_prices(raw))).collect(),
               key=lambda r: r.week_start)
    assert [x.week_start for x in w] == [D(2024, 1, 7), D(2024, 1, 14)]
    assert all(x.weekly_return_pct == 0.0 and x.weekly_return_stddev is None for x in w)


def test_latest_price_keeps_null_at_latest_date(spark):
    f = T(2024, 2, 1)
    raw = price_rows(spark, [("a", D(2024, 1, 1), 10.0, f, None, 5.0),
                             ("a", D(2024, 1, 2), 11.0, f, None, None)])
    r = marts.latest_price(staging.stage_prices(raw)).collect()[0]
    assert (r.latest_price_date, r.latest_close_usd, r.latest_market_cap_usd, r.days_of_data) \
        == (D(2024, 1, 2), 11.0, None, 2)


def test_cards_skip_null_at_latest_date(spark):
    from pricelake.operators import serving
    f = T(2024, 2, 1)
    raw = price_rows(spark, [("a", D(2024, 1, 1), 10.0, f, None, 5.0),
                             ("a", D(2024, 1, 2), 11.0, f, None, None)])
    fact = marts.fact_daily(staging.stage_prices(raw))
    dim = spark.createDataFrame([("a", "A", None)], "asset_id string, name string, symbol string")
    c = serving.latest_cards(fact, dim).collect()[0]
    assert (c.close_usd, c.market_cap_usd) == (11.0, 5.0)
    t = serving.display_text(serving.latest_cards(fact, dim)).collect()[0]
    assert (t.label, t.price_text, t.return_text, t.market_cap_text) == \
        ("A", "$11.0000", "+10.00%", "$0.0B")


def test_price_text_rounding(spark):
    from pyspark.sql import functions as F
    from pricelake.functions import fmt_billions, fmt_pct, fmt_price
    df = spark.createDataFrame([(1000.5,), (1234567.0,), (1.005,), (-3.14159,), (None,)],
                               "v double")
    got = [tuple(r) for r in df.select(fmt_price("v"), fmt_pct("v"), fmt_billions("v")).collect()]
    assert got[0][0] == "$1,000" and got[1][0] == "$1,234,567"
    assert got[2][0] == "$1.0050" and got[3][1] == "-3.14%"
    assert got[1][2] == "$0.0B" and got[4] == ("N/A", "N/A", "N/A")
    assert F is not None


def test_rebase_missing_first_date_is_null(spark):
    from pricelake.operators import reshape
    f = T(2024, 2, 1)
    raw = price_rows(spark, [("a", D(2024, 1, 1), 10.0, f), ("a", D(2024, 1, 2), 20.0, f),
                             ("b", D(2024, 1, 2), 5.0, f)])
    out = {(r.asset_id, r.price_date): r.index_value
           for r in reshape.rebased_index(staging.stage_prices(raw), ["a", "b"]).collect()}
    assert out[("a", D(2024, 1, 1))] == 100.0 and out[("a", D(2024, 1, 2))] == 200.0
    assert out[("b", D(2024, 1, 1))] is None and out[("b", D(2024, 1, 2))] is None


def test_histogram_max_in_last_bin(spark):
    from pricelake.operators import serving
    df = spark.createDataFrame([("a", float(x)) for x in range(0, 121)],
                               "asset_id string, daily_return_pct double")
    h = {r.bin: r.n_days for r in serving.return_histogram(df).collect()}
    assert sum(h.values()) == 121 and max(h) == 60 and h[60] == 3
