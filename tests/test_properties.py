"""Properties over whole fixtures and random series."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import SF001, price_rows
from pricelake.operators import marts, staging
from pricelake.plans import incremental
from pricelake.sources import fixtures as fx


def test_drawdown_nonpositive_and_running_max_monotone(spark):
    fact = marts.fact_daily(staging.stage_prices(fx.f1_raw_prices(spark, SF001),
                                                 tiebreak=fx.F1_TIEBREAK))
    assert fact.filter(F.col("drawdown_from_ath_pct") > 0).count() == 0
    w = Window.partitionBy("asset_id").orderBy("price_date")
    drops = fact.withColumn("prev_max", F.lag("cummax_close").over(w)) \
        .filter(F.col("cummax_close") < F.col("prev_max"))
    assert drops.count() == 0
    assert fact.filter(F.col("cummax_close") < F.col("close_usd")).count() == 0


series = st.lists(st.floats(min_value=0.5, max_value=1000, allow_nan=False), min_size=2,
                  max_size=80)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(closes=series, gaps=st.lists(st.integers(1, 5), min_size=80, max_size=80),
       cut=st.floats(0.1, 0.9))
def test_incremental_equals_full(spark, closes, gaps, cut):
    f = dt.datetime(2030, 1, 1)
    day, rows = dt.date(2024, 1, 1), []
    for c, g in zip(closes, gaps):
        day += dt.timedelta(days=g)
        rows.append(("a", day, c, f))
    staged = staging.stage_prices(price_rows(spark, rows))
    end = rows[max(0, int(len(rows) * cut) - 1)][1]
    stored = marts.fact_daily(staged.filter(F.col("price_date") <= F.lit(end)))
    new = staged.filter(F.col("price_date") > F.lit(end))
    inc = incremental.incremental_features(stored, new)
    full = marts.fact_daily(staged).filter(F.col("price_date") > F.lit(end))

    def norm(df):
        return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r)
                      for r in df.select(*marts.FACT_COLUMNS).collect())
    assert norm(inc) == norm(full)


def test_split_series_equal_whole_ones_at_every_length(spark):
    """Series below, at and above ``hot_rows``, sparse and dense, and one without a name."""
    f, rows = dt.datetime(2030, 1, 1), []
    for name, n, step in (("short", 12, 9), ("edge", 40, 1), ("long", 41, 1), ("sparse", 150, 23), (None, 60, 2)):
        rows += [(name, dt.date(2020, 1, 1) + dt.timedelta(days=k * step), 50.0 + (k * 37) % 101, f) for k in range(n)]
    staged = staging.stage_prices(price_rows(spark, rows))

    def norm(df):
        return sorted(repr(tuple(round(v, 9) if isinstance(v, float) else v for v in r)) for r in df.collect())
    for chunk_rows, days in ((31, 7), (64, 40)):
        assert norm(marts.fact_daily(staged, hot_rows=40, chunk_rows=chunk_rows, segment_days=days)) == norm(marts.fact_daily(staged))
