"""The stored state of the series: equal to a recompute, and all that a batch in order reads."""

import datetime as dt
import glob
import random

import pytest

from helpers import price_rows
from pricelake.operators import marts, staging
from pricelake.plans import series_state
from pricelake.streaming import jobs

D, T = dt.date, dt.datetime


def rows_of(df, digits=9):
    return sorted((tuple(round(v, digits) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


def staged(spark, rows):
    return staging.stage_prices(price_rows(spark, rows))


def same(spark, path, rows):
    """Fact, state and latest prices equal those of a full computation of ``rows``."""
    full = marts.fact_daily(staged(spark, rows))
    got = spark.read.parquet(path).select(*marts.FACT_COLUMNS)
    assert rows_of(got) == rows_of(full)
    assert rows_of(series_state.latest_price(series_state.load(spark, path))) == rows_of(marts.latest_price(full))
    built = {r.asset_id: (r.first_date, r.last_date, r.days, [round(t.cummax_close, 9) for t in r.tail], [t.price_date for t in r.tail])
             for r in series_state.load(spark, path).collect()}
    want = {}
    for r in sorted(full.collect(), key=lambda r: r.price_date):
        w = want.setdefault(r.asset_id, [])
        w.append(r)
    assert built == {a: (w[0].price_date, w[-1].price_date, len(w), [round(x.cummax_close, 9) for x in w[-30:]],
                         [x.price_date for x in w[-30:]]) for a, w in want.items()}


def test_batches_in_order_late_and_new_equal_a_recompute(spark, tmp_path):
    r, path, seen = random.Random(4), str(tmp_path / "fact"), {}
    f = T(2024, 6, 1)

    def batch(*keys):
        out = []
        for a, day in keys:
            row = (a, D(2024, 1, 1) + dt.timedelta(days=day), r.uniform(1, 9), f + dt.timedelta(hours=len(seen)), r.choice([None, 5.0]), r.choice([None, 7.0]))
            seen[row[:2]] = row
            out.append(row)
        jobs.features_batch(spark, path, staged(spark, out))
        same(spark, path, list(seen.values()))

    batch(*[("a", d) for d in range(0, 40)], *[("b", d) for d in range(0, 20, 5)])
    batch(("a", 40), ("a", 41), ("b", 41), ("new", 41))             # all in order, one asset is new
    batch(("a", 42), ("b", 7), ("b", 41))                           # b is late and corrected
    batch(("a", 3), ("late", 2), ("late", 90))                      # far behind the tail


def test_a_batch_in_order_reads_no_older_partition(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows = [("a", D(2024, 1, 1) + dt.timedelta(days=d), 1.0 + d % 7, T(2024, 6, 1)) for d in range(45)]
    jobs.features_batch(spark, path, staged(spark, rows[:44]))
    series_state.load(spark, path)
    for f in glob.glob(f"{path}/price_date=2024-01-*/*.parquet"):
        if "=2024-01-01" not in f:                                  # Spark takes the schema from its footer
            open(f, "w").write("unreadable")                        # a read of January would fail
    jobs.features_batch(spark, path, staged(spark, rows[44:]))
    got = spark.read.parquet(f"{path}/price_date=2024-02-14").first()
    want = marts.fact_daily(staged(spark, rows)).filter("price_date = '2024-02-14'").first()
    assert (got.sma_30d, got.return_stddev_30d, got.cummax_close) == pytest.approx((want.sma_30d, want.return_stddev_30d, want.cummax_close))
    with pytest.raises(Exception, match="2024-01"):                 # a late row does need them
        jobs.features_batch(spark, path, staged(spark, [("a", D(2024, 1, 30), 3.0, T(2024, 7, 1))]))


def test_a_batch_lost_before_its_state_is_done_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "fact")
    rows = [("a", D(2024, 1, 1) + dt.timedelta(days=d), 1.0 + d % 5, T(2024, 6, 1)) for d in range(40)]
    jobs.features_batch(spark, path, staged(spark, rows[:35]))
    series_state.load(spark, path)

    def lost(*a):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(series_state, "save", lost)
        with pytest.raises(RuntimeError, match="lost"):
            jobs.features_batch(spark, path, staged(spark, rows[35:]))
    for _ in range(2):                                              # done again, and once more after the state
        jobs.features_batch(spark, path, staged(spark, rows[35:]))
        same(spark, path, rows)
