"""Data-quality semantics: NULL passes an expression, `where` filters first,
freshness thresholds and the empty table, the suite summary."""

import datetime as dt

from helpers import price_rows
from pricelake.operators import quality

D = dt.date
T = dt.datetime


def test_expression_null_passes_and_where(spark):
    df = price_rows(spark, [("a", D(2024, 1, 1), 1.0, T(2024, 1, 2), None, 5.0),
                            ("b", D(2024, 1, 1), 2.0, T(2024, 1, 2), -1.0, None),
                            ("c", D(2024, 1, 1), 3.0, T(2024, 1, 2), 4.0, -2.0)])
    bad_vol = quality.expression_is_true(df, "volume_usd >= 0", where="volume_usd is not null")
    assert [r.asset_id for r in bad_vol.collect()] == ["b"]
    bad_cap = quality.expression_is_true(df, "market_cap_usd >= 0")   # NULL passes
    assert [r.asset_id for r in bad_cap.collect()] == ["c"]


def test_unique_checks(spark):
    df = price_rows(spark, [("a", D(2024, 1, 1), 1.0, T(2024, 1, 2)),
                            ("a", D(2024, 1, 1), 2.0, T(2024, 1, 3)),
                            ("a", D(2024, 1, 2), 2.0, T(2024, 1, 3))])
    assert [(r.asset_id, r.n_records) for r in quality.unique(df, "asset_id").collect()] == \
        [("a", 3)]
    combo = quality.unique_combo(df, ["asset_id", "price_date"]).collect()
    assert [(r.price_date, r.n_records) for r in combo] == [(D(2024, 1, 1), 2)]
    assert quality.not_null(df, "volume_usd").count() == 3


def test_freshness_thresholds_and_empty(spark):
    df = price_rows(spark, [("a", D(2024, 1, 1), 1.0, T(2024, 1, 2, 6))])
    status = lambda ts, d=df: quality.freshness(d, "fetched_at", ts).collect()[0].status  # noqa
    assert status("2024-01-03 06:00:00") == "pass"
    assert status("2024-01-03 06:00:01") == "warn"
    assert status("2024-01-04 06:00:01") == "error"
    assert status("2024-01-03 00:00:00", df.limit(0)) == "error"


def test_suite_summary(spark):
    df = price_rows(spark, [("a", D(2024, 1, 1), 1.0, T(2024, 1, 2), -5.0),
                            ("a", D(2024, 1, 1), 2.0, T(2024, 1, 3))])
    checks = quality.price_checks("t", "t") + [
        quality.Check("t.unique", "t", "unique_combo", ["asset_id", "price_date"])]
    got = {r.test_name: (r.failures, r.status)
           for r in quality.run_suite({"t": df}, checks).collect()}
    assert got["t.volume_usd_ge_0"] == (1, "fail")
    assert got["t.close_usd_gt_0"] == (0, "pass")
    assert got["t.unique"] == (1, "fail")
    assert len(got) == 7
