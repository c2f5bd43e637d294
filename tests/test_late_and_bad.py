"""Streams that keep what is late or bad: stored, counted, replayed to the same tables."""

import datetime as dt

import pytest

from helpers import FETCHED, envelope_df, price_rows
from pricelake.operators import marts, staging
from pricelake.sources import payloads as pl
from pricelake.sources import versioned
from pricelake.streaming import jobs

D, T = dt.date, dt.datetime


def rows_of(df, digits=9):
    return sorted((tuple(round(v, digits) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


def test_weeks_out_of_order_equal_the_batch_rollup(spark, tmp_path):
    rows = [(a, D(2024, 1, 1) + dt.timedelta(days=d), 1.0 + (d * 7 + k) % 11, T(2024, 6, 1), 5.0, None)
            for k, a in enumerate("ab") for d in range(0, 60)]
    rows += [(a, D(2024, 6, 1), 3.0, T(2024, 6, 2), 5.0, None) for a in "ab"]           # closes all weeks before
    fact = marts.fact_daily(staging.stage_prices(price_rows(spark, rows))).cache()
    week = lambda n: fact.filter(f"price_date between date'2024-01-01' + {7 * n} and date'2024-01-01' + {7 * n + 6}")
    out = str(tmp_path / "w")
    jobs.weekly_batch(spark, out, week(2).unionByName(week(5)), 0)
    jobs.weekly_batch(spark, out, week(0).filter("asset_id = 'a'").unionByName(week(1)), 1)      # behind the mark
    before = versioned.read(spark, f"{out}/weekly", "week_start").filter("week_start < date'2024-01-14'").count()
    jobs.weekly_batch(spark, out, week(0).filter("asset_id = 'b'").unionByName(week(8)), 2)
    for _ in range(2):                                                                   # the last one is replayed
        jobs.weekly_batch(spark, out, fact.filter("price_date >= '2024-02-26' or price_date between '2024-01-22' and '2024-02-25'"), 3)
    got = jobs.read_weekly(spark, out).select(*marts.WEEKLY_COLUMNS)
    assert rows_of(got) == rows_of(marts.weekly_rollup(fact.filter("price_date < '2024-06-01'")))
    late = {r.ingest_epoch: r.late_rows for r in jobs.late_rows(spark, out).collect()}
    # after epoch 0 weeks up to 2024-01-28 are closed (newest row 02-11, 14 days back)
    assert late[0] == 0 and late[1] == 7 + 14 and late[2] == 7 and late[3] > 0
    assert before > 0
    stored = spark.read.parquet(f"{out}/late/ingest_epoch=1")
    assert rows_of(stored.select("asset_id").groupBy("asset_id").count()) == [("a", 14), ("b", 7)]


def test_good_and_bad_lines_are_replaced_together(spark, tmp_path, monkeypatch):
    land = tmp_path / "land"
    land.mkdir()
    (land / "1.json").write_text(
        '{"asset_id": "a", "fetched_at": "2024-03-08T06:00:00.000000", "payload": {"prices": [[1709510400000, 8.0]]}}\n'
        '{"asset_id": "b", "fetched_at": "2024-03-08T06:00:00.000000", "payload": {"prices": [[1709510400000]]}}\n'
        '{"asset_id": "c", "fetched_at": "2024-03-0\n')
    out, bad, ck = (str(tmp_path / x) for x in ("rows", "bad", "ck"))
    write = jobs.sinks.write_table

    def lost(df, path, *a, **k):
        if "/rows/" in path:
            raise RuntimeError("lost")
        return write(df, path, *a, **k)
    with monkeypatch.context() as m:                        # lost between the two writes
        m.setattr(jobs.sinks, "write_table", lost)
        with pytest.raises(Exception, match="lost"):
            jobs.stream_landed(spark, str(land), out, bad, ck).awaitTermination()
    for _ in range(2):
        jobs.stream_landed(spark, str(land), out, bad, ck).awaitTermination()
    assert [(r.asset_id, r.close_usd) for r in spark.read.parquet(out).collect()] == [("a", 8.0)]
    assert sorted((r.reason, r.asset_id) for r in spark.read.parquet(bad).collect()) == [("point_shape", "b"), ("unparseable", None)]


def test_chart_points_have_two_members_and_arrays_may_lack(spark):
    t = 1709510400000.0
    df = envelope_df(spark, [("three", FETCHED, {"prices": [[t, 1.0, 2.0]]}), ("vol3", FETCHED, {"prices": [[t, 1.0]], "total_volumes": [[t, 1.0, 2.0]]}),
                             ("none", FETCHED, {}), ("noprices", FETCHED, {"total_volumes": [[t, 1.0]]}), ("ok", FETCHED, {"prices": [[t, 1.0]]})], "")
    good, bad = pl.split_payloads(df, "market_chart")
    assert sorted((r.asset_id, r.reason) for r in bad.collect()) == [("three", "point_shape"), ("vol3", "volume_shape")]
    assert sorted(r.asset_id for r in good.collect()) == ["none", "noprices", "ok"]
    assert [r.asset_id for r in pl.parse_market_chart(good).collect()] == ["ok"]
    broken = spark.createDataFrame([("x", FETCHED, '{"prices": [[1, '), ("y", FETCHED, None), ("z", FETCHED, "[]")],
                                   "asset_id string, fetched_at timestamp_ntz, payload string")
    assert sorted(r.asset_id for r in pl.split_payloads(broken, "market_chart")[1].collect()) == ["x", "y", "z"]
