"""The daily job end to end: land payloads, ingest twice, build twice, check."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from helpers import SF001
from pricelake.operators import marts, staging
from pricelake.plans import pipeline
from pricelake.sources import fixtures as fx
from pricelake.sources import payloads as pl

AS_OF = dt.date(2024, 1, 31)


def land(df, path):
    """Envelope rows -> JSON lines, payload text spliced in as is."""
    os.makedirs(path, exist_ok=True)
    n = len(os.listdir(path))
    with open(os.path.join(path, f"part-{n}.json"), "w") as fh:
        for r in df.collect():
            fh.write('{"asset_id": "%s", "fetched_at": "%s", "payload": %s}\n'
                     % (r.asset_id, r.fetched_at.isoformat(), r.payload))


def rows_of(df):
    out = [tuple(round(v, 9) if isinstance(v, float) else v for v in r)
           for r in df.select(*sorted(df.columns)).collect()]
    return sorted(out, key=repr)


@pytest.mark.parametrize("mode", ["per_asset", "tail"])
def test_ingest_build_check(spark, tmp_path, mode):
    charts = fx.f4_chart_payloads(spark, SF001, 256)
    candles = fx.f4_candle_payloads(spark, SF001, 256)
    info = fx.f3_info_payloads(spark, SF001)
    root, landing = str(tmp_path / "lake"), str(tmp_path / "landing")
    wl = str(tmp_path / "watchlist")
    fx.f3_watchlist(spark, SF001).withColumnRenamed("asset_id", "coin_id") \
        .coalesce(1).write.option("header", True).csv(wl)

    # run 1: the first chunk of events; run 2: the rest
    for run, cond in enumerate([F.col("chunk") == 0, F.col("chunk") > 0]):
        land(charts.filter(cond).drop("chunk"), f"{landing}/r{run}/market_chart")
        land(candles.filter(cond).drop("chunk"), f"{landing}/r{run}/candles")
        land(info if run == 0 else info.limit(0), f"{landing}/r{run}/info")
        dry = pipeline.ingest(spark, f"{landing}/r{run}", root, AS_OF, full_refresh=True,
                              dry_run=True)
        assert len(dry.preview) == 3 and dry.price_rows > 0
        res = pipeline.ingest(spark, f"{landing}/r{run}", root, AS_OF, full_refresh=True)
        assert res.price_rows == dry.price_rows and res.quarantined == dry.quarantined
        pipeline.build(spark, root, wl, AS_OF, mode=mode)

    good, _ = pl.split_payloads(charts.drop("chunk"), "market_chart")
    raw = pl.merge_ohlc(good, candles.drop("chunk"))
    expected = marts.fact_daily(staging.stage_prices(raw))
    got = spark.read.parquet(f"{root}/marts/fact_daily").select(*marts.FACT_COLUMNS)
    assert rows_of(got) == rows_of(expected)

    weekly = spark.read.parquet(f"{root}/marts/weekly")
    assert rows_of(weekly.select(*marts.WEEKLY_COLUMNS)) == \
        rows_of(marts.weekly_rollup(expected))
    dim = spark.read.parquet(f"{root}/marts/dim_assets")
    assert dim.count() == fx.f3_watchlist(spark, SF001).count()
    latest_cols = ["asset_id", "latest_price_date", "latest_close_usd",
                   "latest_market_cap_usd", "days_of_data"]
    exp_latest = marts.latest_price(staging.stage_prices(raw)) \
        .join(dim.select("asset_id"), "asset_id", "left_semi").select(*latest_cols)
    assert rows_of(dim.filter(F.col("latest_price_date").isNotNull()).select(*latest_cols)) \
        == rows_of(exp_latest)

    summary = {r.test_name: r for r in pipeline.check(spark, root, "2024-01-31 06:00:00")
               .collect()}
    assert summary["fact_daily.unique_asset_date"].failures == 0
    assert summary["stg_prices.unique_asset_date"].failures == 0
    assert summary["dim_assets.unique_asset_id"].failures == 0
    assert summary["freshness.prices"].status == "pass"
    late = {r.test_name: r for r in pipeline.check(spark, root, "2024-02-10 00:00:00").collect()}
    assert late["freshness.prices"].status == "error"

    # serving reads prune the date partitions of the stored fact
    daily = pipeline.load_daily_prices(spark, root, AS_OF, 7)
    plan = daily._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(price_date" in plan and "2024-01-24" in plan
    assert daily.count() == expected.filter(F.col("price_date") >= "2024-01-24").count()
    assert pipeline.load_dim_assets(spark, root).count() == dim.count()
    assert pipeline.load_weekly(spark, root, AS_OF).count() > 0
    assert pipeline.load_pipeline_status(spark, root, AS_OF).count() > 0


# ---- the daily run, late files and refreshes -------------------------------------

def chart(days, price):
    ms = lambda d: 1000.0 * (d - dt.date(1970, 1, 1)).days * 86400
    return {"prices": [[ms(d), price(d)] for d in days], "market_caps": [], "total_volumes": []}


def fetch(tmp, name, assets, fetched, days, price):
    """Land one fetch of the assets' charts; returns the landing folder."""
    for kind in ("market_chart", "candles", "info"):
        os.makedirs(tmp / name / kind)
        (tmp / name / kind / "none.json").write_text("")
    for a in assets:
        env = {"asset_id": a, "fetched_at": fetched, "payload": chart(days, price)}
        (tmp / name / "market_chart" / f"{a}.json").write_text(json.dumps(env) + "\n")
        info = {"asset_id": a, "fetched_at": fetched, "payload": {"id": a, "name": a.upper(), "symbol": a}}
        (tmp / name / "info" / f"{a}.json").write_text(json.dumps(info) + "\n")
    return str(tmp / name)


def daterange(first, last):
    return [first + dt.timedelta(days=k) for k in range((last - first).days + 1)]


@pytest.fixture()
def lake(spark, tmp_path):
    (tmp_path / "wl.csv").write_text("coin_id,name,symbol,category\n" + "".join(f"a{k},A{k},s{k},c\n" for k in range(3)))
    root = str(tmp_path / "lake")
    full = daterange(dt.date(2024, 1, 1), dt.date(2024, 4, 10))
    land0 = fetch(tmp_path, "full", ("a0", "a1", "a2"), "2024-04-10T06:00:00", full, lambda d: 10.0 + d.toordinal() % 17)
    pipeline.ingest(spark, land0, root, dt.date(2024, 4, 10), full_refresh=True)
    built = pipeline.build(spark, root, str(tmp_path / "wl.csv"), dt.date(2024, 4, 10))
    assert built["fact_rows_written"] == 303
    return tmp_path, root


def build_and_compare(spark, tmp, root, as_of):
    out = pipeline.build(spark, root, str(tmp / "wl.csv"), as_of)
    want = marts.fact_daily(pipeline.staged_prices(spark, root))
    assert rows_of(spark.read.parquet(f"{root}/marts/fact_daily").select(*marts.FACT_COLUMNS)) == rows_of(want)
    assert rows_of(spark.read.parquet(f"{root}/marts/weekly").select(*marts.WEEKLY_COLUMNS)) == rows_of(marts.weekly_rollup(want))
    return out


def test_two_daily_runs_then_an_older_fetch(spark, lake):
    tmp, root = lake
    assets = ("a0", "a1", "a2")
    for k, day in enumerate((dt.date(2024, 4, 11), dt.date(2024, 4, 12))):
        land_k = fetch(tmp, f"d{k}", assets, f"{day}T06:00:00", daterange(day - dt.timedelta(days=2), day),
                       lambda d: 10.0 + d.toordinal() % 17)
        assert pipeline.ingest(spark, land_k, root, day).price_rows == 9       # two days of history and today
        assert build_and_compare(spark, tmp, root, day)["fact_rows_written"] == 3
    # a file with older fetch times lands last: an asset never seen, and a value that must lose
    days = daterange(dt.date(2024, 4, 9), dt.date(2024, 4, 10))
    late = fetch(tmp, "late", ("a9", "a1"), "2024-04-09T01:00:00", days, lambda d: 77.0)
    pipeline.ingest(spark, late, root, dt.date(2024, 4, 11))
    build_and_compare(spark, tmp, root, dt.date(2024, 4, 12))
    fact = {(r.asset_id, r.price_date): r.close_usd for r in spark.read.parquet(f"{root}/marts/fact_daily").collect()}
    assert fact["a9", dt.date(2024, 4, 10)] == 77.0 and fact["a1", dt.date(2024, 4, 10)] != 77.0
    assert pipeline.build(spark, root, str(tmp / "wl.csv"), dt.date(2024, 4, 12))["fact_rows_written"] == 0


def test_refresh_of_a_subset_keeps_other_assets(spark, lake):
    tmp, root = lake
    day = dt.date(2024, 4, 10)
    short = daterange(dt.date(2024, 4, 1), day)
    again = fetch(tmp, "again", ("a0",), "2024-04-10T06:00:00", short, lambda d: 50.0)
    pipeline.ingest(spark, again, root, day, full_refresh=True, assets=["a0"])
    counts = {r.asset_id: r["count"] for r in spark.read.parquet(f"{root}/raw/prices").groupBy("asset_id").count().collect()}
    assert counts == {"a0": 10, "a1": 101, "a2": 101}
    meta = spark.read.parquet(f"{root}/raw/asset_metadata").groupBy("asset_id").count().collect()
    assert {r.asset_id: r["count"] for r in meta} == {"a0": 1, "a1": 1, "a2": 1}
    build_and_compare(spark, tmp, root, day)
    pipeline.ingest(spark, again, root, day, full_refresh=True, scope="all")
    assert {r.asset_id for r in spark.read.parquet(f"{root}/raw/prices").collect()} == {"a0"}
    assert spark.read.parquet(f"{root}/raw/asset_metadata").count() == 1
    build_and_compare(spark, tmp, root, day)


def test_declared_tests_can_fail(spark):
    from pricelake.operators import quality
    from pricelake.plans.queries import q_dq_summary
    got = {r.test_name: r.failures for r in q_dq_summary(spark, SF001).collect()}
    assert set(got) == {c.name for c in quality.declared_checks()} and len(got) >= 40
    assert got["raw_metadata.unique_asset_id"] > 0


def test_a_refresh_rewrites_only_its_series(spark, lake):
    """Partitions without the refreshed asset keep their files; one it alone held goes."""
    import glob
    tmp, root = lake
    early = fetch(tmp, "solo", ("a9",), "2024-02-03T06:00:00", daterange(dt.date(2023, 12, 30), dt.date(2024, 2, 3)), lambda d: 5.0 + d.day)
    pipeline.ingest(spark, early, root, dt.date(2024, 2, 3), full_refresh=True, assets=["a9"])
    build_and_compare(spark, tmp, root, dt.date(2024, 4, 10))
    files = lambda: {f for f in glob.glob(f"{root}/marts/fact_daily/*/*.parquet")}
    before = files()
    short = fetch(tmp, "short", ("a9",), "2024-02-03T06:00:00", daterange(dt.date(2024, 1, 20), dt.date(2024, 2, 2)), lambda d: 6.0 + d.day)
    pipeline.ingest(spark, short, root, dt.date(2024, 2, 3), full_refresh=True, assets=["a9"])
    out = build_and_compare(spark, tmp, root, dt.date(2024, 4, 10))
    kept = {f.split("price_date=")[1][:10] for f in before & files()}
    assert "2024-02-04" in kept and "2024-04-10" in kept and "2024-01-25" not in kept
    assert not glob.glob(f"{root}/marts/fact_daily/price_date=2023-12-30")
    assert out["fact_rows_written"] == 3 * 34 + 14                  # its 34 shared days (of 36) with the other three assets
    state = pipeline.series_state.load(spark, f"{root}/marts/fact_daily")
    assert {r.asset_id: (r.first_date, r.days) for r in state.collect()}["a9"] == (dt.date(2024, 1, 20), 14)
    assert pipeline.build(spark, root, str(tmp / "wl.csv"), dt.date(2024, 4, 10))["fact_rows_written"] == 0
