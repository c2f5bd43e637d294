import datetime as dt

import json

import pytest
from helpers import CANDLES, CHART, DAY1, DAY2, FETCHED, INFO, envelope_df

from pricelake.sources import payloads as pl

D = dt.date


def test_parse_market_chart_rows_and_fields(spark):
    df = envelope_df(spark, [("kelp", FETCHED, CHART)], None)
    rows = sorted(pl.parse_market_chart(df).collect(), key=lambda r: r.price_date)
    assert len(rows) == 3
    r = rows[0]
    assert (r.asset_id, r.price_date, r.close_usd, r.volume_usd, r.market_cap_usd) == \
        ("kelp", D(2024, 3, 4), 8.0, 31.0, 800.0)
    assert r.open_usd is None and r.high_usd is None and r.low_usd is None
    assert r.fetched_date == D(2024, 3, 8) and r.fetched_at == FETCHED
    assert [x.price_date for x in rows] == [D(2024, 3, 4), D(2024, 3, 5), D(2024, 3, 6)]


def test_empty_payload_gives_no_rows(spark):
    empty = {"prices": [], "market_caps": [], "total_volumes": []}
    df = envelope_df(spark, [("kelp", FETCHED, empty)], None)
    assert pl.parse_market_chart(df).count() == 0


def test_missing_volume_and_cap_are_null(spark):
    one = {"prices": [[DAY1, 8.0]], "market_caps": [], "total_volumes": []}
    r = pl.parse_market_chart(envelope_df(spark, [("kelp", FETCHED, one)], None)).collect()
    assert len(r) == 1 and r[0].volume_usd is None and r[0].market_cap_usd is None


def test_repeated_timestamp_last_wins(spark):
    dup = {"prices": [[DAY1, 1.0], [DAY1, 2.0]],
           "market_caps": [], "total_volumes": [[DAY1, 5.0],
                                                [DAY1, 6.0]]}
    r = pl.parse_market_chart(envelope_df(spark, [("x", FETCHED, dup)], None)).collect()
    assert len(r) == 1 and r[0].close_usd == 2.0 and r[0].volume_usd == 6.0


def test_merge_ohlc_sets_open_high_low_not_close(spark):
    ch = envelope_df(spark, [("kelp", FETCHED, CHART)], None)
    cd = envelope_df(spark, [("kelp", FETCHED, CANDLES)], None)
    rows = sorted(pl.merge_ohlc(ch, cd).collect(), key=lambda r: r.price_date)
    assert [(r.open_usd, r.high_usd, r.low_usd, r.close_usd) for r in rows] == [
        (7.5, 8.25, 7.25, 8.0), (8.5, 10.5, 8.0, 10.0), (10.25, 10.75, 9.0, 9.5)]


def test_merge_last_candle_of_a_date_wins(spark):
    two = [[DAY1, 1.0, 2.0, 0.5, 1.5], [DAY1 + 39e6, 3.0, 4.0, 2.5, 3.5]]
    ch = envelope_df(spark, [("b", FETCHED, CHART)], None)
    cd = envelope_df(spark, [("b", FETCHED, two)], None)
    r = [x for x in pl.merge_ohlc(ch, cd).collect() if x.price_date == D(2024, 3, 4)][0]
    assert (r.open_usd, r.high_usd, r.low_usd) == (3.0, 4.0, 2.5)


def test_bad_candle_payload_keeps_prices(spark):
    bad = [[DAY1, 1.0, 2.0, 0.5]]
    ch = envelope_df(spark, [("b", FETCHED, CHART)], None)
    cd = envelope_df(spark, [("b", FETCHED, bad)], None)
    rows = pl.merge_ohlc(ch, cd).collect()
    assert len(rows) == 3 and all(r.open_usd is None for r in rows)


def test_parse_metadata(spark):
    r = pl.parse_metadata(envelope_df(spark, [("kelp", FETCHED, INFO)], None)).collect()[0]
    assert (r.asset_id, r.name, r.symbol, r.genesis_date, r.ath_usd, r.ath_date) == \
        ("kelp", "Kelp Coin", "klp", D(2016, 5, 17), 12.75, D(2021, 9, 30))


def test_bad_ath_date_is_null(spark):
    info = dict(INFO, market_data={"ath": {"usd": 1.0}, "ath_date": {"usd": "garbage"}})
    r = pl.parse_metadata(envelope_df(spark, [("b", FETCHED, info)], None)).collect()[0]
    assert r.ath_date is None and r.ath_usd == 1.0


def test_quarantine_split(spark):
    data = [("a", FETCHED, json.dumps(CHART)), ("b", FETCHED, json.dumps(CHART)[:20])]
    df = spark.createDataFrame(data, "asset_id string, fetched_at timestamp_ntz, payload string")
    good, bad = pl.split_payloads(df, "market_chart")
    assert [r.asset_id for r in good.collect()] == ["a"]
    b = bad.collect()
    assert [(r.asset_id, r.reason) for r in b] == [("b", "unparseable")]


def test_stamp_batch(spark):
    df = envelope_df(spark, [("kelp", FETCHED, CHART)], None)
    out = pl.stamp_batch(pl.parse_market_chart(df), "2024-02-01T06:00:00+00:00").collect()
    assert {(r.fetched_at, r.fetched_date) for r in out} == \
        {(dt.datetime(2024, 2, 1, 6), D(2024, 2, 1))}


def test_read_payload_files_with_corrupt_line(spark, tmp_path):
    from pricelake.sources.files import read_payloads
    good = {"asset_id": "a", "fetched_at": "2024-01-15T06:00:00", "payload": CHART}
    (tmp_path / "a.json").write_text(json.dumps(good) + "\n")
    (tmp_path / "b.json").write_text('{"asset_id": "b", "payload": {"prices": [[1\n')
    g, q = read_payloads(spark, str(tmp_path), "market_chart")
    assert [r.asset_id for r in g.collect()] == ["a"]
    bad = q.collect()
    assert len(bad) == 1 and bad[0].source_file.endswith("b.json")


def test_read_watchlist_by_header_name(spark, tmp_path):
    from pricelake.sources.files import read_watchlist
    p = tmp_path / "wl.csv"
    p.write_text("name,category,coin_id,note,symbol\nKelp Coin,sea,kelp,x,KLP\nReef,sea,reef,,RF\n")
    rows = read_watchlist(spark, str(p)).collect()
    assert [tuple(r) for r in rows] == [("kelp", "Kelp Coin", "KLP", "sea"), ("reef", "Reef", "RF", "sea")]
    assert read_watchlist(spark, str(p), id_column="note").columns == ["asset_id", "name", "symbol", "category"]


def test_merge_resample_ohlc(spark):
    two = [[DAY1, 1.0, 2.0, 0.5, 1.5], [DAY1 + 39e6, 3.0, 4.0, 0.7, 3.5],
           [DAY2, 7.0, 8.0, 6.0, 7.5]]
    ch = envelope_df(spark, [("b", FETCHED, CHART)], None)
    cd = envelope_df(spark, [("b", FETCHED, two)], None)
    got = {x.price_date: (x.open_usd, x.high_usd, x.low_usd)
           for x in pl.merge_ohlc(ch, cd, resample="ohlc").collect()}
    assert got[D(2024, 3, 4)] == (1.0, 4.0, 0.5)
    assert got[D(2024, 3, 5)] == (7.0, 8.0, 6.0)
    assert got[D(2024, 3, 6)] == (None, None, None)


BAD_CHARTS = [
    ({"prices": [[DAY1, 1.0], []]}, "point_shape"),
    ({"prices": [[DAY1, 1.0], [DAY2]]}, "point_shape"),
    ({"prices": [[DAY1, 1.0], None]}, "point_shape"),
    ({"prices": [[None, 1.0]]}, "point_shape"),
    ({"prices": [[DAY1, 1.0]], "total_volumes": [[DAY1]]}, "volume_shape"),
    ({"prices": [[DAY1, 1.0]], "total_volumes": [[None, 2.0]]}, "volume_shape"),
    ({"prices": [[DAY1, 1.0]], "market_caps": [[None, 2.0]]}, "cap_shape"),
    ({"prices": [[DAY1, 1.0]], "market_caps": [None]}, "cap_shape"),
    ({"prices": None}, "unparseable"),
]
BAD_CANDLES = [[[None, 1.0, 2.0, 0.5, 1.0]], [None], [[]], [[DAY1, 1.0, 2.0, 0.5]]]


def test_each_malformed_shape_costs_one_fetch(spark):
    charts = envelope_df(spark, [("good", FETCHED, CHART)] + [(f"c{k}", FETCHED, c) for k, (c, _) in enumerate(BAD_CHARTS)], None)
    good, bad = pl.split_payloads(charts, "market_chart")
    assert [r.asset_id for r in good.collect()] == ["good"]
    assert {r.asset_id: r.reason for r in bad.collect()} == {f"c{k}": why for k, (_, why) in enumerate(BAD_CHARTS)}
    assert pl.parse_market_chart(good).count() == 3
    candles = envelope_df(spark, [("good", FETCHED, CANDLES)] + [(f"k{k}", FETCHED, c) for k, c in enumerate(BAD_CANDLES)], None)
    good, bad = pl.split_payloads(candles, "candles")
    assert [r.asset_id for r in good.collect()] == ["good"]
    assert {(r.asset_id, r.reason) for r in bad.collect()} == {(f"k{k}", "candle_arity") for k in range(len(BAD_CANDLES))}
    # unsplit candles: a malformed payload yields no map and raises nothing
    assert [r.asset_id for r in pl.candles_by_date(candles).collect()] == ["good"]


@pytest.mark.parametrize("kind,rows", [("market_chart", BAD_CHARTS), ("candles", [(c, "") for c in BAD_CANDLES])])
def test_malformed_files_are_quarantined(spark, tmp_path, kind, rows):
    from pricelake.sources.files import read_payloads
    for k, (c, _) in enumerate([*rows, (CHART if kind == "market_chart" else CANDLES, None)]):
        (tmp_path / f"{k}.json").write_text(json.dumps({"asset_id": f"a{k}", "fetched_at": "2024-03-08T06:00:00", "payload": c}) + "\n")
    g, q = read_payloads(spark, str(tmp_path), kind)
    assert [r.asset_id for r in g.collect()] == [f"a{len(rows)}"] and q.count() == len(rows)


def test_a_payload_delivered_twice_counts_once(spark):
    ch = envelope_df(spark, [("b", FETCHED, CHART)] * 2, None)
    cd = envelope_df(spark, [("b", FETCHED, CANDLES)] * 3, None)
    assert pl.merge_ohlc(ch, cd).count() == 3
    assert pl.merge_ohlc(ch, None).count() == 3


def test_long_payload_equals_a_plain_merge(spark):
    import random
    r = random.Random(3)
    times = [DAY1 + 3_600_000 * r.randrange(3000) for _ in range(6000)]
    prices = [[t, r.random()] for t in times]
    vols = [[t, r.random()] for t in r.sample(times, 2500)]
    caps = [[t, r.random()] for t in r.sample(times, 2500)] + [[DAY1 - 1, 5.0]]
    got = pl.parse_market_chart(envelope_df(spark, [("b", FETCHED, {
        "prices": prices, "total_volumes": vols, "market_caps": caps})], None)).collect()
    p, v, c = dict(map(tuple, prices)), dict(map(tuple, vols)), dict(map(tuple, caps))
    epoch = dt.datetime(1970, 1, 1)
    want = {epoch + dt.timedelta(milliseconds=t): (x, v.get(t), c.get(t)) for t, x in p.items()}
    assert {r.source_ts: (r.close_usd, r.volume_usd, r.market_cap_usd) for r in got} == want and len(got) == len(want)
