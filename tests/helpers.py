"""Shared inputs of the price engine's tests."""

import datetime as dt

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

# Three daily points of an invented asset, its candles and its info.
DAY1, DAY2, DAY3 = 1709510400000.0, 1709596800000.0, 1709683200000.0      # 2024-03-04, -05, -06
CHART = {
    "prices": [[DAY1, 8.0], [DAY2, 10.0], [DAY3, 9.5]],
    "market_caps": [[DAY1, 800.0], [DAY2, 1000.0], [DAY3, 950.0]],
    "total_volumes": [[DAY1, 31.0], [DAY2, 47.0], [DAY3, 29.0]],
}
CANDLES = [[DAY1, 7.5, 8.25, 7.25, 8.0], [DAY2, 8.5, 10.5, 8.0, 10.0], [DAY3, 10.25, 10.75, 9.0, 9.5]]
INFO = {"id": "kelp", "name": "Kelp Coin", "symbol": "klp", "genesis_date": "2016-05-17",
        "market_data": {"ath": {"usd": 12.75}, "ath_date": {"usd": "2021-09-30T18:45:02.120Z"}}}
FETCHED = dt.datetime(2024, 3, 8, 6, 0, 0)


def envelope_df(spark, rows, payload_ddl):
    """rows: list of (asset_id, fetched_at, payload python object)."""
    import json
    data = [(a, f, json.dumps(p)) for a, f, p in rows]
    df = spark.createDataFrame(data, "asset_id string, fetched_at timestamp_ntz, payload string")
    return df


def price_rows(spark, rows):
    """rows: (asset_id, date, close, fetched_at[, volume, cap])"""
    from pricelake import schemas
    full = []
    for r in rows:
        a, d, c, f = r[:4]
        v = r[4] if len(r) > 4 else None
        m = r[5] if len(r) > 5 else None
        full.append((a, d, None, None, None, c, v, m, f.date(), f))
    from pyspark.sql.types import StructField, StructType
    loose = StructType([StructField(f.name, f.dataType, True) for f in schemas.RAW_PRICES.fields])
    return spark.createDataFrame(full, loose)
