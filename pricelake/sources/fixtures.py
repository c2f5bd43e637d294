"""Adapters from the shared test tables to the engine's input shapes.

Each adapter is a plain projection (plus, for payloads, a bounded grouping) of
the given tables, so its work grows with them. Timestamps in the tables are
wall-clock UTC (``timestamp_ntz``) and stay so.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.functions import as_ts_lit, ntz_to_epoch_ms

# Fixed parameters of the fixtures.
F1_AS_OF = dt.date(2001, 11, 5)          # day after the last ship date
F2_AS_OF = dt.date(2024, 1, 31)          # day after the last event
F1_TIEBREAK = ["src_orderkey", "src_partkey", "close_usd"]
F2_TIEBREAK = ["source_ts"]
#: Events (of all series) a landed payload covers, and the series they fall in:
#: about 400 points a payload, whatever the number of events.
PAYLOAD_CHUNK_EVENTS, PAYLOAD_SERIES = 2048, 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One shared table, as it is; a DataFrame is an immutable plan, so it is
    reused within its session."""
    key = (id(spark), f"{sf_dir.rstrip('/')}/{name}.parquet")
    if key not in _TABLES or _TABLES[key][0] is not spark:
        _TABLES[key] = (spark, spark.read.parquet(key[1]))
    return _TABLES[key][1]


_TABLES: dict = {}


def f1_raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw price rows from ``lineitem``: one row per line, several per day.

    ``fetched_at`` = ship date + line number hours; the source keys ride along
    as tie-break columns so the newest-version pick is total.
    """
    li = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice")
    fetched_at = F.col("l_shipdate") + F.make_dt_interval(
        F.lit(0), F.col("l_linenumber"), F.lit(0), F.lit(0))
    return li.select(
        F.col("l_suppkey").cast("string").alias("asset_id"),
        F.col("l_shipdate").cast("date").alias("price_date"),
        (price * (1 - F.col("l_discount"))).alias("open_usd"),
        (price * (1 + F.col("l_tax"))).alias("high_usd"),
        F.when(F.col("l_returnflag") != "N", price * (1 - F.col("l_tax"))).alias("low_usd"),
        price.alias("close_usd"),
        F.when(F.col("l_discount") != 0, F.col("l_quantity") * price).alias("volume_usd"),
        F.when(F.col("l_returnflag") != "R", F.col("l_quantity") * F.lit(1e6))
        .alias("market_cap_usd"),
        fetched_at.cast("date").alias("fetched_date"),
        fetched_at.alias("fetched_at"),
        F.col("l_orderkey").alias("src_orderkey"),
        F.col("l_partkey").alias("src_partkey"),
    )


def f2_raw_prices(spark: SparkSession, sf_dir: str, by: str = "user_id") -> DataFrame:
    """Dense short series from ``events``: ``by`` = user_id (150 gappy series at
    sf0.01) or event_type (5 series, every day present)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col(by).cast("string").alias("asset_id"),
        F.col("ts").cast("date").alias("price_date"),
        F.lit(None).cast("double").alias("open_usd"),
        F.lit(None).cast("double").alias("high_usd"),
        F.lit(None).cast("double").alias("low_usd"),
        F.col("value").alias("close_usd"),
        F.lit(None).cast("double").alias("volume_usd"),
        F.lit(None).cast("double").alias("market_cap_usd"),
        F.col("ts").cast("date").alias("fetched_date"),
        F.col("ts").alias("fetched_at"),
        F.col("ts").alias("source_ts"),
    )


def f3_watchlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watchlist from ``supplier`` x ``nation`` (nation is a fixed 25-row table)."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    return s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey, "left").select(
        F.col("s_suppkey").cast("string").alias("asset_id"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("symbol"),
        F.col("n_name").alias("category"),
    )


F3_FETCH_NEW = dt.datetime(2001, 11, 4, 6, 0, 0)
F3_FETCH_OLD = dt.datetime(2001, 11, 3, 6, 0, 0)


def f3_info_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Asset-info payload text per supplier, two fetches one day apart.

    Suppliers of region 0 have no info (so joins miss); a low balance drops
    the symbol; nation 7 has no genesis date; a negative balance gives an
    unparseable ATH date. The older fetch has ATH 0 (it must lose).
    """
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    s = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey, "inner") \
        .filter(F.col("n_regionkey") != 0)
    key = F.col("s_suppkey")
    genesis = F.when(F.col("s_nationkey") != 7,
                     F.date_format(F.date_add(F.lit(dt.date(1990, 1, 1)), key.cast("int")),
                                   "yyyy-MM-dd"))
    ath_date = F.when(F.col("s_acctbal") >= 0,
                      F.concat(F.date_format(F.date_add(F.lit(dt.date(1999, 1, 1)),
                                                        key.cast("int")), "yyyy-MM-dd"),
                               F.lit("T07:10:36.635Z"))).otherwise(F.lit("garbage"))
    symbol = F.when(F.col("s_acctbal") >= 1000,
                    F.lower(F.concat(F.lit("S"), key.cast("string"))))

    def payload(ath):
        return F.to_json(F.struct(
            key.cast("string").alias("id"), F.lower("s_name").alias("name"),
            symbol.alias("symbol"), genesis.alias("genesis_date"),
            F.struct(F.struct(ath.alias("usd")).alias("ath"),
                     F.struct(ath_date.alias("usd")).alias("ath_date")).alias("market_data")))

    new = s.select(key.cast("string").alias("asset_id"),
                   as_ts_lit(F3_FETCH_NEW).alias("fetched_at"),
                   payload(F.abs("s_acctbal")).alias("payload"))
    old = s.select(key.cast("string").alias("asset_id"),
                   as_ts_lit(F3_FETCH_OLD).alias("fetched_at"),
                   payload(F.lit(0.0)).alias("payload"))
    return new.unionByName(old)


def _events_chunked(spark: SparkSession, sf_dir: str, chunk_events: int) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.concat(F.lit("u"), (F.col("user_id") % PAYLOAD_SERIES).cast("string")).alias("asset_id"),
        F.floor(F.col("event_id") / chunk_events).alias("chunk"),
        "event_id", "ts", "event_type", "value",
        ntz_to_epoch_ms("ts").alias("ts_ms"),
    )


def f4_chart_payloads(spark: SparkSession, sf_dir: str, chunk_events: int = PAYLOAD_CHUNK_EVENTS) -> DataFrame:
    """Market-chart payload text per (series, chunk of event ids), points in event order.

    Volumes are reported for every event except views; caps are never
    reported. A payload whose first event is an error is malformed, in one of
    four ways by its chunk: truncated text, a price without members, a volume
    of one member, a cap without a time. Grouping by event-id chunk bounds every
    payload whatever the series' share of events.
    """
    e = _events_chunked(spark, sf_dir, chunk_events)
    pt = F.struct(F.col("event_id"),
                  F.array(F.col("ts_ms").cast("double"), F.col("value")).alias("p"),
                  (F.col("event_type") != "view").alias("has_vol"),
                  F.col("event_type").alias("kind"))
    g = e.groupBy("asset_id", "chunk").agg(
        F.array_sort(F.collect_list(pt)).alias("pts"),
        F.max("ts").alias("fetched_at"))
    prices = F.transform("pts", lambda x: x["p"])
    vols = F.transform(F.filter("pts", lambda x: x["has_vol"]), lambda x: x["p"])
    none = F.array().cast("array<array<double>>")
    odd = F.when(F.col("pts")[0]["kind"] == "error", F.col("chunk") % 4).otherwise(F.lit(-1))
    zero = F.lit(0.0)
    doc = F.to_json(F.struct(
        F.when(odd == 1, F.concat(prices, F.array(F.array().cast("array<double>")))).otherwise(prices).alias("prices"),
        F.when(odd == 3, F.array(F.array(F.lit(None).cast("double"), zero))).otherwise(none).alias("market_caps"),
        F.when(odd == 2, F.concat(vols, F.array(F.array(zero)))).otherwise(vols).alias("total_volumes")))
    text = F.when(odd == 0, F.substring(doc, 1, F.floor(F.length(doc) / 2).cast("int"))).otherwise(doc)
    return g.select("asset_id", "chunk", "fetched_at", text.alias("payload"))


def f4_candle_payloads(spark: SparkSession, sf_dir: str, chunk_events: int = PAYLOAD_CHUNK_EVENTS) -> DataFrame:
    """Candle payload text per (series, chunk): one [ts, v, 1.1v, 0.9v, v] per event.

    A payload whose first event is a signup is malformed: with an even chunk its
    candles have four members, with an odd one the last candle has no time.
    """
    e = _events_chunked(spark, sf_dir, chunk_events)
    c = F.struct(F.col("event_id"),
                 F.array(F.col("ts_ms").cast("double"), F.col("value"),
                         F.col("value") * 1.1, F.col("value") * 0.9, F.col("value")).alias("c"),
                 F.col("event_type").alias("kind"))
    g = e.groupBy("asset_id", "chunk").agg(F.array_sort(F.collect_list(c)).alias("cs"),
                                           F.max("ts").alias("fetched_at"))
    signup, even = F.col("cs")[0]["kind"] == "signup", F.col("chunk") % 2 == 0
    zero = F.lit(0.0)
    candles = F.transform("cs", lambda x: F.when(signup & even, F.slice(x["c"], 1, 4)).otherwise(x["c"]))
    candles = F.when(signup & ~even, F.concat(candles, F.array(F.array(F.lit(None).cast("double"), zero, zero, zero, zero)))) \
        .otherwise(candles)
    return g.select("asset_id", "chunk", "fetched_at", F.to_json(candles).alias("payload"))
