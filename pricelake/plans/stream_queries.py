"""Registered queries that run: the streaming jobs over landed copies of the
given tables, each to its end, the CSV reader, a stored round trip and a bucketed copy. Their
files go to the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake import schemas
from pricelake.functions import week_start
from pricelake.operators import marts, staging
from pricelake.plans.common import rounded
from pricelake.plans.queries import register
from pricelake.session import scratch_path
from pricelake.sources import files, layout, sinks, versioned
from pricelake.sources import fixtures as fx
from pricelake.streaming import jobs

STREAM_RUNS = 3         # deliveries of a landed stream


def _folder(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def _delivered(raw: DataFrame, name: str, by: str, run) -> None:
    """``raw`` as a stream: dealt by the hash of ``by`` into deliveries that land one
    after the other, each in files by its size; ``run(stream)`` starts the job, which
    takes up what is new each time."""
    spark = raw.sparkSession
    dealt = sinks.staged_copy(spark, raw.withColumn("__run", F.pmod(F.xxhash64(by), F.lit(STREAM_RUNS))), name)
    path = _folder(spark, name)
    for k in range(STREAM_RUNS):
        dealt.filter(F.col("__run") == k).drop("__run").write.parquet(f"{path}/{k}")
        run(spark.readStream.schema(raw.schema).parquet(f"{path}/*")).awaitTermination()


def _lines(payloads: DataFrame) -> DataFrame:
    """Envelopes as JSON lines, the payload text as it is."""
    at = F.date_format("fetched_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return payloads.select(F.concat(F.lit('{"asset_id": "'), "asset_id", F.lit('", "fetched_at": "'), at,
                                    F.lit('", "payload": '), "payload", F.lit("}")).alias("value"))


@register("q_watchlist_scan")
def q_watchlist_scan(spark, sf):
    """The watchlist as a CSV with its columns in another order, read by header."""
    path = _folder(spark, "watchlist")
    fx.f3_watchlist(spark, sf).select("category", F.col("asset_id").alias("coin_id"), "symbol", "name") \
        .write.option("header", True).csv(path)
    return staging.typed(files.read_watchlist(spark, path), schemas.WATCHLIST)


@register("q_table_roundtrip")
def q_table_roundtrip(spark, sf):
    """Raw prices into a table created first, guarded by its schema, partitioned by
    fetch year and clustered by asset; read back by name with the written count."""
    path = _folder(spark, "roundtrip")
    raw = fx.f1_raw_prices(spark, sf).select(*schemas.PRICE_COLUMNS).withColumn("fetch_year", F.year("fetched_date"))
    sinks.ensure_table(spark, path, raw.schema, ["fetch_year"])
    sinks.check_schema(raw.schema, raw.schema)
    n = sinks.write_table(raw, path, "append", ["fetch_year"], ["asset_id"])
    n += sinks.write_table(raw.limit(0), path, "append", ["fetch_year"], ["asset_id"])      # an empty batch writes nothing
    back = sinks.read_table(spark, path, raw.schema)
    return rounded(back.select(*schemas.PRICE_COLUMNS, F.lit(n).cast("long").alias("rows_written")))


@register("q_weekly_bucketed")
def q_weekly_bucketed(spark, sf):
    """The weekly roll-up over a bucketed copy of the fact: no exchange."""
    name = f"fact_{uuid.uuid4().hex}"
    fact = marts.fact_daily(staging.stage_prices(fx.f1_raw_prices(spark, sf), tiebreak=fx.F1_TIEBREAK))
    table = layout.write_bucketed(fact, name, _folder(spark, name), int(spark.conf.get("spark.sql.shuffle.partitions")))
    return rounded(marts.weekly_rollup(table))


@register("q_stream_raw")
def q_stream_raw(spark, sf):
    """Landed chart files, some malformed, through the raw stream."""
    landing, out = _folder(spark, "landing"), _folder(spark, "stream-raw")
    _lines(fx.f4_chart_payloads(spark, sf)).write.text(landing)
    jobs.stream_raw(spark, landing, out, f"{out}-checkpoint").awaitTermination()
    return rounded(spark.read.parquet(out).select(*schemas.PRICE_COLUMNS, "source_ts"))


@register("q_stream_ingest")
def q_stream_ingest(spark, sf):
    """Landed chart files with the candle files of the same fetches."""
    landing, out = _folder(spark, "landing"), _folder(spark, "stream-ingest")
    _lines(fx.f4_chart_payloads(spark, sf)).write.text(f"{landing}/market_chart")
    _lines(fx.f4_candle_payloads(spark, sf)).write.text(f"{landing}/candles")
    jobs.stream_ingest(spark, landing, out, f"{out}-checkpoint").awaitTermination()
    return rounded(spark.read.parquet(out).select(*schemas.PRICE_COLUMNS, "source_ts"))


@register("q_stream_quarantine")
def q_stream_quarantine(spark, sf):
    """What the two-table stream quarantines of the landed chart files."""
    landing, out = _folder(spark, "landing"), _folder(spark, "stream-landed")
    _lines(fx.f4_chart_payloads(spark, sf)).write.text(landing)
    jobs.stream_landed(spark, landing, f"{out}/rows", f"{out}/bad", f"{out}/checkpoint").awaitTermination()
    bad = spark.read.parquet(f"{out}/bad")
    # a line that is no JSON has only its text
    at = F.to_timestamp_ntz(F.regexp_extract("payload_text", '"fetched_at": "([^"]*)"', 1), F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    return bad.select(F.coalesce("asset_id", F.regexp_extract("payload_text", '"asset_id": "([^"]*)"', 1)).alias("asset_id"),
                      F.coalesce("fetched_at", at).alias("fetched_at"), "kind", "reason")


@register("q_stream_upsert")
def q_stream_upsert(spark, sf):
    """Versions of one day in different deliveries: the newest stays."""
    out = _folder(spark, "stream-upsert")
    _delivered(fx.f2_raw_prices(spark, sf, by="event_type"), "stream-in", "source_ts",
               lambda stream: jobs.stream_upsert(spark, stream, out, f"{out}-checkpoint"))
    return rounded(versioned.read(spark, out, "price_date").select("asset_id", "price_date", "close_usd", "fetched_at"))


@register("q_stream_weekly")
def q_stream_weekly(spark, sf):
    """Whole weeks in deliveries out of order: most come late, are stored and merged.
    A far later row of each asset closes all weeks."""
    out = _folder(spark, "stream-weekly")
    fact = marts.fact_daily(staging.stage_prices(fx.f2_raw_prices(spark, sf, by="event_type"), tiebreak=fx.F2_TIEBREAK))
    last = fact.groupBy("asset_id").agg(F.max("price_date").alias("price_date")).withColumn(
        "price_date", F.date_add("price_date", 100))
    fact = fact.unionByName(last, allowMissingColumns=True).withColumn("__week", week_start("price_date"))
    _delivered(fact, "stream-in", "__week",
               lambda stream: jobs.stream_weekly(spark, stream, out, f"{out}-checkpoint", late="merge"))
    return rounded(jobs.read_weekly(spark, out).select(*marts.WEEKLY_COLUMNS))


@register("q_stream_features")
def q_stream_features(spark, sf):
    """The daily fact from deliveries of whole days in any order: late days
    are computed in, and what follows them again."""
    out = _folder(spark, "stream-features")
    _delivered(fx.f2_raw_prices(spark, sf, by="event_type"), "stream-in", "price_date",
               lambda stream: jobs.stream_features(spark, stream, out, f"{out}-checkpoint", tiebreak=fx.F2_TIEBREAK))
    return rounded(spark.read.parquet(out).select(*marts.FACT_COLUMNS))
