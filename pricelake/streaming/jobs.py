"""Structured Streaming versions of ingestion, upsert, weekly roll-up and
incremental features.

The daily batch maps onto streams as follows:

* ``stream_raw``: landed payload files -> parsed raw rows, appended
  (stateless; exactly-once through the checkpoint and the file sink log);
* ``stream_ingest``: the same with the candle merge, per micro-batch, into a
  folder of the epoch (a replayed epoch replaces its own rows);
* ``stream_upsert``: each micro-batch is deduplicated and merged into the
  keyed table, newest version wins (``foreachBatch``; replaying an epoch
  gives the same table);
* ``stream_landed``: the same into two tables, rows and quarantined lines, each
  micro-batch replaced as a whole when it is done again;
* ``stream_weekly``: Sunday-aligned 7-day event-time windows with a watermark
  bounding late data, which is dropped, or stored and merged into its weeks;
* ``stream_features``: row-frame windows are not allowed on streams, so each
  micro-batch computes features from each touched asset's first incoming
  date on, after the 30 rows its stored state keeps (``foreachBatch``).

Every job needs the caller's checkpoint folder: a restart under another one would
read all files again.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, LongType, StructField, StructType

from pricelake import schemas
from pricelake.functions import pct_change, week_start
from pricelake.operators import marts, staging
from pricelake.plans import incremental, series_state
from pricelake.sources import files, payloads, sinks, versioned


def _started(w, checkpoint: str, available_now: bool) -> StreamingQuery:
    if not checkpoint:
        raise ValueError("a stream needs a checkpoint folder that stays the same over restarts")
    w = w.option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def _good_charts(landed: DataFrame) -> DataFrame:
    """Well-formed chart payloads of a landed stream, by the same split as in
    batch; ``sources.files.read_payloads`` reports the others."""
    src = landed.filter(F.col("_corrupt_record").isNull() & F.col("asset_id").isNotNull()).drop("_corrupt_record")
    return payloads.split_payloads(src, "market_chart")[0]


def read_landed(spark: SparkSession, landing_dir: str, kind: str = "market_chart",
                max_files: int | None = None) -> DataFrame:
    """Streaming read of landed envelope files (one JSON object per line)."""
    r = (spark.readStream.schema(schemas.envelope(kind))
         .option("mode", "PERMISSIVE")
         .option("columnNameOfCorruptRecord", "_corrupt_record"))
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.json(landing_dir)


def stream_raw(spark: SparkSession, landing_dir: str, out_path: str,
               checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Landed chart payloads -> raw price rows appended to ``out_path``
    (partitioned by fetch date). Malformed payloads are left to the batch
    quarantine."""
    rows = payloads.parse_market_chart(_good_charts(read_landed(spark, landing_dir, "market_chart")))
    w = (rows.writeStream.format("parquet").option("path", out_path)
         .partitionBy("fetched_date").outputMode("append"))
    return _started(w, checkpoint, available_now)


def stream_landed(spark: SparkSession, landing_dir: str, out_path: str, quarantine_path: str,
                  checkpoint: str, available_now: bool = True, max_files: int | None = None) -> StreamingQuery:
    """Landed chart payloads -> raw price rows in ``out_path`` and what is bad, line
    by line, in ``quarantine_path``. Both are written per micro-batch, under
    ``ingest_epoch=<n>``: one that is done again replaces what it had written to
    either, so no line is in both, lost or there twice."""
    lines = spark.readStream.option("maxFilesPerTrigger", max_files or 1000).text(landing_dir).select("value", "_metadata")

    def split(batch: DataFrame, epoch_id: int) -> None:
        good, bad = files.split_lines(batch, "market_chart")
        rows = payloads.parse_market_chart(good).select(*schemas.PRICE_COLUMNS, "source_ts")
        # good rows last: they tell that the epoch is whole
        sinks.write_table(bad, f"{quarantine_path}/ingest_epoch={epoch_id}", "overwrite", guard_empty=False)
        sinks.write_table(rows, f"{out_path}/ingest_epoch={epoch_id}", "overwrite", ["fetched_date"], ["asset_id"], guard_empty=False)

    return _started(lines.writeStream.foreachBatch(split), checkpoint, available_now)


def stream_ingest(spark: SparkSession, landing: str, raw_path: str,
                  checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Landed chart payloads under ``landing/market_chart`` as a stream; each
    micro-batch looks up the candle payloads of the same fetches in
    ``landing/candles`` (a semi join on the fetch keys, so only those files'
    rows are kept), merges them and writes the rows to ``raw_path`` under
    ``ingest_epoch=<n>/fetched_date=<d>``: an epoch that is replayed replaces what
    it had written."""
    def merge(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        keys = list(payloads.ENVELOPE_KEYS)
        cands, _ = files.read_payloads(session, f"{landing}/candles", "candles")
        cands = cands.join(batch.select(*keys).distinct(), keys, "left_semi")
        rows = payloads.merge_ohlc(batch, cands).select(*schemas.PRICE_COLUMNS, "source_ts")
        sinks.write_table(rows, f"{raw_path}/ingest_epoch={epoch_id}", "overwrite", ["fetched_date"], ["asset_id"])

    w = _good_charts(read_landed(spark, f"{landing}/market_chart", "market_chart")).writeStream.foreachBatch(merge)
    return _started(w, checkpoint, available_now)


def stream_upsert(spark: SparkSession, raw_stream: DataFrame, target_path: str,
                  checkpoint: str, tiebreak: Sequence[str] = ("source_ts",),
                  available_now: bool = True) -> StreamingQuery:
    """Each micro-batch: stage (type, filter, keep latest per key), then merge
    into the versioned table at ``target_path`` (``sources.versioned``,
    partitioned by ``price_date``) keeping the newest ``fetched_at``. The tie-break columns are
    stored too, so a tie over two micro-batches is resolved as within one, in any
    order of arrival and on a replay. Readers see whole micro-batches only; one
    that is lost half-way leaves the version before it."""
    kept = [c for c in tiebreak if c in raw_stream.columns and c not in schemas.PRICE_COLUMNS]
    order = ["fetched_at", *[c for c in tiebreak if c in raw_stream.columns], *staging.VALUE_ORDER]

    def merge(batch: DataFrame, epoch_id: int) -> None:
        staged = staging.stage_prices(batch, tiebreak=tiebreak, keep=kept)
        versioned.upsert(batch.sparkSession, target_path, staged, ["asset_id", "price_date"], "price_date",
                         order=order, sort_within=["asset_id"])

    return _started(raw_stream.writeStream.foreachBatch(merge), checkpoint, available_now)


def weekly_stream(fact_stream: DataFrame, watermark: str = "14 days") -> DataFrame:
    """Streaming weekly roll-up. 1970-01-01 was a Thursday, so 7-day windows
    shifted by 3 days start on Sunday."""
    # the UTC-midnight instant of the date, built from epoch seconds so the
    # session time zone plays no part (watermarks need TIMESTAMP, not NTZ)
    ts = F.timestamp_seconds(F.unix_date(F.col("price_date")).cast("bigint") * 86400)
    d = (fact_stream.withColumn("__ts", ts).withWatermark("__ts", watermark))
    agg = d.groupBy(F.window("__ts", "7 days", startTime="3 days").alias("__w"),
                    "asset_id").agg(
        F.min("close_usd").alias("weekly_low"),
        F.max("close_usd").alias("weekly_high"),
        F.avg("close_usd").alias("weekly_avg_close"),
        F.sum("volume_usd").alias("weekly_volume"),
        F.avg("market_cap_usd").alias("avg_market_cap"),
        F.stddev_samp("daily_return_pct").alias("weekly_return_stddev"),
        F.avg("annualised_volatility_30d").alias("avg_annualised_volatility_30d"),
        F.count(F.lit(1)).alias("trading_days"),
        F.min_by("close_usd", "price_date").alias("__open"),
        F.max_by("close_usd", "price_date").alias("__close"))
    return agg.select(
        "asset_id",
        F.date_add(F.lit(dt.date(1970, 1, 1)),
                   F.floor(F.unix_seconds(F.col("__w.start")) / 86400).cast("int"))
        .alias("week_start"),
        "weekly_low", "weekly_high", "weekly_avg_close", "weekly_volume", "avg_market_cap",
        "weekly_return_stddev",
        (F.col("weekly_return_stddev") * F.lit(math.sqrt(52))).alias(
            "annualised_volatility_weekly"),
        "avg_annualised_volatility_30d", "trading_days",
        pct_change("__close", "__open").alias("weekly_return_pct"))


#: What the roll-up needs of a day.
WEEK_ROWS = ["asset_id", "price_date", "close_usd", "daily_return_pct", "volume_usd", "market_cap_usd", "annualised_volatility_30d"]
EPOCHS = StructType([StructField("until", DateType()), StructField("late_rows", LongType()), StructField("ingest_epoch", LongType())])


def _closed_until(spark: SparkSession, path: str, epoch_id: int) -> dt.date | None:
    """The date up to which the epochs before ``epoch_id`` have closed weeks."""
    if not sinks.table_exists(spark, f"{path}/epochs"):
        return None
    return spark.read.schema(EPOCHS).parquet(f"{path}/epochs").filter(F.col("ingest_epoch") < epoch_id).agg(F.max("until")).first()[0]


def weekly_batch(spark: SparkSession, path: str, batch: DataFrame, epoch_id: int, lateness_days: int = 14) -> None:
    """One micro-batch of fact rows into the weekly roll-up under ``path``:

    ``days`` (versioned, by week): the rows themselves, keyed by asset and date;
    ``weekly`` (versioned, by week): the published weeks, ``late``: rows of weeks
    that were closed before they came, per epoch; ``epochs``: how far weeks are closed
    and how many rows were late.

    A week is closed, and published, once a row ``lateness_days`` beyond its end has
    come. Late rows are stored, counted, and merged: only the weeks (of the assets)
    they belong to are rolled up again. A replayed epoch gives the same tables.
    """
    rows = sinks.staged_copy(spark, batch.select(*WEEK_ROWS, week_start("price_date").alias("week_start")), "weekly-batch")
    newest = rows.agg(F.max("price_date")).first()[0]
    if newest is None:
        return
    closed = _closed_until(spark, path, epoch_id)
    until = newest - dt.timedelta(days=lateness_days)
    until = until if closed is None else max(until, closed)
    end = F.date_add("week_start", 7)
    late = rows.filter(F.lit(False) if closed is None else end <= F.lit(closed))
    n_late = sinks.write_table(late, f"{path}/late/ingest_epoch={epoch_id}", "overwrite", guard_empty=False)
    versioned.upsert(spark, f"{path}/days", rows, ["asset_id", "price_date"], "week_start", sort_within=["asset_id"])
    days = versioned.read(spark, f"{path}/days", "week_start", rows.schema)
    now = days.filter((end <= F.lit(until)) & (F.lit(True) if closed is None else end > F.lit(closed)))
    if n_late:
        weeks = late.select("asset_id", "week_start").distinct()
        bounds = late.agg(F.min("week_start").alias("lo"), F.max("week_start").alias("hi")).first()
        now = now.unionByName(sinks.within(days, "week_start", bounds).join(weeks, ["asset_id", "week_start"], "left_semi"))
    versioned.upsert(spark, f"{path}/weekly", marts.weekly_rollup(now), ["asset_id", "week_start"], "week_start", sort_within=["asset_id"])
    mark = spark.createDataFrame([(until, n_late)], StructType(EPOCHS.fields[:2]))
    sinks.write_table(mark, f"{path}/epochs/ingest_epoch={epoch_id}", "overwrite", guard_empty=False)


def read_weekly(spark: SparkSession, path: str) -> DataFrame | None:
    """The weeks that ``stream_weekly(late="merge")`` has published."""
    return versioned.read(spark, f"{path}/weekly", "week_start")


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """(ingest_epoch, late_rows) of every epoch of ``stream_weekly(late="merge")``."""
    return spark.read.schema(EPOCHS).parquet(f"{path}/epochs").select("ingest_epoch", "late_rows")


def stream_weekly(spark: SparkSession, fact_stream: DataFrame, out_path: str, checkpoint: str,
                  watermark: str = "14 days", available_now: bool = True, late: str = "drop") -> StreamingQuery:
    """The weekly roll-up of a stream of fact rows.

    ``late="drop"``: ``weekly_stream`` into Parquet; a week is appended once the
    watermark passes its end, and rows behind the watermark are lost.
    ``late="merge"``: ``weekly_batch`` per micro-batch; late rows are kept and re-open
    their weeks.
    """
    if late == "drop":
        w = weekly_stream(fact_stream, watermark).writeStream.outputMode("append").format("parquet").option("path", out_path)
        return _started(w, checkpoint, available_now)
    if late != "merge":
        raise ValueError(f"unknown late policy {late!r}")
    days = int(watermark.split()[0])

    def run(batch: DataFrame, epoch_id: int) -> None:
        weekly_batch(batch.sparkSession, out_path, batch, epoch_id, days)

    return _started(fact_stream.writeStream.foreachBatch(run), checkpoint, available_now)


def _tail_by_date(spark: SparkSession, stored: DataFrame, first: DataFrame, bounds, days: int) -> DataFrame:
    """The 30-row tail of each asset with late rows: from the partitions of the last ``days``
    days before the batch, and for the assets that are too sparse to have 30
    rows there from the older ones as well."""
    recent = stored.filter((F.col("price_date") >= F.date_sub(F.lit(bounds["lo"]), days)) &
                           (F.col("price_date") < F.lit(bounds["hi"])))
    tail = sinks.staged_copy(spark, incremental.stored_tail(recent, first), "tail")
    short = first.join(tail.groupBy("asset_id").count().filter("count >= 30"), "asset_id", "left_anti")
    short = sinks.staged_copy(spark, short, "short")
    if short.isEmpty():
        return tail
    older = stored.filter(F.col("price_date") < F.lit(bounds["hi"]))
    return tail.join(short, "asset_id", "left_anti").unionByName(incremental.stored_tail(older, short))


def features_batch(spark: SparkSession, fact_path: str, staged_batch: DataFrame,
                   late: str = "recompute", tail_days: int = 60) -> int:
    """Merge one batch of staged rows into the fact table at ``fact_path``;
    returns the rows written.

    Features are computed per touched asset from its first incoming date on. Where
    that is after the asset's last date, the 30 rows and the running maximum before
    it come from the stored state of the series (``plans.series_state``), and the
    fact is not read. For assets with late rows they come from the fact, and only
    rows that differ from the stored ones are merged. ``late="drop"`` ignores rows
    dated on or before an asset's last stored date (the strict-watermark behaviour).
    """
    keys = ["asset_id", "price_date"]
    if late not in ("recompute", "drop"):
        raise ValueError(f"unknown late policy {late!r}")
    if not sinks.table_exists(spark, fact_path):
        series_state.forget(spark, fact_path)
        return sinks.write_table(marts.fact_daily(staged_batch), fact_path, "overwrite",
                                 ["price_date"], ["asset_id"])
    state = series_state.load(spark, fact_path)
    if late == "drop":
        last = state.select("asset_id", F.col("last_date").alias("__last"))
        staged_batch = staged_batch.join(last, "asset_id", "left").filter(
            F.col("__last").isNull() | (F.col("price_date") > F.col("__last"))).drop("__last")
    batch = sinks.staged_copy(spark, staged_batch.select(*series_state.BASE), "features-batch")
    first = batch.groupBy("asset_id").agg(F.min("price_date").alias("__first"))
    touched = sinks.staged_copy(spark, first.join(state, "asset_id", "left"), "features-state")
    late_first = touched.filter(F.col("last_date") >= F.col("__first")).select("asset_id", "__first")
    ordered = touched.filter(F.col("last_date").isNull() | (F.col("last_date") < F.col("__first")))
    tail = series_state.unrolled(ordered)
    span = batch.join(late_first, "asset_id", "left_semi").agg(F.min("price_date").alias("lo"), F.max("price_date").alias("hi")).first()
    stored = None
    if span["lo"] is not None:
        fact = spark.read.parquet(fact_path).select(*marts.FACT_COLUMNS)
        tail = tail.unionByName(_tail_by_date(spark, fact, late_first, span, tail_days).select(*tail.columns))
        stored = fact.filter(F.col("price_date") >= F.lit(span["lo"])).join(late_first, "asset_id", "left_semi")     # prunes the partitions
    tail = sinks.staged_copy(spark, tail, "features-tail")
    computed = sinks.staged_copy(spark, incremental.incremental_features(
        batch.filter(F.lit(False)) if stored is None else stored, batch, tail=tail), "features-rows")
    new = batch if stored is None else batch.join(stored.select(*keys), keys, "left_anti")
    fresh = sinks.staged_copy(spark, new.groupBy("asset_id").agg(F.count(F.lit(1)).alias("new_days"), F.min("price_date").alias("came")), "features-days")
    n = sinks.upsert_table(spark, fact_path, computed if stored is None else incremental.changed_rows(computed, stored), keys, "price_date")
    rows = tail.unionByName(computed.select(*tail.columns))
    series_state.save(spark, fact_path, series_state.merged(touched, rows, fresh))
    return n


def stream_features(spark: SparkSession, raw_stream: DataFrame, fact_path: str,
                    checkpoint: str, tiebreak: Sequence[str] = ("source_ts",),
                    available_now: bool = True, late: str = "recompute") -> StreamingQuery:
    def run(batch: DataFrame, epoch_id: int) -> None:
        features_batch(batch.sparkSession, fact_path,
                       staging.stage_prices(batch, tiebreak=tiebreak), late)

    return _started(raw_stream.writeStream.foreachBatch(run), checkpoint, available_now)
