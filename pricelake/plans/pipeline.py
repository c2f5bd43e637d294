"""The daily job as two entry points: ``ingest`` (landed payloads -> raw tables)
and ``build`` (raw tables -> staged views, fact, weekly roll-up, dimension),
plus ``check`` (the data-quality suite and freshness).

Tables live as Parquet directories under one root:

    <root>/raw/prices        partitioned by fetched_date, clustered by asset
    <root>/raw/asset_metadata
    <root>/raw/_ingests      one row per ingest: its number and what it touched
    <root>/marts/fact_daily  partitioned by price_date, clustered by asset
    <root>/marts/weekly      partitioned by week
    <root>/marts/dim_assets  rebuilt each run
    <root>/marts/_build_state   the last ingest the marts hold

Materializations: staging and intermediate layers are lazy DataFrames
(views); weekly and dimension are tables; the fact is incremental (keyed upsert
of what an ingest changes); the watchlist is a CSV seed. Nothing is collected
to the driver except counts and bounds.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType, TimestampNTZType

from pricelake import schemas
from pricelake.functions import week_start
from pricelake.operators import marts, quality, staging
from pricelake.plans import incremental, series_state
from pricelake.sources import files, payloads, sinks
from pricelake.streaming.jobs import features_batch


def _paths(root: str) -> dict[str, str]:
    r = root.rstrip("/")
    return {"prices": f"{r}/raw/prices", "metadata": f"{r}/raw/asset_metadata",
            "fact": f"{r}/marts/fact_daily", "weekly": f"{r}/marts/weekly",
            "dim": f"{r}/marts/dim_assets", "quarantine": f"{r}/raw/quarantine"}


@dataclass
class IngestResult:
    price_rows: int = 0
    metadata_rows: int = 0
    quarantined: int = 0
    preview: list = field(default_factory=list)


#: Raw prices as stored: the declared columns, the source time that orders
#: points of one fetch, and the number of the ingest that brought the row.
STORED_PRICES = StructType([*schemas.RAW_PRICES.fields, StructField("source_ts", TimestampNTZType()),
                            StructField("ingest_id", LongType())])
STORED_METADATA = StructType([*schemas.RAW_METADATA.fields, StructField("fetched_date", DateType())])


def _last_ingest(spark: SparkSession, root: str) -> int:
    path = f"{root.rstrip('/')}/raw/_ingests"
    if not sinks.table_exists(spark, path):
        return 0
    return spark.read.parquet(path).agg(F.max("ingest_id")).first()[0] or 0


def ingest(spark: SparkSession, landing: str, root: str, as_of, full_refresh: bool = False,
           assets=None, dry_run: bool = False, scope: str = "keys") -> IngestResult:
    """Landed envelopes under ``landing/{market_chart,candles,info}`` -> raw tables.

    History window: 365 days on a full refresh, 2 days otherwise. An incremental
    run appends (duplicates are resolved by staging). A full refresh replaces
    the rows of the (asset, fetch date) pairs it brings, in prices and in
    metadata, and leaves all others; ``scope="all"`` replaces both tables as a
    whole. Bad payloads go to the quarantine table; they lose only their own
    fetch.
    """
    if scope not in ("keys", "all"):
        raise ValueError(f"unknown scope {scope!r}")
    p = _paths(root)
    charts, bad_c = files.read_payloads(spark, f"{landing}/market_chart", "market_chart")
    candles, bad_k = files.read_payloads(spark, f"{landing}/candles", "candles")
    infos, bad_i = files.read_payloads(spark, f"{landing}/info", "info")
    if assets is not None:
        charts, candles, infos = (staging.select_assets(x, assets)
                                  for x in (charts, candles, infos))
    rows = staging.batch_window(payloads.merge_ohlc(charts, candles), as_of, full_refresh)
    rows = rows.select(*schemas.PRICE_COLUMNS, "source_ts")
    meta = payloads.parse_metadata(infos)
    bad = bad_c.unionByName(bad_k).unionByName(bad_i)
    if dry_run:
        order = ["asset_id", "price_date", "fetched_at"]
        return IngestResult(rows.count(), meta.count(), bad.count(),
                            [r.asDict() for r in sinks.preview(rows, order, 3).collect()])
    number = _last_ingest(spark, root) + 1
    rows = sinks.staged_copy(spark, rows.withColumn("ingest_id", F.lit(number).cast("long")), "ingest")
    meta = meta.withColumn("fetched_date", F.col("fetched_at").cast("date"))
    if scope == "all" and full_refresh:
        n_rows = sinks.write_table(rows, p["prices"], "overwrite", ["fetched_date"], ["asset_id"])
        n_meta = sinks.write_table(meta, p["metadata"], "overwrite", ["fetched_date"])
    else:
        sinks.ensure_table(spark, p["prices"], STORED_PRICES, ["fetched_date"])
        sinks.ensure_table(spark, p["metadata"], STORED_METADATA, ["fetched_date"])
        if full_refresh:
            key = ["asset_id", "fetched_date"]
            n_rows = rows.count()
            sinks.upsert_table(spark, p["prices"], rows, key, "fetched_date", schema_guard=False)
            meta = sinks.staged_copy(spark, meta, "metadata")
            n_meta = meta.count()
            sinks.upsert_table(spark, p["metadata"], meta, key, "fetched_date", schema_guard=False)
        else:
            n_rows = sinks.write_table(rows, p["prices"], "append", ["fetched_date"], ["asset_id"])
            n_meta = sinks.write_table(meta, p["metadata"], "append", ["fetched_date"])
    n_bad = sinks.write_table(bad, p["quarantine"], "append")
    # what a build has to look at: the fetch dates of this ingest, the series of which
    # rows may have gone, and whether all may have
    if full_refresh and scope != "all":
        gone = rows.select("asset_id", "ingest_id").distinct()
        sinks.write_table(gone, f"{root.rstrip('/')}/raw/_refreshed", "append", guard_empty=False)
    seen = rows.agg(F.lit(number).cast("long").alias("ingest_id"), F.min("fetched_date").alias("lo"),
                    F.max("fetched_date").alias("hi"), F.lit(full_refresh and scope == "all").alias("replaced"))
    sinks.write_table(seen, f"{root.rstrip('/')}/raw/_ingests", "append", guard_empty=False)
    return IngestResult(n_rows, n_meta, n_bad)


def staged_prices(spark: SparkSession, root: str) -> DataFrame:
    return staging.stage_prices(spark.read.parquet(_paths(root)["prices"]))


def staged_metadata(spark: SparkSession, root: str) -> DataFrame:
    path = _paths(root)["metadata"]
    raw = sinks.stored(spark, path)
    return staging.stage_metadata(spark.createDataFrame([], schemas.RAW_METADATA) if raw is None else raw)


def _state_path(root: str) -> str:
    return f"{root.rstrip('/')}/marts/_build_state"


def changed_prices(spark: SparkSession, root: str, since: int) -> DataFrame | None:
    """Newest versions of the (asset, date) pairs that the ingests after ``since``
    brought, whatever their fetch times; None if they brought none.

    Unseen rows are found by ingest number within the fetch dates those ingests
    wrote (literal bounds). The versions that may compete with them were fetched
    on or after the prices' own dates (a day's slack for time zones), so older
    partitions are not read.
    """
    p = _paths(root)
    unseen = spark.read.parquet(f"{root.rstrip('/')}/raw/_ingests").filter(F.col("ingest_id") > since)
    bounds = unseen.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).first()
    if bounds["lo"] is None:
        return None
    raw = spark.read.parquet(p["prices"])
    new = sinks.staged_copy(spark, sinks.within(raw, "fetched_date", bounds).filter(F.col("ingest_id") > since), "unseen")
    first = new.agg(F.min("price_date")).first()[0]
    if first is None:
        return None
    keys = new.select("asset_id", "price_date").distinct()
    rivals = raw.filter(F.col("fetched_date") >= F.date_sub(F.lit(first), 1)) \
        .filter(F.col("ingest_id") <= since).join(keys, ["asset_id", "price_date"], "left_semi")
    return staging.stage_prices(rivals.unionByName(new.select(*rivals.columns)))


def _refreshed(spark: SparkSession, root: str, since: int) -> DataFrame | None:
    """The assets that keyed refreshes after ``since`` brought anew."""
    path = f"{root.rstrip('/')}/raw/_refreshed"
    if not sinks.table_exists(spark, path):
        return None
    feed = spark.read.parquet(path).filter(F.col("ingest_id") > since).select("asset_id").distinct()
    return None if feed.isEmpty() else sinks.staged_copy(spark, feed, "refreshed")


def _rebuild_series(spark: SparkSession, root: str, series: DataFrame) -> tuple[int, int]:
    """Write the series of some assets anew, from all their raw rows: fact, weekly
    roll-up and state. Only partitions that hold or get their rows are rewritten."""
    p = _paths(root)
    raw = spark.read.parquet(p["prices"]).join(series, "asset_id", "left_semi")
    fact = sinks.staged_copy(spark, marts.fact_daily(staging.stage_prices(raw)), "series-fact")
    n_fact = sinks.replace_series(spark, p["fact"], fact, series)
    series_state.replace(spark, p["fact"], fact, series)
    n_week = sinks.replace_series(spark, p["weekly"], marts.weekly_rollup(fact), series, "week_start") \
        if sinks.table_exists(spark, p["weekly"]) else 0
    return n_fact, n_week


def build(spark: SparkSession, root: str, watchlist_csv: str, as_of,
          mode: str = "tail", lookback_days: int = 2) -> dict[str, int]:
    """Raw tables -> fact (incremental), weekly and dimension.

    The first run (no fact yet) writes the full fact, and so does the first run
    after a full refresh of all assets. After a keyed refresh, which may have taken
    rows away, the series it names are written anew, and no partition without them
    is touched. All other rows:

    * ``mode="tail"``: the rows of the ingests not built yet are found by number;
      their newest versions get features per touched asset from its first
      incoming date on, and what differs from the stored fact is upserted. The
      weekly table is recomputed for the touched assets from that week on.
    * ``mode="per_asset"`` / ``"strict"``: features over the staged history, then
      the slice the mode selects is upserted; ``per_asset`` also lands
      corrections of the last ``lookback_days`` days and new assets'
      back-history.
    """
    p = _paths(root)
    raw = sinks.stored(spark, p["prices"])
    if raw is None or raw.isEmpty():
        return {"fact_rows_written": 0, "weekly_rows": 0, "dim_rows": 0}
    staged = staged_prices(spark, root)
    keys = ["asset_id", "price_date"]
    state = _state_path(root)
    last = _last_ingest(spark, root)
    built = spark.read.parquet(state).agg(F.max("ingest_id")).first()[0] if sinks.table_exists(spark, state) else 0
    replaced = not spark.read.parquet(f"{root.rstrip('/')}/raw/_ingests").filter(
        (F.col("ingest_id") > built) & F.col("replaced")).isEmpty()
    weekly_done = False
    whole = not sinks.table_exists(spark, p["fact"]) or replaced
    refreshed = None if whole else _refreshed(spark, root, built)
    n_series = n_series_weeks = 0
    if refreshed is not None:
        n_series, n_series_weeks = _rebuild_series(spark, root, refreshed)
    if whole:
        # the raw table has rows (checked above), so the fact has rows
        series_state.forget(spark, p["fact"])
        n_fact = sinks.write_table(marts.fact_daily(staged), p["fact"], "overwrite",
                                   ["price_date"], ["asset_id"], guard_empty=False)
    elif mode == "tail":
        n_fact = n_week = 0
        changed = changed_prices(spark, root, built)
        if changed is not None:
            if refreshed is not None:
                changed = changed.join(refreshed, "asset_id", "left_anti")
            changed = sinks.staged_copy(spark, changed, "changed")
            n_fact = features_batch(spark, p["fact"], changed)
            # features look backward only: weeks before an asset's first incoming
            # date stay as they are
            since = changed.groupBy("asset_id").agg(week_start(F.min("price_date")).alias("__from"))
            first_week = changed.agg(week_start(F.min("price_date"))).first()[0]
            if first_week is not None and sinks.table_exists(spark, p["weekly"]):
                recent = (spark.read.parquet(p["fact"]).select(*marts.FACT_COLUMNS)
                          .filter(F.col("price_date") >= F.lit(first_week))        # prunes partitions
                          .join(since, "asset_id").filter(F.col("price_date") >= F.col("__from"))
                          .drop("__from"))
                n_week = sinks.upsert_table(spark, p["weekly"], marts.weekly_rollup(recent),
                                            ["asset_id", "week_start"], "week_start")
        weekly_done = sinks.table_exists(spark, p["weekly"])
    else:
        features = marts.fact_daily(staged)
        target = spark.read.parquet(p["fact"]).select(*marts.FACT_COLUMNS)
        slice_ = incremental.incremental_slice(features, target, mode, lookback_days)
        series_state.forget(spark, p["fact"])
        n_fact = sinks.upsert_table(spark, p["fact"], slice_, keys, "price_date")
    if not weekly_done:
        fact = spark.read.parquet(p["fact"]).select(*marts.FACT_COLUMNS)
        n_week = sinks.write_table(marts.weekly_rollup(fact), p["weekly"], "overwrite",
                                   ["week_start"], guard_empty=False)
    wl = files.read_watchlist(spark, watchlist_csv)
    # the latest prices come from the state of the touched series, not from the fact
    dim = marts.dim_assets(wl, staged_metadata(spark, root), series_state.latest_price(series_state.load(spark, p["fact"])), as_of)
    n_dim = sinks.write_table(dim, p["dim"], "overwrite", guard_empty=False)
    # last of all: a build that failed before is done again in full
    sinks.write_table(spark.range(1).select(F.lit(last).cast("long").alias("ingest_id")), state, "overwrite",
                      guard_empty=False)
    return {"fact_rows_written": n_fact + n_series, "weekly_rows": n_week + n_series_weeks, "dim_rows": n_dim}


def check(spark: SparkSession, root: str, as_of_ts) -> DataFrame:
    """The declared tests over raw, staged and mart tables, plus freshness of
    the two raw sources (warn after 1 day, error after 2).

    Each stored table is read once. The staged prices, returns and rolling metrics
    are columns of the fact's rows, so their tests are evaluated there and no
    layer is computed again."""
    p = _paths(root)
    tables = {
        "raw_prices": spark.read.parquet(p["prices"]),
        "raw_metadata": spark.read.parquet(p["metadata"]),
        "stg_metadata": staged_metadata(spark, root),
        "fact_daily": spark.read.parquet(p["fact"]),
        "weekly": spark.read.parquet(p["weekly"]),
        "dim_assets": spark.read.parquet(p["dim"]),
    }
    suite = quality.run_suite(tables, quality.declared_checks(), quality.FACT_VIEWS)
    fresh = quality.freshness(tables["raw_prices"], "fetched_at", as_of_ts, source="prices") \
        .unionByName(quality.freshness(tables["raw_metadata"], "fetched_at", as_of_ts,
                                       source="asset_metadata"))
    fresh_rows = fresh.select(F.concat(F.lit("freshness."), F.col("source")).alias("test_name"),
                              F.col("source").alias("table_name"),
                              F.when(F.col("status") == "pass", 0).otherwise(1)
                              .cast("bigint").alias("failures"), "status")
    return suite.unionByName(fresh_rows)


# ---- serving reads over the stored tables (the dashboard's four loaders) --------

def load_daily_prices(spark: SparkSession, root: str, as_of, days_back: int = 90) -> DataFrame:
    """Fact rows of the lookback window; the literal date bound prunes the
    ``price_date`` partitions at planning time, so only those are read."""
    from pricelake.operators import serving
    fact = spark.read.parquet(_paths(root)["fact"])
    return serving.daily_prices(fact, as_of, days_back).orderBy("asset_id", "price_date")


def load_dim_assets(spark: SparkSession, root: str) -> DataFrame:
    from pricelake.operators import serving
    return serving.dim_ranked(spark.read.parquet(_paths(root)["dim"]))


def load_weekly(spark: SparkSession, root: str, as_of, days_back: int = 180) -> DataFrame:
    from pricelake.operators import serving
    weekly = spark.read.parquet(_paths(root)["weekly"])
    return serving.weekly_volatility(weekly, as_of, days_back).orderBy("asset_id", "week_start")


def load_pipeline_status(spark: SparkSession, root: str, as_of) -> DataFrame:
    from pricelake.operators import serving
    raw = spark.read.parquet(_paths(root)["prices"])
    return serving.pipeline_status(raw, as_of).orderBy("asset_id")
