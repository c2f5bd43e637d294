"""The stored state of every series: what the next batch needs of its past.

One row per asset, kept beside the fact as a versioned table dealt into
``BUCKETS`` by the asset's hash: its first and last date, its number of days, and
its last ``TAIL`` rows with the running maximum. A batch that follows a series'
last date takes its lookback from there, so it reads no partition of the fact
before its own dates; the dimension takes the latest prices and the day count from
there, so it reads no fact at all.

The state is merged after the fact's rows are written. A batch that is done again
because it was lost in between gives the same fact and the same state. Whoever
writes the fact in another way first forgets the state (``forget``); it is then
built from the fact when it is next needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from pricelake.operators import marts
from pricelake.sources import sinks, versioned

BUCKETS = 32
TAIL = 30
BASE = marts.RETURNS_COLUMNS[:8]
KEPT = [*BASE[1:], "cummax_close"]
SCHEMA = StructType([
    StructField("asset_id", StringType()), StructField("first_date", DateType()), StructField("last_date", DateType()),
    StructField("days", LongType()),
    StructField("tail", ArrayType(StructType([StructField("price_date", DateType()),
                                              *[StructField(c, DoubleType()) for c in KEPT[1:]]]))),
    StructField("bucket", IntegerType())])


def state_path(fact_path: str) -> str:
    return f"{fact_path.rstrip('/')}_state"


def _tails(rows: DataFrame) -> DataFrame:
    """(asset_id, tail): each asset's last TAIL rows by date (a top-k cut in each task first)."""
    w = Window.partitionBy("asset_id").orderBy(F.col("price_date").desc())
    last = rows.select("asset_id", *KEPT).withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= TAIL)
    return last.groupBy("asset_id").agg(F.sort_array(F.collect_list(F.struct(*KEPT))).alias("tail"))


def _shaped(df: DataFrame) -> DataFrame:
    return df.withColumn("last_date", F.element_at("tail", -1)["price_date"]).withColumn(
        "bucket", F.pmod(F.xxhash64("asset_id"), F.lit(BUCKETS)).cast("int")).select(*SCHEMA.names)


def of_fact(fact: DataFrame) -> DataFrame:
    """The state of whole series."""
    spans = fact.groupBy("asset_id").agg(F.min("price_date").alias("first_date"), F.count(F.lit(1)).alias("days"))
    return _shaped(_tails(fact).join(spans, "asset_id"))


def replace(spark: SparkSession, fact_path: str, fact: DataFrame, series: DataFrame) -> None:
    """The state of the assets in ``series`` becomes that of their rows in ``fact``;
    one without rows has none."""
    state = load(spark, fact_path)
    kept = state.join(series, "asset_id", "left_anti")
    buckets = [r["bucket"] for r in state.join(series, "asset_id", "left_semi").select("bucket").union(
        of_fact(fact).select("bucket")).distinct().collect()]              # at most BUCKETS
    rows = sinks.staged_copy(spark, kept.filter(F.col("bucket").isin(buckets)).unionByName(of_fact(fact)), "state")
    versioned.replace_partitions(spark, state_path(fact_path), rows, "bucket", ["asset_id"], emptied=[str(b) for b in buckets])


def forget(spark: SparkSession, fact_path: str) -> None:
    """Drop the state, before the fact is written in another way."""
    versioned.drop(spark, state_path(fact_path))


def load(spark: SparkSession, fact_path: str) -> DataFrame:
    """The state; built from the stored fact where there is none."""
    path = state_path(fact_path)
    state = versioned.read(spark, path, "bucket", SCHEMA)
    if state is not None:
        return state
    versioned.replace_partitions(spark, path, of_fact(spark.read.parquet(fact_path)), "bucket", ["asset_id"])
    return versioned.read(spark, path, "bucket", SCHEMA)


def unrolled(state: DataFrame) -> DataFrame:
    """The rows of the tails, with the running maximum."""
    return state.select("asset_id", F.explode("tail").alias("t")).select("asset_id", "t.*")


def merged(touched: DataFrame, rows: DataFrame, fresh: DataFrame) -> DataFrame:
    """The new state of the touched assets: their old state (columns of SCHEMA, null
    for new assets), the rows that may be among their last, and per asset the number
    of days that are new (``new_days``) and the first date that came (``came``)."""
    old = touched.select("asset_id", "first_date", "days")
    j = _tails(rows).join(old, "asset_id", "left").join(fresh, "asset_id", "left")
    return _shaped(j.withColumn("first_date", F.least("first_date", "came"))
                   .withColumn("days", F.coalesce("days", F.lit(0)) + F.coalesce("new_days", F.lit(0))))


def save(spark: SparkSession, fact_path: str, rows: DataFrame) -> None:
    versioned.upsert(spark, state_path(fact_path), rows, ["asset_id"], "bucket", sort_within=["asset_id"])


def latest_price(state: DataFrame) -> DataFrame:
    """``marts.latest_price`` from the state alone."""
    last = F.element_at("tail", -1)
    return state.select("asset_id", F.col("last_date").alias("latest_price_date"), last["close_usd"].alias("latest_close_usd"),
                        last["market_cap_usd"].alias("latest_market_cap_usd"), F.col("days").alias("days_of_data"))
