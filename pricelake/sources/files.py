"""File sources: the watchlist CSV and landed payload files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake import schemas
from pricelake.sources.payloads import split_payloads


def read_watchlist(spark: SparkSession, path: str, id_column: str = "coin_id") -> DataFrame:
    """Header CSV of (id, name, symbol, category) in any column order, all text;
    ``id_column`` names the id and becomes ``asset_id``. No schema inference."""
    df = spark.read.option("header", True).csv(path)
    return df.select(F.col(id_column).alias("asset_id"), "name", "symbol", "category")


def read_payloads(spark: SparkSession, path: str, kind: str) -> tuple[DataFrame, DataFrame]:
    """Landed envelopes ``{asset_id, fetched_at, payload}`` (JSON lines) ->
    (good, quarantine). Lines are read as text and parsed with ``from_json``,
    so a line that is not valid JSON stays as text and is attributed to its
    file (one asset per landed file); one bad payload loses only its own fetch."""
    return split_lines(spark.read.text(path), kind)


def split_lines(lines: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """``read_payloads`` on lines read by the text source, in batch or as a stream."""
    raw = lines.select("value", F.col("_metadata.file_path").alias("source_file"))
    # the payload stays text here: which arrays it has tells a missing one from a null
    env = F.from_json(F.col("value"), schemas.envelope(kind, corrupt_col=None, text=True))
    parsed = raw.select("value", "source_file", env.alias("e"))
    unreadable = F.col("e").isNull() | (F.col("e.asset_id").isNull() &
                                         F.col("e.fetched_at").isNull() &
                                         F.col("e.payload").isNull())
    broken = parsed.filter(unreadable).select(
        F.col("e.asset_id").alias("asset_id"), F.col("e.fetched_at").alias("fetched_at"),
        F.lit(kind).alias("kind"), F.lit("unparseable").alias("reason"),
        F.col("value").alias("payload_text"), "source_file")
    ok = parsed.filter(~unreadable).select("e.asset_id", "e.fetched_at", "e.payload",
                                           "source_file")
    good, bad = split_payloads(ok, kind, keys=("asset_id", "fetched_at", "source_file"))
    return good.drop("source_file"), bad.unionByName(broken)
