"""Declared schemas (nothing is inferred)."""

from pyspark.sql.types import (
    ArrayType, DateType, DoubleType, StringType, StructField, StructType,
    TimestampNTZType,
)

# Raw price rows: one per (asset, date, fetch). Timestamps are UTC wall clock.
PRICE_COLUMNS = [
    "asset_id", "price_date", "open_usd", "high_usd", "low_usd", "close_usd",
    "volume_usd", "market_cap_usd", "fetched_date", "fetched_at",
]
RAW_PRICES = StructType([
    StructField("asset_id", StringType(), False),
    StructField("price_date", DateType(), False),
    StructField("open_usd", DoubleType(), True),
    StructField("high_usd", DoubleType(), True),
    StructField("low_usd", DoubleType(), True),
    StructField("close_usd", DoubleType(), False),
    StructField("volume_usd", DoubleType(), True),
    StructField("market_cap_usd", DoubleType(), True),
    StructField("fetched_date", DateType(), False),
    StructField("fetched_at", TimestampNTZType(), False),
])

METADATA_COLUMNS = [
    "asset_id", "name", "symbol", "genesis_date", "ath_usd", "ath_date", "fetched_at",
]
RAW_METADATA = StructType([
    StructField("asset_id", StringType(), False),
    StructField("name", StringType(), True),
    StructField("symbol", StringType(), True),
    StructField("genesis_date", DateType(), True),
    StructField("ath_usd", DoubleType(), True),
    StructField("ath_date", DateType(), True),
    StructField("fetched_at", TimestampNTZType(), False),
])

WATCHLIST = StructType([
    StructField("asset_id", StringType(), False),
    StructField("name", StringType(), True),
    StructField("symbol", StringType(), True),
    StructField("category", StringType(), True),
])

# Payloads, as landed: one JSON envelope per asset fetch.
POINTS = ArrayType(ArrayType(DoubleType()))
MARKET_CHART = StructType([
    StructField("prices", POINTS, True),
    StructField("market_caps", POINTS, True),
    StructField("total_volumes", POINTS, True),
])
CANDLES = POINTS
ASSET_INFO = StructType([
    StructField("id", StringType(), True),
    StructField("name", StringType(), True),
    StructField("symbol", StringType(), True),
    StructField("genesis_date", StringType(), True),
    StructField("market_data", StructType([
        StructField("ath", StructType([StructField("usd", DoubleType(), True)]), True),
        StructField("ath_date", StructType([StructField("usd", StringType(), True)]), True),
    ]), True),
])

ENVELOPE_KINDS = {"market_chart": MARKET_CHART, "candles": CANDLES, "info": ASSET_INFO}


def envelope(kind: str, corrupt_col: str | None = "_corrupt_record", text: bool = False) -> StructType:
    """Landed file row: ``{asset_id, fetched_at, payload}``, the payload parsed or as text."""
    fields = [
        StructField("asset_id", StringType(), True),
        StructField("fetched_at", TimestampNTZType(), True),
        StructField("payload", StringType() if text else ENVELOPE_KINDS[kind], True),
    ]
    if corrupt_col:
        fields.append(StructField(corrupt_col, StringType(), True))
    return StructType(fields)
