"""Staging: typed projection, validity filters, keep-latest, selections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType, TimestampType

from pricelake import schemas
from pricelake.functions import as_of_date, valid_price
from pricelake.operators.dedup import keep_latest


def _cast_to(df: DataFrame, name: str, dtype: DataType):
    """Cast to the declared type; a timestamp of either kind is left as is."""
    src = df.schema[name].dataType
    if isinstance(dtype, (TimestampType, TimestampNTZType)) and \
            isinstance(src, (TimestampType, TimestampNTZType)):
        return F.col(name)
    return F.col(name).cast(dtype)


def typed(df: DataFrame, schema, extra: Sequence[str] = ()) -> DataFrame:
    """Project and cast to a declared schema (ANSI cast: bad text raises).
    Columns already of the declared type are passed through."""
    have = {f.name: f.dataType for f in df.schema.fields}
    cols = [f.name if have.get(f.name) == f.dataType
            else _cast_to(df, f.name, f.dataType).alias(f.name) for f in schema.fields]
    return df.select(*cols, *extra)


VALUE_ORDER = ["close_usd", "open_usd", "high_usd", "low_usd", "volume_usd", "market_cap_usd"]


def stage_prices(raw: DataFrame, tiebreak: Sequence[str] = ("source_ts",),
                 method: str = "window", keep: Sequence[str] = ()) -> DataFrame:
    """Typed, valid, one row per (asset_id, price_date), newest fetch wins.

    ``tiebreak`` columns (if present in ``raw``) order rows that share a
    ``fetched_at``; those in ``keep`` stay in the output, so that a later merge
    can order by them too.
    """
    extra = [c for c in tiebreak if c in raw.columns and c not in schemas.PRICE_COLUMNS]
    staged = typed(raw, schemas.RAW_PRICES, extra).filter(valid_price("close_usd"))
    # the value columns close the order: even rows that tie on every given
    # column are then picked the same way on every run and every retry
    order_rest = [c for c in tiebreak if c in raw.columns] + VALUE_ORDER
    deduped = keep_latest(staged, ["asset_id", "price_date"], ["fetched_at"], order_rest, method)
    return deduped.select(*schemas.PRICE_COLUMNS, *[c for c in keep if c in extra])


def stage_metadata(raw: DataFrame, tiebreak: Sequence[str] = (), method: str = "window") -> DataFrame:
    """Typed metadata with a non-NULL key, one row per asset, newest fetch wins.

    Without a tie-break, rows of one asset sharing ``fetched_at`` are ordered
    by their values so the pick is repeatable.
    """
    extra = [c for c in tiebreak if c in raw.columns and c not in schemas.METADATA_COLUMNS]
    staged = typed(raw, schemas.RAW_METADATA, extra).filter(F.col("asset_id").isNotNull())
    order_rest = [c for c in tiebreak if c in raw.columns] or \
        ["ath_usd", "ath_date", "genesis_date", "name", "symbol"]
    return keep_latest(staged, ["asset_id"], ["fetched_at"], order_rest, method) \
        .select(*schemas.METADATA_COLUMNS)


def select_assets(df: DataFrame, assets=None, default: Sequence[str] = (),
                  key: str = "asset_id") -> DataFrame:
    """Keep the chosen assets.

    ``assets`` may be a list (an ``IN`` filter, pushed to the scan) or a
    DataFrame holding ``key`` (a semi join, for lists too long for a literal).
    An empty list falls back to ``default``; ``None`` with no default keeps all.
    """
    if isinstance(assets, DataFrame):
        return df.join(assets.select(key).distinct(), key, "left_semi")
    chosen = list(assets) if assets else list(default)
    if not chosen:
        return df
    return df.filter(F.col(key).isin(chosen))


def lookback(df: DataFrame, date_col: str, as_of, days: int) -> DataFrame:
    """Rows with ``date_col >= as_of - days`` (a literal bound: partition-prunable)."""
    return df.filter(F.col(date_col) >= F.date_sub(as_of_date(as_of), int(days)))


def batch_window(df: DataFrame, as_of, full_refresh: bool, date_col: str = "price_date",
                 full_days: int = 365, incremental_days: int = 2) -> DataFrame:
    """History a run asks for: 365 days on a full refresh, 2 days otherwise."""
    return lookback(df, date_col, as_of, full_days if full_refresh else incremental_days)
