"""Incremental maintenance of the daily fact.

Two slice rules (which computed rows to load into the target):

* ``strict``: rows dated after the target's global max date -- a new asset's
  back-history or a corrected value on a stored date never arrive, and an
  existing but empty target loads nothing;
* ``per_asset`` (recommended): per asset, rows on or after that asset's own
  max stored date minus ``lookback_days``; assets absent from the target load
  whole. Combined with a keyed upsert, corrections of recent days land.

And one way to compute those rows without recomputing history:
``incremental_features`` starts at each touched asset's first incoming date and
needs, before it, only the last ``tail_rows`` stored rows and the stored
running max.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelake.operators import features as ft
from pricelake.operators import marts


def incremental_slice(features: DataFrame, target: DataFrame, mode: str = "per_asset",
                      lookback_days: int = 2, key: str = "asset_id",
                      date_col: str = "price_date") -> DataFrame:
    if mode == "strict":
        # scalar subquery: reads only the target's max date
        wm = target.agg(F.max(date_col)).scalar()
        return features.filter(F.col(date_col) > wm)
    if mode != "per_asset":
        raise ValueError(f"unknown mode {mode!r}")
    wm = target.groupBy(key).agg(F.max(date_col).alias("__wm"))
    j = features.join(wm, key, "left")
    keep = F.col("__wm").isNull() | \
        (F.col(date_col) >= F.date_sub(F.col("__wm"), int(lookback_days)))
    return j.filter(keep).drop("__wm")


def stored_tail(stored_fact: DataFrame, first: DataFrame, tail_rows: int = 30) -> DataFrame:
    """Per asset of ``first`` (asset_id, __first): its last ``tail_rows`` stored
    rows before that date (a per-asset top-k, pruned in each task)."""
    w = Window.partitionBy("asset_id").orderBy(F.col("price_date").desc())
    before = stored_fact.join(first, "asset_id").filter(F.col("price_date") < F.col("__first")).drop("__first")
    return before.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= tail_rows).drop("__rn")


def stored_reach(stored_fact: DataFrame, first: DataFrame, tail_rows: int = 30) -> DataFrame:
    """Per asset of ``first`` (asset_id, __first): its stored rows from that date on
    (``__new``) and the last ``tail_rows`` before it, found in one pass.

    A row before the date is among the last ones if the row ``tail_rows`` further on
    is not before it. The window has the order of the fact's own, so a fact that is
    computed here, or bucketed by asset, is neither exchanged again nor read twice.
    """
    w = ft.series_window("asset_id", "price_date")
    ahead = stored_fact.withColumn("__ahead", F.lead("price_date", tail_rows).over(w))
    new = F.col("price_date") >= F.col("__first")
    last = F.col("__ahead").isNull() | (F.col("__ahead") >= F.col("__first"))
    return (ahead.join(first, "asset_id").filter(new | ((F.col("price_date") < F.col("__first")) & last))
            .withColumn("__new", new).drop("__ahead", "__first"))


def incremental_features(stored_fact: DataFrame, new_staged: DataFrame, tail_rows: int = 30,
                         tail: DataFrame | None = None) -> DataFrame:
    """Fact rows of every touched asset from its first incoming date on, equal to
    a full recompute over the stored history with ``new_staged`` merged in.

    Incoming rows replace stored rows of their date (ordinary overlap, late
    rows and corrections alike). Row frames reach back 29 rows and the return
    on the first of those needs one more close, hence a 30-row tail. The running
    max continues from the ``cummax_close`` of the last row before the first
    incoming date: as a seed in that row's place it takes part in one running
    maximum, without a join. ``tail`` may hold the tail already found.
    """
    first = new_staged.groupBy("asset_id").agg(F.min("price_date").alias("__first"))
    cols = marts.RETURNS_COLUMNS[:8]
    replaced = new_staged.select("asset_id", "price_date")
    none = F.lit(None).cast("double").alias("__seed")
    if tail is None:
        # no incoming row has a tail row's date
        held = (stored_reach(stored_fact.select(*cols, "cummax_close"), first, tail_rows)
                .join(replaced, ["asset_id", "price_date"], "left_anti")
                .select(*cols, F.when(~F.col("__new"), F.col("cummax_close")).alias("__seed"), "__new"))
    else:
        after = (stored_fact.join(first, "asset_id").filter(F.col("price_date") >= F.col("__first"))
                 .join(replaced, ["asset_id", "price_date"], "left_anti"))
        held = (tail.select(*cols, F.col("cummax_close").alias("__seed"), F.lit(False).alias("__new"))
                .unionByName(after.select(*cols, none, F.lit(True).alias("__new"))))
    combined = held.unionByName(new_staged.select(*cols, none, F.lit(True).alias("__new")))
    df = ft.add_rolling(ft.add_returns(combined.withColumn("__top", F.greatest("close_usd", "__seed"))), cummax="__max")
    df = df.withColumn("cummax_close", F.max("__top").over(ft.series_window("asset_id", "price_date").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)))
    df = ft.add_deviation(ft.add_drawdown(ft.add_annualised_vol(df)))
    return df.filter(F.col("__new")).select(*marts.FACT_COLUMNS)


def changed_rows(computed: DataFrame, stored_fact: DataFrame) -> DataFrame:
    """The computed rows that the stored fact does not hold already, value for
    value: a correction spreads only as far as it changes something."""
    same = [F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")) for c in marts.FACT_COLUMNS[2:]]
    keys = [F.col(f"n.{c}") == F.col(f"o.{c}") for c in marts.FACT_COLUMNS[:2]]
    on = keys[0] & keys[1]
    for c in same:
        on = on & c
    return computed.alias("n").join(stored_fact.alias("o"), on, "left_anti")
