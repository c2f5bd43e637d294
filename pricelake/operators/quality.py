"""Declarative data-quality checks. Each check returns a violations DataFrame;
zero rows = pass. ``run_suite`` folds many checks into few passes."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from pricelake.functions import as_ts_lit


def _expr(e) -> Column:
    return F.expr(e) if isinstance(e, str) else e


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def unique(df: DataFrame, col: str) -> DataFrame:
    """Values (non-NULL) that occur more than once, with their count."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def unique_combo(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1))


def expression_is_true(df: DataFrame, expr, where=None) -> DataFrame:
    """Rows where ``expr`` is false (a NULL result passes), after ``where``."""
    if where is not None:
        df = df.filter(_expr(where))
    return df.filter(~_expr(expr))


def freshness(df: DataFrame, col: str, as_of_ts, warn_after_s: int = 86400,
              error_after_s: int = 172800, source: str | None = None) -> DataFrame:
    """One row: newest ``col``, its age in seconds at ``as_of_ts``, and a status.
    An empty table is an error."""
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), as_of_ts_col(as_of_ts))
    out = df.agg(F.max(col).alias("max_loaded_at")).select(
        *( [F.lit(source).alias("source")] if source else []),
        "max_loaded_at", age.alias("age_seconds"))
    status = (F.when(F.col("age_seconds").isNull(), F.lit("error"))
              .when(F.col("age_seconds") > error_after_s, F.lit("error"))
              .when(F.col("age_seconds") > warn_after_s, F.lit("warn"))
              .otherwise(F.lit("pass")))
    return out.withColumn("status", status)


def as_of_ts_col(ts) -> Column:
    return as_ts_lit(ts)


@dataclass
class Check:
    """A named test on one table.

    kind: not_null | expression | unique | unique_combo
    """
    name: str
    table: str
    kind: str
    cols: Sequence[str] = field(default_factory=tuple)
    expr: str | None = None
    where: str | None = None


def _violation(c: Check) -> Column:
    if c.kind == "not_null":
        return F.col(c.cols[0]).isNull()
    if c.kind == "expression":
        bad = ~F.expr(c.expr)
        if c.where:
            bad = F.expr(c.where) & bad
        return F.coalesce(bad, F.lit(False))
    raise ValueError(c.kind)


def _rows_of(frame: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(test_name, table_name, failures) of the checks from an aggregate with one column a check."""
    return frame.select(F.explode(F.array(*[
        F.struct(F.lit(c.name).alias("test_name"), F.lit(c.table).alias("table_name"),
                 F.coalesce(F.col(f"c{i}").cast("bigint"), F.lit(0)).alias("failures"))
        for i, c in enumerate(checks)])).alias("r")).select("r.*")


def _one_pass(df: DataFrame, checks: Sequence[Check]) -> list[DataFrame]:
    """The checks of one table. Uniqueness takes one grouped pass per key, shared
    by all its tests; the row checks ride on the first of those passes."""
    row = [c for c in checks if c.kind in ("not_null", "expression")]
    keyed: dict[tuple, list[Check]] = {}
    for c in checks:
        if c.kind in ("unique", "unique_combo"):
            keyed.setdefault(tuple(c.cols), []).append(c)
    if not keyed:
        return [_rows_of(df.agg(*[F.count_if(_violation(c)).alias(f"c{i}") for i, c in enumerate(row)]), row)]
    out = []
    for key, cs in keyed.items():
        groups = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(_violation(c)).alias(f"__c{i}") for i, c in enumerate(row)])
        bad = [F.count_if((F.col("__n") > 1) if c.kind == "unique_combo" else (F.col("__n") > 1) & F.col(c.cols[0]).isNotNull()) for c in cs]
        measures = [F.sum(f"__c{i}") for i in range(len(row))] + bad
        out.append(_rows_of(groups.agg(*[m.alias(f"c{i}") for i, m in enumerate(measures)]), [*row, *cs]))
        row = []
    return out


def _status(rows: DataFrame) -> DataFrame:
    return rows.withColumn("status", F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit("fail")))


def run_suite(tables: dict[str, DataFrame], checks: Sequence[Check], views: dict[str, str] | None = None,
              measured: Sequence[tuple[str, str, int]] = ()) -> DataFrame:
    """One row per check: (test_name, table_name, failures, status).

    Each table is one plan: its row-level checks are folded into one aggregate
    (a count per check), which rides on the grouped pass of its key where it has
    one. ``views`` names tables that are columns of another table's rows, row for
    row: their checks are evaluated there, without a plan of their own.
    ``measured`` are results taken while a table was written (``written``).
    """
    views = views or {}
    by_table: dict[str, list[Check]] = {}
    for c in checks:
        by_table.setdefault(views.get(c.table, c.table), []).append(c)
    parts = [p for t, cs in by_table.items() for p in _one_pass(tables[t], cs)]
    if measured:
        spark = next(iter(tables.values())).sparkSession
        parts.append(spark.createDataFrame(list(measured), "test_name string, table_name string, failures bigint"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return _status(out)


def metrics(checks: Sequence[Check]) -> list[Column]:
    """The checks as aggregates of one pass, named by position. Uniqueness needs
    the column that ``with_repeats`` adds."""
    return [F.count_if(_violation(c) if c.kind in ("not_null", "expression") else F.col("__repeat")).alias(f"c{i}")
            for i, c in enumerate(checks)]


def with_repeats(df: DataFrame, series: str, order: str) -> DataFrame:
    """``__repeat`` marks one row of every (series, order) key that occurs more than
    once. On rows that series windows hold sorted this needs no exchange or sort."""
    w = Window.partitionBy(series).orderBy(order)
    this = F.struct(order)
    again, before = F.lag(this, 1).over(w).eqNullSafe(this), F.lag(this, 2).over(w).eqNullSafe(this)
    return df.withColumn("__repeat", again & ~before)


def written(df: DataFrame, path: str, checks: Sequence[Check], series: str = "asset_id",
            order: str = "price_date") -> tuple[DataFrame, list[tuple[str, str, int]]]:
    """``df`` written once to ``path`` with its checks as metrics of the write itself:
    the stored frame and (test_name, table_name, failures) of every check.

    The metrics are taken in the write's own tasks, each of which counts once
    however often executors are lost.
    """
    seen = Observation(f"checks_{uuid.uuid4().hex[:8]}")
    if any(c.kind in ("unique", "unique_combo") and tuple(c.cols) != (series, order) for c in checks):
        raise ValueError("only the key of the series can be checked during its write")
    with_repeats(df, series, order).observe(seen, *metrics(checks)).drop("__repeat").write.parquet(path)
    got = seen.get
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    return stored, [(c.name, c.table, int(got[f"c{i}"])) for i, c in enumerate(checks)]


#: Tables whose rows the fact holds, row for row, with all their columns.
FACT_VIEWS = {"stg_prices": "fact_daily", "daily_returns": "fact_daily", "rolling_metrics": "fact_daily"}


def price_checks(table: str, prefix: str) -> list[Check]:
    """The tests declared on every price-grain table."""
    return [
        Check(f"{prefix}.not_null_asset_id", table, "not_null", ["asset_id"]),
        Check(f"{prefix}.not_null_price_date", table, "not_null", ["price_date"]),
        Check(f"{prefix}.not_null_close_usd", table, "not_null", ["close_usd"]),
        Check(f"{prefix}.close_usd_gt_0", table, "expression", expr="close_usd > 0"),
        Check(f"{prefix}.volume_usd_ge_0", table, "expression", expr="volume_usd >= 0",
              where="volume_usd is not null"),
        Check(f"{prefix}.market_cap_usd_ge_0", table, "expression", expr="market_cap_usd >= 0",
              where="market_cap_usd is not null"),
    ]


def _nulls(table: str, *cols: str) -> list[Check]:
    return [Check(f"{table}.not_null_{c}", table, "not_null", [c]) for c in cols]


def metadata_checks(table: str) -> list[Check]:
    """The tests declared on raw and staged metadata."""
    return [*_nulls(table, "asset_id", "name", "symbol"), Check(f"{table}.unique_asset_id", table, "unique", ["asset_id"])]


def declared_checks() -> list[Check]:
    """Every declared test of the pipeline's tables."""
    key = ["asset_id", "price_date"]
    return [
        *price_checks("raw_prices", "raw_prices"),
        *price_checks("stg_prices", "stg_prices"),
        *price_checks("fact_daily", "fact_daily"),
        Check("stg_prices.unique_asset_date", "stg_prices", "unique_combo", key),
        Check("fact_daily.unique_asset_date", "fact_daily", "unique_combo", key),
        Check("fact_daily.close_usd_positive", "fact_daily", "expression", expr="close_usd > 0"),
        *_nulls("daily_returns", "asset_id", "price_date", "close_usd"),
        Check("daily_returns.close_usd_gt_0", "daily_returns", "expression", expr="close_usd > 0"),
        *_nulls("rolling_metrics", "asset_id", "price_date"),
        *_nulls("weekly", "asset_id", "week_start"),
        Check("weekly.unique_asset_week", "weekly", "unique_combo", ["asset_id", "week_start"]),
        *metadata_checks("raw_metadata"),
        *metadata_checks("stg_metadata"),
        *_nulls("dim_assets", "asset_id", "name"),
        Check("dim_assets.unique_asset_id", "dim_assets", "unique", ["asset_id"]),
    ]
