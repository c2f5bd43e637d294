"""Layouts: series work over a bucketed copy without an exchange, few files after compaction."""

import datetime as dt
import glob

from helpers import price_rows
from pricelake.operators import features, marts, staging
from pricelake.sources import layout, sinks

D, T = dt.date, dt.datetime


def fact(spark, days=90, assets="abcde"):
    rows = [(a, D(2024, 1, 1) + dt.timedelta(days=d), 1.0 + (d + k) % 7, T(2024, 6, 1)) for k, a in enumerate(assets) for d in range(days)]
    return marts.fact_daily(staging.stage_prices(price_rows(spark, rows)))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


def test_series_work_over_a_bucketed_copy_needs_no_exchange(spark, tmp_path):
    f = fact(spark)
    table = layout.write_bucketed(f, "fact_by_asset", str(tmp_path / "b"), 4)
    weekly = marts.weekly_rollup(table)
    again = features.add_rolling(features.add_returns(table.select(*marts.RETURNS_COLUMNS[:8])))
    assert "Exchange" not in plan(weekly) and "Exchange" not in plan(again)
    assert rows_of(weekly) == rows_of(marts.weekly_rollup(f))
    assert 1 <= len(glob.glob(str(tmp_path / "b" / "*.parquet"))) <= 4
    # another session names the same files
    columns = ", ".join(f"{x.name} {x.dataType.simpleString()}" for x in f.schema)
    other = layout.attach_bucketed(spark, "fact_again", str(tmp_path / "b"), 4, columns)
    assert "Exchange" not in plan(marts.weekly_rollup(other)) and rows_of(other) == rows_of(f)
    spark.sql("DROP TABLE fact_by_asset")
    spark.sql("DROP TABLE fact_again")


def test_month_partitions_and_compaction(spark, tmp_path):
    f, p, q = fact(spark), str(tmp_path / "m"), str(tmp_path / "d")
    assert layout.write_months(f, p) == 450
    assert sorted(x.rsplit("=", 1)[1] for x in glob.glob(f"{p}/price_month=*")) == ["2024-01-01", "2024-02-01", "2024-03-01"]
    march = spark.read.parquet(p).filter("price_month = date'2024-03-01'")
    assert "PartitionFilters: [isnotnull(price_month" in plan(march) and march.count() == 150
    for k in range(6):                                  # six deliveries into each of a few dates, one into another
        sinks.write_table(f.filter("asset_id in ('a', 'b') and day(price_date) <= 3 and month(price_date) = 1"), q, "append", ["price_date"])
    sinks.write_table(f.filter("price_date = date'2024-02-05'"), q, "append", ["price_date"])
    before = rows_of(spark.read.parquet(q).select(*marts.FACT_COLUMNS))
    kept = glob.glob(f"{q}/price_date=2024-02-05/*.parquet")
    assert layout.compact(spark, q, "price_date") == 3
    assert rows_of(spark.read.parquet(q).select(*marts.FACT_COLUMNS)) == before
    assert len(glob.glob(f"{q}/price_date=2024-01-0*/*.parquet")) <= 6 and glob.glob(f"{q}/price_date=2024-02-05/*.parquet") == kept
    assert layout.compact(spark, q, "price_date") == 0
