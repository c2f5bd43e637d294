"""Plan checks: shuffle count of the main chain, pushdown, no Python UDF,
and the driver contract."""

import pytest

from helpers import SF001
from pricelake.operators import marts, staging
from pricelake.plans import incremental
from pricelake.sources import fixtures as fx


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_aqe(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_chain_has_two_exchanges(no_aqe):
    spark = no_aqe
    staged = staging.stage_prices(fx.f1_raw_prices(spark, SF001), tiebreak=fx.F1_TIEBREAK)
    weekly = marts.weekly_rollup(marts.fact_daily(staged))
    p = plan_text(weekly)
    assert p.count("Exchange hashpartitioning") == 2, p
    # the copies are cut map-side, before the first shuffle
    assert "row_number(), 1, Partial" in p
    # lag and all rolling frames share one sort (the other two serve the top-1)
    import re
    window_sorts = re.findall(r"Sort \[asset_id#\d+ ASC NULLS FIRST, price_date#\d+ ASC NULLS "
                              r"FIRST\], false", p)
    assert len(window_sorts) == 1 and p.count("Sort [") == 3
    assert p.count("Sort [__key_hash") == 2          # the top-1 compares hashes first, not texts of one prefix


def wide_exchanges(df):
    """The rows of the fact that its exchanges carry: those with all price columns."""
    import re
    nodes = [n.split("\n") for n in re.split(r"\n(?=\(\d+\) )", df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))]
    return [n[0] for n in nodes if re.match(r"\(\d+\) Exchange", n[0]) and "volume_usd" in n[1]]


def test_split_path_exchanges_the_rows_three_times(no_aqe):
    """Staging, segments, chunks; rows without an asset are few."""
    staged = staging.stage_prices(fx.f1_raw_prices(no_aqe, SF001), tiebreak=fx.F1_TIEBREAK)
    keyed = staged.filter("asset_id IS NOT NULL")
    fact = marts.fact_daily(keyed, hot_rows=300, chunk_rows=100, segment_days=64)
    assert len(wide_exchanges(fact)) - len(wide_exchanges(marts.fact_daily(keyed))) == 3, plan_text(fact)


def test_incremental_reads_the_computed_target_once(no_aqe):
    staged = staging.stage_prices(fx.f1_raw_prices(no_aqe, SF001), tiebreak=fx.F1_TIEBREAK)
    stored = marts.fact_daily(staged.filter("price_date <= DATE '2001-06-30'"))
    inc = incremental.incremental_features(stored, staged.filter("price_date >= DATE '2001-03-01'"))
    assert len(wide_exchanges(inc)) <= 7, plan_text(inc)


def test_stored_target_is_read_without_an_exchange(no_aqe):
    from __spark_entry__ import queries
    df = queries()["q_incremental_features"](no_aqe, SF001)
    assert len(wide_exchanges(df)) == 2, plan_text(df)      # the replaced rows' join, the features' windows


def test_filters_pushed_and_columns_pruned(no_aqe):
    spark = no_aqe
    staged = staging.stage_prices(fx.f1_raw_prices(spark, SF001), tiebreak=fx.F1_TIEBREAK)
    p = plan_text(staged.select("asset_id", "close_usd"))
    assert "PushedFilters: [IsNotNull(l_extendedprice), GreaterThan(l_extendedprice,0.0)]" in p
    assert "l_tax" not in p.split("ReadSchema:")[1].split("\n")[0]


def test_no_python_udf_anywhere(spark):
    from __spark_entry__ import queries
    for name, q in queries().items():
        if not name.startswith("q_") or name.startswith("q_stream_"):   # the others run jobs to plan
            continue
        p = plan_text(q(spark, SF001))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_entry_smoke(spark):
    from __spark_entry__ import entry, oracle_sql, queries
    df = entry(spark)
    assert df.count() > 0
    assert set(oracle_sql()) <= set(queries())


def test_weekly_bounds_by_window_equal_fast_path(spark):
    staged = staging.stage_prices(fx.f1_raw_prices(spark, SF001), tiebreak=fx.F1_TIEBREAK)
    fact = marts.fact_daily(staged)
    a = marts.weekly_open_close(fact)
    b = marts.weekly_open_close(fact, method="window")
    diff = a.exceptAll(b.select(*a.columns))
    assert diff.count() == 0 and a.count() == b.count()


def test_results_do_not_depend_on_session_time_zone(spark):
    from __spark_entry__ import queries
    names = ["q_parse_market_chart", "q_merge_ohlc", "q_dq_freshness", "q_stage_metadata",
             "q_batch_stamp", "q_fact_daily"]
    qs = queries()

    def rows(session, name):
        return sorted(map(repr, qs[name](session, SF001).collect()))
    base = {n: rows(spark, n) for n in names}
    other = spark.newSession()          # own conf, own plan caches
    other.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    shifted = {n: rows(other, n) for n in names}
    for n in names:
        assert base[n] == shifted[n], n


def test_upsert_scans_only_the_batch_dates(spark, tmp_path):
    import datetime as dt

    from helpers import price_rows
    from pricelake.sources import sinks
    path = str(tmp_path / "t")
    days = [(f"a{k}", dt.date(2024, 1, d), 1.0, dt.datetime(2024, 1, d, 6)) for k in range(2) for d in range(1, 29)]
    staging.stage_prices(price_rows(spark, days)).write.partitionBy("price_date").parquet(path)
    batch = staging.stage_prices(price_rows(spark, [("a0", dt.date(2024, 1, 28), 2.0, dt.datetime(2024, 1, 29))]))
    assert sinks.upsert_table(spark, path, batch.select(*spark.read.parquet(path).columns), ["asset_id", "price_date"]) == 2
    bounds = {"lo": dt.date(2024, 1, 28), "hi": dt.date(2024, 1, 28)}
    scan = plan_text(sinks.within(spark.read.parquet(path), "price_date", bounds))
    assert "PartitionFilters: [isnotnull(price_date" in scan and "2024-01-28" in scan


def test_plans_have_one_shape_at_both_sizes(no_aqe):
    import re
    for q in ("q_stage_prices", "q_volume_series", "q_rebased_index"):
        from __spark_entry__ import queries
        shapes = []
        for sf in (SF001, "/root/testdata/sf0.1"):
            p = plan_text(queries()[q](no_aqe, sf))
            shapes.append(re.findall(r"(Exchange|Window|SortMergeJoin|FileScan)\b", p))
        assert shapes[0] == shapes[1], q
        if q != "q_stage_prices":
            assert shapes[0].count("FileScan") == 1, q


def test_a_cluster_must_name_a_shared_folder(monkeypatch):
    from pricelake import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
