import random

import pytest
from pyspark.sql import functions as F

from pricelake.operators import serving
from pricelake.operators.ranking import total_rank


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_total_rank_equals_brute_force(spark, n):
    """Ties, NULLs (a third of all rows), and column names that clash."""
    r = random.Random(n)
    rows = [(f"a{k:05d}", r.choice([None, 1.0, 2.0, float(r.randint(0, 50))]), r.random(), k) for k in range(n)]
    df = spark.createDataFrame(rows, "asset_id string, cap double, part double, row long").repartition(7)
    got = total_rank(df, [F.col("cap").desc_nulls_last(), F.col("asset_id")])
    want = sorted(rows, key=lambda x: (x[1] is None, -(x[1] or 0), x[0]))
    assert sorted(tuple(x) for x in got.collect()) == [(k, *x) for k, x in enumerate(want, 1)]
    plan = got._jdf.queryExecution().toString()
    assert "Window" not in plan and "SinglePartition" not in plan


def test_positions_show_every_row(spark):
    df = spark.createDataFrame([("b", None), ("a", 2.0), ("c", 5.0), ("d", None), ("e", 2.0)], "asset_id string, cap double")
    got = sorted((r.position, r.asset_id) for r in serving.positions(df, "cap").collect())
    assert got == [(1, "c"), (2, "a"), (3, "e"), (4, "b"), (5, "d")]
