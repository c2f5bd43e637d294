"""A total rank over a whole table without a one-task window."""

from __future__ import annotations

import uuid
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.session import scratch_path

#: ``monotonically_increasing_id`` counts a partition's rows in its low bits.
_INDEX_BITS = 33


def total_rank(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """``df`` with its row's position (from 1) in the total order ``order``.

    The rows are range-partitioned and sorted by ``order``, and written once to
    the shared checkpoint folder with their index in their own partition; a
    partition's offset is the sum of the counts of those before it. Only the
    counts, one number a partition, pass through the driver. Rows that are
    equal in all of ``order`` get different positions, in no fixed order, so end
    it with a key.
    """
    spark = df.sparkSession
    columns = df.columns
    row = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")         # no name can clash
    path = scratch_path(spark, f"rank-{uuid.uuid4().hex}")
    (df.repartitionByRange(*order).sortWithinPartitions(*order)
       .select(row, F.monotonically_increasing_id().alias("at")).write.parquet(path))
    placed = spark.read.parquet(path).select(
        "row", F.shiftright("at", _INDEX_BITS).alias("part"), F.col("at").bitwiseAND(F.lit((1 << _INDEX_BITS) - 1)).alias("index"))
    counts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    before = [0, *accumulate(r["n"] for r in counts)]
    offsets = spark.createDataFrame([(r["part"], b) for r, b in zip(counts, before)], "part long, before long")
    return placed.join(F.broadcast(offsets), "part").select(          # one row a partition
        (F.col("before") + F.col("index") + 1).alias(name), "row.*")
