"""Physical layouts of stored tables: bucketed copies, month partitions, compaction.

The daily fact is partitioned by date, which suits the daily upsert and lookbacks.
Work on whole series wants the rows of an asset together instead: a bucketed copy
is hash-dealt by asset and sorted by date, so series windows and the weekly
roll-up over it need no exchange. Month partitions hold few files where daily ones
would be tiny. Appends leave many small files in a partition; ``compact`` rewrites
those partitions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.sources import sinks


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, key: str = "asset_id",
                   order: str = "price_date") -> DataFrame:
    """``df`` as the catalog table ``table`` at ``path``, in ``buckets`` by ``key``, each
    one file sorted by (key, order). Returns the table."""
    spark = df.sparkSession
    # dealt by the hash that buckets use, so that a task writes one file per bucket
    dealt = df.repartition(buckets, key).sortWithinPartitions(key, order)
    dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key, order).saveAsTable(table)
    return spark.table(table)


def attach_bucketed(spark: SparkSession, table: str, path: str, buckets: int, columns: str,
                    key: str = "asset_id", order: str = "price_date") -> DataFrame:
    """Name the files that ``write_bucketed`` has left at ``path`` in this session's
    catalog (one without a shared metastore forgets them); ``columns`` as in DDL."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
              f"CLUSTERED BY ({key}) SORTED BY ({key}, {order}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)


def with_month(df: DataFrame, col: str = "price_date", month: str = "price_month") -> DataFrame:
    """``df`` with the first day of its month, the partition column of month tables."""
    return df.withColumn(month, F.trunc(col, "month"))


def write_months(df: DataFrame, path: str, col: str = "price_date", sort_within: Sequence[str] = ("asset_id", "price_date"),
                 mode: str = "overwrite") -> int:
    """``df`` partitioned by the month of ``col``; small months share a task, a month
    that holds most rows is split over several. ``mode="overwrite_partitions"``
    replaces the months in ``df``."""
    return sinks.write_table(with_month(df, col), path, mode, ["price_month"], sort_within)


def file_counts(spark: SparkSession, path: str, partition_col: str) -> DataFrame:
    """(partition, files): from the files' names alone."""
    files = spark.read.parquet(path).select(partition_col, F.col("_metadata.file_path").alias("f")).distinct()
    return files.groupBy(partition_col).agg(F.count(F.lit(1)).alias("files"))


def compact(spark: SparkSession, path: str, partition_col: str, max_files: int = 4,
            sort_within: Sequence[str] = ("asset_id",)) -> int:
    """Rewrite the partitions that hold more than ``max_files`` files into as few as
    the write needs; returns how many partitions were rewritten. The rows are staged
    first, so a lost job leaves either the old files or the new ones to do again."""
    many = sinks.staged_copy(spark, file_counts(spark, path, partition_col).filter(F.col("files") > max_files), "compact-list")
    n = many.count()
    if n:
        table = spark.read.parquet(path)
        rows = table.join(many.select(partition_col), partition_col, "left_semi").select(*table.columns)
        sinks.write_table(sinks.staged_copy(spark, rows, "compact"), path, "overwrite_partitions", [partition_col], sort_within, guard_empty=False)
    return n
